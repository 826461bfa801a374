"""Licence scan by ordered signature rules; DataFrame functions only.

A text becomes its words (A-Z in lower case, everything in ASCII but letters and digits separates) with
one blank between. Two keywords of every rule are looked up among the words first, so that the rule's
expression runs on few texts. A rule that matches marks the first and last word of every match, and the
marks' places among the words are the detection's interval. A detection is suppressed when a detection
of the same or a higher priority (``license_rules``) contains its interval; of equal intervals and
priorities the earlier rule stays. Phrases that always count are detected by rules too, but counted
before suppression, and their labels stay.

Scale: texts are read once and never shuffled; all expressions run where the row lies. Detections,
some dozens of bytes each, are stored, and suppression is a running maximum per document over them, in
order of their starts: no pairs are built, however many detections a text has.

Defined results: NULL text has no words. Repeated rows, and rows without an id, are scanned each on
their own. A document without a detection has empty labels and a score of 0. An empty table gives an
empty result. Other columns play no part.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import let, stored
from tillflow.llm.exact import lower_ascii
from tillflow.llm.license_rules import rules

#: All of ASCII but letters and digits; runs of anything else are words (after A-Z became a-z).
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks around a match; they can't occur in words.
FIRST, LAST = "\x01", "\x02"
#: How sure a detection of each priority is.
SURE = {1: 0.5, 2: 0.8, 3: 0.95, 4: 1.0}

TABLE = "array<struct<rule:int,label:string,priority:int,one:string,two:string,expression:string,base:boolean>>"


def rule_table() -> Column:
    """The rules as one constant array."""
    rows = [
        {"rule": r.number, "label": r.label, "priority": r.priority, "one": r.keywords[0],
         "two": r.keywords[1], "expression": f" ({r.expression})(?= )", "base": r.base}
        for r in rules()
    ]
    return F.from_json(F.lit(json.dumps(rows)), TABLE)


def spaced(text: Column) -> Column:
    """The words of a text with one blank before, between and after; one blank if there are none."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(lower_ascii(text), F.lit(" ")), BREAKS, " ")))


def places(parts: Column, mark: str, at_end: bool) -> Column:
    """The numbers of the words that carry a mark."""
    has = (lambda w: F.endswith(w, F.lit(mark))) if at_end else (lambda w: F.startswith(w, F.lit(mark)))
    found = F.transform(parts, lambda w, i: F.when(has(w), i - 1))
    return F.filter(found, lambda i: i.isNotNull())


def matches(words: Column, rule: Column) -> Column:
    """``rule, label, priority, base, start, end`` of every match of one rule; ``end`` is its last word."""
    marked = F.regexp_replace(words, rule["expression"], F.lit(f" {FIRST}$1{LAST}"))

    def located(text: Column) -> Column:
        pairs = let(
            F.split(text, " "),
            lambda parts: F.arrays_zip(
                places(parts, FIRST, False).alias("start"), places(parts, LAST, True).alias("end")
            ),
        )
        return F.when(F.contains(text, F.lit(FIRST)), pairs)

    return F.transform(
        F.coalesce(let(marked, located), F.array().cast("array<struct<start:int,end:int>>")),
        lambda p: F.struct(
            rule["rule"].alias("rule"), rule["label"].alias("label"), rule["priority"].alias("priority"),
            rule["base"].alias("base"), p["start"].alias("start"), p["end"].alias("end"),
        ),
    )


def detected(words: Column) -> Column:
    """All matches of all rules whose keywords occur among the words."""
    table = rules()
    known = F.array(*[F.lit(k) for k in sorted({k for r in table for k in r.keywords})])

    def run(present: Column) -> Column:
        gated = F.filter(
            rule_table(), lambda r: F.array_contains(present, r["one"]) & F.array_contains(present, r["two"])
        )
        return F.flatten(F.transform(gated, lambda r: matches(words, r)))

    return let(F.array_intersect(known, F.split(words, " ")), run)


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row, doc_id, n_words, found`` of every document, stored; ``row`` tells rows apart."""
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        spaced(F.col(text_column)).alias("words"),
    )
    found = words.select(
        "row",
        "doc_id",
        (F.char_length("words") - F.char_length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) - 1)
        .cast("bigint")
        .alias("n_words"),
        detected(F.col("words")).alias("found"),
    )
    return stored(found, "license-matches")


def detections(scan: DataFrame) -> DataFrame:
    """``row, rule, label, priority, base, start, end, kept`` of every match in ``scanned`` rows.

    In order of starts, longer and better ones first, all that may contain a detection come before it;
    it is suppressed if one of its priority or better reaches at least to its end.
    """
    rows = scan.select("row", F.explode("found").alias("d")).select("row", "d.*")
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.lit(None).cast("int")
    for priority in SURE:
        reach = F.max(F.when(F.col("priority") >= priority, F.col("end"))).over(before)
        reached = F.when(F.col("priority") == priority, reach).otherwise(reached)
    return rows.withColumn("kept", F.coalesce(reached < F.col("end"), F.lit(True)))


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    scan = scanned(docs, id_column, text_column)
    base = F.filter("found", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"].cast("bigint"))
    rows = scan.select(
        "row",
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda d: d["label"])).alias("base_labels"),
    )
    sure = F.lit(0.0)
    for priority, value in SURE.items():
        sure = F.when(F.col("priority") == priority, value).otherwise(sure)
    seen = detections(scan).where("kept OR base").groupBy(F.col("row").alias("seen")).agg(
        joined(F.collect_set("label")).alias("labels"), F.max(F.when(F.col("kept"), sure)).alias("score")
    )
    columns = [c for c in rows.columns if c != "row"]
    return rows.join(seen, F.col("row") == F.col("seen"), "left").select(
        *columns, F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
