"""Quality rules: fixed limits, then robust multivariate outliers; DataFrame functions only.

Documents that pass the fixed limits are turned into vectors of transformed statistics. For each
language and source, a minimum-covariance-determinant estimate (the mean and covariance of the
half of the documents that lie closest together) is found by concentration steps from medians and
median deviations, all of which survive nearly half of bad rows, copies of one text among them. A
document is rejected when its Mahalanobis distance to the estimate of its group exceeds a
chi-squared limit.

Scale: texts are read once and never shuffled. The statistics (some 100 bytes a document) are
stored; a concentration step is one aggregation of them into at most ``BINS`` rows a group, with
exact integer sums, so that a large group is pre-aggregated where it lies and reruns agree.

Defined results: NULL text has no words and fails the limits. NULL language or source is a group
of its own. A group with fewer than ``LEAST`` documents is judged by its language, and a small
language by all documents; below ``LEAST`` documents in all, nothing is rejected. Repeated rows are
judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import WORD, fresh, let, stored, words

SYMBOLS = "[^#*$%&|<>]+"
FEWEST_WORDS = 50
REPEATED_PERCENT = 50
#: Documents needed for an estimate of a group's own.
LEAST = 60
#: Share of a group that the estimate rests on, and the number of concentration steps.
SHARE, STEPS = 0.5, 8
#: Statistics are kept as integers of this fraction, so that sums are exact.
UNIT = 1 << 12
#: Distances are sorted into this many steps per factor of two, from 2**-16 to 2**48.
FINE = 16
BINS = 64 * FINE
#: Smallest deviation of each statistic; statistics that are mostly zero have no spread of their own.
#: Where clean documents repeat nothing, "repeats" alone passes the limit from a quarter of the words on.
FLOORS = {"size": 0.25, "length": 0.05, "symbols": 0.2, "lines": 0.18, "repeats": 0.18}
NAMES = list(FLOORS)
#: Chi-squared with five degrees of freedom: its median, the factor that makes the covariance of
#: the closest half consistent, and its limit at one in 10**4.
MEDIAN, CONSISTENT, LIMIT = 4.3515, 1.9122, 25.745


def repeated_words(tokens: Column) -> Column:
    """Words inside any 3-word window that occurs twice or more among ``tokens``."""

    def marks(sorted_windows: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return F.coalesce(F.get(sorted_windows, a)["h"] == F.get(sorted_windows, b)["h"], F.lit(False))

        places = F.sequence(F.lit(0), F.size(sorted_windows) - 1)
        twice = F.filter(places, lambda j: same(j, j - 1) | same(j, j + 1))
        return F.sort_array(F.transform(twice, lambda j: F.get(sorted_windows, j)["p"]))

    def covered(starts: Column) -> Column:
        later = F.sequence(F.lit(1), F.size(starts) - 1)
        gaps = F.when(
            F.size(starts) > 1,
            F.aggregate(
                later, F.lit(0), lambda n, j: n + F.least(F.lit(3), F.get(starts, j) - F.get(starts, j - 1))
            ),
        ).otherwise(0)
        return F.when(F.size(starts) == 0, 0).otherwise(gaps + 3)

    def windows(ts: Column) -> Column:
        def window(i: Column) -> Column:
            return F.struct(
                F.xxhash64(F.get(ts, i), F.get(ts, i + 1), F.get(ts, i + 2)).alias("h"), i.alias("p")
            )

        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(ts) - 3), window))

    count = let(tokens, lambda ts: let(let(windows(ts), marks), covered))
    return F.when(F.size(tokens) < 4, 0).otherwise(count).cast("bigint")


def statistics(text: Column, tokens: Column) -> dict[str, Column]:
    """The counted statistics of a text whose words are ``tokens``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return {
        "n_words": F.size(tokens).cast("bigint"),
        "word_chars": F.char_length(F.array_join(tokens, "")).cast("bigint"),
        "n_symbols": F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint"),
        "n_dup_lines": let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint"),
        "n_repeat_words": repeated_words(tokens),
    }


def vectors(s: Column) -> dict[str, Column]:
    """Transformed statistics in integers of 1/``UNIT``; ``s`` must hold words."""
    n, chars = s["n_words"], s["word_chars"]
    values = {
        "size": F.log(n),
        "length": F.log(chars / n),
        "symbols": F.log1p(100 * s["n_symbols"] / chars),
        "lines": F.log1p(100 * s["n_dup_lines"] / n),
        "repeats": F.log1p(10 * s["n_repeat_words"] / n),
    }
    return {name: F.round(value * UNIT).cast("bigint") for name, value in values.items()}


def measured(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, str, str]:
    """``carry`` and a struct of statistics, group, base verdict and vector of each row, stored;
    the name of that column, and one more name that is free."""
    tokens, stats, free = fresh(docs, "tokens", "s", "by")
    rows = docs.withColumn(tokens, words(F.col("text")))
    counted = rows.select(
        *carry,
        F.struct(
            F.col("lang").alias("lang"),
            F.col("source").alias("source"),
            *[c.alias(n) for n, c in statistics(F.col("text"), F.col(tokens)).items()],
        ).alias(stats),
    )
    s = F.col(stats)
    failed = (s["n_words"] < FEWEST_WORDS) | (
        100 * s["n_repeat_words"] > REPEATED_PERCENT * s["n_words"]
    )
    vector = [F.when(~failed, value).alias(name) for name, value in vectors(s).items()]
    full = s.withField("base_failed", failed).withField("x", F.struct(*vector))
    return stored(counted.withColumn(stats, full), "statistics"), stats, free


def group_name(level: int, *parts: Column) -> Column:
    """A text for a group; NULL and the text of it differ."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *[p.alias(f"p{i}") for i, p in enumerate(parts)]))


def assigned(passed: DataFrame) -> DataFrame:
    """``lang, source, judge``: the group by which each language and source is judged, stored."""
    sizes = stored(passed.groupBy("s.lang", "s.source").agg(F.count("*").alias("n")), "sizes")
    langs = sizes.groupBy(F.col("lang").alias("same")).agg(F.sum("n").alias("n_lang"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    judged = (
        F.when(F.col("n") >= LEAST, group_name(0, F.col("lang"), F.col("source")))
        .when(F.col("n_lang") >= LEAST, group_name(1, F.col("lang")))
        .when(F.lit(total >= LEAST), group_name(2))
    )
    return stored(
        sizes.join(langs, F.col("lang").eqNullSafe(F.col("same"))).select(
            "lang", "source", judged.alias("judge")
        ),
        "judges",
    )


def medians(members: DataFrame) -> DataFrame:
    """The median of each statistic in each group."""
    middle = [F.floor(F.percentile(name, F.lit(0.5))).alias(f"c_{name}") for name in NAMES]
    return stored(members.groupBy("group").agg(*middle), "medians")


def starts(centred: DataFrame, centres: DataFrame) -> DataFrame:
    """Medians, and a diagonal scale from the median deviations, of each group."""
    spread = {n: F.percentile(F.abs(n), F.lit(0.5)) / (0.6745 * UNIT) for n in NAMES}
    scale = [F.greatest(value, F.lit(FLOORS[name])).alias(f"l_{i}{i}") for i, (name, value) in enumerate(spread.items())]
    zero = [F.lit(0.0).alias(f"l_{i}{j}") for i in range(len(NAMES)) for j in range(i)]
    means = [F.lit(0.0).alias(f"m_{name}") for name in NAMES]
    spreads = centred.groupBy("group").agg(*scale)
    return stored(spreads.select("*", *means, *zero).join(centres, "group"), "starts")


def distance(x: dict[str, Column], at: Callable[[str], Column] = F.col) -> Column:
    """Squared Mahalanobis distance of centred ``x`` from the means ``m_*`` by the root ``l_*``."""

    def solve(i: int, solved: list[Column]) -> Column:
        if i == len(NAMES):
            return reduce(Column.__add__, [y * y for y in solved])
        rest = x[NAMES[i]] / UNIT - at(f"m_{NAMES[i]}")
        for j, y in enumerate(solved):
            rest = rest - at(f"l_{i}{j}") * y
        return let(rest / at(f"l_{i}{i}"), lambda y: solve(i + 1, [*solved, y]))

    return solve(0, [])


def binned(square: Column) -> Column:
    step = F.floor(F.log2(F.greatest(square, F.lit(2.0**-16))) * FINE) + 16 * FINE
    return F.least(step, F.lit(BINS - 1)).cast("int")


def by_bin(rows: DataFrame, *measures: Column) -> DataFrame:
    """Aggregates of each group and bin, shuffled by both: a large group is spread over its bins."""
    both = rows.withColumn("both", F.struct("group", "bin")).groupBy("both").agg(*measures)
    return both.select("both.*", *both.columns[1:])


def up_to(bins: DataFrame, share: float) -> DataFrame:
    """The lowest bins of each group that together hold ``share`` of its rows."""
    group = Window.partitionBy("group")
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return (
        bins.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("_all", F.sum("n").over(group))
        .where(F.col("_before") < share * F.col("_all"))
    )


def concentrated(members: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step: mean and covariance root of the closest rows of each group."""
    pairs = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
    at = members.join(estimate, "group").withColumn("bin", binned(distance({n: F.col(n) for n in NAMES})))
    bins = by_bin(
        at,
        F.count("*").alias("n"),
        *[F.sum(n).alias(f"s_{i}") for i, n in enumerate(NAMES)],
        *[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s_{i}{j}") for i, j in pairs],
    )
    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).cast("double")
    sums = up_to(bins, SHARE).groupBy("group").agg(
        F.sum("n").alias("n"),
        *[exact(f"s_{i}").alias(f"s_{i}") for i in range(len(NAMES))],
        *[exact(f"s_{i}{j}").alias(f"s_{i}{j}") for i, j in pairs],
    )
    table = sums.withColumns({f"m_{n}": F.col(f"s_{i}") / F.col("n") / UNIT for i, n in enumerate(NAMES)})
    table = table.withColumns(
        {
            f"v_{i}{j}": F.col(f"s_{i}{j}") / F.col("n") / UNIT**2
            - F.col(f"m_{NAMES[i]}") * F.col(f"m_{NAMES[j]}")
            + F.lit(FLOORS[NAMES[i]] ** 2 if i == j else 0.0)
            for i, j in pairs
        }
    )
    for i, j in pairs:
        inner = [F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)]
        rest = reduce(Column.__sub__, inner, F.col(f"v_{i}{j}"))
        table = table.withColumn(f"l_{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}{j}"))
    keep = [f"m_{n}" for n in NAMES] + [f"l_{i}{j}" for i, j in pairs]
    centres = estimate.select("group", *[f"c_{n}" for n in NAMES])
    return stored(table.select("group", *keep).join(centres, "group"), "estimate")


def estimates(passed: DataFrame, judges: DataFrame) -> DataFrame:
    """The estimate of every group that judges any document, with its scale."""
    needed = judges.select(F.col("judge").alias("group")).distinct().where("group IS NOT NULL")
    s = F.col("s")
    names = F.array(group_name(0, s["lang"], s["source"]), group_name(1, s["lang"]), group_name(2))
    rows = passed.select(F.explode(names).alias("group"), "s.x.*").join(needed, "group", "left_semi")
    members = stored(rows, "members")
    centres = medians(members)
    members = stored(
        members.join(centres, "group").select("group", *[(F.col(n) - F.col(f"c_{n}")).alias(n) for n in NAMES]),
        "centred",
    )
    estimate = starts(members, centres)
    for _ in range(STEPS):
        estimate = concentrated(members, estimate)
    at = members.join(estimate, "group").withColumn("bin", binned(distance({n: F.col(n) for n in NAMES})))
    half = up_to(by_bin(at, F.count("*").alias("n")), 0.5)
    middle = half.groupBy("group").agg(F.pow(F.lit(2.0), (F.max("bin") + 1) / FINE - 16).alias("middle"))
    scale = F.greatest(F.lit(CONSISTENT), F.col("middle") / MEDIAN)
    return stored(estimate.join(middle, "group").withColumn("scale", scale), "estimates")


def judged(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, str]:
    """``carry`` of every row and, in a column whose name is returned too, a struct of its
    statistics, ``base_failed``, the scaled squared ``distance`` (NULL if not judged) and ``kept``.

    ``docs`` needs the columns ``text, lang, source``.
    """
    rows, stats, by = measured(docs, carry)
    s = F.col(stats)
    passed = rows.where(~s["base_failed"]).select(s.alias("s"))
    judges = assigned(passed)
    found = estimates(passed, judges)
    limits = judges.join(found, F.col("judge") == F.col("group"), "left")
    limits = stored(limits.select(F.struct("*").alias(by)), "limits")
    limit = F.col(by)
    same = s["lang"].eqNullSafe(limit["lang"]) & s["source"].eqNullSafe(limit["source"])
    x = {n: s["x"][n] - limit[f"c_{n}"] for n in NAMES}
    away = F.when(~s["base_failed"], distance(x, lambda name: limit[name]) / limit["scale"])
    result = s.withField("distance", away)
    kept = ~s["base_failed"] & F.coalesce(F.col(stats)["distance"] <= LIMIT, F.lit(True))
    joined = rows.join(limits, same, "left").withColumn(stats, result)
    return joined.select(*carry, F.col(stats).withField("kept", kept).alias(stats)), stats


def rate(docs: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``kept`` and ``distance`` of every document."""
    rows, s = judged(docs.select("doc_id", "text", "lang", "source"), ["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *[f"{s}.{n}" for n in [*counts, "base_failed", "kept", "distance"]])


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows."""
    rows, s = judged(docs, docs.columns)
    return rows.where(F.col(s)["kept"]).select(docs.columns)
