"""Quality rules, language identification, resampling and the mix against plain Python."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tillflow.llm import langid, mixing, outliers, resampling

FOLDER = "/root/testdata/sf0.001"


# --- quality rules ----------------------------------------------------------------------


def test_statistics_and_limits(spark):
    got = {(r.doc_id, r.n_words, r.word_chars): r for r in outliers.rate(cases.frame(spark)).collect()}
    assert len(outliers.rate(cases.frame(spark)).collect()) == len(cases.rows())
    for row in cases.rows():
        want = cases.counted(row[1])
        r = got[(row[0], want["n_words"], want["word_chars"])]
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r.base_failed == failed
        assert not (failed and r.kept)


def sources(spark, clean=220, junk=12):
    """Two sources of differing style, a source too small to judge by itself, and junk."""
    out = []
    for k in range(clean):
        out.append((k, cases.prose(k, 60 + k), "en", "long" if k % 2 else "short", 1))
    for k in range(clean, clean + 8):
        out.append((k, cases.prose(k, 90), "en", None, 1))
    for k in range(1000, 1000 + junk):
        marks = " ".join(w + "###" for w in cases.prose(k, 150).split())
        out.append((k, marks, "en", "long" if k % 2 else None, 1))
    return [(*r, *["clash"] * len(cases.CLASHING)) for r in out]


def test_outliers_go_and_clean_documents_stay(spark):
    docs = cases.frame(spark, sources(spark))
    rated = {r.doc_id: r for r in outliers.rate(docs).collect()}
    assert all(r.kept for i, r in rated.items() if i < 1000)
    assert not any(r.kept for i, r in rated.items() if i >= 1000)
    left = outliers.keep_good(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in rated.items() if r.kept}


def test_estimates_against_numpy(spark):
    """The last concentration step's mean and root, recomputed from the stored statistics."""
    docs = cases.frame(spark, sources(spark, 300, 20)).where("source = 'long'")
    rows, s, _ = outliers.measured(docs, ["doc_id"])
    passed = rows.where(~F.col(s)["base_failed"]).select(F.col(s).alias("s"))
    judges = outliers.assigned(passed)
    found = outliers.estimates(passed, judges).where("group LIKE '%long%'").first()
    x = np.array([[r[n] for n in outliers.NAMES] for r in passed.select("s.x.*").collect()]) / outliers.UNIT
    centre = np.floor(np.median(x, axis=0) * outliers.UNIT) / outliers.UNIT
    quarter = np.quantile(x, [0.25, 0.75], axis=0)
    floors = np.array(list(outliers.FLOORS.values()))
    mean, root = np.zeros(5), np.diag(np.maximum((quarter[1] - quarter[0]) / 1.349, floors))
    for _ in range(outliers.STEPS):
        d = (np.linalg.solve(root, (x - centre - mean).T) ** 2).sum(axis=0)
        bins = np.clip(np.floor(np.log2(np.maximum(d, 2.0**-16)) * outliers.FINE) + 16 * outliers.FINE, 0, outliers.BINS - 1)
        order = np.sort(np.unique(bins))
        before = np.array([(bins < b).sum() for b in order])
        near = x[np.isin(bins, order[before < outliers.SHARE * len(x)])] - centre
        mean = near.mean(axis=0)
        root = np.linalg.cholesky(np.cov(near.T, bias=True) + np.diag(floors**2))
    assert np.allclose([found[f"m_{n}"] for n in outliers.NAMES], mean)
    got = np.array([[found[f"l_{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
    assert np.allclose(got, root)


def test_a_third_of_junk_copies(spark):
    """Copies of one junk text in a third of a group, and other junk like it, are rejected."""
    marks = lambda k, n: " ".join(w + "###" for w in cases.prose(k, n).split())
    data = [(k, cases.prose(k, 60 + k), "en", "a", 1) for k in range(200)]
    data += [(k, marks(7, 150), "en", "a", 1) for k in range(1000, 1100)]
    data += [(k, marks(k, 100 + k % 90), "en", "a", 1) for k in range(2000, 2020)]
    docs = cases.frame(spark, [(*r, *["clash"] * len(cases.CLASHING)) for r in data])
    rated = outliers.rate(docs).collect()
    assert not any(r.base_failed for r in rated)
    assert {r.doc_id for r in rated if r.kept} == set(range(200))


def repeating(seed: int, words: int, percent: int, mark: str) -> str:
    """Prose of which ten-word passages, each there twice, make up ``percent`` of the words."""
    twice, lines = round(words * percent / 2000), [cases.prose(1000 * seed + k, 10) for k in range(words // 10)]
    return mark.join([*lines[: len(lines) - twice], *lines[:twice]])


def test_repeated_words_are_rejected(spark):
    """30-50% of repeated words, in lines or not, among clean documents of several lengths."""
    data = [(k, repeating(k, 60 + 10 * (k % 60), 0, "\n "[k % 2]), "en", "a", 1) for k in range(300)]
    data += [(1000 + k, repeating(400 + k, 400, 5, "\n "[k % 2]), "en", "a", 1) for k in range(10)]
    data += [(2000 + k, repeating(500 + k, 200 + 40 * (k % 8), 30 + k, "\n "[k % 2]), "en", "a", 1) for k in range(20)]
    docs = cases.frame(spark, [(*r, *["clash"] * len(cases.CLASHING)) for r in data])
    rated = outliers.rate(docs).collect()
    bad = [r for r in rated if r.doc_id >= 2000]
    assert all(not r.base_failed and 0.28 < r.n_repeat_words / r.n_words <= 0.5 for r in bad)
    assert {r.doc_id for r in rated if r.kept} == {r[0] for r in data if r[0] < 2000}


def test_rules_on_little(spark):
    empty = cases.frame(spark, [])
    assert outliers.rate(empty).count() == 0
    few = cases.frame(spark, sources(spark)[:20])
    assert all(r.kept and r.distance is None for r in outliers.rate(few).collect())


# --- language identification --------------------------------------------------------------


def languages(count=60):
    letters = {"aa": "aeioulmn", "bb": "aeszktrp", "cc": "ñúéàlmso"}
    out = []
    for k in range(3 * count):
        lang = list(letters)[k % 3]
        out.append((k, cases.prose(k, 40, letters[lang]), lang, "a", 1))
    out += [(900, None, "aa", "a", 1), (901, "12 34 !?", "aa", "a", 1), (902, "", "bb", "a", 1)]
    out += [(903, cases.prose(7, 30, letters["bb"]), None, "a", 1), (None, cases.prose(8, 30, letters["cc"]), "cc", "a", 1)]
    return [(*r, *["clash"] * len(cases.CLASHING)) for r in out]


def test_languages_are_told_apart(spark):
    data = languages()
    got = langid.identify(cases.frame(spark, data)).collect()
    assert len(got) == len(data)
    truth = {r[0]: r[2] for r in data}
    for r in got:
        if r.doc_id is not None and r.doc_id < 900:
            assert r.lang_pred == truth[r.doc_id] and not r.rejected
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].lang_pred for k in (900, 901, 902, 903, None)] == ["und", "und", "und", "bb", "cc"]
    assert by_id[901].score == 0 and by_id[901].rejected


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = rows[rows.held_out]
    assert len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.97


def test_prediction_does_not_see_the_labels(spark):
    """Held-out labels, sources and the neighbours in a batch change nothing."""
    docs = cases.frame(spark, languages())
    other = docs.withColumn("lang", F.when(langid.remainder() == 2, F.lit("zz")).otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit("z")).repartition(5, "n_chars", "doc_id")
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(other).collect()}
    assert one == two


def test_nothing_to_learn(spark):
    docs = cases.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(docs).collect()} == {"und"}
    assert langid.identify(cases.frame(spark, [])).count() == 0


def test_probabilities_sum_to_one():
    """Over the alphabet and one unseen character, after any context."""
    texts = [cases.prose(k, 300, "abcd") for k in range(4)]
    padded, places, _ = langid.characters(texts)
    ends, contexts = langid.grams(padded, places)
    _, at, counts = np.unique(ends[3], return_index=True, return_counts=True)
    columns = [ends[3], ends[2], ends[1], ends[0], contexts[2], contexts[1], contexts[0]]
    table = {c: v[at] for c, v in zip(langid.COUNTED, columns)} | {"n": counts}
    model = langid.fitted(["xx"], [table])
    alphabet = [ord(c) for c in "abcd"] + [0, ord("z")]
    for context in ([ord("a"), ord("b"), ord("c")], [0, ord("a"), ord("a")], [ord("z"), ord("z"), ord("q")]):
        total = 0.0
        for char in alphabet:
            total += np.exp(model.log_probabilities(np.array([*context, char], np.uint64), np.array([3]))[0, 0])
        assert total == pytest.approx(1.0, abs=1e-4)


def test_calibration_is_monotone():
    rng = np.random.default_rng(3)
    odds = rng.exponential(10, 2000)
    right = rng.random(2000) < 1 - 0.5 * np.exp(-odds / 5)
    places, shares = langid.monotone(odds, right)
    assert (np.diff(places) > 0).all() and (np.diff(shares) >= 0).all()
    assert abs(np.interp(20, places, shares) - 0.99) < 0.05


# --- importance resampling -------------------------------------------------------------------


def test_resampling_draws_the_highest_keys(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(24)] + [(3, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = resampling.resample(docs, labels, 0.4).collect()
    assert len(rows) == len(cases.rows())
    kept = [r for r in rows if r.kept]
    assert len(kept) == round(0.4 * len(rows))
    assert min(r.gumbel_key for r in kept) >= max(r.gumbel_key for r in rows if not r.kept) - 1e-9
    again = resampling.resample(docs.repartition(4, "n_chars", "doc_id"), labels, 0.4).collect()
    assert {r.doc_id for r in kept if r.doc_id is not None and r.doc_id != 30} <= {r.doc_id for r in again if r.kept}
    assert all(r.log_weight == 0 for r in rows if r.n_ngrams == 0)


def test_weights_by_hand(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 24, 2)], "doc_id bigint, quality int, toxic int")
    target, raw = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    import pyarrow as pa

    grams = {}
    for r in cases.rows():
        hashed, _ = resampling.buckets_of(pa.array([r[1]]))
        words = cases.words(cases.normal(r[1]))
        assert len(hashed) == max(2 * len(words) - 1, 0)
        grams[(r[0], r[1])] = hashed
        np.add.at(raw, hashed, 1)
        if r[0] in range(0, 24, 2):
            np.add.at(target, hashed, 1)
    ratio = resampling.log_ratio(target, raw)
    got = resampling.resample(docs, labels, 1.0).collect()
    assert all(r.kept for r in got)
    weights = collections.defaultdict(set)
    for r in got:
        weights[r.doc_id].add(round(r.log_weight, 6))
    for (doc_id, _), hashed in grams.items():
        want = resampling.SHARPNESS * ratio[hashed].mean() if len(hashed) else 0.0
        assert any(abs(want - w) < 1e-5 for w in weights[doc_id])


def test_resampling_nothing(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert resampling.resample(cases.frame(spark, []), labels).count() == 0
    rows = resampling.resample(cases.frame(spark), labels).collect()
    assert len(rows) == len(cases.rows()) and not any(r.kept for r in rows)


def test_radix_selection(spark):
    rng = np.random.default_rng(1)
    data = [(int(k) - 5000, int(i)) for i, k in enumerate(rng.integers(0, 10_000, 3000) // 100 * 100)]
    data += [(-(1 << 62), 9000), (1 << 62, 9001)]
    df = spark.createDataFrame(data, "k bigint, row bigint")
    for count in (1, 2, 777, 3001, 3002):
        assert resampling.highest(df, ["k", "row"], count) == sorted(data, reverse=True)[count - 1]
    assert resampling.highest(df, ["k", "row"], 0) is None


# --- mix of sources ---------------------------------------------------------------------------


def wanted(sizes: dict, repeats: int = 3) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in full)
        open_weight = sum(w for s, w in weights.items() if s not in full)
        share = {s: rest * w / open_weight for s, w in weights.items() if s not in full} if open_weight else {}
        over = {s for s, t in share.items() if t >= repeats * sizes[s]}
        if not over:
            return {s: float(repeats * sizes[s]) if s in full else share[s] for s in sizes}
        full |= over


def many_sources(seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(700):
        source = ["huge", "b", "é", None, "tiny", "none"][int(rng.choice(6, p=[0.6, 0.15, 0.1, 0.1, 0.04, 0.01]))]
        out.append((k, None if source == "none" else cases.prose(k, int(rng.integers(1, 80))), "en", source, 1))
    return [(*r, *["clash"] * len(cases.CLASHING)) for r in out]


def test_mix_comes_near_its_targets(spark):
    data = many_sources()
    docs = cases.frame(spark, data)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(data)
    source = {r[0]: r[3] for r in data}
    sizes = collections.Counter()
    for r in data:
        sizes[r[3]] += len(cases.words(r[1]))
    targets, taken = wanted(sizes), collections.Counter()
    for r in rows:
        assert r.size == len(cases.words(data[r.doc_id][1]))
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(0.02 * target, 12)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(3, "n_chars", "doc_id")).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_schedule_and_blocks(spark):
    parts = mixing.mixed(cases.frame(spark, many_sources()).select("doc_id", "text", "source"), [])
    slots = parts["slots"].toPandas()
    info = parts["sources"].toPandas().set_index("place")
    assert (slots.epoch < mixing.REPEATS).all()
    for place, mine in slots.groupby("place"):
        mine = mine.sort_values("slot")
        assert (mine["rank"].to_numpy() == np.arange(len(mine))).all()
        assert (mine["block"] == mine["rank"] % info.blocks[place]).all()
        # Low discrepancy: any stretch of the schedule holds about its share.
        share = len(mine) / len(slots)
        for end in (len(slots) // 7, len(slots) // 2):
            assert abs((mine["slot"] < end).sum() - share * end) <= 6
    pieces = parts["pieces"].toPandas()
    sizes = (pieces["to"] - pieces["from"]).groupby([pieces["place"], pieces["block"]]).sum()
    for place, mine in sizes.groupby(level=0):
        assert len(mine) == info.blocks[place] and mine.max() - mine.min() <= 1
        assert mine.sum() == info.source_size[place]


def test_mix_of_awkward_rows(spark):
    rows = mixing.mix(cases.frame(spark)).collect()
    assert len(rows) == len(cases.rows())
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix(cases.frame(spark, [])).count() == 0
    docs = cases.frame(spark)
    again = mixing.repeat_rows(docs)
    assert again.columns == docs.columns
    found = collections.Counter(tuple(r) for r in again.collect())
    assert set(found) <= set(cases.rows()) and max(found.values()) <= 3 * 2
