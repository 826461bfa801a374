"""Exact copies, near copies and repeated passages against plain Python."""

from __future__ import annotations

import collections
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cases
from tillflow.llm import chunking, components, exact, hashing, jaccard
from tillflow.llm.queries import QUERIES


def expected_copies(data):
    groups = collections.defaultdict(list)
    for r in data:
        groups[cases.normal(r[1])].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def test_copies(spark):
    found = exact.find_copies(cases.frame(spark)).collect()
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr)
    assert got == expected_copies(cases.rows())
    kept = collections.Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept) == {r.text_sha256 for r in found} and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_dropping_copies_keeps_rows_whole(spark):
    docs = cases.frame(spark)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    got = left.collect()
    assert len(got) == len({cases.normal(r[1]) for r in cases.rows()})
    assert {tuple(r) for r in got} <= set(cases.rows())


def test_no_documents(spark):
    empty = cases.frame(spark, [])
    assert exact.find_copies(empty).count() == 0
    assert exact.drop_copies(empty).count() == 0
    assert jaccard.components(empty).count() == 0
    assert chunking.passages(empty).count() == 0


def test_full_filter_stays_exact(spark, monkeypatch):
    """A filter with far too few bits lets nearly all rows through, and the result is the same."""
    monkeypatch.setattr(exact, "MOST_BITS", 16)
    monkeypatch.setattr(exact, "BITS_A_ROW", 1)
    found = exact.find_copies(cases.frame(spark)).collect()
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr)
    assert got == expected_copies(cases.rows())


def test_filter_marks_all_repeats_and_few_others(spark):
    docs = spark.range(20_000).selectExpr("sha2(cast(id % 19000 as string), 256) AS h")
    bitmaps, bits = exact.repeat_filter(docs, "h", 20_000)
    marked = exact.maybe_repeated(docs, "h", bitmaps, bits, "maybe")
    rows = marked.groupBy("h").agg(F.count("*").alias("n"), F.min("maybe").alias("maybe")).toPandas()
    assert rows[rows.n > 1].maybe.all()
    assert rows[rows.n == 1].maybe.mean() < 0.03


@pytest.mark.parametrize("most", [1 << 29, 1 << 14])
def test_id_bitmap(spark, monkeypatch, most):
    """Dense ids by an exact bitmap, and the other way where that would be too large."""
    monkeypatch.setattr(exact, "MOST_BITS", most)
    docs = cases.frame(spark)
    ids = spark.createDataFrame([(k,) for k in (3, 30, 110, 999)], "of bigint")
    left = exact.without(docs, "doc_id", ids)
    assert left.columns == docs.columns
    got = [r.doc_id for r in left.collect()]
    assert sorted(got, key=repr) == sorted([r[0] for r in cases.rows() if r[0] not in (3, 30, 110)], key=repr)


def expected_components(data):
    sets = {}
    for r in data:
        if r[0] is not None:
            sets[r[0]] = cases.shingles(r[1])
    found = cases.linked_components(sets)
    return sorted([(r[0], len(cases.shingles(r[1])), found.get(r[0])) for r in data], key=repr)


def test_components_by_jaccard(spark):
    got = [tuple(r) for r in jaccard.components(cases.frame(spark)).collect()]
    assert sorted(got, key=repr) == expected_components(cases.rows())


def test_components_by_differences(spark, monkeypatch):
    """Groups around bases of several sizes, most nodes too different to link, met by their differences."""
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "WORTH", 1)
    rng, data = np.random.default_rng(8), []
    for base, (length, most) in enumerate([(60, 5), (60, 2), (150, 9), (400, 24)]):
        words = [f"b{base}w{k}" for k in range(length)]
        edits = [(int(p), f"e{base}{k}") for k, p in enumerate(rng.integers(0, length, 12))]
        for _ in range(60):
            copy = list(words)
            for place in rng.choice(length, int(rng.integers(0, most)), replace=False):
                copy[place] = f"x{rng.integers(1 << 30)}"
            for k in rng.choice(len(edits), int(rng.integers(0, 4)), replace=False):  # shared by some
                copy[edits[k][0]] = edits[k][1]
            data.append((len(data), " ".join(copy[int(rng.integers(0, 4)) :]), "en", "a", 1, *["clash"] * len(cases.CLASHING)))
    got = [tuple(r) for r in jaccard.components(cases.frame(spark, data)).collect()]
    assert sorted(got, key=repr) == expected_components(data)
    assert 4 < len({r[2] for r in got}) < len(got)


def near_copies(count, seed=1):
    """A chain and a crowd of near copies, some just over and some just under the limit."""
    rng = np.random.default_rng(seed)
    out, base = [], [f"w{k}" for k in range(400)]
    for k in range(count):
        words = list(base)
        for place in rng.choice(400, int(rng.integers(1, 16)), replace=False):
            words[place] = f"x{rng.integers(1 << 30)}"
        out.append((k, " ".join(words)))
    chain = [f"c{k}" for k in range(300)]
    for k in range(20):
        out.append((1000 + k, " ".join(chain[k * 8 : k * 8 + 140])))
    for k in range(60):  # a passage that many documents share
        own = [f"p{k}x{j}" for j in range(150)]
        out.append((2000 + k, " ".join(own[:75] + base[:60] + own[75:])))
    return [(i, t, "en", "a", 1, *["clash"] * len(cases.CLASHING)) for i, t in out]


def test_crowds_and_chains(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 3)
    monkeypatch.setattr(jaccard, "BATCH_ROWS", 37)
    data = near_copies(70)
    docs = cases.frame(spark, data).repartition(3)
    got = [tuple(r) for r in jaccard.components(docs).collect()]
    assert sorted(got, key=repr) == expected_components(data)


def test_too_few_segments_are_widened(spark, monkeypatch):
    """With hardly any segments the pigeonhole fails, which is seen and mended."""
    plain = jaccard.segments
    monkeypatch.setattr(
        jaccard, "segments", lambda largest, wider=1: plain(largest, wider) if wider > 1 else largest // 40 + 1
    )
    data = near_copies(25, 3)
    got = [tuple(r) for r in jaccard.components(cases.frame(spark, data)).collect()]
    assert sorted(got, key=repr) == expected_components(data)


def test_pigeonhole_meets_every_similar_pair():
    """Two sets at the limit share a probed segment hash, for many sizes."""
    rng = np.random.default_rng(5)
    for size in [3, 4, 5, 6, 7, 8, 10, 13, 21, 40, 77, 150, 400, 1000]:
        for _ in range(12):
            pool = hashing.mix(rng.integers(1, 1 << 63, 4 * size, np.uint64))
            a = pool[:size]
            cut = int(rng.integers(0, size // 7 + 2))
            b = np.concatenate([a[cut:], pool[size : size + int(rng.integers(0, size // 4 + 2))]])
            both = size - cut
            if 100 * both < 75 * (len(a) + len(b) - both) or cut == 0 == len(b) - both:
                continue
            seen = {}
            for name, one in (("a", np.sort(a)), ("b", np.sort(b))):
                owner, sizes = np.zeros(len(one), np.int64), np.array([len(one)])
                for low in (False, True):
                    h, _, flags, lacking = jaccard.signatures(one, owner, sizes, np.zeros(len(one), np.int64), low)
                    assert not len(lacking)
                    for x, f in zip(h.tolist(), flags.tolist()):
                        seen.setdefault(x, {"a": 0, "b": 0})[name] |= f
            assert any((r["a"] | r["b"]) == 3 and r["a"] and r["b"] for r in seen.values()), (size, cut, len(b))


def test_word_hashes_in_steps(monkeypatch):
    texts = pa.array([r[1] for r in cases.rows()])
    whole = hashing.shingles(texts)
    monkeypatch.setattr(hashing, "STEP", 1000)
    steps = hashing.shingles(texts)
    assert (whole[0] == steps[0]).all() and (whole[1] == steps[1]).all()
    sizes = np.bincount(whole[1], minlength=len(texts))
    assert sizes.tolist() == [len(cases.shingles(r[1])) for r in cases.rows()]


def test_labels_of_a_path(spark):
    links = spark.range(200).selectExpr("id AS a", "id + 1 AS b").unionAll(spark.sql("SELECT 500L, 400L"))
    got = {r.node: r.label for r in components.labelled(links).collect()}
    assert got == {**{k: 0 for k in range(201)}, 400: 400, 500: 400}


def by_chunk(data):
    at = collections.defaultdict(list)
    for r in data:
        raw = (r[1] or "").encode()
        ends = chunking.cuts(np.frombuffer(raw, np.uint8)).tolist()
        for a, b in zip([0, *ends], ends):
            at[raw[a:b]].append((-(1 << 63) if r[0] is None else r[0], a))
    return {k: sorted(set(v)) for k, v in at.items()}


def test_repeated_chunks(spark, monkeypatch):
    monkeypatch.setattr(chunking, "COMMON", 3)
    monkeypatch.setattr(chunking, "BATCH_ROWS", 9)
    data = [r for k, r in enumerate(cases.rows()) if r[0] != 30 or k % 2]  # ids tell rows apart
    got = chunking.repeats(cases.frame(spark, data).repartition(2)).collect()
    found = sorted(
        [(-(1 << 63) if r.doc is None else r.doc, r.start, r.length, r.copies, r.kept, r.across) for r in got]
    )
    expected = []
    for chunk, places in by_chunk(data).items():
        if len(places) > 1:
            across = len({d for d, _ in places}) > 1
            expected += [(d, s, len(chunk), len(places), (d, s) == places[0], across) for d, s in places]
    assert found == sorted(expected)


def test_passages_and_cutting(spark):
    shared = cases.prose(1234, 60)
    data = [(k, f"{cases.prose(k, 40)} {shared} {cases.prose(50 + k, 30)}") for k in range(6)]
    data += [(k, cases.prose(k, 120)) for k in range(10, 16)]
    data = [(i, t, "en", "a", 1, *["clash"] * len(cases.CLASHING)) for i, t in data]
    docs = cases.frame(spark, data)
    spans = chunking.passages(docs).collect()
    assert {r.doc_id for r in spans} == set(range(6))
    for r in spans:
        part = dict((x[0], x[1]) for x in data)[r.doc_id].encode()[r.start : r.end].decode()
        assert part in shared and r.first_doc_id == 0 and r.copies == 6 and r.kept == (r.doc_id == 0)
    cut = {r.doc_id: r.text for r in chunking.without_repeats(docs).collect()}
    texts = {x[0]: x[1] for x in data}
    assert cut[0] == texts[0] and all(cut[k] == texts[k] for k in range(10, 16))
    assert all(len(cut[k]) < len(texts[k]) - 200 for k in range(1, 6))


def test_every_repeated_byte_is_kept_once(spark):
    """Copies that hold a passage of an earlier document, and a passage within one document twice."""
    shared, whole = cases.prose(1234, 60), f"{cases.prose(5, 60)} {cases.prose(1234, 60)} {cases.prose(6, 60)}"
    twice = cases.prose(77, 50)
    texts = {1: f"{cases.prose(1, 40)} {shared} {cases.prose(2, 40)}", 5: whole, 7: whole}
    texts[9] = f"{cases.prose(9, 30)} {twice} {cases.prose(10, 30)} {twice} {whole[:400]}"
    docs = cases.frame(spark, [(i, t, "en", "a", 1, *["clash"] * len(cases.CLASHING)) for i, t in texts.items()])
    raw = {i: t.encode() for i, t in texts.items()}
    again = {c: p for c, p in by_chunk(list(texts.items())).items() if len(p) > 1}
    found = chunking.repeats(docs)
    for least in (1, chunking.PASSAGE_BYTES):
        spans = chunking.parts(found, least).collect()
        covers = lambda d, a, b: [r for r in spans if r.doc_id == d and r.start <= a and b <= r.end]
        for r in spans:
            part = raw[r.doc_id][r.start : r.end]
            assert raw[r.first_doc_id][r.first_start :].startswith(part)
            assert r.kept == ((r.doc_id, r.start) == (r.first_doc_id, r.first_start))
            assert not any(x for x in spans if not x.kept and x.doc_id == r.first_doc_id and x.start < r.first_start + len(part) and r.first_start < x.end)
        if least == 1:
            for chunk, places in again.items():
                kept = [x.kept for d, a in places for x in covers(d, a, a + len(chunk))]
                assert len(kept) == len(places) and kept.count(True) == 1
        assert sum(r.end - r.start for r in spans if r.doc_id == 5 and r.kept) > 500


def test_query_reports_all_repeats_and_what_stays(spark, tmp_path):
    twice = cases.prose(77, 80)
    texts = {1: f"{cases.prose(9, 30)} {twice} {cases.prose(10, 30)} {twice}", 2: cases.prose(2, 90), 3: "", 4: None}
    texts |= {5: cases.prose(5, 120), 6: cases.prose(5, 120), None: cases.prose(11, 50)}
    docs = cases.frame(spark, [(i, t, "en", "a", 1, *["clash"] * len(cases.CLASHING)) for i, t in texts.items()])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op3_gear_chunks"](spark, str(tmp_path)).collect()
    inside = [r for r in rows if r.doc_id == 1]
    assert {r.across for r in inside} == {False} and {r.kept for r in inside} == {True, False}
    assert all(r.first_doc_id == 1 for r in inside) and sum(r.end - r.start for r in inside if not r.kept) > 250
    assert {(r.across, r.kept, r.first_doc_id) for r in rows if r.doc_id == 6} == {(True, False, 5)}
    assert all(r.start is None for r in rows if r.doc_id in (2, 3, 4, None))
    gone = collections.defaultdict(list)
    for chunk, places in by_chunk(list(texts.items())).items():
        for d, a in places[1:]:
            gone[d].append((a, a + len(chunk)))
    want = set()
    for i, text in texts.items():
        raw, left, at = (text or "").encode(), b"", 0
        for a, b in sorted(gone[i]):
            left, at = left + raw[at:a], b
        left += raw[at:]
        want.add((i, *((len(raw), len(left), hashlib.sha256(left).hexdigest()) if text is not None else [None] * 3)))
    assert {(r.doc_id, r.n_bytes, r.bytes_kept, r.digest_kept) for r in rows} == want


def test_cuts_move_with_insertions():
    raw = cases.prose(8, 4000, "abcdefghijäö").encode()
    moved = raw[:5000] + b"inserted words " + raw[5000:]
    parts = [{x[a:b] for a, b in zip([0, *e], e)} for x in (raw, moved) for e in [chunking.cuts(np.frombuffer(x, np.uint8)).tolist()]]
    assert len(parts[0] - parts[1]) <= 4
    for x in (raw, b"\xc3\xa4" * 999, b"a" * 3000):
        ends = chunking.cuts(np.frombuffer(x, np.uint8)).tolist()
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(x) and sizes.max() <= chunking.MOST and (sizes[:-1] >= chunking.LEAST).all()
        for a, b in zip([0, *ends], ends):
            x[a:b].decode()


def test_packed_rows_carry_half_a_key_of_each_set(spark):
    texts = spark.range(400).select(
        F.col("id").alias("doc"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.md5(F.concat_ws("-", "id", i))), " ").alias("text"),
    )
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for row in jaccard.packed(texts.coalesce(1), none, 61, 1).collect():
        places = np.frombuffer(row.places, np.uint16) & 0x1FFF
        wide = 4 if row.bucket >= 0 else 8
        carried = sum(len(value) for value in row.asDict().values() if isinstance(value, (bytes, bytearray)))
        assert carried == (wide + 2) * len(places) + 8 * len(np.unique(places))


def test_frequent_shingles_of_a_window():
    random = np.random.default_rng(5)
    drawn = np.concatenate([random.zipf(1.3, 50_000), random.integers(0, 1 << 62, 250_000)]).astype(np.uint64)
    values, counts = np.unique(drawn, return_counts=True)
    pending = [drawn[:100_000], drawn[100_000:]]
    tracemalloc.start()
    found = jaccard._counted(pending)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found[0], values[counts >= jaccard.REPORTED])
    assert np.array_equal(found[1], counts[counts >= jaccard.REPORTED])
    assert peak < 2 * drawn.nbytes
    for few in ([], [drawn[:1]], [drawn[:2]]):
        assert not len(jaccard._counted(few)[0])


def test_differences_meet_through_rare_shingles(spark, monkeypatch):
    """Nodes that share some changes of a pivot's text, but are not similar, don't all meet each other."""
    rng, base = np.random.default_rng(3), [f"w{k}" for k in range(400)]
    data = [(0, " ".join(base), "en", "a", 1, *["clash"] * len(cases.CLASHING))]
    for k in range(1, 91):
        words = [f"s{place}" if place in (10, 20, 30, 40) else word for place, word in enumerate(base)]
        for place in rng.choice(np.arange(50, 390, 6), 24, replace=False):
            words[place] = f"x{rng.integers(1 << 30)}"
        data.append((k, " ".join(words), *data[0][2:]))
    texts = cases.frame(spark, data).select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    lists = texts.select(F.lit(7).cast("bigint").alias("hash"), "doc", F.lit(3).alias("flags"), F.col("doc").alias("label"))
    pivot = F.struct(F.lit(0).cast("bigint").alias("label"), F.lit(0).cast("bigint").alias("doc")).alias("pivot")
    monkeypatch.setattr(jaccard, "pivots", lambda _: spark.range(7, 8).select(F.col("id").alias("same"), pivot))
    assert jaccard.by_difference(lists, jaccard.TokenSets(texts)).count() < 3 * len(data)
