"""WARC archives, plane files, packing and the pipeline: round trips and brute force."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import cases
import corpus_pipeline
from tillflow.llm import bitplane, encoding, exact, jaccard, mixing, outliers, packing, warc
from tillflow.llm.common import new_folder, sums_before
from tillflow.llm.queries import vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "  a b", " a", "a ", "a\n\nb", "a \nb", "x\n y", "don't we'll it's", "a\tb c", "a\x1cb c",
    "<|endoftext|> hi<|endoftext|>x", "<|ENDOFTEXT|> A", "Ünïcode ñandú 123 45.6, ok?!", "é a ́b", "İstanbul I",
    "日本 語 テスト", "x. Y, z; w: q!? a... b", "ΣΑΣ ΣΑΣ.", "a​b c", "hello,world foo.bar", "a\x85b c",
    "a \x00b\x00 c", "a　b c d", "ÀÉ. é! ß, Ŀx.", "word. Word. WORD.", "x" * 3000,
]


# --- encoding --------------------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_encode_like_whole_texts(path, monkeypatch):
    monkeypatch.setattr(encoding, "CACHE", 50)
    plain, fast = Tokenizer.from_file(path), encoding.Encoder(path, 2)
    rng = random.Random(4)
    pieces = ["the", "Of.", "ñandú,", "\n", " ", "12", "don't", "é́", "#x", "a.b", "İ", "ß!"]
    texts = ODD + [r[1] or "" for r in cases.rows()]
    texts += [" ".join(rng.choices(pieces, k=rng.randint(1, 30))) for _ in range(300)]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), "<u2").tolist() == want, text[:60]
    for size in (1, 100, 16 << 20):  # the same as columns, in slices of all kinds
        monkeypatch.setattr(encoding, "SLICE", size)
        column = pa.array([None, *texts, "", None], pa.string()).slice(1)
        together = list(fast.encode_all(column))
        assert len(together) == len(texts) + 2 and not len(together[-1]) and not len(together[-2])
        for text, ids in zip(texts, together):
            assert ids.astype("<u2").tobytes() == fast.encode(text), text[:60]
    assert list(fast.encode_all(pa.array([], pa.string()))) == []


# --- plane files ------------------------------------------------------------------------


class Memory(io.BytesIO):
    def read_at(self, length, offset):
        self.seek(offset)
        return self.read(length)

    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("top", [1, 2, 255, 256, 50_000, (1 << 32) - 1])
def test_planes_round_trip(kind, top):
    rng = np.random.default_rng(top)
    for size in (1, 7, 8, 1000):
        ids = rng.integers(0, top, size, dtype=np.uint32, endpoint=True)
        assert (bitplane.from_planes(bitplane.to_planes(ids, kind), size, kind) == ids).all()
    assert bitplane.to_planes(np.zeros(5, np.uint32), kind) == []


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_file_and_its_index(kind):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 50_000, int(n), dtype=np.uint32) for n in (1, 0, 63, 64, 65, 500, 3)]
    out = Memory()
    writer = bitplane.PlaneWriter(out, kind, block=64)
    for k, ids in enumerate(docs):
        writer.add(None if k == 1 else k, ids)
    assert writer.close() == out.size()
    reader = bitplane.PlaneReader(out)
    assert [b[1] for b in reader.index["blocks"]] == [64] * 10 + [56]
    start = 0
    for (doc_id, at, n, crc), (k, ids) in zip(reader.documents(), enumerate(docs), strict=True):
        assert (doc_id, at, n) == (None if k == 1 else k, start, len(ids))
        assert crc == zlib.crc32(ids.astype("<u4").tobytes())
        assert np.concatenate([*reader.ids(at, at + n), np.zeros(0, np.uint32)]).tolist() == ids.tolist()
        start += n
    with pytest.raises(ValueError):
        bitplane.PlaneReader(Memory(out.getvalue()[:-3] + b"???"))


def test_documents_through_plane_files(spark):
    docs = cases.frame(spark).repartition(5)
    got = [tuple(r) for r in bitplane.round_trip(spark, docs, BYTE).collect()]
    plain = Tokenizer.from_file(BYTE)
    encoded = collections.defaultdict(list)
    for r in cases.rows():
        ids = np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        encoded[r[0]].append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for doc_id, at, n, crc in sorted(got, key=lambda r: r[1]):
        assert at == start
        encoded[doc_id].remove((n, crc))
        start += n
    assert not any(encoded.values())
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    assert bitplane.round_trip(spark, cases.frame(spark, []), BYTE).count() == 0


def test_a_task_rolls_its_files(spark):
    docs = spark.createDataFrame([(i, "some words " * (i % 7)) for i in range(200)], "doc_id long, text string")
    folder = new_folder(spark, "planes")
    manifest = bitplane.write_files(docs.coalesce(1), BYTE, folder, file_ids=100)
    rows = manifest.collect()
    assert len(rows) > 10 and all(r.n_ids < 200 for r in rows)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = bitplane.read_files(manifest).select(columns).orderBy("start").collect()
    assert got == bitplane.round_trip(spark, docs, BYTE).select(columns).orderBy("start").collect()
    assert [r.doc_id for r in got] == list(range(200))


# --- packing -----------------------------------------------------------------------------


def test_sum_of_squares_rule():
    """Every placement without a known end minimises the sum of squares, as counted afresh."""
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 40, 120))[::-1]
    where, offsets = packing.place(lengths, 40)
    fills = np.bincount(where, lengths)
    least = max(-(-int(lengths.sum()) // 40), int((lengths > 20).sum()))
    assert (fills <= 40).all() and len(fills) <= least + 3
    used = collections.defaultdict(int)
    for size, sequence, offset in zip(lengths.tolist(), where.tolist(), offsets.tolist()):
        assert used[sequence] == offset
        gaps = collections.Counter(40 - f for f in used.values() if f < 40)
        left, room = int(lengths.sum()) - sum(used.values()), sum(40 - f for f in used.values())

        def cost(gap):
            after = gaps.copy()
            after[gap] -= gap < 40 or gap in gaps
            after[gap - size] += gap > size
            return sum(n * n for n in after.values())

        choices = [(cost(g), g) for g in gaps if g >= size and gaps[g]]
        fresh = gaps.copy()
        fresh[40 - size] += size < 40
        new = sum(n * n for n in fresh.values())
        gap = 40 - offset
        if sequence in used:
            assert (cost(gap), gap) == min(choices)
            assert left <= room or min(choices)[0] <= new
        else:
            assert not choices or (left > room and new < min(choices)[0])
        used[sequence] += size


def test_packing_every_piece(spark):
    rows = packing.pack(cases.frame(spark).repartition(3), WORD).collect()
    plain = Tokenizer.from_file(WORD)
    want = collections.Counter()
    for r in cases.rows():
        ids = np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[(r[0], piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    ends = collections.defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(ends) <= -(-total // 2048) + 2
    assert packing.pack(cases.frame(spark, []), WORD).count() == 0


def test_groups_are_packed_apart(spark):
    parts = packing.pieces(cases.frame(spark), WORD)
    rows = packing.packed(parts, group=7).collect()
    assert len(rows) == parts.count()
    fills = collections.Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 2048


# --- WARC ----------------------------------------------------------------------------------

PAGES = [
    (1, "https://a.example/1", "<p>one</p>"),
    (2, "https://a.example/2", "<p>two</p>"),
    (3, "https://b.example/é", "<p>one</p>"),
    (4, None, None),
    (5, "bad\r\nurl: x", ""),
    (6, "https://c.example/", "long " * 60_000),
    (7, "https://c.example/again", "long " * 60_000),
    (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (9, "u", "ß€😀"),
    (None, "u", "<p>one</p>"),
    (None, "u", "only without an id"),
    (10, "same", "twice"),
    (10, "same", "twice"),
]


def pages(spark, data=PAGES):
    rows = [(*r, "clash", "clash") for r in data]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, sha string, `of` string")


def expected_pages(least=0):
    top = {}
    for i, _, html in PAGES:
        if i is not None:
            top[html or ""] = max(i, top.get(html or "", i))
    counts = collections.Counter(html or "" for _, _, html in PAGES)
    out = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        of = top.get(html or "")
        if counts[html or ""] < 2 or of is None or of == i or len(raw) < least:
            out.append((i, len(raw), digest, "response", None))
        else:
            out.append((i, len(raw), digest, "revisit", of))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 8])
def test_pages_through_archives(spark, least):
    got = warc.round_trip(spark, pages(spark).repartition(3), least).collect()
    assert sorted([tuple(r) for r in got], key=repr) == expected_pages(least)


def test_no_pages(spark):
    assert warc.round_trip(spark, pages(spark, [])).count() == 0


def test_chunks_carry_running_digests(spark):
    manifest = warc.write_archives(pages(spark).coalesce(1), new_folder(spark, "warc"), size=200)
    assert manifest.count() > 3  # archives are closed by size
    rows = warc.read_chunks(manifest, 1000).where("record_id IS NOT NULL").collect()
    records = collections.defaultdict(list)
    for r in rows:
        records[r.record_id].append(r)
    found = collections.Counter()
    for parts in records.values():
        parts.sort(key=lambda r: r.chunk_no)
        if parts[0].headers["warc-type"] != "response" or len({r.chunk_no for r in parts}) < len(parts):
            continue
        assert [r.chunk_no for r in parts] == list(range(len(parts)))
        assert [r.is_last for r in parts] == [False] * (len(parts) - 1) + [True]
        whole = b""
        for r in parts:
            assert len(r.chunk) <= 1000
            whole += bytes(r.chunk)
            assert r.bytes_so_far == len(whole)
            assert r.sha1_so_far == base64.b32encode(hashlib.sha1(whole).digest()).decode()
        found[whole.decode()] += 1
    assert set(found) == {html or "" for _, _, html in PAGES} - {"twice"}


def test_records_in_small_reads_and_cut_archives():
    made = [warc.page_record(k, "u", b"x" * k, "s", None) for k in (0, 1, 70_000)]
    data = b"".join(gzip.compress(m) for m in made)
    for step in (1 << 16, 50):
        records = [(f["x-page-id"], b"".join(body)) for f, body in warc.Records(io.BytesIO(data), step)]
        assert records == [("0", b""), ("1", b"x"), ("70000", b"x" * 70_000)]
    skipped = [f["x-page-id"] for f, _ in warc.Records(io.BytesIO(data))]
    assert skipped == ["0", "1", "70000"]
    with pytest.raises(EOFError):
        list(warc.Records(io.BytesIO(data[:-40])))


# --- sums and the pipeline --------------------------------------------------------------------


def test_sums_before(spark):
    data = [(k, (k * 7919) % 101) for k in range(500)]
    df = spark.createDataFrame(data, "k int, x int").repartition(6)
    got = {r.k: r.before for r in sums_before(df, ["k"], {"before": "x"}, rows_per_piece=37).collect()}
    total = 0
    for k, x in data:
        assert got[k] == total
        total += x


def corpus(spark):
    """Clean prose in two sources, copies, near copies and junk."""
    out = []
    for k in range(160):
        out.append((k, cases.prose(k, 80 + k), "en", "a" if k % 2 else "b", 1))
    out += [(200 + k, cases.prose(k, 80 + k).upper(), "en", "a", 1) for k in range(10)]
    out += [(300 + k, cases.prose(k, 80 + k) + " extra words", "en", "b", 1) for k in range(10, 20)]
    out += [(400 + k, " ".join(w + "&&&" for w in cases.prose(900 + k, 90).split()), "en", "a", 1) for k in range(9)]
    out += [(500, "too short", "en", "a", 1), (501, None, None, None, None)]
    return [(*r, *["clash"] * len(cases.CLASHING)) for r in out]


def test_pipeline_against_plain_python(spark):
    """Each stage on its own input: the verdicts are Spark's, what follows from them is redone here."""
    data = corpus(spark)
    docs = cases.frame(spark, data)
    state = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, "")
        if name != "pack_sequences":
            assert made.columns == docs.columns
        path = new_folder(spark, name)
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        state[name] = docs.collect()
    good = {r.doc_id for r in state["quality_rules"]}
    assert good == {r[0] for r in data if r[0] < 400}
    exact_left = {r.doc_id for r in state["exact_dedup"]}
    groups = collections.defaultdict(list)
    for r in data:
        if r[0] in good:
            groups[cases.normal(r[1])].append(r[0])
    assert exact_left == {max(ids) for ids in groups.values()}
    sets = {r[0]: cases.shingles(r[1]) for r in data if r[0] in exact_left}
    found = cases.linked_components(sets)
    near_left = {r.doc_id for r in state["near_dedup"]}
    assert near_left == {d for d in found if found[d] == d} and len(near_left) < len(exact_left)
    sizes = {r[0]: len(cases.words(r[1])) for r in data}
    taken = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(state["near_dedup"], cases.SCHEMA)).collect()}
    times = collections.Counter(r.doc_id for r in state["source_mix"])
    assert times == collections.Counter({d: int(t / sizes[d] + 0.5) for d, t in taken.items() if t / sizes[d] >= 0.5})
    plain = Tokenizer.from_file(WORD)
    texts = {r[0]: r[1] for r in data}
    packed = collections.Counter()
    for r in state["pack_sequences"]:
        packed[r.doc_id] += r.length
    want = {d: n * (len(plain.encode(texts[d], add_special_tokens=False).ids) + 1) for d, n in times.items()}
    assert packed == want


def test_pipeline_is_registered():
    import __spark_entry__ as contract

    queries = contract.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries if n.startswith("op"))
    assert numbers == list(range(1, 14))
    stages = [f.__module__ for _, f in corpus_pipeline.STAGES]
    assert len(stages) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_nothing(spark):
    docs = cases.frame(spark, [])
    for stage in (outliers.keep_good, exact.drop_copies, jaccard.keep_one, mixing.repeat_rows):
        assert stage(docs).count() == 0
