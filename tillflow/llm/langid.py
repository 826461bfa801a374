"""Language identification by character models with interpolated Kneser-Ney smoothing.

Letters are read in lower case and everything between them as one blank. For each language the
probability of a character after the three before it is estimated from counts of character 4-grams,
and from the number of different contexts for shorter ones. The models of all languages are stored
together: per order a sorted array of the 64-bit hashes of the n-grams that any language has, beside
a matrix of their log-probabilities, and another pair for the weights of the contexts. A text gets the
language of the lowest cross-entropy per character. Its score is the share of right answers among
calibration texts with a like log-odds to the second language (made monotone), and it is marked as
rejected if the score is below a half or the cross-entropy beyond nearly all calibration texts.

Learning uses at most about ``LEARN`` whole texts per language and ``CALIBRATE`` for calibration, picked
by a hash of the id, out of the rows that may be learned from; so the model, which the driver makes
and broadcasts, is bounded by these parameters. Counting and scoring are Spark's: texts are read
where they lie, and only 4-gram counts are shuffled.

Defined results: NULL text, or one without letters, is ``und`` with score 0. Rows with a NULL language
teach nothing; rows with a NULL id teach nothing and are not held out. Equal cross-entropies give
the first language by name. Without any learned language all is ``und``. Repeated rows are scored
alike. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored
from tillflow.llm.hashing import mix

ORDER = 4
LEARN, CALIBRATE = 6000, 3000
BATCH_CHARS = 1 << 20
UNKNOWN = "und"
U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(77))
_WEIGHTS = _rng.integers(1, 1 << 63, ORDER, np.uint64) * U64(2) + U64(1)
COUNTED = ["k4", "k3", "k2", "k1", "c4", "c3", "c2"]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, or 0."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, each after ``ORDER - 1`` blanks; the places of its characters, and their text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = _letters()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    owner = np.repeat(np.arange(len(texts)), lengths)
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = codes != 0
    keep[1:] |= (codes[:-1] != 0) & ~first[1:]
    codes, owner = codes[keep], owner[keep]
    places = np.arange(len(codes)) + (ORDER - 1) * (owner + 1)
    padded = np.zeros(len(codes) + (ORDER - 1) * (len(texts) + 1), U64)
    padded[places] = codes
    return padded, places, owner


def grams(padded: np.ndarray, places: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of the 1- to 4-grams that end at each place, and of their contexts (from the 2-grams on)."""
    sums, total = [], np.zeros(len(padded), U64)
    for back in range(ORDER):
        part = (padded + U64(1)) * _WEIGHTS[back]
        total = total.copy()
        total[back:] += part[: len(part) - back] if back else part
        sums.append(mix(total + U64(back)))
    return [s[places] for s in sums], [s[places - 1] for s in sums[: ORDER - 1]]


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in parts of bounded size, each with its first row; NULL is empty."""
    start, held, size = 0, [], 0
    for place, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        if held and size + len(text) > BATCH_CHARS:
            yield start, held
            start, held, size = place, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def counted(rows: DataFrame) -> DataFrame:
    """Distinct 4-grams of ``lang, text`` rows: hashes of theirs and of their parts, and counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for start, texts in _batches(batch, 1):
                padded, places, owner = characters(texts)
                ends, contexts = grams(padded, places)
                names = langs[start : start + len(texts)]
                for name in sorted(set(names)):
                    mine = np.flatnonzero((names == name)[owner])
                    _, at, counts = np.unique(ends[3][mine], return_index=True, return_counts=True)
                    at = mine[at]
                    columns = [ends[3], ends[2], ends[1], ends[0], contexts[2], contexts[1], contexts[0]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at), pa.string())]
                        + [pa.array(c[at].view(np.int64)) for c in columns]
                        + [pa.array(counts.astype(np.int64))],
                        names=["lang", *COUNTED, "n"],
                    )

    schema = "lang string, " + ", ".join(f"{c} bigint" for c in COUNTED) + ", n bigint"
    made = rows.select("lang", "text").mapInArrow(scan, schema)
    return made.groupBy("lang", "k4").agg(*[F.max(c).alias(c) for c in COUNTED[1:]], F.sum("n").alias("n"))


@dataclass
class Model:
    """``keys[i]`` and ``logs[i]`` for the n-grams of order i + 1; ``contexts[i]`` and ``weights[i]`` for
    the contexts of order i + 1 that order i + 2 falls back from; ``floor`` for unseen characters."""

    langs: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray
    limits: np.ndarray | None = None
    odds: np.ndarray | None = None
    shares: np.ndarray | None = None

    def log_probabilities(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Per place and language, the log-probability of the character there."""
        ends, contexts = grams(padded, places)
        out = np.zeros((len(places), len(self.langs)), np.float32)
        left = np.arange(len(places))
        for order in range(ORDER - 1, -1, -1):
            row, found = _find(self.keys[order], ends[order][left])
            out[left[found]] += self.logs[order][row[found]]
            left = left[~found]
            if not len(left):
                return out
            if order:
                row, found = _find(self.contexts[order - 1], contexts[order - 1][left])
                out[left[found]] += self.weights[order - 1][row[found]]
        out[left] += self.floor
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text and language, and the number of characters."""
        padded, places, owner = characters(texts)
        logs = self.log_probabilities(padded, places)
        counts = np.bincount(owner, minlength=len(texts))
        sums = np.zeros((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            sums[:, k] = np.bincount(owner, logs[:, k], len(texts))
        return -sums / np.maximum(counts, 1)[:, None], counts


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return row, keys[row] == wanted


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.1


def fitted(langs: list[str], tables: list[dict[str, np.ndarray]]) -> Model:
    """The model of the languages from their 4-gram tables."""
    orders = []  # per order and language: keys, contexts (of order - 1), suffixes, counts
    for order in range(ORDER, 0, -1):
        per_lang = []
        for table in tables:
            keys, at = np.unique(table[f"k{order}"], return_index=True)
            context = table[f"c{order}"][at] if order > 1 else np.zeros(len(keys), U64)
            suffix = table[f"k{order - 1}"][at] if order > 1 else np.zeros(len(keys), U64)
            if order == ORDER:
                counts = table["n"][at].astype(float)
            else:  # in how many different (order + 1)-grams it is the end
                _, longer = np.unique(table[f"k{order + 1}"], return_index=True)
                ends = np.searchsorted(keys, table[f"k{order}"][longer])
                counts = np.bincount(ends, minlength=len(keys)).astype(float)
            per_lang.append((keys, context, suffix, counts))
        orders.append(per_lang)
    orders.reverse()
    alphabet = len(np.unique(np.concatenate([t["k1"] for t in tables]))) + 1
    n = len(langs)
    model = Model(langs, [], [], [], [], np.zeros(n, np.float32))
    lower = None
    for order, per_lang in enumerate(orders, 1):
        union, at = np.unique(np.concatenate([p[0] for p in per_lang]), return_index=True)
        context = np.concatenate([p[1] for p in per_lang])[at]
        suffix = np.concatenate([p[2] for p in per_lang])[at]
        all_contexts = np.unique(context)
        probabilities = np.zeros((len(union), n))
        weights = np.ones((len(all_contexts), n))
        for k, (keys, contexts, _, counts) in enumerate(per_lang):
            discount = _discount(counts)
            place = np.searchsorted(all_contexts, contexts)
            totals = np.bincount(place, counts, len(all_contexts))
            types = np.bincount(place, minlength=len(all_contexts))
            seen = totals > 0
            weights[seen, k] = discount * types[seen] / totals[seen]
            probabilities[np.searchsorted(union, keys), k] = (counts - discount) / totals[place]
        backed = weights[np.searchsorted(all_contexts, context)]
        if lower is None:
            model.floor = np.log(weights[0] / alphabet).astype(np.float32)
            probabilities += backed / alphabet
        else:
            keys, values = lower
            probabilities += backed * values[np.searchsorted(keys, suffix)]
            model.contexts.append(all_contexts)
            model.weights.append(np.log(weights).astype(np.float32))
        model.keys.append(union)
        model.logs.append(np.log(probabilities).astype(np.float32))
        lower = (union, probabilities)
    return model


def judged(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language, log-odds to the second, cross-entropy and number of characters of each text."""
    entropies, counts = model.entropies(texts)
    best = entropies.argmin(axis=1)
    ordered = np.sort(entropies, axis=1)
    second = ordered[:, 1] if entropies.shape[1] > 1 else ordered[:, 0] + 1.0
    return best, (second - ordered[:, 0]) * counts, ordered[:, 0], counts


def monotone(odds: np.ndarray, right: np.ndarray, bins: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Shares of right answers that do not fall with the log-odds, at the middles of their ranges."""
    order = np.argsort(odds, kind="stable")
    blocks = [
        [float(part_right.sum()) + 0.5, len(part_right) + 1.0, float(np.median(part_odds))]
        for part_odds, part_right in zip(
            np.array_split(odds[order], bins), np.array_split(right[order], bins), strict=True
        )
        if len(part_right)
    ]
    pooled: list[list[float]] = []
    for block in blocks:
        pooled.append([*block, 1])
        while len(pooled) > 1 and pooled[-2][0] / pooled[-2][1] >= pooled[-1][0] / pooled[-1][1]:
            r, n, middle, k = pooled.pop()
            last = pooled[-1]
            pooled[-1] = [last[0] + r, last[1] + n, (last[2] * last[3] + middle * k) / (last[3] + k), last[3] + k]
    if pooled[0][2] > 0:  # no odds at all are an even chance
        pooled.insert(0, [min(0.5, pooled[0][0] / pooled[0][1]), 1.0, 0.0, 1])
    return np.array([p[2] for p in pooled]), np.array([p[0] / p[1] for p in pooled])


def remainder(id_column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(4))


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows per language (all of a rarer one), by a hash of the id."""
    sizes = stored(rows.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")), "languages")
    share = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 40)) / float(1 << 40)
    return rows.join(sizes, F.col("lang") == F.col("of")).where(share < F.lit(float(most)) / F.col("n"))


def learned(rows: DataFrame, learn: int = LEARN, calibrate: int = CALIBRATE) -> Model | None:
    """The calibrated model of ``doc_id, text, lang`` rows whose remainder is not 2."""
    known = rows.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    table = counted(sampled(known.where(remainder() < 2), learn)).toPandas()
    if not len(table):
        return None
    langs = sorted(table["lang"].unique())
    tables = []
    for lang in langs:
        mine = table[table["lang"] == lang]
        tables.append({c: mine[c].to_numpy(np.int64).view(U64) for c in COUNTED} | {"n": mine["n"].to_numpy()})
    model = fitted(langs, tables)
    number = {lang: k for k, lang in enumerate(langs)}
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            truth = [number.get(name, -1) for name in batch.column(0).to_pylist()]
            for start, texts in _batches(batch, 1):
                best, odds, entropy, counts = judged(shared.value, texts)
                right = best == np.array(truth[start : start + len(texts)])
                use = counts > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(odds[use]), pa.array(entropy[use]), pa.array(right[use])], names=["odds", "entropy", "right"]
                )

    held = sampled(known.where(remainder() == 3), calibrate).select("lang", "text")
    seen = held.mapInArrow(score, "odds double, entropy double, right boolean").toPandas()
    if not len(seen):
        seen = seen.reindex([0]).assign(odds=0.0, entropy=0.0, right=True)
        model.limits = np.array([np.inf])
    else:
        model.limits = np.array([seen["entropy"].quantile(0.999) * 1.05])
    model.odds, model.shares = monotone(seen["odds"].to_numpy(float), seen["right"].to_numpy(bool))
    return model


OUT = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean, cross_entropy double"


def identify(docs: DataFrame, learn: int = LEARN, calibrate: int = CALIBRATE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected, cross_entropy`` of every document.

    Learns from ``text`` and ``lang`` of the rows whose id's checksum does not leave 2.
    """
    model = learned(docs.select("doc_id", "text", "lang"), learn, calibrate)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for start, texts in _batches(batch, 2):
                n = len(texts)
                if model is None:
                    names, scores = [UNKNOWN] * n, np.zeros(n)
                    rejected, entropy = np.ones(n, bool), np.full(n, np.nan)
                else:
                    best, odds, entropy, counts = judged(model, texts)
                    empty = counts == 0
                    names = [UNKNOWN if e else model.langs[k] for k, e in zip(best, empty)]
                    scores = np.where(empty, 0.0, np.interp(odds, model.odds, model.shares))
                    rejected = empty | (scores < 0.5) | (entropy > model.limits[0])
                    entropy = np.where(empty, np.nan, entropy)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, n),
                        batch.column(1).slice(start, n),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(rejected),
                        pa.array(entropy, pa.float64(), from_pandas=True),
                    ],
                    names=[field.split()[0] for field in OUT.split(", ")],
                )

    held = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("bigint"), held, "text").mapInArrow(score, OUT)
