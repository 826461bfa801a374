"""Small documents with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}
CLASHING = "row kept size source_size s by tokens bucket bits group label taken target maybe doc n hash cell _sha _maybe _row".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in CLASHING
)


def prose(seed: int, words: int, letters: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words))


def rows() -> list[tuple]:
    """NULLs in every column, empty and long texts, ties, repeated rows, near copies."""
    base, out = [prose(k, 60 + 7 * k) for k in range(24)], []
    for k, text in enumerate(base):
        out.append((k, text, ["en", "de", None][k % 3], ["a", "b", None, "c d"][k % 4], len(text)))
    out += [
        (100, base[3].upper(), "en", "a", 1),  # equal but for case
        (101, base[3], "en", "a", None),
        (102, base[5] + " one more line of words", "en", "b", 1),  # near copies
        (103, "some words before " + base[5], None, "b", 1),
        (104, " ".join(base[7].split()[:90]), "de", None, 1),
        (110, None, "en", "a", None),
        (111, "", "en", "a", 0),
        (112, " \n\t ", None, None, 4),
        (113, None, None, None, None),
        (114, "just three words", "en", "a", 16),
        (115, "JUST three words", "en", "a", 16),
        (116, prose(99, 20_000), "en", "a", 1),  # long
        (117, prose(99, 20_000) + " tail", "en", "b", 1),
        (118, "ÄÖÜ ñandú 日本語 € 😀 " * 20, "de", "c d", 1),
        (119, "ab cd\n" * 60, "en", "a", 1),
        (120, "x" * 5000, "en", "a", 5000),
        (121, "#*$% &&& <> " * 40 + prose(5, 80), "en", "a", 1),
        (None, base[9], "en", "a", 1),  # no id
        (None, None, None, None, None),
        (30, base[11], "en", "a", 1),  # a repeated row
        (30, base[11], "en", "a", 1),
    ]
    return [(*r, *["clash"] * len(CLASHING)) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def normal(text: str | None) -> str:
    return (text or "").translate(LOWER)


def shingles(text: str | None) -> frozenset:
    w = words(normal(text))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def linked_components(sets: dict) -> dict:
    """The least id reachable over pairs with a similarity of at least 3/4."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def counted(text: str | None) -> dict:
    """The statistics of the quality rules."""
    w = words(text)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else None
    if often is None:
        seen, often = set(), set()
        for x in windows:
            (often if x in seen else seen).add(x)
    covered = {k + j for k, x in enumerate(windows) if x in often for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
