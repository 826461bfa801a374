"""Token ids of whole texts by the tokenizers library, with a cache of words.

Both vocabularies cut a text into words before merging, and never across a blank between two
visible characters. So a text is cut there first, and each distinct word is given to the library
once per worker; its ids are kept as bytes. Texts in which that cut is not safe (two blanks in a
row, control characters, unusual blanks) go to the library whole.

A column of texts is cut and its words are numbered by Arrow, so Python handles each distinct word of
a slice once; the ids of the texts are then gathered by numpy.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per worker; the older half is forgotten first.
CACHE = 500_000
#: Characters of a slice of texts whose words are numbered together (a longer text is a slice alone).
SLICE = 16 << 20
#: Words of texts whose ids are gathered together (a longer text is gathered alone).
GATHERED = 1 << 16
#: Where texts are cut. Texts that hold it go to the library whole.
CUT = "\0"
#: Control characters, blanks other than the usual one and the line end, and signs of no width.
ODD = re.compile(
    "[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)


def cut_is_safe(text: str) -> bool:
    """No two blanks or line ends in a row, none at an end, and no odd characters."""
    return not (
        "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or text[:1] in (" ", "\n")
        or text[-1:] in (" ", "\n")
        or ODD.search(text)
    )


#: A word followed by one mark that the vocabularies always cut off. The letter U+0130 is not among its
#: letters: in lower case it becomes two code points, of which the last joins the mark.
MARKS = frozenset(".,;:!?")
MARKED = re.compile("([A-Za-zÀ-ÖØ-öø-ÿĀ-įı-ſ]+)([.,;:!?])")


class Encoder:
    """``encode`` gives the ids of a text as little-endian unsigned 16- or 32-bit bytes."""

    def __init__(self, path: str, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.code = f"<u{width}", {2: "H", 4: "I"}[width]
        #: Does the blank before a word belong to the word's first token?
        self.blanks_count = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        #: A special token that stands for itself wherever it is, and its id.
        self.special, self.special_id = None, -1
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.special and not (token.normalized or token.single_word or token.lstrip or token.rstrip):
                self.special, self.special_id = token.content, number
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Fetch words from the old half of the cache, or from the library."""
        young, missing, joined = self.young, [], []
        for word, known in zip(words, map(self.old.get, words)):
            if known is not None:
                young[word] = known
            elif word[-1:] in MARKS and MARKED.fullmatch(word, word[:1] == " "):
                joined.append(word)
            else:
                missing.append(word)
        parts = [*dict.fromkeys([word[:-1] for word in joined]), *{word[-1] for word in joined}]
        for part, known in zip(parts, map(self.old.get, parts)):
            if part not in young:
                if known is None:
                    missing.append(part)
                else:
                    young[part] = known
        missing = list(dict.fromkeys(missing))
        for start in range(0, len(missing), 1024):
            block = missing[start : start + 1024]
            young.update(zip(block, self._each(block)))
        for word in joined:
            young[word] = young[word[:-1]] + young[word[-1]]

    def _each(self, words: list[str]) -> list[bytes]:
        """The ids of each word.

        They go to the library as one text, since a call for each takes longer. A special token between two
        words stands for itself, and the library handles what lies between such tokens on its own.
        """
        if self.special is not None and not any(self.special in word for word in words):
            text = self.special.join(words)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(ids == self.special_id)
            if len(ends) == len(words) - 1:
                data, width = ids.astype(self.dtype).tobytes(), np.dtype(self.dtype).itemsize
                starts, ends = [0, *((ends + 1) * width).tolist()], [*(ends * width).tolist(), len(data)]
                return [data[one:two] for one, two in zip(starts, ends)]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _cut(self, text: str) -> str | None:
        """The text with ``CUT`` between its words; None if it must go to the library whole."""
        if self.blanks_count:
            # A blank starts the next word's token; a line end is a token of its own.
            return text.replace(" ", "\0 ").replace("\n", "\0\n\0") if cut_is_safe(text) else None
        if CUT in text:
            return None
        # This vocabulary has no upper case.
        lower = text.lower() if text.isascii() and "<|" not in text else text
        return lower.replace("\n", CUT).replace(" ", CUT)

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        missing = [word for word, ids in zip(words, found) if ids is None]
        if missing:
            self._learn(missing)
            found = [self.young[word] if ids is None else ids for word, ids in zip(words, found)]
        return found

    def encode(self, text: str) -> bytes:
        cut = self._cut(text)
        if cut is None:
            return self._whole(text)
        words = cut.split(CUT)
        distinct = list(dict.fromkeys(words))
        ids = dict(zip(distinct, self._known(distinct)))
        return b"".join([ids[w] for w in words])

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (NULL: none), in order."""
        start = held = 0
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for place, length in enumerate(lengths):
            if place > start and held + length > SLICE:
                yield from self._slice(texts.slice(start, place - start))
                start, held = place, 0
            held += length
        yield from self._slice(texts.slice(start))

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if not len(texts):
            return
        cuts, whole = [], {}
        for place, text in enumerate(texts.to_pylist()):
            cut = self._cut(text or "")
            if cut is None:
                whole[place], cut = self._whole(text), ""  # an empty word, replaced below
            cuts.append(cut)
        lists = pc.split_pattern(pa.array(cuts, pa.large_string()), CUT)
        words = lists.flatten().dictionary_encode()
        first = lists.offsets.to_numpy()
        ids = self._known(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        number = words.indices.to_numpy().astype(np.int64)
        for place, found in whole.items():
            number[first[place]] = len(ids)
            ids.append(found)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.dtype).itemsize
        flat = np.frombuffer(b"".join(ids), self.dtype)
        begins = np.cumsum(sizes) - sizes
        start = 0
        while start < len(cuts):
            # Some texts together: at least one, and more while their words are few.
            end = max(start + 1, int(np.searchsorted(first, first[start] + GATHERED, "right")) - 1)
            word = number[first[start] : first[end]]
            size = sizes[word]
            ends = np.concatenate([[0], np.cumsum(size)])
            # Each word's ids, from their place in ``flat`` to their place in these texts.
            shift = np.repeat(begins[word] - ends[:-1], size)
            shift += np.arange(len(shift))
            found, bounds = flat[shift], ends[first[start : end + 1] - first[start]].tolist()
            for one, two in zip(bounds, bounds[1:]):
                yield found[one:two]
            start = end


@lru_cache(maxsize=4)
def encoder(path: str, width: int = 4) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, width)
