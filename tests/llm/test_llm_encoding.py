"""Words go to the tokenizers library in few calls, with the ids that each has alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillflow.llm import encoding
from tillflow.llm.queries import vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **settings):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **settings)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_many_words_are_few_texts_for_the_library(path, monkeypatch):
    monkeypatch.setattr(encoding, "GATHERED", 64)
    plain, fast = Tokenizer.from_file(path), encoding.Encoder(path, 2)
    fast.tokenizer = counted = Counted(fast.tokenizer)
    texts = [" ".join(f"wörd{i}x{j}{'.' * (j % 2)}" for j in range(40)) for i in range(100)]
    ids = [x.tolist() for x in fast.encode_all(pa.array(texts))]
    assert ids == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert counted.texts <= 10


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_between_and_inside_words(path):
    plain, fast = Tokenizer.from_file(path), encoding.Encoder(path, 2)
    words = ["", " ", "a", " b", "<|", "|>", "<|endoftext|", "endoftext|>", "\n", "<", ">", "é", "́"]
    for some in (words, [*words, "x<|endoftext|>y"], [*words, "<|startoftext|>"], ["<|endoftext|>"], ["", ""], [""]):
        want = [plain.encode(w, add_special_tokens=False).ids for w in some]
        assert [np.frombuffer(x, "<u2").tolist() for x in fast._each(some)] == want
