"""The cached tokenizer gives the library's own ids for any text."""

import random

import numpy as np
import public_tokenizers
import pytest

from fairspark.llm import tokens

LETTERS = "abéß ΣσςİıẞŁ’'\n .,!?…—12٣中文ñ\t\r  ´́ǅ🙂-_$|<>endoftext"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("cache", [500_000, 50])
def test_ids_are_the_librarys(name, cache, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_UNITS", cache)
    monkeypatch.setattr(tokens, "CACHE_PIECES", cache)
    rng = random.Random(5)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "\n", "a  b", "a\n\nb", "a \n", "\t\n\tb", "a\r\n\r\nb", "don't 's", "<|endoftext|> <|startoftext|>"]
    tok = tokens.UnitTokenizer(public_tokenizers.path(name))
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.lib.encode_batch(texts, add_special_tokens=False)]
    assert tok.encode(texts) == want
    assert tok.encode(texts[::-1]) == want[::-1]
