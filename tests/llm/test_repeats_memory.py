"""What a worker holds while repeated passages are sorted and while texts are encoded."""

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from fairspark.llm import repeats
from fairspark.llm.tokens import UnitTokenizer


class Grouped:
    """Stands for a table: keeps the function that its groups are given to."""

    def groupBy(self, *_):
        return self

    def applyInPandas(self, run, _schema):
        return run


def contexts(anchors: int, classes: int, length: int, rng) -> pd.DataFrame:
    rows = []
    for h in range(anchors):
        core = rng.integers(97, 123, length + 60).astype(np.uint8).tobytes()
        for c in range(classes):
            at = int(rng.integers(0, 40))
            rows.append((h, 10 * h + c, int(rng.integers(0, 9)), 100 * h + c, 0, core[at:at + length + 20] + bytes([65 + c])))
    return pd.DataFrame(rows, columns=["hash", "context", "doc_id", "text_key", "lo", "bytes"])


def test_sorted_by_whole_anchors(spark, monkeypatch):
    pdf, seen, plain = contexts(40, 3, 64, np.random.default_rng(3)), [], repeats.factors
    monkeypatch.setattr(repeats, "SORT_BYTES", 1 << 30, raising=False)
    run = repeats.sorted_factors(Grouped(), 1, 64)
    whole = run(pdf).sort_values("context")
    monkeypatch.setattr(repeats, "SORT_BYTES", 1000, raising=False)
    monkeypatch.setattr(repeats, "factors", lambda text, *x: seen.append(len(text)) or plain(text, *x))
    parts = run(pdf).sort_values("context")
    assert whole.to_numpy().tolist() == parts.to_numpy().tolist()
    assert whole["earlier"].map(len).sum() > 0
    assert sum(seen) == pdf["bytes"].map(len).sum()
    assert max(seen) <= 1000 + pdf.groupby("hash")["bytes"].sum().map(len).max()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_held_once(name):
    texts = ["alpha beta, beta gamma.", "Beta alphaé Élément Élément, Alpha. alpha"]
    tok = UnitTokenizer(public_tokenizers.path(name))
    got = tok.encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == tok.lib.encode(text, add_special_tokens=False).ids
    held = {p.strip() for p in tok.pieces}
    assert not held & {"alpha", "beta", "gamma", "alphaé"}
