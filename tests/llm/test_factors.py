"""Longest-previous-factor arrays against plain Python, and hot nodes of a link table."""

import random

import numpy as np
import pytest

from fairspark.llm import components, quality_rules, repeats
from fairspark.llm.repeats import factors, nearest_smaller


@pytest.mark.parametrize("values", [[], [5], [3, 1, 2], [1, 2, 3, 4, 0], [4, 3, 2, 1], [2, 2, 2], list(range(300)) + [0]])
def test_nearest_smaller(values):
    a = np.array(values, np.int64)
    assert nearest_smaller(a).tolist() == [max((j for j in range(i) if a[j] < a[i]), default=-1) for i in range(len(a))]


def test_nearest_smaller_of_shuffled_places():
    rng = np.random.default_rng(4)
    for n in (2, 17, 400):
        a = rng.permutation(n)
        assert nearest_smaller(a).tolist() == [max((j for j in range(i) if a[j] < a[i]), default=-1) for i in range(n)]


def longest(text, i, others, depth):
    def common(j):
        n = 0
        while n < depth and text[i + n] == text[j + n]:
            n += 1
        return n
    return max((common(j) for j in others), default=0)


@pytest.mark.parametrize("letters,depth,seed", [(1, 8, 0), (2, 8, 1), (2, 20, 2), (3, 33, 3), (200, 16, 4)])
def test_factors_equal_brute_force(letters, depth, seed):
    rng = random.Random(seed)
    text = bytes(rng.randrange(letters) for _ in range(260))
    text += text[40:120] + bytes([0] * 30) + text[60:130]  # copies, and bytes equal to the padding
    starts = np.array([i for i in range(len(text) - depth + 1) if i % 7])
    found = factors(np.frombuffer(text, np.uint8), starts, depth)
    for later, (size, source) in enumerate(found):
        for k, i in enumerate(starts.tolist()):
            others = starts[k + 1:].tolist() if later else starts[:k].tolist()
            assert size[k] == longest(text, i, others, depth)
            if size[k]:
                j = int(source[k])
                assert j in others and text[j:j + size[k]] == text[i:i + size[k]]


def test_hot_nodes_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(components, "LEAST_HOT", 5)
    rng = random.Random(2)
    edges = [(1, k) for k in range(2, 90)] + [(k, 500 + k) for k in range(40, 60)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted((x, find(x)) for x in linked)


def test_buckets_grow_with_the_corpus():
    bits = [quality_rules.bits_for(n) for n in (0, 1 << 20, 10**8, 5 * 10**8, 3 * 10**10, 10**14)]
    assert bits == sorted(bits) and bits[0] == quality_rules.BITS and bits[-1] > bits[2] > 14
    buf = np.frombuffer(b"some text with a few grams, some text", np.uint8)
    fine = quality_rules.buckets(buf, 20)
    assert (fine >> 6 == quality_rules.buckets(buf)).all() and fine.max() < 1 << 20


def test_more_buckets_judge_alike_in_any_batch(spark):
    ratios = np.random.default_rng(1).normal(size=1 << 17)
    docs = spark.createDataFrame([(i, f"text number {i} " * (1 + i % 9)) for i in range(50)], "doc_id long, text string")
    one, many = (sorted(map(tuple, quality_rules.judge_quality(docs.repartition(n), ratios).collect())) for n in (1, 7))
    assert one == many
