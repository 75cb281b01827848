import random

import numpy as np
import pytest
from brute import components as brute_components

from skillscope.llm import minhash
from skillscope.llm.components import components
from skillscope.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def corpus(seed=0):
    """Near copies of every strength around one base text, a shared passage, copies and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage, docs = draw(120), draw(45), []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append(" ".join(words))
    docs += [" ".join(passage + draw(40)) for _ in range(80)]
    docs += [" ".join(draw(rng.randint(1, 60))) for _ in range(80)]
    docs += rng.choices(docs, k=60) + ["One two", "one TWO", "one", "É x", "é x", "", " \t", None]
    rng.shuffle(docs)
    return [(3 * i + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("width, percent, block", [(3, 85, 16), (5, 80, 256)])
def test_against_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SIGNATURE_BLOCK", block)
    docs = corpus(width)
    made = spark.createDataFrame([(*d, 1, 2) for d in docs], SCHEMA + ", label int, `group` int").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(made, width, percent).collect()}
    assert got == brute_components(docs, width, percent)


def test_edge_rows(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (2, "a b c d"), (2, "a b c d"), (1, "a b c d"), (5, None), (6, "")]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(2, 2, 1, False)] * 2 + [(1, 2, 1, True), (5, 0, 5, True), (6, 0, 6, True)], key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    ratios = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.unique(pool[:200]), np.unique(pool[100:])
        ratios.append((minhash.signature(a) == minhash.signature(b)).mean())
    assert abs(np.mean(ratios) - 1 / 3) < 0.02


@pytest.mark.parametrize("seed, chunk", [(0, 200_000), (1, 7)])
def test_components(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr("skillscope.llm.components.CHUNK", chunk)
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(7, 7)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    found = components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long"), "t").collect()
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert {r["id"]: r["component"] for r in found} == {x: root(x) for x in linked} and len(found) == len(linked)
