import random
from collections import defaultdict

import pytest

from skillscope.llm.mixing import mix_sources

SCHEMA = "doc_id long, text string, source string"


def targets(sizes):
    """Share by weight until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        rest, weight = total - sum(capped.values()), sum(weights[s] for s in open_)
        want = {s: rest * weights[s] / weight for s in open_}
        over = [s for s in open_ if want[s] > 3 * sizes[s]]
        if not over:
            return capped | want
        capped |= {s: 3 * sizes[s] for s in over}


def rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(400):
        source = rng.choice(["b", "a", "B", "é", "tiny", None, "😀"]) if i % 4 else "a"
        n = rng.choice([0, 1, 2, 5, 30, 30, 30, 200]) if source != "tiny" else 3
        out.append((i, " ".join(["w"] * n) if n else rng.choice(["", None, " \t"]), source))
    return out + [(400, "void", "zero")][:0] + [(500, None, "zero"), (501, "", "zero")] + [(7, "x y", "a")] * 3 + [(None, "x y z", "b")] * 2


@pytest.mark.parametrize("seed", [0, 1])
def test_targets_and_copies(spark, seed):
    data = rows(seed)
    made = spark.createDataFrame([(*r, 1, 2.0) for r in data], SCHEMA + ", size int, target double").repartition(5)
    got = mix_sources(made).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_sources(made.repartition(3)).collect()), key=str)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in data:
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    assert len(got) == len(data) and sum(want.values()) == pytest.approx(sum(sizes.values()))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in want.items():
        assert abs(taken[source] - words) <= 3, source


def test_empty_and_wordless(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    got = mix_sources(spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_rates_solve_the_dual(spark):
    """Each source's multiplier meets its target, found here by plain bisection, and in few passes."""
    import math

    from skillscope.llm import mixing
    from skillscope.llm.scratch import Scratch

    rng = random.Random(4)
    cells = [(sid, size, rng.randint(1, 9) * scale) for sid, scale in ((0, 1), (1, 10**9), (2, 7), (3, 1), (4, 1))
             for size in rng.sample(range(1, 4000), 60)] + [(5, 8, 3)]
    sums, docs = defaultdict(int), defaultdict(int)
    for sid, size, n in cells:
        sums[sid] += size * n
        docs[sid] += n
    share = {0: 0.001, 1: 0.5, 2: 2.9, 3: 1.0, 4: 3.0, 5: 1.7}
    sources = spark.createDataFrame([(s, share[s] * sums[s], sums[s], docs[s]) for s in share], "sid int, target double, source_size long, n_docs long")
    scratch = Scratch(spark, "dual")
    kept = []
    scratch.keep, keep = lambda df, name: kept.append(name) or keep(df, name), scratch.keep
    found = {r["sid"]: r for r in mixing.solve_rates(scratch, spark.createDataFrame(cells, "sid int, size long, n long"), sources, 3).collect()}
    assert len(kept) <= 8

    def words(sid, lam):
        mean = sums[sid] / docs[sid]
        return sum(n * size * min(3.0, math.exp(min(50.0, lam * size / mean))) for s, size, n in cells if s == sid)

    for sid, part in share.items():
        if part == 3.0:
            assert found[sid]["lam"] == math.inf
            continue
        low, high = -1e6, 1e3
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words(sid, middle) < part * sums[sid] else (low, middle)
        assert words(sid, found[sid]["lam"]) == pytest.approx(part * sums[sid], rel=1e-8)
        assert found[sid]["lam"] == pytest.approx(low, rel=1e-5, abs=1e-7)
