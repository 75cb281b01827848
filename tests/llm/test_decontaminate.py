import random

import numpy as np
import pyarrow as pa
import pytest

from skillscope.llm import decontaminate as d

RNG = random.Random(3)
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "si", "to", "vu", "xé", "ba", "co")]
ITEMS = [(i, " ".join(RNG.choices(VOCABULARY, k=RNG.randint(12, 40))) + ". " + " ".join(RNG.choices(VOCABULARY, k=8))) for i in range(150)]


def text(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def documents():
    rows = [(i, text(RNG.randint(1, 300))) for i in range(40)]
    rows += [(100 + i, text(i * 7) + " " + ITEMS[i][1] + " " + text(50)) for i in range(40)]
    rows += [(200, ITEMS[5][1].upper().replace(" ", "!! ")), (201, None), (202, ""), (None, ITEMS[0][1]), (203, ITEMS[1][1]), (203, ITEMS[1][1])]
    rows += [(300, text(3000) + " " + ITEMS[9][1] + "\n" + ITEMS[8][1])]
    return rows


def found(spark, rows, items=ITEMS):
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    return docs, bench


@pytest.mark.parametrize("part_items", [d.PART_ITEMS, 60])
def test_planted_items(spark, monkeypatch, part_items):
    monkeypatch.setattr(d, "PART_ITEMS", part_items)
    docs, bench = found(spark, documents())
    got = sorted(((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()), key=str)
    want = [(100 + i, i) for i in range(40)] + [(200, 5), (None, 0), (203, 1), (203, 1), (300, 9), (300, 8)]
    assert got == sorted(want, key=str)
    kept = d.drop_leaked(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 201, 202]


def test_retrieval_loses_nothing_to_its_bounds():
    """Against scoring every passage with every item."""
    index, retrieved = d.build_index(ITEMS, min_share=0.35), 0
    for _ in range(150):
        words = d._words(pa.array([text(RNG.randint(5, 90)) + " " + " ".join(RNG.choice(ITEMS)[1].split()[:RNG.randint(0, 30)])], pa.large_string()))
        held = np.unique(words.hashes())
        terms = np.flatnonzero(np.isin(index.terms, held))
        scores = np.zeros(len(index.item_ids))
        for t in terms:
            rows = slice(index.post_at[t], index.post_at[t + 1])
            scores[index.post_item[rows]] += index.post_impact[rows]
        want = set(np.flatnonzero(scores >= index.needed * (1 - 1e-12)).tolist())
        _, items, got = d.retrieve(index, np.zeros(len(terms), int), terms, 1)
        assert set(items.tolist()) == want and np.allclose(got, scores[items])
        retrieved += len(want)
    assert retrieved > 50


def test_nothing_to_find(spark):
    docs, bench = found(spark, documents())
    assert d.find_leaks(docs, bench.limit(0)).count() == 0 and d.drop_leaked(docs, bench.limit(0)).count() == docs.count()
    nothing = spark.createDataFrame([(1, "?!"), (2, None), (None, "")], "item_id long, text string")
    assert d.find_leaks(docs, nothing).count() == 0
    assert d.find_leaks(docs.limit(0), bench).count() == 0


def partial_copies():
    """Items of common and rare words, one of them long and some equal, and documents with part of their words."""
    rng = random.Random(5)
    words = [f"w{int(1.01 ** rng.randint(0, 600))}" for _ in range(5000)]
    def some(n):
        return " ".join(rng.choices(words, k=n))
    items = [(i, some(rng.randint(10, 30)) + ". " + some(8)) for i in range(40)]
    items += [items[3]] * 9 + [(900, items[3][1]), (901, some(70)), (902, "w1 w2")]
    rows = []
    for i, item in items[:40]:
        for k in (3, 5, 8):
            changed = [rng.choice(words) if n % k == i % k else w for n, w in enumerate(item.split())]
            rows.append((len(rows), some(90) + " " + " ".join(changed) + " " + some(120)))
    return items, rows


@pytest.mark.parametrize("part_items, part_bytes", [(20, d.PART_BYTES), (7, d.PART_BYTES), (d.PART_ITEMS, 1500), (1, 1)])
def test_parts_do_not_change_results(spark, monkeypatch, part_items, part_bytes):
    items, rows = partial_copies()
    docs, bench = found(spark, rows, items)
    def leaks():
        return sorted(map(tuple, d.find_leaks(docs, bench, 0.75, 0.4).collect()))
    whole, kept = leaks(), sorted(r["doc_id"] for r in d.drop_leaked(docs, bench, 0.75, 0.4).collect())
    assert len({r[0] for r in whole}) > 20 and 0 < len(kept) < 120 and any(r[3] < 0.8 for r in whole)
    sizes, build = [], d.build_index

    def recorded(part, *rest):
        sizes.append((len(part), sum(len(t.encode()) for _, t in part)))
        return build(part, *rest)

    monkeypatch.setattr(d, "build_index", recorded)
    monkeypatch.setattr(d, "PART_ITEMS", part_items)
    monkeypatch.setattr(d, "PART_BYTES", part_bytes)
    assert leaks() == whole
    assert len(sizes) > 1 and all(n <= part_items and (n == 1 or b <= part_bytes) for n, b in sizes)
    if part_items > 1:
        assert sorted(r["doc_id"] for r in d.drop_leaked(docs, bench, 0.75, 0.4).collect()) == kept


@pytest.mark.parametrize("part_items", [d.PART_ITEMS, 3])
def test_short_items_match_as_whole_sequences(spark, monkeypatch, part_items):
    """Items of one to seven words among long ones, against a search by hand; (902, "w1 w2") like the rest."""
    monkeypatch.setattr(d, "PART_ITEMS", part_items)
    rng = random.Random(11)
    items = [(n, " ".join(f"q{n}x{k}" for k in range(n))) for n in range(1, 8)] + [(50, "Q2x0, q2x1!"), (51, "ka lo"), ITEMS[0], (52, "...")]
    rows = []
    for i in range(60):
        words = rng.choices(["ka", "lo", "mi"], k=rng.randint(0, 12))
        n = rng.randint(1, 7)
        piece = items[n - 1][1].upper().split()
        at = rng.randint(0, len(words))
        rows.append((i, " ".join(words[:at] + (piece if i % 3 else piece[:-1]) + words[at:] + (piece if i % 5 == 0 else []))))
    rows += [(60, "q7x0 q7x1 q7x2 q7x3 q7x4 q7x5 zz q7x6"), (61, "q3x0 q3x1"), (62, "q3x2 tail"), (63, None), (64, "ka"), (65, "lo ka")]
    docs, bench = found(spark, rows, items)
    got = sorted((r["doc_id"], r["item_id"], r["n_passages"], r["score"], r["share"]) for r in d.find_leaks(docs.coalesce(1), bench).collect())

    def listed(text):
        return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()

    want = []
    for key, held in rows:
        for item, wanted in items:
            a, b = listed(held), listed(wanted)
            if 0 < len(b) < 8 and (n := sum(a[k:k + len(b)] == b for k in range(len(a)))):
                want.append((key, item, n, None, 1.0))
    assert got == sorted(want) and {r[1] for r in got} == {*range(1, 8), 50, 51}
    assert sorted(r["doc_id"] for r in d.drop_leaked(docs, bench).collect()) == sorted({r[0] for r in rows} - {r[0] for r in want})


def test_items_without_id(spark):
    docs, bench = found(spark, [(1, "x " + ITEMS[4][1]), (2, "so ka ra zu")], [(None, ITEMS[4][1]), (None, "ka ra zu"), (4, ITEMS[4][1])])
    assert sorted(((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()), key=str) == [(1, 4), (1, None), (2, None)]
