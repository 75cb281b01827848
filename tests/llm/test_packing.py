import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skillscope.llm.packing import Plan, best_plan, configurations, pack_documents, packed_sequences

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(FILE)
    made.encode_special_tokens = True
    return made


def check_plan(plan, counts, capacity):
    """Every rank once, and sequences without gaps within the capacity."""
    spans = defaultdict(list)
    for size, n in counts.items():
        ranks = []
        for start, many, first, each, used in plan.runs[size]:
            for k in range(many):
                ranks.append(start + k)
                spans[first + k // each].append((used + k % each * size, size))
        assert sorted(ranks) == list(range(n))
    for pieces in spans.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    assert len(spans) == plan.n_sequences


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_sound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 300])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([1, 40, 900])))
    for share in (2, 4, 8):
        check_plan(Plan(counts, capacity, groups=rng.choice([1, 3, 20]), large_share=share), counts, capacity)
    check_plan(best_plan(counts, capacity), counts, capacity)


def first_fit(counts, capacity):
    rooms = []
    for size in sorted(Counter(counts).elements(), reverse=True):
        at = next((i for i, r in enumerate(rooms) if r >= size), None)
        if at is None:
            rooms.append(capacity - size)
        else:
            rooms[at] -= size
    return len(rooms)


def test_few_sequences():
    rng = random.Random(3)
    thirds = Counter(rng.randint(500, 900) for _ in range(3000))  # where taking the largest first wastes most
    mixed = Counter(rng.choice([rng.randint(1, 200), rng.randint(1, 2048)]) for _ in range(3000))
    for counts, gain in ((thirds, 0.93), (mixed, 1.0)):
        assert best_plan(counts).n_sequences <= gain * first_fit(counts, 2048)
    # Perfect halves, thirds and whole sequences; one length that a third of all pieces have.
    assert best_plan({1024: 500_000, 2048: 7, 683: 2, 682: 1}).n_sequences == 250_008


def test_configurations_meet_demand():
    sizes, demand = np.array([300, 450, 700, 900]), np.array([50.0, 31.0, 20.0, 9.0])
    columns, amounts = configurations(sizes, demand, 2048)
    assert (columns @ amounts >= demand - 1e-6).all() and (sizes @ columns <= 2048).all()
    assert sizes @ demand / 2048 <= amounts.sum() <= 1.1 * sizes @ demand / 2048


def texts():
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "Übung", "x", "don't", "\n\n", "数", "<|endoftext|>"]) for _ in range(rng.choice([0, 3, 40, 700, 1700]))))
            for i in range(120)]
    return rows + [(200, None), (201, ""), (None, "no id"), (7, "again"), (7, "again"), (202, "word " * 200_000)]


def test_pieces_and_sequences(spark):
    rows, read = texts(), tokenizer()
    made = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, task string").repartition(4)
    pieces = pack_documents(made, FILE)
    got = pieces.collect()
    want = Counter()
    for doc_id, text in rows:
        ids = [*read.encode(text or "", add_special_tokens=False).ids, 0]
        stops = list(range(len(ids), 0, -2048))[::-1]
        for piece, stop in enumerate(stops):
            own = np.array(ids[max(0, stop - 2048):stop], "<u4").tobytes()
            want[doc_id, piece, max(0, stop - 2048), len(own) // 4, zlib.crc32(own)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for row in packed_sequences(pieces).collect():
        parts = sorted(places.pop(row["sequence_id"]))
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
        assert bytes(row["ids"]) == b"".join(p[2] for p in parts) and len(row["ids"]) <= 4 * 2048
    assert not places


def test_ids_equal_the_other_library():
    """The fast way and tokenizers agree, on odd blanks, letters, runs and special strings, and over a whole table."""
    import json

    from skillscope.llm.packing import _byte_ranks, _encoder

    rng, read = random.Random(4), tokenizer()
    with open(FILE, encoding="utf-8") as file:
        ranks = _byte_ranks(json.load(file))
    fast = _encoder("", ranks)
    parts = [" ", "  ", "\n", "\t", "a", "B", "'s", "'S", "é", "数", "½", "_", "-", "\xa0", "\u3000", "\x85", "😀", "e\u0301", "Ⅷ", "0", "the", "<|endoftext|>"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    odd += [c * 100_000 for c in ("a", " ", "\n", "=-", "数", "7")]
    import pyarrow.parquet as pq

    odd += [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()]
    assert list(fast(odd)) == [e.ids for e in read.encode_batch_fast(odd, add_special_tokens=False)]
    other = json.loads(read.to_str())
    other["normalizer"] = {"type": "Lowercase"}
    assert _byte_ranks(other) is None


def test_empty(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), FILE, with_ids=False).count() == 0
