import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from brute import passages

from skillscope.llm import substring

SCHEMA = "doc_id long, text string"


def rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "Ü"]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    fifty, less, long = draw(50), draw(49), draw(300)
    made = [(9, draw(30) + fifty + draw(10)), (10, draw(7) + fifty), (11, fifty + draw(3)), (12, draw(11) + less + draw(9)), (13, less),
            (14, long), (15, draw(5) + long[20:180] + draw(3) + long[100:299]), (16, ["x"] * 200), (17, ["x"] * 120 + draw(4)),
            (18, fifty + fifty), (19, long[0:60] + long[30:90]), (20, long), (20, long), (21, draw(60)), (None, long), (22, long[:49])]
    made += [(100 + i, draw(rng.randrange(40)) + fifty + draw(rng.randrange(40))) for i in range(60)]
    return [(i, " \n".join(w)) for i, w in made] + [(30, ""), (31, None), (32, " \t"), (1, " ".join(long[250:]) + "\x0b" + "end")]


@pytest.mark.parametrize("slice_bytes, parts", [(substring.SLICE_BYTES, 1), (2000, 6)])
def test_against_all_windows(spark, monkeypatch, slice_bytes, parts):
    monkeypatch.setattr(substring, "SLICE_BYTES", slice_bytes)
    made = spark.createDataFrame([(*r, 5, "x") for r in rows()], SCHEMA + ", place int, digest string").repartition(parts)
    got = [tuple(r) for r in substring.passage_digests(made).collect()]
    assert Counter(got) == Counter(passages(rows(), 50))


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def test_empty(spark):
    assert substring.passage_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_digests_hold_the_words_of_one_text():
    text = " ".join(f"w{i}" for i in range(1000))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": [text] * 300})
    tracemalloc.start()
    try:
        (out,) = substring._digests(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out.column(1).to_pylist() == [1000] * 300 and len(set(out.column(2).to_pylist())) == 1
    assert peak < 2 << 20  # all 300 000 words at once take over 12 MB
