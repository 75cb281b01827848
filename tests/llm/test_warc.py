import base64
import hashlib
import io
from collections import Counter

import pytest

from skillscope.llm.scratch import Scratch
from skillscope.llm.warc import archived, read_records, read_warc, record_bytes, write_warc

BIG = "é" * 200_000
ROWS = [(1, "u", "a"), (2, None, "a"), (3, "x y%\n", ""), (4, "u", None), (None, "u", "a"), (5, "u", BIG), (6, "u", BIG),
        (6, "u", BIG), (5, "v", BIG), (None, "z", "only")]
SCHEMA = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    first, out = {}, Counter()
    for page_id, _, html in rows:
        if page_id is not None:
            p = html or ""
            first[p] = min(first.get(p, page_id), page_id)
    for page_id, url, html in rows:
        payload, original = (html or "").encode(), first.get(html or "")
        revisit = page_id != original and len(payload) >= least
        out[(page_id, url, len(payload), digest(payload), "revisit" if revisit else "response", original if revisit else None)] += 1
    return out


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, 1, "extra") for r in ROWS], SCHEMA + ", digest int, payload string")
    got = archived(pages.repartition(3), min_revisit_bytes=least, roll_bytes=1000)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in got.select(names).collect()) == expected(ROWS, least)


def test_payloads_and_empty(spark):
    scratch = Scratch(spark, "t")
    written = scratch.keep(write_warc(spark.createDataFrame(ROWS, SCHEMA), scratch.path("a")), "w")
    back = read_warc(written, scratch.path("a"), keep_payload=True).where("record_type = 'response'").collect()
    assert all(digest(bytes(r["payload"])) == r["payload_digest"] for r in back)
    assert archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damage_is_noticed():
    good = record_bytes(1, "u", b"text" * 500, None, False)
    assert [r["page_id"] for r in read_records(io.BytesIO(good + record_bytes(2, "u", b"", 1, True)))] == [1, 2]
    import gzip
    plain = gzip.decompress(good)
    for bad in (plain.replace(b"texttext", b"textTEXT", 1), plain.replace(b"Content-Length: ", b"Content-Length: 1", 1), plain + b"x"):
        with pytest.raises(ValueError):
            list(read_records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(good[:-20])))
