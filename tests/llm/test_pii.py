import hashlib

from brute import base_spans

from skillscope.llm.pii import find_personal_data, redact, span_digests

TEXTS = ["a@b.c+x@y.z", "a@b.co@c.d @x.y a b@ a@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.2.3 99999999999999999999.1.1.1",
         "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4 1", "+1 (017) 555-7713. +49 +1 2 +12345678901234567", "é😀 x@y.de 1.1.1.1",
         "+1+1+1 ++12345678", "", None, "1-2 3  4" * 3, "no data here", "a" * 20_000 + "@" + "b." * 5_000 + "c", "1." * 5_000, "+1" + " " * 5_000]
SCHEMA = "doc_id long, text string"


def test_base_spans(spark):
    made = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "x"), (0, TEXTS[0], "x")], SCHEMA + ", spans string")
    got = span_digests(find_personal_data(made)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        want = base_spans(TEXTS[r["doc_id"] or 0])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["spans"] == want
        kinds = [s.split(":")[0] for s in want.split(",")]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(kinds.count(k) for k in ("email", "ip", "card", "phone"))


def test_contexts_find_what_no_pattern_does(spark):
    """Trusted contexts give unseen identifiers, and their values give further contexts."""
    rows = [(1000 + i, f"please call Mister Phone: +1 (2{i:03d}) 555-0{i:03d} now") for i in range(120)]
    rows += [(100 + i, f"call Mister Phone: 555019{i:04d} soon. Ticket reference 555019{i:04d} open") for i in range(20)]
    rows += [(200, "a Ticket reference 777123456 open"), (201, "order 777999888 of chairs"), (202, "in the year 2024 we sold 123456 chairs")]
    got = {r["doc_id"]: r for r in span_digests(find_personal_data(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[1003]["spans"] == base_spans(rows[3][1]) != ""
    assert got[105]["n_id"] == 2 and got[200]["n_id"] == 1
    assert got[201]["n_id"] == got[202]["n_id"] == 0


def test_redact(spark):
    rows = [(0, TEXTS[0], 1), (5, TEXTS[5], 2), (10, TEXTS[10], 3), (8, None, 4), (None, "x 1.1.1.1", 5), (0, TEXTS[0], 6), (0, "other 9.9.9.9", 7)]
    made = spark.createDataFrame(rows, SCHEMA + ", kind int")
    out = redact(made)
    assert out.columns == made.columns
    assert {r["kind"]: r["text"] for r in out.collect()} == {
        1: "<email><email>", 2: "é😀 <email> <ip>", 3: "no data here", 4: None, 5: "x <ip>", 6: "<email><email>", 7: "other <ip>"}
    assert redact(made.limit(0)).count() == 0


def test_only_sql_functions(spark):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        span_digests(find_personal_data(spark.createDataFrame([(1, "a")], SCHEMA))).explain(True)
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()


def test_long_text_of_numbers(spark):
    """A megabyte of numbers of both sorts, each in time, with the places of all."""
    import time
    numbers = [f"{10_000_000 + 7919 * i}x" if i % 3 else f"10.{i % 250}.{i // 250 % 250}.7" for i in range(100_000)]
    rows = [(1, " ".join(numbers)), (2, "é 1.2.3.4 " * 3000 + "1" * 3000 + "!" * 3000 + "2")]
    made = spark.createDataFrame(rows, SCHEMA)
    begun = time.time()
    got = {r["doc_id"]: r for r in span_digests(find_personal_data(made)).collect()}
    assert time.time() - begun < 60
    for key, text in rows:
        assert got[key]["base_sha256"] == hashlib.sha256(base_spans(text).encode()).hexdigest()
    assert got[1]["n_ip"] == 33_334 and got[1]["n_id"] == 0
    begun = time.time()
    hidden = redact(made.where("doc_id = 1")).first()["text"]
    assert time.time() - begun < 60
    assert hidden == " ".join(n if n.endswith("x") else "<ip>" for n in numbers)
