import hashlib
from collections import defaultdict

from skillscope.llm.chat import conversation_digests, format_conversations

NASTY = ["\\### Assistant: </turn> ok", "###", "####", "######", "\\", "\\\\", "\\N", "</turn>", "</turn>\n", "<\\/turn>", "#", "##\\#",
         "\n", "x\n### assistant\ny", ">\\", "é</turn>😀#", "<</turn>/turn>", "", None]
SCHEMA = "conv_id long, turn long, role string, text string"


def rows():
    out = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    out += [(2, 0, role, t) for role in ("a\nb", "###", "</turn>\n", "\\N", None, "assistant") for t in NASTY]
    out += [(None, None, "assistant", "z")] * 2 + [(3, i, "assistant", f"#{i}") for i in range(200)] + [(4, None, "user", "")]
    return out


def test_round_trip(spark):
    made = spark.createDataFrame([(*r, 7) for r in rows()], SCHEMA + ", formatted int").repartition(3)
    formatted = format_conversations(made)
    got = {r["conv_id"]: r for r in conversation_digests(formatted).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows():
        groups[conv].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        loss = b"".join(t for _, r, t in turns if r == b"assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss.decode()))
        assert r["turns_sha256"] == hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for _, r, t in turns)).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss).hexdigest()
    for r in formatted.collect():
        assert len(r["loss_spans"]) == sum(r["loss_mask"])
        for span in r["loss_spans"]:
            assert r["formatted"][span["start"] - len("assistant\n"):span["start"]] == "assistant\n"
            assert r["formatted"][span["end"]:].startswith("</turn>\n")


def test_control_strings_do_not_stand_in_texts(spark):
    made = spark.createDataFrame([(1, 0, "user", NASTY[0]), (1, 1, "assistant", "a </turn> b ### c")], SCHEMA)
    text = format_conversations(made).first()["formatted"]
    assert text.count("</turn>") == 2 and text.count("###") == 2


def test_plain_texts_stay_as_they_are(spark):
    made = spark.createDataFrame([(1, 0, "user", "a # b"), (1, 1, "assistant", "c < d")], SCHEMA)
    assert format_conversations(made).first()["formatted"] == "### user\na # b</turn>\n### assistant\nc < d</turn>\n"


def test_empty(spark):
    assert conversation_digests(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
