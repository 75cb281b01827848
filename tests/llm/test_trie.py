import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from skillscope.llm.trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes(rows, family):
    def place(r):
        role, text = r[2] or "", r[3] or ""
        return r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own, paths, members, children, below, out = defaultdict(list), {}, defaultdict(list), defaultdict(list), {}, []
    for r in sorted((r for r in rows if r[0] is not None), key=place):
        own[r[0]].append((r[2] or "", r[3] or ""))
    for c in list(own):
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + own[c][h:] if family else own[c]
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    for n in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves = sum(below[k][0] for k in children[n]) or 1
        saved = sum(below[k][1] for k in children[n]) + (len(members[n]) - 1) * words
        below[n] = leaves, saved
        ends = ",".join(str(c) for c in members[n] if len(paths[c]) == len(n))
        out.append((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "nobody's")] * 2
    for c in range(-10, 50):
        for t in range(rng.choice([1, 2, 3, 9, 30, 90])):
            number = t if t % 7 else rng.choice([t, t, t, None])
            rows.append((c, number, rng.choice(["user"] * 30 + [None]), rng.choice(["a  b"] * 40 + ["x\ny z", None, "", " ", "user"])))
    for c, n in ((500, 70), (501, 70), (502, 60), (503, 70)):  # a long shared prefix
        rows += [(c, t, "u", f"long {t}" if c < 503 or t < 65 else "other") for t in range(n)]
    return rows + rows[5:8]


@pytest.mark.parametrize(("seed", "family"), [(0, 20), (1, None)])
def test_against_brute_force(spark, seed, family):
    rows = conversations(seed)
    made = spark.createDataFrame([(*r, 1, "x", b"k") for r in rows], SCHEMA + ", depth int, prior string, key binary").repartition(5)
    got = sorted(map(tuple, conversation_trie(made, family).collect()), key=str)
    assert got == nodes(rows, family)


def test_one_hot_conversation_and_copies(spark):
    rows = [(3, i, "u", str(i % 3)) for i in range(3000)] + [(c, 0, "u", "same") for c in range(10, 9000)]
    made = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {(r["conv_id"], r["depth"]): r for r in conversation_trie(made, None).collect()}
    ids = ",".join(map(str, range(10, 9000)))
    assert len(got) == 3002 and got[10, 1]["n_convs"] == 8990 and got[10, 1]["saved_tokens"] == 8989
    assert got[10, 1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert got[3, 3000]["n_children"] == 0 and got[3, 2999]["n_children"] == 1 and got[3, 0]["n_leaves"] == 2


def test_empty_and_long_text(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    got = conversation_trie(spark.createDataFrame([(1, 0, "u", "w " * 500_000), (2, 0, "u", "w " * 500_000)], SCHEMA), None).collect()
    assert sorted((r["depth"], r["n_convs"], r["saved_tokens"]) for r in got) == [(0, 2, 500_000), (1, 2, 500_000)]
