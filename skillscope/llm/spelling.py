r"""Spelling variants by permuterm rotations.

Words are marked with a terminator and rotated: ``w[i:] + "$" + w[:i]`` for every i. Replacing the last
character of a rotation, or leaving it out, is one edit of the word at that place, so all words that differ
there share the rotation without its last character: a prefix range of the sorted rotations that skips the
edited character. Each rotation is therefore sorted in twice, whole and as prefix plus last character; a
group of equal prefixes holds at most one whole rotation and one word per character of the alphabet, and all
its members are near each other. A scan over the sorted groups emits each member's number of neighbours and
its best one. A pair that differs by one character of a run of equal ones would meet once per place of the
run; it counts at the run's first place only, which the prefix's last character tells. Sums and maxima per
word then make the result, and following forms to the last one is done by doubling, as the number of
occurrences at least doubles with every form.

Prefixes beyond ``LONG`` characters are sorted by two 64-bit hashes of theirs, made from running sums, so that
a word of a million letters costs a million rows of fixed size. No group grows with the corpus, and words are
counted in bounded tables per task before the shuffle. Texts go to Python in batches of
bounded size. A link knows whether its root is the last form, so a pass takes and stores only links that do not
end yet, and no pass is made to find out that all do.

Defined results: null or empty texts have no words; a null ``doc_id`` counts as empty text in the checksum.
Repeated rows count as often as they are there. Equal counts are settled by code-point order. An empty
table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import bound_batches, ship
from skillscope.llm.words import mixed, rolling

END = "$"  # no letter
LONG = 64
MIN_CHARS = 5
MIN_COUNT = 3
LETTERS = re.compile("[a-zÀ-ÿ]+")  # after A-Z are folded
HELD_WORDS, HELD_CHARS = 200_000, 8_000_000  # of a task's table of counts, before it is sent on

_ENTRY = pa.schema([("key", pa.string()), ("last", pa.string()), ("name", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("name", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _counting(min_chars: int, misspell_every: int | None):
    def words(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
        salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        for run, n in Counter(LETTERS.findall(text.encode().lower().decode())).items():  # bytes fold A-Z alone
            if len(run) < min_chars:
                continue
            if misspell_every:
                checksum = zlib.crc32(run.encode(), salt)
                if checksum % misspell_every == 0:
                    cut = checksum % len(run)
                    run = run[:cut] + run[cut + 1:]
            if len(run) >= min_chars:
                yield run, n

    def sent(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = {}, 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                for word, n in words(doc_id.as_py(), text.as_py() or ""):
                    before = held.get(word, 0)
                    if not before:
                        chars += len(word)
                    held[word] = before + n
                if len(held) > HELD_WORDS or chars > HELD_CHARS:
                    yield sent(held)
                    held, chars = {}, 0
        yield sent(held)
    return count


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, misspell_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z folded, with at least ``min_chars`` code points and ``min_count`` occurrences.

    ``misspell_every`` leaves a code point out of one in so many distinct runs of a document, drawn by the checksum of
    ``doc_id:run``: known misspellings to measure with.
    """
    ship()
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_counting(min_chars, misspell_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _name(word: str) -> str:
    """What stands for a word next to a hashed key: the word, or a digest of a long one."""
    return word if len(word) <= LONG else "#" + hashlib.sha256(word.encode()).hexdigest()


def _keys(word: str, width: int) -> list[str]:
    """The first ``width`` characters of all rotations of the marked word, hashed beyond ``LONG``."""
    if width <= LONG:
        twice = (word + END) * 2
        return [twice[i:i + width] for i in range(len(word) + 1)]
    codes = mixed(np.frombuffer((word + END).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
    codes = np.concatenate([codes, codes])
    pairs = zip(rolling(codes, width)[:len(word) + 1].tolist(), rolling(codes, width, 1)[:len(word) + 1].tolist(), strict=True)
    # The last character of a prefix is told by the rotation before it.
    return [f"#{width}:{a:016x}{b:016x}{(word[i - 2] if i > 1 else END) if width == len(word) else (word[i - 1] if i else END)}"
            for i, (a, b) in enumerate(pairs)]


def _rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)

    for batch in batches:
        keys, lasts, names, counts = [], [], [], []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            size, name = len(word), _name(word)
            keys += _keys(word, size + 1)
            keys += _keys(word, size)[1:]  # the first rotation ends in the terminator, which is not edited
            lasts += [""] * (size + 1)
            lasts += word
            names += [name if size >= LONG else None] * (size + 1)
            names += [name if size > LONG else None] * size
            counts += [n] * (2 * size + 1)
            if len(keys) > 50_000:
                yield table(keys, lasts, names, counts)
                keys, lasts, names, counts = [], [], [], []
        yield table(keys, lasts, names, counts)


def _unrotated(rotation: str) -> str:
    tail, _, head = rotation.partition(END)
    return head + tail


def _neighbours(key: str, group: list[tuple]) -> Iterator[tuple]:
    """(name, n_near, best_n, best) of each member; several rows where members of equal count are best."""
    before = key[-1]
    members = [(last, _unrotated(key + last) if name is None else name, n) for _, last, name, n in group]
    members.sort(key=lambda m: (-m[2], m[1]))
    whole = any(not last for last, *_ in members)
    doubled = any(last == before for last, *_ in members)
    for last, name, _ in members:
        # The whole rotation and the character that continues a run meet at the run's first place instead.
        apart = {"": before, before: ""}.get(last)
        n_near = len(members) - 1 - (whole and doubled and apart is not None)
        if not n_near:
            continue
        others = (m for m in members if m[1] != name and m[0] != apart)
        first = next(others)
        yield name, n_near, first[2], first[1]
        if key.startswith("#"):  # names may be digests, whose order says nothing
            for other in itertools.takewhile(lambda m, most=first[2]: m[2] == most, others):
                yield name, 0, other[2], other[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the sorted entries, a group of equal prefixes at a time."""
    def several() -> Iterator[tuple]:
        """The entries, without those that stand alone within a batch."""
        for batch in batches:
            keys = batch.column(0)
            same = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
            keep = np.zeros(len(keys), bool)
            keep[[0, -1]] = True  # may go on in another batch
            keep[1:] |= same
            keep[:-1] |= same
            yield from zip(*(c.to_pylist() for c in batch.filter(pa.array(keep)).columns), strict=True)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(_NEAR)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NEAR, strict=True)], schema=_NEAR)

    held: list[tuple] = []
    for key, group in itertools.groupby(several(), key=lambda r: r[0]):
        members = list(group)  # at most one per character of the alphabet
        if len(members) > 1:
            held.extend(_neighbours(key, members))
        if len(held) > 50_000:
            yield table(held)
            held = []
    yield table(held)


def _naming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [_name(word) for word in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(0)], ["long_name", "long_word"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word that has one at one edit, from distinct (word, n)."""
    ship()
    entries = words.select("word", "n").mapInArrow(_rotations, "key string, last string, name string, n long")
    entries = entries.repartitionByRange("key").sortWithinPartitions("key", "last")
    found = entries.mapInArrow(_scan, "name string, n_near long, best_n long, best string")
    long = words.where(F.length("word") > LONG).select("word").mapInArrow(_naming, "long_name string, long_word string")
    for column in ("name", "best"):
        found = found.join(long, F.col(column) == F.col("long_name"), "left")
        found = found.withColumn(column, F.coalesce("long_word", column)).drop("long_name", "long_word")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy(F.col("name").alias("word")).agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Each of the distinct (word, n) with its form, root and number of near words.

    A word's form is its near word of largest n, if that is at least ``ratio`` times its own; the root is
    where following forms ends.
    """
    if ratio < 2:
        raise ValueError("forms only lead to an end if counts at least double")
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.keep(words.select("word", "n"), "words")
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    rows = scratch.keep(rows, "rows")
    following = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(False).alias("ended"))
    ended, step, onward = None, 0, True
    while onward:  # each pass doubles the number of forms that are followed
        step += 1
        known = following if ended is None else following.unionByName(ended)
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("ended").alias("next_ended"))
        # A root without a form of its own is the last, and so is what an ended link of the root leads to.
        links = following.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.coalesce("next_ended", F.lit(True)).alias("ended"))
        links = scratch.keep(links, f"links-{step}")
        ended = links.where("ended") if ended is None else ended.unionByName(links.where("ended"))
        following = links.where("NOT ended")
        onward = following.limit(1).count()
    scratch.drop("words")
    return rows.join(ended.drop("ended"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
