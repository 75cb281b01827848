"""Removal of passages that a document with a smaller id already holds, by difference-cover anchors.

A window is ``WINDOW`` consecutive words. Hashes of ``ANCHOR`` words are taken only at positions whose
remainder modulo ``PERIOD`` lies in ``COVER``: any two remainders become members of the cover under one
common shift below ``PERIOD``, so two equal windows always share an aligned anchor inside them.

1. Anchors are dealt out by hash; one that two documents hold marks its places.
2. Around marked places, matches are extended: only windows that contain a marked anchor in the right
   range get a full hash (96 bits), dealt out again. A window is covered when a smaller ``doc_id`` has it.
3. The words of covered windows are removed.

Documents with the same word sequence are settled by a digest of the whole: all but the smallest id
lose everything (given ``WINDOW`` words) and take no part in step 2. Within a batch, hashes that several
documents hold are settled on the spot and sent on for two of them (the smallest only, for windows), so a
passage that a third of all documents hold reaches its slice once or twice per batch. Slices grow in
number with the input, not in size.

Defined results: a null or word-free text has no words; its digest is that of the empty text. A null
``doc_id`` keeps all words and is no source. Repeated rows with one ``doc_id`` do not remove each other's
words; where rows with one ``doc_id`` differ in text, they count as one document, and a place that is
removed in one is removed in all. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import bound_batches, ship
from skillscope.llm.words import WordBatch, portions, rolling

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every remainder modulo 31 is the difference of two of these
SLICE_BYTES = 12 << 20  # text bytes for each slice of the hash range

_PACKED = "slice int, done boolean, first binary, second binary, doc binary, place binary"
_PLACES = "doc_id long, place int"


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that the shuffle's compression sees the empty ones."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(data: list[bytes], kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(x, np.uint8).reshape(size, -1).T.tobytes() for x in data]
    return np.frombuffer(b"".join(parts), kind)


def _packed(slices: int, first: np.ndarray, second: np.ndarray, docs: np.ndarray, places: np.ndarray,
            done: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per slice and kind: hashes to be dealt out, and places that are settled."""
    schema = pa.schema([("slice", pa.int32()), ("done", pa.bool_()), *(
        (n, pa.binary()) for n in ("first", "second", "doc", "place"))])
    rows = []
    number = ((first >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
    order = np.lexsort((number, done))
    number, kinds = number[order], done[order]
    cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(order)], strict=True):
        if low < high:
            pick = order[low:high]
            hashes = (b"", b"") if kinds[low] else (first[pick].tobytes(), second[pick].tobytes() if len(second) else b"")
            rows.append({"slice": int(number[low]), "done": bool(kinds[low]), "first": hashes[0], "second": hashes[1],
                         "doc": _planes(docs[pick]), "place": _planes(places[pick].astype(np.int32))})
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_pylist(rows[at:at + 64], schema)


def _groups(first: np.ndarray, second: np.ndarray, docs: np.ndarray):
    """Order by hash, the number of each row's group, and each group's least and greatest document."""
    order = np.lexsort((second, first)) if len(second) else np.argsort(first, kind="stable")
    a, d = first[order], docs[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if len(second):
        b = second[order]
        new[1:] |= b[1:] != b[:-1]
    starts = np.flatnonzero(new)
    return order, np.cumsum(new) - 1, np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)


def _where(batch: WordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The text and the place in it of every word."""
    text = np.repeat(np.arange(len(batch.counts)), batch.counts)
    return text, np.arange(len(text)) - batch.first[:-1][text]


def _anchors(slices: int, window: int):
    width = window - PERIOD + 1
    in_cover = np.isin(np.arange(PERIOD), COVER)

    def found(ids: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, ...]:
        words = WordBatch(texts)
        hashes = rolling(words.hashes(), width)
        text, place = _where(words)
        text, place = text[:len(hashes)], place[:len(hashes)]
        total = words.counts[text]
        use = np.flatnonzero(in_cover[place % PERIOD] & (total - place >= width) & (total >= window))
        return hashes[use], ids[text[use]], place[use].astype(np.int32)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [found(ids[low:], texts) for low, texts in portions(batch.column(1))]
            hashes, docs, place = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0),) * 3
            if not len(hashes):
                continue
            order, group, low, high = _groups(hashes, np.empty(0), docs)
            hashes, docs, place = hashes[order], docs[order], place[order]
            several = (low < high)[group]
            # Shared within the batch: all places are settled; a least and a greatest document go on.
            key = np.flatnonzero(several & ((docs == low[group]) | (docs == high[group])))
            _, once = np.unique(2 * group[key] + (docs[key] == low[group[key]]), return_index=True)
            sent = np.concatenate([np.flatnonzero(~several), key[once]])
            rows = np.concatenate([sent, np.flatnonzero(several)])
            done = np.arange(len(rows)) >= len(sent)
            none = np.empty(0, np.uint32)
            yield from _packed(slices, hashes[rows], none, docs[rows], place[rows], done)
    return anchors


def _settle(strict: bool):
    """Places of hashes that two documents hold; with ``strict``, of those that a smaller one holds."""
    def settled(rows: list[dict]) -> pa.RecordBatch:
        first, second = (np.frombuffer(b"".join(r[n] for r in rows if not r["done"]), np.uint64 if n == "first" else np.uint32)
                         for n in ("first", "second"))
        docs, places = [], []
        waiting = [r for r in rows if not r["done"]]
        if waiting:
            d, p = _unplaned([r["doc"] for r in waiting], np.int64), _unplaned([r["place"] for r in waiting], np.int32)
            order, group, low, high = _groups(first, second, d)
            d, p = d[order], p[order]
            good = d > low[group] if strict else (low < high)[group]
            docs, places = [d[good]], [p[good]]
        ready = [r for r in rows if r["done"]]
        if ready:
            docs.append(_unplaned([r["doc"] for r in ready], np.int64))
            places.append(_unplaned([r["place"] for r in ready], np.int32))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], ["doc_id", "place"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in batch.to_pylist()]  # the whole of one slice
        if held:
            yield settled(held)
    return settle


def _windows(slices: int, window: int):
    reach = PERIOD - 1

    def found(ids: np.ndarray, texts: pa.Array, marks: pa.Array) -> tuple[np.ndarray, ...]:
        words = WordBatch(texts)
        hashes = words.hashes()
        one, two = rolling(hashes, window), (rolling(hashes, window, 1) >> np.uint64(32)).astype(np.uint32)
        change = np.zeros(len(hashes) + 1, np.int64)
        for i, places in enumerate(marks):
            at = places.values.to_numpy()
            first, last = words.first[i], words.counts[i] - window
            starts, stops = np.maximum(at - reach, 0), np.minimum(at, last) + 1
            fits = starts < stops
            np.add.at(change, first + starts[fits], 1)
            np.add.at(change, first + stops[fits], -1)
        use = np.flatnonzero(np.cumsum(change)[:len(one)] > 0)
        text, place = _where(words)
        return one[use], two[use], ids[text[use]], place[use].astype(np.int32)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [found(ids[low:], texts, batch.column(2).slice(low, len(texts)))
                     for low, texts in portions(batch.column(1))]
            one, two, docs, place = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0),) * 4
            if not len(one):
                continue
            order, group, low, _ = _groups(one, two, docs)
            one, two, docs, place = one[order], two[order], docs[order], place[order]
            later = docs > low[group]
            # A window that a smaller document of the batch has is settled; the smallest goes on.
            least = np.flatnonzero(~later)
            rows = np.concatenate([least, np.flatnonzero(later)])
            done = np.arange(len(rows)) >= len(least)
            yield from _packed(slices, one[rows], two[rows], docs[rows], place[rows], done)
    return windows


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests = [], []
        for text in batch.column(1):  # the words of one text at a time are held
            words = (text.as_py() or "").encode().split()  # splits at exactly the six blanks
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "n_words", "digest"])


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, removed, kept = [], [], []
            for doc_id, text, places in zip(*batch.columns, strict=True):
                words = (text.as_py() or "").encode().split()
                change = np.zeros(len(words) + window + 1, np.int64)
                at = np.unique(places.values.to_numpy())
                at = at[at + window <= len(words)]
                change[at] += 1
                change[at + window] -= 1
                stays = np.cumsum(change)[:len(words)] == 0
                ids.append(doc_id)
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(itertools.compress(words, stays)).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_removed", "kept"])
    return cut


def _settled_places(rows: DataFrame, deal, settle, slices: int) -> DataFrame:
    """Deal packed hashes out, one slice to a task, and settle each slice."""
    return rows.mapInArrow(deal, _PACKED).repartitionById(slices, "slice").mapInArrow(settle, _PLACES)


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, digest, is_copy) of all rows, and (doc_id, n_removed, kept) of those that lose some.

    ``kept`` is the remaining words joined by blanks. Copies lose everything and are in the first only.
    """
    if window <= PERIOD:
        raise ValueError(f"a window needs more than {PERIOD} words")
    ship()
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring")
    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text")
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = size // SLICE_BYTES + 1
    info = scratch.keep(texts.mapInArrow(_digests, "doc_id long, n_words long, digest binary"), "info")
    long_enough = info.where(f"doc_id IS NOT NULL AND n_words >= {window}")
    first = long_enough.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = long_enough.join(first, "digest").where("doc_id > first").select("doc_id").distinct()
    copies = scratch.keep(copies, "copies")

    named = texts.where("doc_id IS NOT NULL")
    marks = _settled_places(named, _anchors(slices, window), _settle(False), slices)
    marks = marks.join(copies, "doc_id", "left_anti").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    marks = scratch.keep(marks, "marks")  # its size decides whether the join has to move the texts
    marked = scratch.keep(named.join(marks, "doc_id"), "marked")
    covered = _settled_places(marked, _windows(slices, window), _settle(True), slices)
    covered = covered.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    cut = marked.select("doc_id", "text").join(covered, "doc_id").mapInArrow(_cut(window), "doc_id long, n_removed long, kept string")
    flagged = info.join(copies.withColumn("is_copy", F.lit(True)), "doc_id", "left").fillna(False, ["is_copy"])
    return flagged, cut


def passage_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the digest of the words that stay."""
    info, cut = repeated_passages(docs, window)
    cut = cut.select("doc_id", "n_removed", F.sha2("kept", 256).alias("cut_sha256")).distinct()
    rows = info.join(cut, "doc_id", "left")
    gone = F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    left = F.when(F.col("is_copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", F.lower(F.hex("digest"))))
    return rows.select("doc_id", "n_words", gone.cast("long").alias("n_removed"), left.alias("kept_sha256"))
