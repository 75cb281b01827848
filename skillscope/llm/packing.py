r"""Best-fit packing of tokenised documents into sequences, by linear grouping.

Documents become token ids, closed by ``END_ID``. A plain byte-level vocabulary is applied by tiktoken, which gives the ids
that tokenizers gives with the same file in a fifth of the time; any other file by tokenizers itself. A document longer
than ``CAPACITY`` is cut into full pieces, the first being what is left over. Lengths are whole numbers up to the
capacity, so that a histogram of at most ``CAPACITY`` counts tells all there is to know for a plan, however many documents there are:

1. Large lengths are sorted and cut into ``GROUPS`` groups of equal cardinality, each rounded up to
   its largest length.
2. Configurations (how many of each rounded length share a sequence) are optimised by column generation:
   the duals of the covering programme price lengths, and a knapsack over the capacity finds the configuration that
   promises most, until none promises anything. Whole parts are taken; what is left over of each group is packed by
   best fit with the rest.
3. Actual lengths take the places of rounded ones, the largest first, and leave room.
4. The left-over large lengths, then the small ones, from the largest down, go to the fullest sequence with room.

What counts as large is tried at several shares of the capacity, and the plan with the fewest sequences is taken.
Sequences of the same make are handled as one class with a count, so a plan has some thousand entries at most, is
made on the driver and sent to the tasks. Each piece then needs its rank among the pieces of its length: tasks
number what they tokenise, and the counts of earlier tasks are added. No piece is shuffled with its ids unless these
are asked for.

Defined results: a null or empty text is ``END_ID`` alone. Repeated rows are packed as often as they are there; a
null ``doc_id`` is carried through. An empty table gives no rows. Strings of special tokens in a text are ordinary text.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import ship
from skillscope.llm.words import portions

CAPACITY = 2048
END_ID = 0
GROUPS = 96
LARGE_SHARES = (2, 4, 8)  # lengths above one of these shares of the capacity are large; the best plan counts

_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, nth long")


# Fixed value: how byte-level tokenizers of this kind part a text before they merge.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_ranks(description: dict) -> dict[bytes, int] | None:
    """The ranks of a plain byte-level vocabulary whose merges are numbered in their order; None for any other."""
    model, parting = description["model"], description.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or parting.get("type") != "ByteLevel" or parting.get("add_prefix_space") or not parting.get("use_regex", True):
        return None
    if description.get("normalizer") or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    # Bytes that are no visible character stand as those from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or not all(c in vocabulary for c in byte_of):
        return None
    special = {t["content"] for t in description.get("added_tokens", ())}
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}


def _encoder(tokenizer_json: str, ranks: dict[bytes, int] | None):
    """A function from texts to lists of ids."""
    if ranks is not None:
        import tiktoken

        encoding = tiktoken.Encoding("packing", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: map(encoding.encode_ordinary, texts)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = True
    return lambda texts: (e.ids for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False))


def _cutting(tokenizer_json: str, capacity: int, end_id: int):
    ranks = _byte_ranks(json.loads(tokenizer_json))
    tokenizer_json = "" if ranks is not None else tokenizer_json  # only one of the two goes to the tasks

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode = _encoder(tokenizer_json, ranks)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for low, texts in portions(batch.column(1).fill_null("")):
                rows: list[tuple] = []
                for at, tokens in enumerate(encode(texts.to_pylist())):
                    ids = np.array([*tokens, end_id], "<u4")
                    doc_id, first = batch.column(0)[low + at].as_py(), len(ids) % capacity
                    stops = [*([first] if first else []), *range(first + capacity, len(ids) + 1, capacity)]
                    start = 0
                    for piece, stop in enumerate(stops):
                        own = ids[start:stop].tobytes()
                        rows.append((doc_id, piece, start, stop - start, zlib.crc32(own), own, task, int(seen[stop - start])))
                        seen[stop - start] += 1
                        start = stop
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth"])
    return cut


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack), and its counts."""
    worth, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for number, (size, price) in enumerate(zip(sizes.tolist(), prices, strict=True)):
        for _ in range(capacity // size):  # once more of this size each time
            gains = worth[:-size] + price
            better = np.flatnonzero(gains > worth[size:] + 1e-12)
            if not len(better):
                break
            worth[size + better] = gains[better]
            choice[size + better] = number
    counts, room = np.zeros(len(sizes)), capacity
    while choice[room] >= 0:
        counts[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return float(worth[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_steps: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (columns of counts per size) and how often each is used, in fractions, so that all
    demand is met by the fewest sequences. Starts with one size per sequence; every step swaps in the best new column.

    Ends early after ``most_steps`` with what it has, which still meets the demand.
    """
    basis = np.diag((capacity // sizes).astype(float))
    amounts = demand / np.diag(basis)
    for _ in range(most_steps):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, column = _best_configuration(sizes, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column)
        limits = np.where(change > 1e-12, amounts / np.where(change > 1e-12, change, 1), np.inf)
        leaves = int(np.argmin(limits))
        basis[:, leaves] = column
        amounts = np.maximum(np.linalg.solve(basis, demand), 0)
    return basis, amounts


class Plan:
    """Classes of equal sequences, and for each length the runs of ranks that they take."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large_share: int = LARGE_SHARES[-1]) -> None:
        self.capacity = capacity
        self.runs: dict[int, list[tuple[int, int, int, int, int]]] = {size: [] for size in counts}
        self.used = dict.fromkeys(counts, 0)  # ranks given out of each length
        self.n_sequences = 0
        self.left = {size: n for size, n in counts.items() if n > 0}
        self.rooms: list[int] = []
        self.classes: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, number)
        self._place_large(groups, large_share)
        for size in sorted(self.left, reverse=True):
            self._best_fit(size, self.left[size])

    def _give(self, size: int, first: int, n: int, each: int, room: int) -> None:
        """The next ranks of a length, ``each`` to a sequence, to ``n`` sequences from ``first`` on."""
        self.runs[size].append((self.used[size], n * each, first, each, self.capacity - room))
        self.used[size] += n * each

    def _add_class(self, first: int, n: int, room: int) -> None:
        if n and room:
            if room not in self.classes:
                insort(self.rooms, room)
            self.classes.setdefault(room, []).append((first, n))

    def _place_large(self, groups: int, large_share: int) -> None:
        large = sorted((s for s in self.left if s > self.capacity // large_share), reverse=True)
        total = sum(self.left[s] for s in large)
        if not total:
            return
        # Equal shares of the sorted lengths; what a length has beyond a border belongs to the next group.
        tops, demand, parts = [], [], []
        share, filled = -(-total // groups), 0
        for size in large:
            n = self.left[size]
            while n:
                if filled % share == 0:
                    tops.append(size)
                    demand.append(0)
                    parts.append([])
                take = min(n, share - filled % share)
                parts[-1].append([size, take])
                demand[-1] += take
                filled, n = filled + take, n - take
        sizes, number = np.unique(tops, return_inverse=True)
        wanted = np.bincount(number, demand).astype(np.int64)
        stock: list[list[list[int]]] = [[] for _ in sizes]
        for group, part in zip(number, parts, strict=True):
            stock[group].extend(part)
        columns, amounts = configurations(sizes.astype(np.int64), wanted.astype(float), self.capacity)
        for column, amount in zip(columns.T.astype(int), np.floor(amounts + 1e-9).astype(int), strict=True):
            self._fill(column, int(amount), stock)

    def _fill(self, column: np.ndarray, n: int, stock: list[list[list[int]]]) -> None:
        """``n`` sequences by one configuration, with the largest actual lengths that are left of each group."""
        classes = [(self.n_sequences, n, self.capacity)]
        self.n_sequences += n
        for group in np.flatnonzero(column):
            for _ in range(column[group]):
                after = []
                for first, many, room in classes:
                    while many:
                        if not stock[group]:
                            after.append((first, many, room))
                            break
                        size, have = stock[group][0]
                        take = min(have, many)
                        self._give(size, first, take, 1, room)
                        self.left[size] -= take
                        after.append((first, take, room - size))
                        stock[group][0][1] -= take
                        if have == take:
                            stock[group].pop(0)
                        first, many = first + take, many - take
                classes = after
        for first, many, room in classes:
            self._add_class(first, many, room)

    def _best_fit(self, size: int, n: int) -> None:
        while n:
            at = bisect_left(self.rooms, size)
            if at == len(self.rooms):  # no sequence has room: open as many as it takes
                each = self.capacity // size
                opened = -(-n // each)
                self._add_class(self.n_sequences, opened, self.capacity)
                self.n_sequences += opened
                continue
            room = self.rooms[at]
            first, many = self.classes[room].pop()
            if not self.classes[room]:
                del self.classes[room], self.rooms[at]
            each = min(room // size, n)
            full = min(many, n // each)
            self._give(size, first, full, each, room)
            self._add_class(first, full, room - each * size)
            self._add_class(first + full, many - full, room)
            n -= full * each


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest sequences among those for all ``LARGE_SHARES``.

    Rounding up costs room that small lengths have to fill; where they are scarce, a higher bound of what is large
    leaves more to best fit.
    """
    return min((Plan(counts, capacity, large_share=share) for share in LARGE_SHARES), key=lambda plan: plan.n_sequences)


def _placing(plan: Plan):
    tables = {size: tuple(np.array(column, np.int64) for column in zip(*runs, strict=True)) for size, runs in plan.runs.items() if runs}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                start, _, first, each, used = tables[int(size)]
                run = np.searchsorted(start, rank[rows], "right") - 1
                place = rank[rows] - start[run]
                sequence[rows] = first[run] + place // each[run]
                offset[rows] = used[run] + place % each[run] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], batch.column(0), pa.array(sequence), pa.array(offset)],
                                             [*batch.schema.names[2:], "length", "sequence_id", "offset"])
    return place


def cut_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, with their token ids, and their number among the task's pieces of that length."""
    ship()
    with open(tokenizer_file, encoding="utf-8") as file:  # a file of the driver's installation, sent with the tasks
        tokenizer_json = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_cutting(tokenizer_json, capacity, end_id), _PIECES)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, ids (little-endian 32-bit, optional), sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = cut_documents(docs, tokenizer_file, capacity, end_id)
    pieces = scratch.keep(cut if with_ids else cut.drop("ids"), "pieces")
    counts = scratch.keep(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    plan = best_plan({r["length"]: r["n"] for r in histogram}, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rest = [c for c in pieces.columns if c not in ("length", "task", "nth")]
    ranked = pieces.join(before, ["length", "task"]).select("length", (F.col("nth") + F.col("before")).alias("rank"), *rest)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*rest).schema)
    return ranked.mapInArrow(_placing(plan), f"{types}, length long, sequence_id long, offset long")


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, which holds no more than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    whole = F.array_join(F.transform(parts, lambda p: p["ids"]), "")
    return pieces.groupBy("sequence_id").agg(F.unhex(whole).alias("ids"))
