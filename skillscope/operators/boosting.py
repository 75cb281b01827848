"""Gradient-boosted regression trees over flags that may be unknown, grown leaf by leaf.

The input is weighted: one row per combination of flags, with the number of rows behind it and their mean label.
Every split sends the states 0, 1 and unknown of one flag to two sides; unknown goes where it lowers the
squared error most. The leaf whose best split gains most is split next, until a tree has its leaves.

A Spark aggregate over all rows gives, for every node that is asked for, the weights and residual sums of each
pair of states of two flags. The pairs with itself are a flag's histogram, from which a node is split; the
others are the histograms of both sides, whatever the split. So one job serves two levels of all open nodes.
A node of at most ``SMALL`` rows is asked for its rows instead, which serve all levels below it. The driver holds
a bounded number of values per node, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.session import discard, materialise
from skillscope.sources.tables import constant_rows

STATES = "01-"  # of a flag, as written in a row's key: no, yes, unknown
SIDES = (((0, 2), (1,)), ((0,), (1, 2)), ((0, 1), (2,)))  # where the states go; of equal gains the first
PAIR_FLAGS = 24  # with more flags than that, a job gives histograms of one level only
SMALL = 4096
ROWS_PER_TASK = 100_000
REFRESH = 10  # trees after which predictions are stored with the rows
NOISE = 1e-12  # gains below this share of the labels' variation are rounding

Path = tuple[tuple[int, tuple[int, ...]], ...]


def flag_states(keys: pa.Array) -> np.ndarray:
    """A row of state numbers for each key."""
    text = np.frombuffer("".join(keys.to_pylist()).encode(), np.uint8).reshape(len(keys), -1)
    states = np.zeros(text.shape, np.uint8)
    for number, mark in enumerate(STATES):
        states[text == ord(mark)] = number
    return states


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has no flag. ``sides`` holds the states that go left."""

    flag: list[int] = field(default_factory=list)
    sides: list[tuple[int, ...]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, empty in ((self.flag, -1), (self.sides, ()), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)):
            column.append(empty)
        return len(self.flag) - 1

    def predict(self, states: np.ndarray) -> np.ndarray:
        out, open_nodes = np.empty(len(states)), [(0, np.arange(len(states)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.flag[node] < 0:
                out[rows] = self.value[node]
                continue
            goes_left = _among(states[rows, self.flag[node]], self.sides[node])
            open_nodes += [(self.left[node], rows[goes_left]), (self.right[node], rows[~goes_left])]
        return out


class _Node:
    """A node while its tree grows: the way to it, its number of rows, and per state of every flag the
    weights, residual sums and numbers of rows."""

    def __init__(self, path: Path, n_rows: float, sums: np.ndarray | None = None, rows: np.ndarray | None = None) -> None:
        self.path, self.n_rows, self.sums, self.rows = path, n_rows, sums, rows
        self.pairs: np.ndarray | None = None
        self.split: tuple[float, int, int] | None = None
        self._children: list[_Node] | None = None
        if rows is not None:
            self.sums = _marks(rows[:, :-2]).T @ np.column_stack([rows[:, -2], rows[:, -2] * rows[:, -1], np.ones(len(rows))])

    def total(self) -> np.ndarray:
        return self.sums[:len(STATES)].sum(axis=0)

    def find_split(self, least_weight: float, least_gain: float) -> None:
        """The flag and sides of the greatest gain, of equals the first; None if none is allowed."""
        cells = self.sums.reshape(-1, len(STATES), 3)
        total = self.total()
        lefts = np.stack([cells[:, list(left)].sum(axis=1) for left, _ in SIDES], axis=1)
        rights = total - lefts
        enough = (lefts[..., 0] >= least_weight) & (rights[..., 0] >= least_weight)
        safe = lambda x: np.where(enough, x[..., 0], 1.0)
        gains = lefts[..., 1] ** 2 / safe(lefts) + rights[..., 1] ** 2 / safe(rights) - total[1] ** 2 / total[0]
        gains = np.where(enough, gains, -np.inf).ravel()
        best = float(gains.max(initial=-np.inf))
        if best > least_gain:
            first = int(np.flatnonzero(gains >= best - 1e-9 * abs(best))[0])
            self.split = (best, first // len(SIDES), first % len(SIDES))

    def children(self) -> list[_Node]:
        if self._children is None:
            _, flag, which = self.split
            self._children = []
            for states in SIDES[which]:
                cells = [flag * len(STATES) + s for s in states]
                path, n_rows = (*self.path, (flag, states)), self.sums[cells, 2].sum()
                rows = None if self.rows is None else self.rows[_among(self.rows[:, flag].astype(int), states)]
                sums = None if self.pairs is None else self.pairs[cells].sum(axis=0)
                self._children.append(_Node(path, n_rows, sums, rows))
        return self._children


def _marks(states: np.ndarray) -> np.ndarray:
    """A column for each state of each flag, 1 where a row has it."""
    return (states[:, :, None] == np.arange(len(STATES))).reshape(len(states), -1).astype(float)


def _among(states: np.ndarray, allowed: tuple[int, ...]) -> np.ndarray:
    table = np.zeros(len(STATES), bool)
    table[list(allowed)] = True
    return table[states]


def _sum_rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["node", "sums"])


def _statistics(wanted: list[tuple[Path, bool]], trees: list[Tree], in_pairs: bool):
    """What one task knows of the wanted nodes: the rows (states, weight, residual) of those that are wanted whole, else
    the sums of weights, residuals and rows over its pairs of states."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            states = flag_states(batch.column(0))
            weight, label, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            residual = label - known - sum(tree.predict(states) for tree in trees)
            for number, (path, whole) in enumerate(wanted):
                here = np.ones(len(states), bool)
                for flag, allowed in path:
                    here &= _among(states[:, flag], allowed)
                w, r = weight[here], residual[here]
                if whole:
                    yield _sum_rows({number: np.column_stack([states[here], w, r])})
                    continue
                own, values = _marks(states[here]), np.stack([w, w * r, np.ones(len(w))])
                part = np.stack([own.T @ (own * x[:, None]) for x in values], axis=-1) if in_pairs else own.T @ values.T
                sums[number] = sums[number] + part if number in sums else part
        yield _sum_rows(sums)
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each node over all tasks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for node, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(data)
            sums[node] = sums[node] + part if node in sums else part
    yield _sum_rows(sums)


def _ask(rows: DataFrame, tasks: int, nodes: list[_Node], trees: list[Tree], n_flags: int) -> None:
    """One job that fills in what the nodes lack; the driver gets a row for each, or at most ``SMALL`` rows' values."""
    in_pairs, width = n_flags <= PAIR_FLAGS, n_flags * len(STATES)
    schema = "node int, sums binary"
    whole = [n.n_rows <= SMALL for n in nodes]
    found = rows.mapInArrow(_statistics([(n.path, w) for n, w in zip(nodes, whole, strict=True)], trees, in_pairs), schema)
    if tasks > 1 and not all(whole):
        small = F.col("node").isin([i for i, w in enumerate(whole) if w])
        summed = found.where(~small).repartition(min(tasks, len(nodes)), "node").sortWithinPartitions("node", "sums")
        found = found.where(small).unionAll(summed.mapInArrow(_merged, schema))
    parts: dict[int, list[np.ndarray]] = {}
    for row in found.collect():
        parts.setdefault(row["node"], []).append(np.frombuffer(row["sums"]))
    for number, one in enumerate(nodes):
        values = np.concatenate(parts[number])
        if whole[number]:
            rows_ = values.reshape(-1, n_flags + 2)
            rows_ = rows_[np.lexsort(rows_[:, :-2].T)]  # in an order of their own, whichever task came first
            one.__init__(one.path, one.n_rows, rows=rows_)
            continue
        flat = values.reshape(-1, 3)
        if in_pairs:
            one.pairs = flat.reshape(width, width, 3)
            flat = one.pairs[np.arange(width), np.arange(width)]
        one.sums = flat


def _grow(ask: Callable[[list[_Node]], None], n_rows: int, leaves: int, least_weight: float, least_gain: float, rate: float) -> Tree:
    root = _Node((), n_rows)
    tree, open_leaves = Tree(), [(0, root)]
    tree.add(0.0)

    def judged(node: _Node) -> None:
        node.find_split(least_weight, least_gain)
        total = node.total()
        tree.value[next(i for i, n in open_leaves if n is node)] = rate * float(total[1] / total[0])

    def fill() -> None:
        """Histograms of all open leaves, and of the children that they may get."""
        while lacking := [n for _, n in open_leaves if n.sums is None]:
            ahead = [c for _, n in open_leaves if n.sums is not None and n.split for c in n.children() if c.sums is None]
            ask([*lacking, *ahead])

    seen: set[int] = set()
    while True:
        fill()
        for i, node in open_leaves:
            if i not in seen:
                seen.add(i)
                judged(node)
        ready = [(i, n) for i, n in open_leaves if n.split]
        if not ready or len(open_leaves) >= leaves:
            return tree
        most = max(n.split[0] for _, n in ready)
        i, node = next(x for x in ready if x[1].split[0] >= most * (1 - 1e-9))  # of equals the oldest
        gain, flag, which = node.split
        tree.flag[i], tree.sides[i], tree.gain[i] = flag, SIDES[which][0], gain
        tree.left[i], tree.right[i] = tree.add(0.0), tree.add(0.0)
        at = open_leaves.index((i, node))
        open_leaves[at:at + 1] = list(zip((tree.left[i], tree.right[i]), node.children(), strict=True))


@dataclass
class FlagModel:
    """A fitted ensemble; ``names`` are the flags in the order of the keys."""

    names: tuple[str, ...]
    base: float
    trees: list[Tree]

    def score(self, rows: DataFrame, key: str = "flags", into: str = "prediction") -> DataFrame:
        """(key, prediction) of every row."""
        base, trees = self.base, self.trees

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                states = flag_states(batch.column(0)) if len(batch) else np.empty((0, 0), np.uint8)
                made = np.full(len(batch), base)
                for tree in trees:
                    made += tree.predict(states)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], [key, into])
        return rows.select(key).mapInArrow(run, f"{key} string, {into} double")

    def split_nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, gain) of every split."""
        rows = [(t, n, self.names[flag], tree.gain[n]) for t, tree in enumerate(self.trees)
                for n, flag in enumerate(tree.flag) if flag >= 0]
        if not rows:
            return spark.createDataFrame([], "tree int, node int, feature string, gain double")
        return constant_rows(spark, ("tree", "node", "feature", "gain"), rows)


def fit_boosted(
    rows: DataFrame, names: tuple[str, ...], trees: int, leaves: int, rate: float, least_weight: float
) -> FlagModel:
    """Fit on (flags, weight, label), one row per combination of flags; ``least_weight`` is a leaf's least weight."""
    w, y = F.col("weight"), F.col("label")
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), F.sum(w * y).alias("wy")).first()
    base = whole["wy"] / whole["w"]
    variation = rows.agg(F.sum(w * (y - F.lit(base)) * (y - F.lit(base))).alias("v")).first()["v"]
    dealt = rows.select("flags", w.cast("double").alias("weight"), y.cast("double").alias("label"), F.lit(base).alias("known"))
    tasks = max(1, whole["n"] // ROWS_PER_TASK)
    stored = materialise(dealt.coalesce(tasks), "boosting")
    grown: list[Tree] = []
    fresh: list[Tree] = []  # not yet in the stored predictions
    for _ in range(trees):
        data = stored.coalesce(tasks)
        tree = _grow(lambda nodes, data=data: _ask(data, tasks, nodes, fresh, len(names)), whole["n"], leaves, least_weight, NOISE * variation, rate)
        if tree.flag[0] < 0:
            break  # nothing is left to gain, nor will be later
        grown.append(tree)
        fresh.append(tree)
        if len(fresh) == REFRESH:
            newer = materialise(stored.mapInArrow(_refreshing(fresh), stored.schema), "boosting")
            discard(stored)
            stored, fresh = newer, []
    discard(stored)
    return FlagModel(names, base, grown)


def _refreshing(trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                states = flag_states(batch.column(0))
                known = batch.column(3).to_numpy(zero_copy_only=False) + sum(tree.predict(states) for tree in trees)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(known)], schema=batch.schema)
    return run
