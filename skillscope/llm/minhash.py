"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

1. Every text becomes its set of word shingles. Texts with the same set form one class, which its
   smallest ``doc_id`` stands for from there on.
2. A signature keeps both the minimum and the maximum of the set under each of ``PERMUTATIONS``
   permutations, so that 2 * PERMUTATIONS values cost half the hash evaluations. Bands of ``ROWS``
   values put classes into buckets.
3. Within a bucket, classes are compared by signature with the bucket's smallest member. Only in
   buckets that stay in several parts, those outside the largest part are compared with all members, in
   blocks. The result is a set of groups that no link crosses.
4. Groups are compared on full shingle sets, in blocks of ``BLOCK`` documents. A group of several blocks
   merges the parts of its blocks through a few hubs of each, until that merges nothing; then all
   documents outside its largest part are compared with all of its blocks. So each link that matters for
   the components is looked at, while the pairs inside a part are not.

Steps 2 and 3 miss a pair of 85 % similarity with a probability below 1e-6 (ROWS, BANDS and the margin
``SIGMAS``); no bucket, group or number of partners is capped.

Defined results: a null or word-free text has no shingles, is linked with nothing and is its own
component. A null ``doc_id`` takes no part (null component, kept). Repeated rows with the same ``doc_id`` and
text are one document, and both rows carry its result. An empty table gives no rows. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillscope.llm.components import components
from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import bound_batches, ship
from skillscope.llm.words import mixed, shingle_sets

PERMUTATIONS = 80
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
SIGMAS = 5  # a signature may agree less than the least similarity by so many standard deviations
BLOCK = 1024
SIGNATURE_BLOCK = 1024
HUBS = 4

_SEEDS = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
_FACTORS, _ADDENDS = _SEEDS[:PERMUTATIONS] | np.uint64(1), _SEEDS[PERMUTATIONS:]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima and maxima under all permutations, as 16-bit values."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 2048):
        values = shingles[at:at + 2048, None] * _FACTORS + _ADDENDS
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return (mixed(np.concatenate([low, high])) >> np.uint64(48)).astype(np.uint16)


def _sketch(width: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, signatures = [], [], [], []
            for shingles in shingle_sets(batch.column(1), width):
                sizes.append(len(shingles))
                first.append(int(shingles.sum(dtype=np.uint64).astype(np.int64)))
                second.append(int(mixed(shingles).sum(dtype=np.uint64).astype(np.int64)))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "signature"])
    return sketch


def _least_agreement(percent: int) -> int:
    """Signature values that must agree for a pair to be looked at."""
    share, n = percent / 100, 2 * PERMUTATIONS
    return int(np.ceil(n * (share - SIGMAS * np.sqrt(share * (1 - share) / n))))


def _agreeing(least: int):
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.array([np.frombuffer(x.as_py(), np.uint16) for x in batch.column(i)]) for i in (2, 3))
            if len(left):
                good = pa.array((left == right).sum(axis=1) >= least)
                yield batch.select(["a", "b"]).filter(good)
    return agree


class _Parts:
    """Union-find over the rows of one block."""

    def __init__(self, labels) -> None:
        first: dict = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = sorted((self.root(i), self.root(j)))
        self.up[j] = i
        return i != j


def _each_block(rows: pd.DataFrame, keys: list[str]) -> Iterator[slice]:
    """The rows of each block of a cell, which is sorted by ``keys``."""
    number = rows.groupby(keys, sort=False).ngroup().to_numpy()
    cuts = np.flatnonzero(np.diff(number)) + 1
    return map(slice, [0, *cuts], [*cuts, len(rows)])


def _signature_links(least: int, keys: list[str]):
    """Links by signature between the probes of a bucket and one block of its members, for each block of a cell."""
    def link(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values([*keys, "probe", "id"], kind="stable").reset_index(drop=True)
        values = np.frombuffer(b"".join(cell["signature"]), np.uint16).reshape(len(cell), -1)
        out, all_ids, all_labels, all_probes = [], cell["id"].to_numpy(), cell["label"].to_numpy(), cell["probe"].to_numpy()
        for block in _each_block(cell, keys):
            own, ids, probes = values[block], all_ids[block], np.flatnonzero(all_probes[block])
            parts, n = _Parts(all_labels[block]), len(all_probes[block]) - len(probes)
            for i in probes:  # members come first
                for j in np.flatnonzero((own[:n] == own[i]).sum(axis=1) >= least):
                    if ids[i] != ids[j] and parts.join(i, j):
                        out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return link


def _share_links(sets: list[np.ndarray], ids, labels, probes: np.ndarray, percent: int) -> tuple[list, np.ndarray]:
    """Links that join parts, and how many of them each row has, from exact set sizes.

    An inverted list of the block's shingles counts what each probe shares with every row.
    """
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    parts, out, degree = _Parts(labels), [], np.zeros(len(sets), int)
    for i in probes:
        low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        spread = high - low
        where = np.repeat(low - np.cumsum(spread) + spread, spread) + np.arange(int(spread.sum()))
        common = np.bincount(owner[where], minlength=len(sets))
        linked = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common))
        degree[i] = len(linked)
        for j in linked:
            if i != j and ids[i] != ids[j] and parts.join(i, j):
                out.append((int(ids[i]), int(ids[j])))
    return out, degree


def _exact_links(width: int, percent: int, keys: list[str]):
    """Confirmed links within each block of a cell, plus a row per probe (a = b) with its number of partners."""
    def link(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values([*keys, "id"], kind="stable").reset_index(drop=True)
        sets = shingle_sets(pa.array(cell["text"], pa.large_string()), width)
        out, all_ids, all_labels, all_probes = [], cell["id"].to_numpy(), cell["label"].to_numpy(), cell["probe"].to_numpy()
        for block in _each_block(cell, keys):
            ids, probes = all_ids[block], np.flatnonzero(all_probes[block])
            links, degree = _share_links(sets[block], ids, all_labels[block], probes, percent)
            out += [(a, b, 0) for a, b in links]
            out += [(int(ids[i]), int(ids[i]), int(degree[i])) for i in probes]
        return pd.DataFrame(out, columns=["a", "b", "degree"], dtype="int64")
    return link


def _in_cells(rows: DataFrame, keys: list[str], n_rows: int, per_cell: int):
    """Group whole blocks into cells of about ``per_cell`` rows, as most blocks hold a few rows only."""
    return rows.withColumn("cell", F.pmod(F.xxhash64(*keys), F.lit(max(1, n_rows // per_cell)))).groupBy("cell")


def _labelled(rows: DataFrame, labels: DataFrame, name: str = "label") -> DataFrame:
    """Add each id's component (the id itself where it has no link)."""
    found = labels.select("id", F.col("component").alias(name))
    return rows.join(found, "id", "left").withColumn(name, F.coalesce(F.col(name), F.col("id")))


def _block_pairs(rows: DataFrame, group: list[str], block: int) -> DataFrame:
    """Rows of groups in several parts, set up as (probe block, member block) pairs.

    Probes are the rows outside the group's largest part (of equals, that with the smallest label);
    every probe block meets every member block. Blocks are drawn by hash, so no group is sorted by
    one task.
    """
    sizes = rows.groupBy(*group, "label").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy(*group).agg(
        F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select(
        *group, (-F.col("top.l")).alias("main"), F.ceil(F.col("n") / block).alias("ms"),
        F.ceil((F.col("n") - F.col("top.n")) / block).alias("ps"))
    rows = rows.join(top, group)
    draw = F.xxhash64(F.lit(7), "id")
    member = F.pmod(draw, F.col("ms")), F.explode(F.sequence(F.lit(0), F.col("ps") - 1)), F.lit(False)
    probe = F.explode(F.sequence(F.lit(0), F.col("ms") - 1)), F.pmod(draw, F.col("ps")), F.lit(True)
    columns = [c for c in rows.columns if c not in ("main", "ms", "ps")]

    def placed(some: DataFrame, m, p, is_probe) -> DataFrame:
        return some.withColumn("m", m).withColumn("p", p).select(*columns, "m", "p", is_probe.alias("probe"))

    return placed(rows, *member).unionByName(placed(rows.where("label <> main"), *probe))


def candidate_groups(scratch: Scratch, classes: DataFrame, percent: int) -> DataFrame:
    """(id, component): groups of classes that no link crosses, from signatures alone."""
    least = _least_agreement(percent)
    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(BANDS)])
    buckets = classes.select("id", F.explode(keys).alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last")
    shared = scratch.keep(buckets.join(leaders.drop("last"), "bucket"), "shared")
    pairs = shared.where("id <> leader").select("id", "leader").distinct()
    left = classes.select("id", F.col("signature").alias("s"))
    right = classes.select(F.col("id").alias("leader"), F.col("signature").alias("t"))
    pairs = pairs.join(left, "id").join(right, "leader").select(F.col("id").alias("a"), F.col("leader").alias("b"), "s", "t")
    near = scratch.keep(pairs.mapInArrow(_agreeing(least), "a long, b long"), "near")
    groups = scratch.keep(components(scratch, near, "near-parts"), "near-groups")

    rows = _labelled(shared.select("bucket", "id"), groups)
    rows = scratch.keep(_block_pairs(rows, ["bucket"], SIGNATURE_BLOCK), "split-buckets")
    keys = ["bucket", "p", "m"]
    cells = _in_cells(rows.join(classes.select("id", "signature"), "id"), keys, rows.count(), 4 * SIGNATURE_BLOCK)
    more = scratch.keep(cells.applyInPandas(_signature_links(least, keys), "a long, b long"), "more")
    if not more.limit(1).count():
        return groups
    return scratch.keep(components(scratch, near.unionAll(more), "all-parts"), "all-groups")


def confirmed_parts(scratch: Scratch, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) from exact links, for rows (id, group, text)."""
    keys = ["group", "block"]
    link = _exact_links(width, percent, keys)
    schema = "a long, b long, degree long"
    sizes = rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    rows = rows.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = scratch.keep(rows, "grouped")
    blocks = rows.select("group", "block", "id", "text", F.col("id").alias("label"), F.lit(True).alias("probe"))
    found = scratch.keep(_in_cells(blocks, keys, rows.count(), BLOCK).applyInPandas(link, schema), "links-0")
    large = rows.where("blocks > 1")
    links = found.where("a <> b").select("a", "b")
    parts = scratch.keep(components(scratch, links, "parts-0"), "labels-0")
    if not large.limit(1).count():
        return parts
    degrees = found.where("a = b").select(F.col("a").alias("id"), "degree")
    step, new = 0, 1
    while new:  # merge through hubs until that merges nothing
        step += 1
        labelled = _labelled(large.select("group", "id"), parts).join(degrees, "id")
        rank = F.row_number().over(Window.partitionBy("group", "label", "slice").orderBy(F.desc("degree"), "id"))
        # Slices keep a large part's ranking apart; parts of several slices have a few hubs of each.
        labelled = labelled.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(64)))
        hubs = labelled.withColumn("rank", rank).where(F.col("rank") <= 1).drop("rank")
        best = Window.partitionBy("group", "label").orderBy(F.desc("degree"), "id")
        hubs = hubs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= HUBS)
        several = hubs.groupBy("group").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        hubs = hubs.select("group", "id", "label").join(several.where("low < high").drop("low", "high"), "group")
        hubs = hubs.withColumn("block", F.pmod(F.xxhash64(F.lit(step), "id"), F.col("n")))
        hubs = hubs.join(large.select("id", "text"), "id").withColumn("probe", F.lit(True))
        fresh = hubs.groupBy(*keys).applyInPandas(link, schema).where("a <> b").select("a", "b")
        fresh = scratch.keep(fresh, f"links-{step}")
        new = fresh.limit(1).count()
        if new:
            links = links.unionAll(fresh)
            parts = scratch.keep(components(scratch, links, f"parts-{step}"), f"labels-{step}")
    rest = _labelled(large.select("group", "id"), parts)
    rest = _block_pairs(rest, ["group"], BLOCK).join(large.select("id", "text"), "id")
    pair = ["group", "p", "m"]
    link = _exact_links(width, percent, pair)
    fresh = rest.groupBy(*pair).applyInPandas(link, schema).where("a <> b").select("a", "b")
    fresh = scratch.keep(fresh, "links-rest")
    return scratch.keep(components(scratch, links.unionAll(fresh), "parts-rest"), "labels-rest")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, min_percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    ship()
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text")
    sketches = scratch.keep(texts.mapInArrow(
        _sketch(shingle_words), "doc_id long, n_shingles long, f1 long, f2 long, signature binary"), "sketches")
    known = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["f1", "f2", "n_shingles"]
    classes = scratch.keep(known.groupBy(*same).agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")), "classes")
    groups = candidate_groups(scratch, classes.select("id", "signature").dropDuplicates(["id"]), min_percent)
    members = groups.select("id", F.col("component").alias("group"))
    grouped = texts.join(members, texts["doc_id"] == members["id"]).select("id", "group", "text")
    parts = scratch.keep(confirmed_parts(scratch, grouped, shingle_words, min_percent), "parts")
    scratch.drop_all_but("sketches", "classes", "parts")
    named = _labelled(classes.select(*same, "id"), parts, "component_id").drop("id")
    rows = sketches.drop("signature").join(named, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
