"""Mixing sources to target weights by entropy balancing.

Every document gets a rate r = min(max_copies, exp(lambda_s * size / mean size of its source)): of
all rates that give source s its target number of words, the ones with the least relative entropy to
taking every document once. The multipliers lambda_s solve the convex dual, found by Newton steps
inside a bracket; each pass is one aggregation over counted (source, size) cells, for several multipliers of
every source at once. The rates are then
rounded into whole copies, cell by cell from the largest size down, carrying the rounding error on, so
that a source ends within about half its smallest documents of its target.

Bounds: a cell table has at most one row per distinct size of a source, and rounding handles one
source's cells at a time; documents of one cell are told apart in hash buckets, so that a cell with a
third of all rows is spread over ``RANK_BUCKETS`` groups or more.

Defined results: null or empty texts have size 0 and are never taken; a null source is a source of its
own, in the last place; repeated rows count as documents of their own and share their cell's copies;
an empty table gives an empty result. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import ship
from skillscope.llm.words import word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
TOLERANCE = 1e-9
GRID = 8
FIRST_TRIES = (-16.0, -4.0, -2.0, -1.0, -0.5, 0.0, 0.25, 0.5, 1.0, 2.0, 4.0, 16.0)
RANK_BUCKETS = 512  # at least; one for each million documents beyond


def source_targets(cells: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: its rank, size and target, from cells (source, size, n).

    Sources are filled in the order in which they reach their limit, so that the excess of all that
    stop is shared among the rest by weight in one pass of running sums.
    """
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy((F.col("limit") / F.col("weight")), "sid").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)) + 1)
    sources = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    sources = sources.withColumn("sid", F.row_number().over(in_order) - 1)
    sources = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_copies)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(filling), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0)))
    sources = sources.withColumn("level", level)
    fits = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))
    sources = sources.withColumn("level", F.max(fits).over(everything))
    target = F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
    return sources.select("sid", "source", "source_size", "n_docs", target.alias("target"))


def _rate(max_copies: int) -> Column:
    return F.least(F.lit(float(max_copies)), F.exp(F.col("lam") * F.col("size") / F.col("mean")))


def _next_tries() -> Column:
    """Multipliers to try next: Newton's from both ends of the bracket and a grid between; beyond an open end, ever farther."""
    low, high = F.col("low"), F.col("high")
    steps = F.array(*[F.lit(float(3**k)) for k in range(6)])
    down = F.transform(steps, lambda x: high["lam"] - x * (1 + F.abs(high["lam"])) / 2)
    up = F.transform(steps, lambda x: low["lam"] + x * (1 + F.abs(low["lam"])) / 2)
    inside = F.transform(F.sequence(F.lit(1), F.lit(GRID - 1)), lambda k: low["lam"] + (high["lam"] - low["lam"]) * k / GRID)
    newton = F.transform(F.array("low", "high"), lambda p: F.when(
        p["slope"] > 0, p["lam"] + (F.col("target") - p["words"].cast("double")) / p["slope"].cast("double")))
    inside = F.concat(inside, newton)
    return F.when(low.isNull(), down).when(high.isNull(), up).otherwise(
        F.array_distinct(F.filter(inside, lambda x: (x > low["lam"]) & (x < high["lam"]))))


def solve_rates(scratch: Scratch, cells: DataFrame, sources: DataFrame, max_copies: int) -> DataFrame:
    """The multiplier of every source with words, as (sid, target, mean, lam).

    Each pass evaluates the dual's gradient and slope at several multipliers of every open source in one
    aggregation: Newton's next points from both ends of its bracket, and a grid between, so that a bracket shrinks
    ``GRID`` times however the Newton steps do. A source is done when its words are within ``TOLERANCE`` of the target,
    or when nothing lies inside its bracket any more; as the words taken grow with lambda, one of the two always
    comes. Sums are decimals, so that their order does not matter and reruns agree.
    """
    full = F.col("target") >= F.col("source_size") * max_copies
    point = "struct<lam:double,words:decimal(38,6),slope:decimal(38,6)>"
    state = sources.where("source_size > 0").select(
        "sid", "target", (F.col("source_size") / F.col("n_docs")).alias("mean"),
        F.when(full, F.lit(math.inf)).otherwise(F.lit(0.0)).alias("lam"), F.lit(None).cast(point).alias("low"),
        F.lit(None).cast(point).alias("high"), F.when(~full, F.array(*map(F.lit, FIRST_TRIES))).alias("tries"))
    state = scratch.keep(state, "state-0")
    step = 0
    while state.where("tries IS NOT NULL").limit(1).count():
        tried = cells.join(state.select("sid", "mean", F.explode("tries").alias("lam")), "sid")
        rate = _rate(max_copies)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < max_copies, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))
        totals = tried.groupBy("sid", "lam").agg(
            F.sum(words.cast("decimal(28,6)")).alias("words"), F.sum(slope.cast("decimal(28,6)")).alias("slope"))
        points = totals.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("lam", "words", "slope"))).alias("points"))  # one per try
        new = state.join(points, "sid", "left")
        gap = lambda p: p["words"].cast("double") - F.col("target")
        below, above = F.filter("points", lambda p: gap(p) < 0), F.filter("points", lambda p: gap(p) >= 0)
        nearest = F.array_min(F.transform("points", lambda p: F.struct(F.abs(gap(p)).alias("off"), p["lam"].alias("lam"))))
        new = new.withColumns({"low": F.coalesce(F.get(F.reverse(below), F.lit(0)), "low"), "high": F.coalesce(F.get(above, F.lit(0)), "high"),
                               "nearest": nearest})
        new = new.withColumn("next", _next_tries())
        close = F.col("nearest.off") <= TOLERANCE * F.col("target")
        narrow = F.col("high.lam") - F.col("low.lam") <= 1e-14 * F.greatest(F.lit(1.0), F.abs("lam"))
        more = F.when(~close & ~F.coalesce(narrow, F.lit(False)) & (F.size("next") > 0), F.col("next"))
        new = new.select("sid", "target", "mean", F.coalesce("nearest.lam", "lam").alias("lam"), "low", "high",
                         F.when(F.col("tries").isNotNull(), more).alias("tries"))
        step += 1
        state = scratch.keep(new, f"state-{step}")
        scratch.drop(f"state-{step - 1}")
    return state.select("sid", "target", "mean", "lam")


def _round_cells(max_copies: int):
    def whole(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False)
        owed, copies = 0.0, []
        for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
            owed += n * rate * size
            take = min(max(round(owed / size), 0), max_copies * n)
            owed -= take * size
            copies.append(take)
        return cells[["sid", "size", "n"]].assign(copies=copies)
    return whole


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: its size, its source's size and target, its copies and words taken."""
    ship()
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    cells = scratch.keep(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counted")
    sources = scratch.keep(source_targets(cells, weights, max_copies), "sources")
    cells = cells.join(sources.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")))
    cells = scratch.keep(cells.where("size > 0").select("sid", "size", "n"), "cells")
    rates = solve_rates(scratch, cells, sources, max_copies)
    rated = cells.join(rates, "sid").select("sid", "size", "n", _rate(max_copies).alias("rate"))
    rounded = scratch.keep(rated.groupBy("sid").applyInPandas(
        _round_cells(max_copies), "sid int, size long, n long, copies long"), "rounded")

    scratch.drop_all_but("sizes", "sources", "rounded")
    named = sources.select("sid", F.col("source").alias("s"), "source_size", "target")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.join(rounded, ["sid", "size"], "left").fillna(0, ["n", "copies"])
    buckets = max(RANK_BUCKETS, (sources.agg(F.sum("n_docs")).first()[0] or 0) // 1_000_000)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    group = ["sid", "size", "bucket"]
    before = Window.partitionBy("sid", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.where("n > 0 AND copies % n > 0").groupBy(*group).agg(F.count(F.lit(1)).alias("members"))
    counted = counted.select(*group, F.coalesce(F.sum("members").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows = rows.withColumn("rank", rank).join(counted, group, "left")
    extra = (F.coalesce(F.col("before"), F.lit(0)) + F.col("rank")) <= F.col("copies") % F.col("n")
    copies = F.when(F.col("n") > 0, F.floor(F.col("copies") / F.col("n")) + F.when(extra, 1).otherwise(0)).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
                       copies.cast("long").alias("copies"), "source")
