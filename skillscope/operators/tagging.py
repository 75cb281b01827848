"""Keyword flags on postings and their reshaping to one row per skill."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.defaults import SKILL_RULES, Rule
from skillscope.functions.text import rule_flag

_LOWERED = "_lowered"


def flag_columns(rules: Sequence[Rule] = SKILL_RULES) -> list[str]:
    return [r.column for r in rules]


def keyword_flags(
    df: DataFrame, text_col: str, rules: Sequence[Rule] = SKILL_RULES, keep: Sequence[str] = ()
) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus one 0/1/NULL column per rule.

    The text is lower-cased once per row and only read here: list the other columns in ``keep`` to
    leave it behind before anything shuffles.
    """
    lowered = df.withColumn(_LOWERED, F.lower(text_col))
    flags = [rule_flag(F.col(_LOWERED), r).alias(r.column) for r in rules]
    return lowered.select(*(keep or df.columns), *flags)


def total_flags(flags: Sequence[str]) -> Column:
    """Row sum of flags; NULL as soon as one flag is."""
    return reduce(add, [F.col(f) for f in flags])


def unpivot_flags(
    df: DataFrame, ids: Sequence[str], rules: Sequence[Rule] = SKILL_RULES, name: str = "skill"
) -> DataFrame:
    """One row per (row, rule that hits), in one pass over ``df``.

    An exploded array of labels, not ``unpivot``: the plan below stays recognisably the same when it
    occurs twice in a query, so a shuffle above it is made once.
    """
    hits = F.array(*[F.when(F.col(r.column) == 1, F.lit(r.label)) for r in rules])
    return df.select(F.explode(hits).alias(name), *ids).filter(F.col(name).isNotNull())
