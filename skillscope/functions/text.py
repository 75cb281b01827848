"""Column expressions on text."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillscope.defaults import Rule


# The Unicode space separators (category Zs).
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def trim_spaces(c: Column) -> Column:
    """Strip every Unicode space separator (U+00A0 too), but not tabs or newlines.

    Plain ASCII text, where only U+0020 can occur, takes the cheaper trim.
    """
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, F.trim(c)).otherwise(F.btrim(c, F.lit(SPACES)))


def split_list(c: Column, sep: str) -> Column:
    """A separated list as an array; NULL gives one empty token, which callers filter out."""
    return F.split(F.coalesce(c, F.lit("")), re.escape(sep))


def na_to_null(c: Column, tokens: Iterable[str]) -> Column:
    return F.when(~c.isin(list(tokens)), c)


def any_like(lowered: Column, patterns: Iterable[str]) -> Column:
    return reduce(or_, [lowered.like(p.lower()) for p in patterns])


def rule_flag(lowered: Column, rule: Rule) -> Column:
    """0/1 for a rule on lower-cased text; NULL text gives NULL."""
    hit = any_like(lowered, rule.any_of)
    if rule.none_of:
        hit = hit & ~any_like(lowered, rule.none_of)
    return hit.cast("int")

