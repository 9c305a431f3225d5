"""Predicates and filtered scans.

Filters are plain Catalyst expressions, so comparisons on scan columns are
pushed into the parquet reader (``PushedFilters``) and prune row groups.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import _col


def lookup(df: DataFrame, **keys: object) -> DataFrame:
    """Rows matching a partition key, or partition + sort key."""
    if not keys:
        raise ValueError("lookup needs at least one key")
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in keys.items()])
    return df.where(cond)


def scan(df: DataFrame, condition: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """P5: filtered scan with bound parameters: ``scan(df, "Grade < :g", {"g": 80})``.

    Parameters are bound by Spark's parser (``spark.sql(..., args=...)``), never
    pasted into the text."""
    spark = df.sparkSession
    return spark.sql(f"SELECT * FROM {{src}} WHERE {condition}", args=dict(params or {}), src=df)


def range_covers(lo: Column | str, hi: Column | str, points: Iterable[int]) -> Column:
    """``lo <= p AND hi >= p`` for any of the points (NULL bounds never match)."""
    lo_c, hi_c = _col(lo), _col(hi)
    conds = [(lo_c <= F.lit(p)) & (hi_c >= F.lit(p)) for p in points]
    return reduce(lambda a, b: a | b, conds)


def range_overlaps(lo: Column | str, hi: Column | str, a: object, b: object) -> Column:
    """P6 (overlap form): range ``[lo, hi]`` shares a point with ``[a, b]``."""
    return (_col(lo) <= F.lit(b)) & (_col(hi) >= F.lit(a))


def in_values(col: Column | str, values: Iterable[object]) -> Column:
    """Membership in a value list."""
    return _col(col).isin(list(values))


def glob_to_regex(pattern: str) -> str:
    """``*`` = any run of characters; everything else is literal; anchored."""
    return "^" + ".*".join(re.escape(p) for p in pattern.split("*")) + "$"


def glob_match(col: Column | str, pattern: str) -> Column:
    """Wildcard name match (``web-*``)."""
    return _col(col).rlike(glob_to_regex(pattern))


def under_prefix(col: Column | str, prefix: str) -> Column:
    """P10: prefix filter (pushed to parquet as ``StringStartsWith``)."""
    return _col(col).startswith(prefix)


def key_exists(df: DataFrame, **keys: object) -> DataFrame:
    """One row ``exists`` telling whether any row has the key.

    ``limit(1)`` stops the scan at the first hit."""
    hit = lookup(df, **keys).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("exists"))


def since(df: DataFrame, ts: str, interval: str, now: object = None) -> DataFrame:
    """Rows with ``ts >= now - interval`` (``interval`` like ``'30 minutes'``).

    ``now`` is injectable; the timestamp column is compared as TIMESTAMP."""
    from nimbusframe.functions.scalars import now_or

    start = now_or(now) - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(ts).cast("timestamp") >= start)


def is_missing(col: Column | str) -> Column:
    """Missing attribute (NULL)."""
    return _col(col).isNull()
