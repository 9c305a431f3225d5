"""Aggregations.

Every aggregate here is a declarative Spark aggregate, so the plan has a
partial (map-side) aggregation before the shuffle: a hot key sends one
partial row per input partition, not its rows. ``collect_set`` is used only
where the set is bounded by the number of distinct values (A5).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import _col, map_values


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """A1: ``COUNT(*)`` per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mapped_mean(
    col: Column | str,
    mapping: Mapping[object, object],
    default: object = "0.00",
    dtype: str = "decimal(3,2)",
    digits: int | None = 2,
) -> Column:
    """A2/A3 aggregate expression: mean of mapped values, rounded HALF_UP to
    ``digits``. The sum is an exact decimal divided by the count at high
    scale (``avg`` on a decimal keeps only 4 extra digits, which can round a
    large group's mean twice at x.xx5)."""
    v = map_values(col, mapping, default, dtype)
    m = F.sum(v.cast("decimal(12,2)") if dtype.startswith("decimal") else v) / F.count(v)
    return F.round(m, digits) if digits is not None else m


def avg_mapped(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    mapping: Mapping[object, object],
    name: str = "avg_value",
    default: object = "0.00",
    dtype: str = "decimal(3,2)",
    digits: int | None = 2,
) -> DataFrame:
    """A2: AVG of a mapped category per group (e.g. letter grade -> points)."""
    return df.groupBy(*keys).agg(mapped_mean(col, mapping, default, dtype, digits).alias(name))


def join_distinct(col: Column | str, sep: str = ", ") -> Column:
    """A5: ``STRING_AGG(DISTINCT col, sep)`` with the values sorted ascending
    (the reference leaves the order open; sorted makes it deterministic).
    The partial aggregate is a set, bounded by the distinct values."""
    return F.array_join(F.array_sort(F.collect_set(_col(col))), sep)


def two_level(
    df: DataFrame,
    inner_keys: Sequence[str],
    inner_aggs: Sequence[Column],
    outer_keys: Sequence[str],
    outer_aggs: Sequence[Column],
) -> DataFrame:
    """A10: aggregate, then aggregate the result (a CTE feeding a GROUP BY).

    When ``outer_keys`` are a subset of ``inner_keys`` Spark reuses the first
    shuffle's partitioning only if the keys match; otherwise the second
    aggregation runs over the (much smaller) first result."""
    first = df.groupBy(*inner_keys).agg(*inner_aggs)
    return first.groupBy(*outer_keys).agg(*outer_aggs)


def count_issues(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column]]],
    label: str = "issue",
    count_col: str = "count",
) -> DataFrame:
    """A11 + U1: one count per named predicate, zero counts kept, most first.

    Each source is scanned once: all of its predicates become ``count_if``
    columns of a single global aggregation, which ``stack`` turns into rows.
    Sources are then combined with ``unionByName``. Ties are ordered by label."""
    parts = []
    for df, preds in sources:
        aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(f"_c{i}") for i, p in enumerate(preds.values())]
        one = df.agg(*aggs)
        pairs = ", ".join(f"'{name.replace(chr(39), chr(39) * 2)}', _c{i}" for i, name in enumerate(preds))
        parts.append(one.selectExpr(f"stack({len(preds)}, {pairs}) AS ({label}, {count_col})"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(count_col, F.col(count_col).cast("bigint"))


def frequencies(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Value counts, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(col))


def total_size(df: DataFrame, size_col: str, by: Sequence[str] = (), name: str = "total_size") -> DataFrame:
    """Total size, overall or per group (e.g. per prefix)."""
    return df.groupBy(*by).agg(F.sum(size_col).alias(name), F.count(F.lit(1)).alias("objects"))


def basket_totals(
    df: DataFrame,
    basket: str,
    product: str,
    qty: str,
    price: str,
    money: str = "decimal(18,2)",
) -> DataFrame:
    """Merge repeated products of a basket, then per basket: number of
    distinct products, item count (sum of quantities) and the grand total.

    Each line total is rounded to cents before summing (``money`` type), as a
    cart does; sums stay exact decimals."""
    lines = df.groupBy(basket, product).agg(
        F.sum(qty).alias("_qty"),
        F.sum((F.col(qty) * F.col(price)).cast(money)).alias("_line_total"),
    )
    return lines.groupBy(basket).agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("_qty").alias("items"),
        F.sum("_line_total").cast(money).alias("grand_total"),
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value_cols: Sequence[str] | None = None) -> DataFrame:
    """The latest row per group by ``order`` (later columns break ties).

    ``max_by`` over a struct is an ordinary aggregate: partial per partition,
    so one row per group and partition crosses the shuffle, whatever the skew."""
    value_cols = list(value_cols or [c for c in df.columns if c not in keys])
    ordering = F.struct(*[F.col(c) for c in order])
    picked = F.max_by(F.struct(*[F.col(c) for c in value_cols]), ordering).alias("_latest")
    return df.groupBy(*keys).agg(picked).select(*keys, "_latest.*")


def metric_statistics(
    df: DataFrame,
    ts: str,
    value: str,
    period: str,
    keys: Sequence[str] = (),
    stats: Sequence[str] = ("avg", "max"),
) -> DataFrame:
    """Statistics per tumbling period (``'6 hours'``), windows aligned to
    the epoch. Returns ``keys, window_start, window_end, <stat>_value...``.

    A ``TIMESTAMP_NTZ`` column is windowed as is (wall-clock buckets, the same
    in every session time zone); a ``TIMESTAMP`` column in UTC instants."""
    fns = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    aggs = [fns[s](value).alias(f"{s}_{value}") for s in stats]
    w = F.window(F.col(ts), period)
    out = df.groupBy(*keys, w.alias("_w")).agg(*aggs)
    return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *[a for a in out.columns if a not in keys and a != "_w"])


def risk_score(
    findings: DataFrame,
    weights: DataFrame,
    entity: str,
    issue: str,
    weight: str = "weight",
    name: str = "risk_score",
    weights_max_rows: int | None = None,
) -> DataFrame:
    """Weighted sum of issues per entity. Issues without a weight count 0.

    The weight table is a small rule table; pass ``weights_max_rows`` when its
    size is known so it is broadcast."""
    from nimbusframe.operators.joins import bounded_broadcast

    w = bounded_broadcast(weights.select(issue, weight), weights_max_rows)
    return (
        findings.join(w, issue, "left")
        .groupBy(entity)
        .agg(F.sum(F.coalesce(F.col(weight), F.lit(0))).alias(name), F.count(F.lit(1)).alias("issues"))
    )


def health_counts(df: DataFrame, healthy: Column, by: Sequence[str] = ()) -> DataFrame:
    """Healthy / unhealthy counts (``count_if``)."""
    return df.groupBy(*by).agg(
        F.count_if(healthy).alias("healthy"),
        F.count_if(~healthy).alias("unhealthy"),
    )
