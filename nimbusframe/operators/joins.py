"""Joins (J1-J12).

Broadcast policy: a side is hinted for broadcast only by
:func:`bounded_broadcast`, when its row count is bounded by construction (a
literal list, a fixed rule table) and that many rows stay below the session's
``autoBroadcastJoinThreshold``. Every other join is left to the planner: AQE
turns a sort-merge join into a broadcast join at run time only when the
measured shuffle output is under its threshold, and splits skewed partitions
(``skewJoin.enabled``) otherwise.

Range and address joins never fall back to a nested loop: intervals are covered
by dyadic cells and equi-joined on (key, level, cell); address blocks are
matched by the prefix lengths that occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import cidr_bounds

def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint broadcast when the caller can prove ``max_rows`` (e.g. the length
    of a literal list) and that many rows of the frame's types stay below the
    session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes. Otherwise the
    frame is returned as is and AQE decides from measured sizes."""
    if max_rows is None:
        return df
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if max_rows * df._jdf.schema().defaultSize() <= limit else df


def join_chain(fact: DataFrame, dims: Sequence[tuple[DataFrame, object, str]]) -> DataFrame:
    """Fact joined to each dimension in turn: ``[(dim, on, how), ...]``."""
    out = fact
    for dim, on, how in dims:
        out = out.join(dim, on=on, how=how)
    return out


def with_parent(child: DataFrame, parent: DataFrame, keys: Sequence[str] | dict[str, str]) -> DataFrame:
    """Child rows whose parent exists (``left_semi``; never duplicates)."""
    return child.join(parent, _on(child, parent, keys), "left_semi")


def without_parent(child: DataFrame, parent: DataFrame, keys: Sequence[str] | dict[str, str]) -> DataFrame:
    """Child rows whose parent is missing (``left_anti``) - the rejects."""
    return child.join(parent, _on(child, parent, keys), "left_anti")


def _on(left: DataFrame, right: DataFrame, keys) -> Column | list[str]:
    if isinstance(keys, dict):
        conds = [left[lk] == right[rk] for lk, rk in keys.items()]
        out = conds[0]
        for c in conds[1:]:
            out = out & c
        return out
    return list(keys)


def batch_get(df: DataFrame, keys: DataFrame, key_cols: Sequence[str], known_rows: int | None = None) -> DataFrame:
    """Fetch the rows for a batch of keys; absent keys give no row, repeated
    keys give the row once (semi-join). ``known_rows`` bounds a literal key list
    so it can be broadcast."""
    k = bounded_broadcast(keys.select(*key_cols), known_rows)
    return df.join(k, list(key_cols), "left_semi")


def match_with_default(
    df: DataFrame,
    rules: DataFrame,
    candidates: Sequence[str],
    rule_key: str,
    rule_value: str,
    out_col: str,
    default_key: str = "*",
    rules_max_rows: int | None = None,
) -> DataFrame:
    """Most specific match with a ``*`` default.

    ``candidates`` are the row's columns from most to least specific (country,
    continent, ...). Each is an equi-join (left) to the rule table; the first
    hit wins. The ``default_key`` rule is one value, read as a scalar subquery
    (it fails if the default is not unique) - no join on a constant key, which
    would plan as a nested loop. Rule keys must be unique."""
    r = bounded_broadcast(rules.select(F.col(rule_key).cast("string").alias("_rk"), F.col(rule_value).alias("_rv")), rules_max_rows)
    out = df
    picked = []
    for i, c in enumerate(candidates):
        alias = f"_rv{i}"
        out = out.withColumn(f"_k{i}", F.col(c).cast("string")).join(
            r.withColumnRenamed("_rk", f"_k{i}").withColumnRenamed("_rv", alias), f"_k{i}", "left"
        ).drop(f"_k{i}")
        picked.append(F.col(alias))
    default = rules.where(F.col(rule_key).cast("string") == F.lit(default_key)).select(F.col(rule_value)).scalar()
    return out.withColumn(out_col, F.coalesce(*picked, default)).drop(*[f"_rv{i}" for i in range(len(candidates))])


def _cells(first: Column, last: Column) -> Column:
    """The dyadic cells ``(level, cell)`` that make up the buckets ``first`` to
    ``last``: at each level at most one at either end, so a range of L buckets
    has at most 2 log2(L) + 2."""
    shift = lambda x, k: F.call_function("shiftright", x, k)
    after = last + 1
    levels = F.sequence(F.lit(0), F.ceil(F.log2((after - first).cast("double"))).cast("int"))

    def at(k: Column) -> Column:
        lo, hi = -shift(-first, k), shift(after, k)  # whole cells of that level: lo to hi - 1
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        left = F.when((lo < hi) & odd(lo), F.struct(k.alias("level"), lo.alias("cell")))
        right = F.when((lo < hi) & odd(hi), F.struct(k.alias("level"), (hi - 1).alias("cell")))
        return F.filter(F.array(left, right), lambda c: c.isNotNull())

    return F.flatten(F.transform(levels, at))


def _stabbed(ranges: DataFrame, first: Column, last: Column, points: DataFrame, point: Column, keys: Sequence[str]) -> DataFrame:
    """Rows of ``ranges`` and ``points`` of equal keys whose bucket ``point``
    is among the range's, each pair once: of a range's cells exactly one is an
    ancestor of a point within."""
    cells = ranges.withColumn("_c", F.explode(_cells(first, last))).select("*", "_c.level", "_c.cell").drop("_c")
    levels = cells.agg(F.collect_set("level")).scalar()  # at most 64 numbers
    up = points.withColumn("level", F.explode(levels))
    up = up.withColumn("cell", F.call_function("shiftright", point, F.col("level")))
    return cells.join(up, [*keys, "level", "cell"]).drop("level", "cell")


def range_overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    bucket_width: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """J10 (general): pairs whose closed ranges overlap, optionally within equal keys.

    Bounds must be numeric (for timestamps pass epoch seconds). Two ranges
    overlap if one starts within the other, so each pair is found once: starts
    of the right side in left ranges, and starts of the left side in right
    ranges that begin earlier. A range is covered by dyadic cells over buckets
    of ``bucket_width`` (a segment tree's cover: 2 log2 of its length, so ranges
    of a second and of years can share a table), a start has one cell at every
    level that occurs, and the equi-join on (keys, level, cell) lets Spark
    hash-partition the work; a hot key is spread over its cells, and AQE splits
    what is still skewed. The exact overlap test runs after the join. Ranges
    with a NULL bound or ``lo > hi`` overlap nothing.

    The output is the set of overlapping pairs; when most ranges of a key
    overlap each other use :func:`overlap_counts`.

    Column names of the two sides must be distinct apart from ``keys``."""
    llo, lhi = left_range
    rlo, rhi = right_range
    bucket = lambda c: F.floor(F.col(c) / F.lit(bucket_width)).cast("bigint")
    lb = left.where(F.col(llo) <= F.col(lhi)).withColumns({"_l1": bucket(llo), "_l2": bucket(lhi)})
    rb = right.where(F.col(rlo) <= F.col(rhi)).withColumns({"_r1": bucket(rlo), "_r2": bucket(rhi)})
    names = [*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys]]
    from_left = _stabbed(lb, F.col("_l1"), F.col("_l2"), rb, F.col("_r1"), keys)
    later = rb.where(F.col("_r2") > F.col("_r1"))
    from_right = _stabbed(later, F.col("_r1") + 1, F.col("_r2"), lb, F.col("_l1"), keys)
    both = from_left.select(*names).unionByName(from_right.select(*names))
    return both.where((F.col(llo) <= F.col(rhi)) & (F.col(rlo) <= F.col(lhi)))


def overlapping_pairs(
    df: DataFrame,
    id_col: str,
    lo: str,
    hi: str,
    bucket_width: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """J10 (self): unordered pairs ``(a, b)``, ``a < b``, of overlapping ranges of the same keys."""
    a = df.select(*keys, F.col(id_col).alias(f"{id_col}_a"), F.col(lo).alias("_lo_a"), F.col(hi).alias("_hi_a"))
    b = df.select(*keys, F.col(id_col).alias(f"{id_col}_b"), F.col(lo).alias("_lo_b"), F.col(hi).alias("_hi_b"))
    pairs = range_overlap_join(a, b, ("_lo_a", "_hi_a"), ("_lo_b", "_hi_b"), bucket_width, keys)
    return pairs.where(F.col(f"{id_col}_a") < F.col(f"{id_col}_b")).select(*keys, f"{id_col}_a", f"{id_col}_b")


def overlap_counts(
    df: DataFrame,
    id_col: str,
    lo: str,
    hi: str,
    keys: Sequence[str],
    block: int,
    name: str = "overlaps",
) -> DataFrame:
    """J10 without pairs: for every range, how many *other* ranges of the same
    keys overlap it (closed ranges): ``#(lo_j <= hi_i) - #(hi_j < lo_i) - 1``.

    One sorted pass computes both counts: four event kinds per key - starts,
    "<" queries (at ``lo``), "<=" queries (at ``hi``) and ends, ordered in that
    sequence at equal times - carry a running count of starts and of ends.
    The running counts are taken per (key, time block) plus a carry from one row per earlier block, so the cost is a sort
    and a few aggregations, never the number of overlapping pairs (which
    grows quadratically when ranges are long or one key is hot).

    A range with a NULL bound, or that ends before it starts, overlaps
    nothing: its count is 0 and it does not count for others."""
    keys = list(keys)
    idt = df.schema[id_col].dataType
    real = F.coalesce(F.col(lo) <= F.col(hi), F.lit(False))
    rows = df.where(real).select(*keys, id_col, lo, hi)
    unreal = df.where(~real).select(*keys, id_col, F.lit(0).cast("bigint").alias(name))
    none = F.lit(None).cast(idt)
    # kind: 0 start, 1 "<" query at lo, 2 "<=" query at hi, 3 end
    ev = (
        rows.select(*keys, F.col(lo).alias("_t"), F.lit(0).alias("_k"), none.alias(id_col))
        .unionByName(rows.select(*keys, F.col(lo).alias("_t"), F.lit(1).alias("_k"), F.col(id_col)))
        .unionByName(rows.select(*keys, F.col(hi).alias("_t"), F.lit(2).alias("_k"), F.col(id_col)))
        .unionByName(rows.select(*keys, F.col(hi).alias("_t"), F.lit(3).alias("_k"), none.alias(id_col)))
        .withColumn("_blk", F.floor(F.col("_t") / F.lit(block)).cast("bigint"))
    )
    is_s = (F.col("_k") == 0).cast("bigint")
    is_e = (F.col("_k") == 3).cast("bigint")
    per_block = ev.groupBy(*keys, "_blk").agg(F.sum(is_s).alias("_ns"), F.sum(is_e).alias("_ne"))
    wk = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(*keys, "_blk", F.coalesce(F.sum("_ns").over(wk), F.lit(0)).alias("_bs"),
                              F.coalesce(F.sum("_ne").over(wk), F.lit(0)).alias("_be"))
    wb = Window.partitionBy(*keys, "_blk").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)
    within = ev.select(*keys, "_blk", "_k", id_col, F.sum(is_s).over(wb).alias("_ws"), F.sum(is_e).over(wb).alias("_we")) \
        .where(F.col("_k").isin(1, 2))
    q = within.join(before, keys + ["_blk"])
    starts_le_hi = F.when(F.col("_k") == 2, F.col("_bs") + F.col("_ws"))
    ends_lt_lo = F.when(F.col("_k") == 1, F.col("_be") + F.col("_we"))
    return q.groupBy(*keys, id_col).agg(
        (F.max(starts_le_hi) - F.max(ends_lt_lo) - F.lit(1)).cast("bigint").alias(name)).unionByName(unreal)


#: Shares that addresses are dealt to at prefix lengths below 8.
SHORT_PREFIX_SALTS = 64


def _prefix_expand(df: DataFrame, block_col: str) -> DataFrame:
    """Add (``_net``, ``_plen``) for every prefix length from 0 to the block's
    own: the network address of the row at that length."""
    lo, _ = cidr_bounds(block_col)
    own = F.coalesce(F.get(F.split(F.col(block_col), "/"), F.lit(1)).cast("int"), F.lit(32))
    out = df.withColumn("_addr", lo).withColumn("_plen", F.explode(F.sequence(F.lit(0), own)))
    size = F.pow(F.lit(2), F.lit(32) - F.col("_plen")).cast("bigint")
    return out.withColumn("_net", F.col("_addr") - F.pmod(F.col("_addr"), size)).drop("_addr")


def cidr_contains(addrs: DataFrame, addr_col: str, blocks: DataFrame, block_col: str) -> DataFrame:
    """(address row, block row) for every block containing the address.

    Exact equi-join: each address is expanded to its networks of the prefix
    lengths that occur among the blocks (a scalar subquery of at most 33
    numbers, nothing is collected) and joined on (network, length) with the
    blocks. Lengths below 8 have few networks, so that all addresses meet in a
    few keys; there the addresses are salted and the few blocks repeated."""
    lo, _ = cidr_bounds(block_col)
    own = F.coalesce(F.get(F.split(F.col(block_col), "/"), F.lit(1)).cast("int"), F.lit(32))
    b = blocks.withColumn("_net", lo).withColumn("_plen", own)
    lengths = b.agg(F.collect_set("_plen")).scalar()
    addr, _ = cidr_bounds(addr_col)
    a = addrs.withColumn("_addr", addr).withColumn("_plen", F.explode(lengths))
    size = F.pow(F.lit(2), F.lit(32) - F.col("_plen")).cast("bigint")
    a = a.withColumn("_net", F.col("_addr") - F.pmod(F.col("_addr"), size)).withColumn(
        "_salt", F.when(F.col("_plen") < 8, F.pmod(F.xxhash64("_addr"), F.lit(SHORT_PREFIX_SALTS))).otherwise(0).cast("int"))
    b = b.withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.when(F.col("_plen") < 8, F.lit(SHORT_PREFIX_SALTS - 1)).otherwise(0))))
    return a.drop("_addr").join(b, ["_net", "_plen", "_salt"]).drop("_net", "_plen", "_salt")


def cidr_overlaps(blocks: DataFrame, id_col: str, block_col: str) -> DataFrame:
    """Pairs of address blocks that overlap (``id_a < id_b`` or the same
    network listed twice). Two CIDR blocks overlap exactly when one contains
    the other's network address, so each block is matched against the
    networks of its own prefixes - an exact equi-join, at most 33 rows per block."""
    own = F.coalesce(F.get(F.split(F.col(block_col), "/"), F.lit(1)).cast("int"), F.lit(32))
    anc = _prefix_expand(
        blocks.select(F.col(id_col).alias("_id_c"), F.col(block_col).alias("_blk_c"), own.alias("_own")), "_blk_c"
    )
    lo, _ = cidr_bounds(block_col)
    par = blocks.select(F.col(id_col).alias("_id_p"), lo.alias("_net"), own.alias("_plen"))
    # a strict ancestor is found once (from the child); identical blocks are
    # found from both sides, so keep that case only from the smaller id
    hits = anc.join(par, ["_net", "_plen"]).where(
        (F.col("_plen") < F.col("_own")) | (F.col("_id_c") < F.col("_id_p"))
    )
    return hits.select(
        F.least("_id_c", "_id_p").alias(f"{id_col}_a"),
        F.greatest("_id_c", "_id_p").alias(f"{id_col}_b"),
    )


def sync_plan(
    src: DataFrame,
    dst: DataFrame,
    keys: Sequence[str],
    signature: Sequence[str],
    delete: bool = False,
) -> DataFrame:
    """What a one-way sync would do (dry run): per key ``upload`` (only in
    source), ``update`` (signature differs, null-safe), ``delete`` (only in
    destination, when ``delete``) or ``skip``. One full outer join on the keys."""
    s = src.select(*keys, *[F.col(c).alias(f"src_{c}") for c in signature], F.lit(True).alias("_in_src"))
    d = dst.select(*keys, *[F.col(c).alias(f"dst_{c}") for c in signature], F.lit(True).alias("_in_dst"))
    j = s.join(d, list(keys), "full_outer")
    same = None
    for c in signature:
        e = F.col(f"src_{c}").eqNullSafe(F.col(f"dst_{c}"))
        same = e if same is None else same & e
    action = (
        F.when(F.col("_in_dst").isNull(), F.lit("upload"))
        .when(F.col("_in_src").isNull(), F.lit("delete" if delete else "keep"))
        .when(~same, F.lit("update"))
        .otherwise(F.lit("skip"))
    )
    return j.withColumn("action", action).drop("_in_src", "_in_dst")
