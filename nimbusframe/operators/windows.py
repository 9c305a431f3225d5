"""Window operators (W1-W5) and ordering helpers.

Windows are always partitioned. W1 is skew-safe by construction (a salted
first stage); W2 runs over already aggregated periods, so its partitions are
bounded by time span, not by data volume. W3-W5 take ``block`` (seconds):
rows of one key are then windowed per (key, time block) and what crosses a
block boundary (row offsets, the previous row, the open run, the last
decisive state) is carried over from one small row per (key, block). So a
key holding a third of all rows is spread over its time blocks instead of
one task. Without ``block`` they use one window per key (fewer shuffles when
keys are known to be small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_ranked(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rank_col: str | None = "rank",
    salts: int = 16,
) -> DataFrame:
    """Rows with ``RANK() OVER (PARTITION BY partition ORDER BY order) <= n``
    (ties kept, so a group may return more than ``n`` rows).

    Two stages keep a hot group from landing in one task: rows are spread over
    ``salts`` sub-groups by a deterministic row hash; a row whose global rank is
    <= n has a rank <= n inside its sub-group too (fewer rows can only beat it),
    so ranking sub-groups first and then ranking only the survivors per group
    is exact. The salt is a hash, never ``rand()``, so a retried task puts every
    row in the same sub-group again."""
    order = list(order)
    if salts and salts > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
        w1 = Window.partitionBy(*partition, salt).orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn("_r1", F.rank().over(w1)).where(F.col("_r1") <= n)
        df = df.drop("_salt", "_r1")
    w = Window.partitionBy(*partition).orderBy(*order)
    out = df.withColumn("_rank", F.rank().over(w).cast("bigint")).where(F.col("_rank") <= n)
    if rank_col:
        return out.withColumnRenamed("_rank", rank_col)
    return out.drop("_rank")


_OPS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "GreaterThanThreshold": lambda a, b: a > b,
    "GreaterThanOrEqualToThreshold": lambda a, b: a >= b,
    "LessThanThreshold": lambda a, b: a < b,
    "LessThanOrEqualToThreshold": lambda a, b: a <= b,
}


def alarm_states(
    stats: DataFrame,
    keys: Sequence[str],
    period_start: str,
    value: str,
    period_seconds: int,
    op: str,
    threshold: float,
    n: int,
    block: int | None = None,
) -> DataFrame:
    """A period is in ``ALARM`` when it and the ``n-1`` periods before it
    all breach the threshold and are contiguous (no missing period in
    between - a missing period counts as not breaching); else ``OK``.

    ``stats`` holds one row per key and period (the output of A16/T3).

    With ``block`` (seconds, at least ``n - 1`` periods) periods are windowed per
    (key, time block): every block gets a copy of the periods that reach into its
    first ``n - 1`` from the block before (a halo), so that a key with many
    periods is spread over tasks. The result is the same."""
    breach = _OPS[op](F.col(value), F.lit(threshold))
    if block:
        return _alarm_states_blocked(stats, keys, period_start, value, period_seconds, op, threshold, n, block)
    frame = Window.partitionBy(*keys).orderBy(period_start).rowsBetween(-(n - 1), 0)
    first = F.min(F.col(period_start)).over(frame)
    breaching = F.count_if(F.coalesce(breach, F.lit(False))).over(frame)
    # subtracting two values of the column's own type gives a day-time interval:
    # wall-clock for TIMESTAMP_NTZ, elapsed time for TIMESTAMP - no session zone
    contiguous = (F.col(period_start) - first) == F.expr(f"INTERVAL '{(n - 1) * period_seconds}' SECOND")
    in_alarm = (breaching == F.lit(n)) & contiguous
    return stats.withColumn("breaching", F.coalesce(breach, F.lit(False))).withColumn(
        "state", F.when(in_alarm, F.lit("ALARM")).otherwise(F.lit("OK"))
    )


def _alarm_states_blocked(stats, keys, period_start, value, period_seconds, op, threshold, n, block) -> DataFrame:
    halo = (n - 1) * period_seconds
    if halo > block:
        raise ValueError("a block must be as long as n - 1 periods")
    zero = "TIMESTAMP_NTZ'1970-01-01'" if dict(stats.dtypes)[period_start] == "timestamp_ntz" else "timestamp_seconds(0)"
    at = F.expr(f"timestampdiff(SECOND, {zero}, `{period_start}`)")  # the column's own clock, whatever the session's zone
    own = F.floor(at / F.lit(block)).cast("bigint")
    reaches = F.pmod(at, F.lit(block)) >= block - halo
    dealt = stats.withColumn("_own", own).withColumn(
        "_blk", F.explode(F.when(reaches, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    marked = alarm_states(dealt, [*keys, "_blk"], period_start, value, period_seconds, op, threshold, n)
    return marked.where(F.col("_own").eqNullSafe(F.col("_blk"))).drop("_own", "_blk")


def _block_id(ts: str, block: int | str) -> Column:
    """Time block of width ``block`` seconds, or an existing block column when
    ``block`` is a column name (e.g. from :func:`volume_blocks`)."""
    if isinstance(block, str):
        return F.col(block)
    return F.floor(F.col(ts).cast("timestamp").cast("double") / F.lit(block)).cast("bigint")


def volume_blocks(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    rows_per_block: int,
    pieces: int = 64,
    name: str = "_vblk",
) -> DataFrame:
    """Add a block column that splits every key with more than
    ``rows_per_block`` rows into about ``pieces`` blocks of similar volume
    (cut at the key's approximate ``ts`` quantiles); other keys get block 0.

    Counts and quantiles are aggregates with map-side combine, and the
    boundaries are one row per hot key, so no step gathers a key's rows.
    Equal timestamps always share a block, and blocks increase with ``ts``
    within a key, which is what the blocked W3-W5 need (pass ``block=name``)."""
    t = F.col(ts).cast("timestamp").cast("double")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    hot = counts.where(F.col("_cnt") > rows_per_block).select(*keys)
    probs = [i / pieces for i in range(1, pieces)]
    bounds = df.join(hot, list(keys), "left_semi").groupBy(*keys).agg(
        F.percentile_approx(t, probs, 10000).alias("_bounds"))
    out = df.join(bounds, list(keys), "left")
    blk = F.coalesce(F.size(F.filter(F.col("_bounds"), lambda b: b < t)), F.lit(0)).cast("bigint")
    return out.withColumn(name, F.when(F.col("_bounds").isNull(), F.lit(0).cast("bigint")).otherwise(blk)).drop("_bounds")


def health_states(
    checks: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ok: Column,
    unhealthy_after: int,
    healthy_after: int,
    initial: str = "healthy",
    block: int | str | None = None,
) -> DataFrame:
    """Health state after every check. ``unhealthy_after`` consecutive
    failures make a target unhealthy, ``healthy_after`` consecutive successes
    make it healthy again; in between the state holds.

    Gaps-and-islands in one window pass: a run starts where ``ok`` changes; a
    check is *decisive* when its run reaches the threshold; the state is the
    last decisive value so far. Adds ``run_length``, ``state`` and ``changed``
    (the check that flipped the state).

    With ``block`` (seconds; ``order[0]`` must be the timestamp) the same
    result is computed per (key, time block) - see the module doc. ``block``
    may also name a block column (:func:`volume_blocks`)."""
    if block:
        return _health_states_blocked(checks, keys, order, ok, unhealthy_after, healthy_after, initial, block)
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    okc = F.coalesce(ok, F.lit(False))
    out = checks.withColumn("_ok", okc).withColumn("_rn", F.row_number().over(w))
    starts = F.when(F.lag("_ok").over(w).isNull() | (F.lag("_ok").over(w) != F.col("_ok")), F.col("_rn"))
    out = out.withColumn("_start", starts)
    out = out.withColumn("run_length", (F.col("_rn") - F.max("_start").over(upto) + 1).cast("bigint"))
    decisive = (
        F.when(~F.col("_ok") & (F.col("run_length") == unhealthy_after), F.lit("unhealthy"))
        .when(F.col("_ok") & (F.col("run_length") == healthy_after), F.lit("healthy"))
    )
    out = out.withColumn("_dec", decisive)
    state = F.coalesce(F.last("_dec", ignorenulls=True).over(upto), F.lit(initial))
    out = out.withColumn("state", state)
    prev = F.coalesce(F.lag("state").over(w), F.lit(initial))
    out = out.withColumn("changed", F.col("state") != prev)
    return out.drop("_ok", "_rn", "_start", "_dec")


def noncurrent_since(df: DataFrame, keys: Sequence[str], modified: str, tie: Sequence[str] = (),
                     name: str = "noncurrent_since", block: int | str | None = None) -> DataFrame:
    """A version becomes noncurrent when the next version of its key is
    written: ``lead(modified)``; NULL for the current version.

    With ``block`` (seconds) the lead is taken inside each (key, time block);
    a block's last version takes the first ``modified`` of the key's next
    non-empty block, found on one row per (key, block)."""
    order = [F.col(modified), *[F.col(t) for t in tie]]
    if not block:
        return df.withColumn(name, F.lead(modified).over(Window.partitionBy(*keys).orderBy(*order)))
    b = df.withColumn("_blk", _block_id(modified, block))
    local = b.withColumn("_lead", F.lead(modified).over(Window.partitionBy(*keys, "_blk").orderBy(*order)))
    firsts = b.groupBy(*keys, "_blk").agg(F.min(modified).alias("_first"))
    nxt = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_blk"))).select(*keys, "_blk", "_next")
    return local.join(nxt, list(keys) + ["_blk"]).withColumn(name, F.coalesce(F.col("_lead"), F.col("_next"))).drop(
        "_blk", "_lead", "_next")


def number_versions(df: DataFrame, keys: Sequence[str], modified: str, tie: Sequence[str] = (),
                    block: int | str | None = None) -> DataFrame:
    """``version_no`` 1 = newest, and ``is_latest``.

    With ``block`` (seconds) rows are numbered inside each (key, time block)
    and shifted by the number of versions in the key's later blocks (a running
    sum over one row per (key, block))."""
    order = [F.col(modified).desc(), *[F.col(t).desc() for t in tie]]
    if not block:
        out = df.withColumn("version_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
        return out.withColumn("is_latest", F.col("version_no") == 1)
    b = df.withColumn("_blk", _block_id(modified, block))
    local = b.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_blk").orderBy(*order)))
    counts = b.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    later = counts.withColumn("_later", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(*keys, "_blk", "_later")
    out = local.join(later, list(keys) + ["_blk"]).withColumn("version_no", (F.col("_later") + F.col("_rn")).cast("bigint"))
    return out.withColumn("is_latest", F.col("version_no") == 1).drop("_blk", "_rn", "_later")


def _health_states_blocked(checks, keys, order, ok, unhealthy_after, healthy_after, initial, block):
    """health_states per (key, time block); three passes over the rows, each
    a window per (key, block), with carries computed on one row per block."""
    keys = list(keys)
    kb = keys + ["_blk"]
    ordc = [F.col(c) for c in order]
    wb = Window.partitionBy(*kb).orderBy(*ordc)
    wk = Window.partitionBy(*keys).orderBy("_blk")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    x = checks.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_blk", _block_id(order[0], block))
    # pass A: position in block and changes inside the block
    x = x.withColumn("_rl", F.row_number().over(wb)).withColumn("_prev", F.lag("_ok").over(wb))
    ordering = F.struct(*ordc)
    blocks = x.groupBy(*kb).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_ok", ordering).alias("_first_ok"),
        F.max_by("_ok", ordering).alias("_last_ok"),
        F.max(F.when(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("_ok")), F.col("_rl"))).alias("_chg"),
    )
    blocks = (
        blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_prev_last", F.lag("_last_ok").over(wk))
    )
    first_is_start = F.col("_prev_last").isNull() | (F.col("_prev_last") != F.col("_first_ok"))
    last_start_in = F.coalesce(F.col("_chg"), F.when(first_is_start, F.lit(1)))
    blocks = blocks.withColumn("_last_start_g", F.col("_off") + last_start_in)
    blocks = blocks.withColumn("_carry_start", F.max("_last_start_g").over(before))
    carry = blocks.select(*kb, "_off", "_prev_last", "_carry_start")
    # pass B: global positions, run lengths, decisive checks
    y = x.join(carry, kb)
    start = F.when(
        ((F.col("_rl") == 1) & (F.col("_prev_last").isNull() | (F.col("_prev_last") != F.col("_ok"))))
        | ((F.col("_rl") > 1) & (F.col("_prev") != F.col("_ok"))),
        F.col("_off") + F.col("_rl"),
    )
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    y = y.withColumn("_start", start).withColumn(
        "run_length", (F.col("_off") + F.col("_rl") - F.coalesce(F.max("_start").over(upto), F.col("_carry_start")) + 1).cast("bigint"))
    y = y.withColumn("_dec", F.when(~F.col("_ok") & (F.col("run_length") == unhealthy_after), F.lit("unhealthy"))
                     .when(F.col("_ok") & (F.col("run_length") == healthy_after), F.lit("healthy")))
    decs = y.where(F.col("_dec").isNotNull()).groupBy(*kb).agg(F.max_by("_dec", ordering).alias("_last_dec"))
    dcarry = (
        blocks.select(*kb).join(decs, kb, "left")
        .withColumn("_carry_dec", F.last("_last_dec", ignorenulls=True).over(before))
        .select(*kb, "_carry_dec")
    )
    # pass C: state = last decisive so far (in block, else carried, else initial)
    z = y.join(dcarry, kb)
    entering = F.coalesce(F.col("_carry_dec"), F.lit(initial))
    z = z.withColumn("state", F.coalesce(F.last("_dec", ignorenulls=True).over(upto), entering))
    z = z.withColumn("changed", F.col("state") != F.coalesce(F.lag("state").over(wb), entering))
    return z.drop("_ok", "_blk", "_rl", "_prev", "_off", "_prev_last", "_carry_start", "_start", "_dec", "_carry_dec")


def sort_by(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """O1: multi-key sort with explicit direction and null order:
    ``[("last_name", "asc", "last"), ("gpa", "desc", "first")]``."""
    cols = []
    for name, direction, nulls in spec:
        c = F.col(name)
        if direction == "desc":
            cols.append(c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last())
        else:
            cols.append(c.asc_nulls_first() if nulls == "first" else c.asc_nulls_last())
    return df.orderBy(*cols)


def partition_desc(df: DataFrame, key_filter: Column, sort_key: str) -> DataFrame:
    """O3: one partition's rows in descending secondary-key order (index query)."""
    return df.where(key_filter).orderBy(F.col(sort_key).desc())
