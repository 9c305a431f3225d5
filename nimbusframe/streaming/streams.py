"""Streaming.

The transforms here are written once and run unchanged on a batch DataFrame
or a streaming one (T1, T3, T7). Per-key state that SQL cannot express (T4,
T5) uses ``transformWithStateInPandas``; its result equals the batch window
operators (W2, W3). Sinks are idempotent per
micro-batch id, so a retried batch after an executor or driver loss
overwrites its own output instead of duplicating it.

Event time: the driver's ``ts`` columns are ``TIMESTAMP_NTZ``. Watermarks
need ``TIMESTAMP``, so the event-time column is cast for them (session zone);
T4/T5 keep the column's own type, so their run arithmetic is in wall-clock
time for ``TIMESTAMP_NTZ``. Watermark policy (not fixed by the reference):
2 x the period unless ``delay`` says otherwise; later rows are dropped and
counted.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from nimbusframe.functions.nested import plain_json, typed_attribute
from nimbusframe.functions.scalars import iso_timestamp, now_or

# Event names of the change stream and the notification texts.
CHANGE_EVENTS = {
    "INSERT": ("ITEM_CREATED", "New Item Created"),
    "MODIFY": ("ITEM_UPDATED", "Item Updated"),
    "REMOVE": ("ITEM_DELETED", "Item Deleted"),
}


def _attribute(img: Column, typed: bool, name: str) -> Column:
    return typed_attribute(img, name) if typed else img.getItem(name)


def _json(img: Column, typed: bool) -> Column:
    return plain_json(img) if typed else F.to_json(img)


def to_notifications(
    changes: DataFrame,
    env: str,
    now: object = None,
    event_col: str = "eventName",
    old_image: str = "OldImage",
    new_image: str = "NewImage",
    id_field: str = "id",
    typed_images: bool = True,
) -> DataFrame:
    """Change record -> notification (``subject``, ``message``).

    INSERT and REMOVE carry the new resp. old item, MODIFY both; any other
    event name gives no notification (filtered out). Images are typed
    attribute JSON (F19; values keep their types in the message, nested ones
    too) or, with ``typed_images=False``, plain ``map<string,string>`` columns.
    The message is compact JSON with the same fields as the reference's (``event, environment, item | oldItem+newItem,
    timestamp``)."""
    ev, modified = F.col(event_col), F.col(event_col) == "MODIFY"
    item = F.when(ev == "REMOVE", F.col(old_image)).otherwise(F.col(new_image))  # images are chosen before they are read
    item_id = _attribute(item, typed_images, id_field)
    ts = iso_timestamp(now_or(now))
    kind = F.coalesce(*[F.when(ev == k, F.lit(v[0])) for k, v in CHANGE_EVENTS.items()])
    title = F.coalesce(*[F.when(ev == k, F.lit(v[1])) for k, v in CHANGE_EVENTS.items()])
    subject = F.concat(F.lit(f"[{env}] "), title, F.lit(": "), F.coalesce(F.col("item_id"), F.lit("undefined")))
    head = F.to_json(F.struct(F.col("event"), F.lit(env).alias("environment")))
    tail = F.to_json(F.struct(ts.alias("timestamp")))

    def part(unless: str, name: str, image: str) -> Column:
        text = F.coalesce(_json(F.col(image), typed_images), F.lit("{}"))
        return F.when(ev != unless, F.concat(F.when(modified, f'"{name}":').otherwise('"item":'), text))

    message = F.concat_ws(
        ",", F.substring(head, F.lit(1), F.length(head) - 1), part("INSERT", "oldItem", old_image), part("REMOVE", "newItem", new_image),
        F.substring(tail, F.lit(2), F.length(tail)),
    )
    named = changes.where(ev.isin(list(CHANGE_EVENTS))).withColumns({"item_id": item_id, "event": kind})
    return named.select(ev.alias("event_name"), "event", "item_id", subject.alias("subject"), message.alias("message"))


def to_audit_rows(changes: DataFrame, actor: str, event_col: str = "eventName", old_image: str = "OldImage",
                  new_image: str = "NewImage", key_field: str = "id", typed_images: bool = True) -> DataFrame:
    """Change records -> audit rows (``action, key, changed_by, old_data,
    new_data``), same shape as M17. Stateless."""
    ev = F.col(event_col)
    action = F.when(ev == "INSERT", "INSERT").when(ev == "MODIFY", "UPDATE").when(ev == "REMOVE", "DELETE")
    key = _attribute(F.when(ev == "REMOVE", F.col(old_image)).otherwise(F.col(new_image)), typed_images, key_field)
    return changes.where(action.isNotNull()).select(
        action.alias("action"),
        key.alias(key_field),
        F.lit(actor).alias("changed_by"),
        _json(F.when(ev != "INSERT", F.col(old_image)), typed_images).alias("old_data"),
        _json(F.when(ev != "REMOVE", F.col(new_image)), typed_images).alias("new_data"),
    )


def stream_statistics(
    df: DataFrame,
    ts: str,
    value: str,
    period: str,
    keys: Sequence[str] = (),
    watermark: str | None = None,
    stats: Sequence[str] = ("avg", "max"),
    event_time: bool = False,
) -> DataFrame:
    """Tumbling-window statistics on a stream (or batch). With a watermark
    (default 2 x period) append mode emits each window once, after it closes.
    ``event_time`` adds a column of that name that carries the watermark on, for
    a stateful operator that follows in the same query."""
    fns = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    ev = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    if df.isStreaming:
        ev = ev.withWatermark("_ts", watermark or _double(period))
    out = ev.groupBy(*keys, F.window("_ts", period).alias("_w")).agg(*[fns[s](value).alias(f"{s}_{value}") for s in stats])
    time = [F.window_time("_w").alias("event_time")] if event_time else []
    return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *[f"{s}_{value}" for s in stats], *time)


def _double(period: str) -> str:
    n, unit = period.split(None, 1)
    return f"{2 * int(n)} {unit}"


# --- T4, T5: stateful rows in event-time order -----------------------------------
#
# Both operators hold rows back in slots of event time until the watermark has
# passed a slot, and then step through it in order, so the result does not depend
# on how rows fall into micro-batches. Keys are dealt to ``groups`` by their hash:
# a call of Python, with its trips to the state store, is for all keys of a group,
# which are stepped through together as arrays. A slot of a group is a state row
# of its own with an event-time timer at its end; a state row and the work of a
# call are bounded by the rows of one group in one slot, so that ``groups`` should
# follow the rows (:func:`groups_for`). It belongs to a query's checkpoint.
# Rows later than the watermark are dropped by Spark before the operator and
# counted in the query's progress (``late_rows``). What is still held back when a
# query ends is in its state: ``drain`` reads it from the checkpoint and steps
# through it as a batch.

#: Groups of keys unless given, and rows of a group in a slot.
GROUPS, GROUP_ROWS = 1024, 10_000

_OP_NAMES = {">": "gt", "GreaterThanThreshold": "gt", ">=": "ge", "GreaterThanOrEqualToThreshold": "ge",
             "<": "lt", "LessThanThreshold": "lt", "<=": "le", "LessThanOrEqualToThreshold": "le"}
_NP_OPS = {"gt": np.greater, "ge": np.greater_equal, "lt": np.less, "le": np.less_equal}
_MICROS = 1_000_000
_STORE = "spark.sql.streaming.stateStore.providerClass"


def groups_for(spark: SparkSession, rows: int, slots: int) -> int:
    """Groups of keys for a stream of about so many rows in so many slots: a
    group has some ``GROUP_ROWS`` rows in a slot, and there are enough for all tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (slots * GROUP_ROWS)))


class _Slots(StatefulProcessor):
    """Rows of a group of keys by slot; a slot is stepped through when its timer fires."""

    def __init__(self, key: str, ts: str, cols: list[str], step, state: str, pending: str, slot: int):
        self.key, self.ts, self.cols, self.step = key, ts, cols, step
        self.state, self.pending, self.slot = state, pending, slot

    def init(self, handle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carried", self.state)
        self.rows = handle.getMapState("rows", "slot bigint", self.pending)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        t = pdf["t"].astype("datetime64[us]").astype("int64").to_numpy()
        nulls = pdf["n"].to_numpy(dtype="int64")
        slots = t // self.slot
        order = np.argsort(slots, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(slots[order])) + 1):
            slot = int(slots[at[0]])
            new = [t[at].tolist(), *(_plain(pdf[f"c{i}"].iloc[at], nulls[at] >> i & 1 > 0) for i in range(len(self.cols) + 1))]
            if self.rows.containsKey((slot,)):
                new = [list(old) + more for old, more in zip(self.rows.getValue((slot,)), new, strict=True)]
            else:
                self.handle.registerTimer((slot + 1) * self.slot // 1000)
            self.rows.updateValue((slot,), tuple(new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A list, not a generator: that would run when the state is another key's.
        last, out = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.slot - 1, []
        due = sorted(k for k in map(tuple, self.rows.keys()) if k[0] <= last)
        if due:
            carried = self.carried.get() if self.carried.exists() else None
            for slot in due:
                carried, done = _stepped(self.key, self.ts, self.cols, self.step, carried, self.rows.getValue(slot))
                self.rows.removeKey(slot)
                out.append(done)
            self.carried.update(tuple(carried))
        return iter(out)

    def close(self) -> None:
        pass


class OrderedStates:
    """A step over the ordered rows of each key that carries state from row to
    row: ``apply`` on a stream, ``drain`` for its held-back rest. ``slot`` is the
    seconds of a group's rows in one state row, ``groups`` how many groups the
    keys are dealt to; ``event`` names the event-time column of a stream that has
    its watermark already. ``step`` gets the rows of several keys, one key after
    the other, where each key begins, and for each key the fields of its state
    (None: it has none); it returns their new values and the rows' output."""

    def __init__(self, df: DataFrame, key: str, ts: str, cols: Sequence[str], out: str, state: str, step, delay: str,
                 slot: int, event: str | None = None, groups: int | None = None):
        self.df, self.key, self.ts, self.cols, self.step, self.delay = df, key, ts, list(cols), step, delay
        self.slot, self.event, self.groups = slot, event, groups or GROUPS
        self.types = types = dict(df.dtypes)
        self.out = f"{key} {types[key]}, {ts} {types[ts]}, {out}"
        fields = [x.split() for x in state.split(",")]
        self.fields = [name for name, _ in fields]
        self.state = ", ".join([f"_keys array<{types[key]}>", *(f"{name} array<{kind}>" for name, kind in fields)])
        self.pending = ", ".join(["_p_ts array<bigint>", *(f"_p_{i} array<{types[c]}>" for i, c in enumerate([key, *self.cols]))])

    def apply(self) -> DataFrame:
        """The stepped rows of a stream, in append mode. Sets the session's state
        store to RocksDB, which keeps slots out of the executors' heaps."""
        spark = self.df.sparkSession
        spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        src = self.df
        if not self.event:
            src = src.withColumn("_event", F.col(self.ts).cast("timestamp")).withWatermark("_event", self.delay)
        # plain names: the processor gets rows as named tuples, which change others; whole numbers without
        # nulls, which pandas would make doubles: these are in the bits of n
        named = [self.key, *self.cols]
        nulls = [F.shiftleft(F.col(c).isNull().cast("bigint"), i) for i, c in enumerate(named)]
        whole = {"tinyint", "smallint", "int", "bigint", "boolean"}
        full = lambda c: F.coalesce(F.col(c), F.lit(0).cast(self.types[c])) if self.types[c] in whole else F.col(c)
        group = F.pmod(F.xxhash64(self.key), F.lit(self.groups)).cast("int")
        src = src.select(group.alias("g"), F.col(self.ts).alias("t"), sum(nulls[1:], nulls[0]).alias("n"),
                         *[full(c).alias(f"c{i}") for i, c in enumerate(named)], F.col(self.event or "_event").alias("event"))
        slots = _Slots(self.key, self.ts, self.cols, self.step, self.state, self.pending, self.slot * _MICROS)
        return src.groupBy("g").transformWithStateInPandas(
            statefulProcessor=slots, outputStructType=self.out, outputMode="append", timeMode="EventTime"
        )

    def drain(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """The stepped rows that a stopped query still held back, from the
        state in its checkpoint; a later run of the query would emit them once
        the watermark has passed. A key's held-back rows, which lie within the
        watermark's delay and a slot, are one task's work."""
        key, ts, cols, step, fields = self.key, self.ts, self.cols, self.step, self.fields
        read = lambda var: spark.read.format("statestore").option("stateVarName", var).option(
            "operatorId", _stateful_operator(spark, checkpoint)).load(checkpoint)
        flat = lambda df: df.select(F.inline(F.arrays_zip(*df.columns)))
        rows = flat(read("rows").select("user_map_value.*"))
        carried = flat(read("carried").select("value.*")).toDF("_k", *[f"_c_{n}" for n in fields])
        both = rows.join(carried, rows["_p_0"].eqNullSafe(carried["_k"]), "left").drop("_k")

        def fn(pdf: pd.DataFrame) -> pd.DataFrame:
            plain = lambda name: _plain(pdf[name], pdf[name].isna().to_numpy())
            held = [plain(name) for name in ["_p_ts", *[f"_p_{i}" for i in range(len(cols) + 1)]]]
            before = [plain(f"_c_{n}")[:1] for n in fields]
            return _stepped(key, ts, cols, step, [held[1][:1], *before], held)[1]

        return both.groupBy("_p_0").applyInPandas(fn, self.out)


def _plain(values: pd.Series, nulls: np.ndarray) -> list:
    """The values as a list, with None where ``nulls`` says so."""
    out = values.tolist()
    for i in np.flatnonzero(nulls).tolist():
        out[i] = None
    return out


def _stateful_operator(spark: SparkSession, checkpoint: str) -> int:
    """The number of the operator of a query that steps through slots."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.where("operatorName LIKE 'transformWithState%'").agg(F.max("operatorId")).first()[0]


def _objects(values: Sequence) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


def _typed(values: np.ndarray) -> pd.Series:
    """A column of these; with None it stays one of objects, as whole numbers would become doubles."""
    out = pd.Series(values)
    return out if any(x is None for x in values) else out.infer_objects()


def _stepped(key: str, ts: str, cols: Sequence[str], step, carried: Sequence | None, held: Sequence):
    """Step through held-back rows, each key's in order; the new state (a list of
    keys and a list for each of its fields) and the output. ``held`` has the
    times (microseconds), the keys, and the columns."""
    known = list(carried[0]) if carried else []
    keys = _objects([*known, *held[1]])
    code, _ = pd.factorize(keys, use_na_sentinel=False)  # a known key's number is its place
    rows = pd.DataFrame({"_code": code[len(known) :], "_t": np.array(held[0], dtype="int64"), "_key": keys[len(known) :]})
    for c, values in zip(cols, held[2:], strict=True):
        rows[c] = _typed(_objects(values))
    rows = rows.sort_values(["_code", "_t", cols[0]], kind="stable", ignore_index=True)
    number = rows["_code"].to_numpy()
    heads = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    at, new = number[heads], int(code.max()) + 1 - len(known)
    state = [_objects([*f, *[None] * new]) for f in (carried[1:] if carried else step.empty)]
    after, out = step(rows, heads, [f[at] for f in state])
    for f, values in zip(state, after, strict=True):
        f[at] = _objects(values.tolist())
    out.insert(0, key, _typed(rows["_key"].to_numpy()))
    out.insert(1, ts, pd.to_datetime(rows["_t"].to_numpy(), unit="us"))
    first = np.unique(code, return_index=True)[1]
    return [keys[first].tolist(), *[f.tolist() for f in state]], out


def _latest(marks: np.ndarray) -> np.ndarray:
    """For every place the last one up to it that is marked; the first one must be."""
    return np.maximum.accumulate(np.where(marks, np.arange(len(marks)), 0))


def land_in_order(df: DataFrame, ts: str, path: str, slices: int, heartbeat: str | None = None, file_rows: int = 2_000_000) -> None:
    """Write a table as it would have arrived: ``slices`` batches of about equal
    time, the oldest first, each appended to the folder ``path``. A file stream
    takes them in this order, so that triggers can be bounded; the files of a
    batch come in any order, so that a watermark's delay must be at least the
    length of a batch for nothing to be late. With ``heartbeat`` (an
    interval such as ``2 days``) a last batch holds one row of nulls that much
    after the newest, which takes the watermark past all others. The files of a
    batch, each a micro-batch of its own, hold about ``file_rows`` rows, however
    many files the table has."""
    ends = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    files = max(1, -(-ends["n"] // (slices * file_rows)))
    if ends["lo"] is None:
        df.write.mode("append").parquet(path)
        return
    kind, step = df.schema[ts].dataType, (ends["hi"] - ends["lo"]) / slices
    cuts = [ends["lo"] + step * i for i in range(1, slices)]
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = df if lo is None else df.where(F.col(ts) >= F.lit(lo).cast(kind))
        part = part if hi is None else part.where(F.col(ts) < F.lit(hi).cast(kind))
        part.repartition(files).write.mode("append").parquet(path)
    if heartbeat:
        last = F.lit(ends["hi"]).cast(kind) + F.expr(f"INTERVAL {heartbeat}")
        one = df.sparkSession.range(1)
        row = [(last if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        one.select(*row).write.mode("append").parquet(path)


def stream_alarm(
    stats: DataFrame,
    key: str,
    period_start: str,
    value: str,
    period_seconds: int,
    op: str,
    threshold: float,
    n: int,
    delay: str | None = None,
    slot: int | None = None,
    event: str | None = None,
    groups: int | None = None,
) -> OrderedStates:
    """T4: alarm state per key over a stream of period statistics (one row per
    key and period; the output of :func:`stream_statistics` can be used at once,
    with ``event="event_time"``). State per key: last period seen and the length of the
    current run of contiguous breaching periods. Output per period:
    ``breaching`` and ``state`` ALARM/OK - the same as
    :func:`windows.alarm_states`, for any order of arrival within ``delay``
    (default 2 periods). NULL does not breach; NaN compares as in Spark, where
    it is larger than any number."""
    cmp = _OP_NAMES[op]

    def step(rows: pd.DataFrame, heads: np.ndarray, before: Sequence[np.ndarray]):
        last, run = (np.array([0 if x is None else x for x in f], dtype="int64") for f in before)
        pos, t = np.arange(len(rows)), rows["_t"].to_numpy(dtype="int64") // _MICROS
        v = rows[value].astype("float64").to_numpy()
        v = np.where(np.isnan(v), np.inf, v)
        breach = _NP_OPS[cmp](v, threshold) & ~rows["_null"].to_numpy(dtype=bool)
        prev = np.concatenate([[0], t[:-1]])
        prev[heads] = np.where([x is None for x in before[0]], -(10**18), last)
        # a run of breaching, contiguous periods continues; anything else restarts it
        reset = ~(breach & ((t - prev) == period_seconds))
        base, marks = breach.astype("int64"), reset.copy()
        base[heads] += np.where(reset[heads], 0, run)  # the carried run goes on
        marks[heads] = True
        at = _latest(marks)
        runs = np.where(breach, base[at] + pos - at, 0)
        values = pd.Series([None if x else y for x, y in zip(rows["_null"], rows[value], strict=True)], dtype=object)
        ends = np.append(heads[1:], len(rows)) - 1
        return (t[ends], runs[ends]), pd.DataFrame({value: values, "breaching": breach, "state": np.where(runs >= n, "ALARM", "OK")})

    step.empty = ((), ())
    return OrderedStates(
        # pandas has one NaN for NULL and NaN
        stats.withColumn(value, F.col(value).cast("double")).withColumn("_null", F.col(value).isNull()), key, period_start, [value, "_null"],
        f"{value} double, breaching boolean, state string", "last_ts bigint, run bigint", step, delay or f"{2 * period_seconds} seconds",
        slot or period_seconds, event, groups)


def stream_health(
    checks: DataFrame,
    key: str,
    ts: str,
    tie: str,
    ok: str,
    unhealthy_after: int,
    healthy_after: int,
    initial: str = "healthy",
    delay: str = "1 hour",
    slot: int = 3600,
    groups: int | None = None,
) -> OrderedStates:
    """T5: health state per target over a stream of checks. State per key:
    current health, the ok-value of the current run and its length. Output per
    check: ``run_length``, ``state``, ``changed`` - equal to
    :func:`windows.health_states` for any order of arrival within ``delay``."""

    def step(rows: pd.DataFrame, heads: np.ndarray, before: Sequence[np.ndarray]):
        health = _objects([x or initial for x in before[0]])
        run_len = np.array([x or 0 for x in before[2]], dtype="int64")
        pos = np.arange(len(rows))
        okb = np.array([bool(x) if x is not None and x == x else False for x in rows[ok]], dtype=bool)
        change = np.append(True, okb[1:] != okb[:-1])
        change[heads] = [x is None or bool(x) != y for x, y in zip(before[1], okb[heads].tolist(), strict=True)]
        start, marks = pos.copy(), change.copy()
        start[heads] -= np.where(change[heads], 0, run_len)  # before the first change the carried run goes on
        marks[heads] = True
        runs = pos - start[_latest(marks)] + 1
        bad, good = ~okb & (runs == unhealthy_after), okb & (runs == healthy_after)
        decided = np.where(bad, "unhealthy", "healthy").astype(object)
        undecided = ~(bad | good)[heads]
        decided[heads[undecided]] = health[undecided]
        marks = bad | good
        marks[heads] = True
        states = decided[_latest(marks)]
        earlier = np.concatenate([[None], states[:-1]])
        earlier[heads] = health
        out = pd.DataFrame({tie: rows[tie], ok: okb, "run_length": runs, "state": states, "changed": (states != earlier).astype(bool)})
        ends = np.append(heads[1:], len(rows)) - 1
        return (states[ends], okb[ends], runs[ends]), out

    step.empty = ((), (), ())
    types = dict(checks.dtypes)
    return OrderedStates(
        checks.withColumn(ok, F.col(ok).cast("boolean")), key, ts, [tie, ok],
        f"{tie} {types[tie]}, {ok} boolean, run_length bigint, state string, changed boolean",
        "health string, run_ok boolean, run_len bigint", step, delay, slot, groups=groups)


def late_rows(query) -> int:
    """Rows that a finished query dropped as later than its watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


# --- T2, T6: sinks ------------------------------------------------------------


def notifications_sink(path: str, env: str = "stream", event_col: str = "eventName", now: object = None, typed_images: bool = True):
    """``foreachBatch`` function writing a batch's notifications to
    ``path/batch_id=N``. Overwriting the batch's own folder makes a retried
    batch idempotent; with ``now`` its texts are the same too. A batch is one
    job; its records are counted on the way (:func:`counted`)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        notes = to_notifications(batch, env=env, now=now, event_col=event_col, typed_images=typed_images)
        notes.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def counted(changes: DataFrame, event_col: str = "eventName") -> DataFrame:
    """The same change records, whose number in every micro-batch, and the
    number of those with a notification, are observed as they pass."""
    return changes.observe(
        "records", F.count(F.lit(1)).alias("records_processed"),
        F.count_if(F.col(event_col).isin(list(CHANGE_EVENTS))).alias("notifications"),
    )


class RecordCounts(StreamingQueryListener):
    """What :func:`counted` observed, micro-batch by micro-batch, for the
    queries that run inside its ``with`` block. A batch that is retried replaces
    its own counts. A row for each batch is kept, nothing of the data."""

    def __init__(self, spark: SparkSession):
        self.spark, self.seen, self.ended = spark, {}, {}

    def __enter__(self) -> RecordCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get("records")
        if row is not None:
            self.seen[str(event.progress.runId), event.progress.batchId] = (row["records_processed"], row["notifications"])

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query, wait: float = 60.0) -> DataFrame:
        """``batch_id, records_processed, notifications`` of a finished query."""
        run = str(query.runId)
        # Events come a little after the query; the last of them says that it has ended.
        if not self.ended.setdefault(run, threading.Event()).wait(wait):
            raise TimeoutError("the listener did not hear of the query's end")
        rows = [(b, *n) for (r, b), n in sorted(self.seen.items()) if r == run]
        return self.spark.createDataFrame(rows, "batch_id long, records_processed long, notifications long")


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order])


def stream_upsert(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of every key that is last by ``order`` (NULL first), on a
    stream (update mode: the keys that a micro-batch changed) or a batch. One
    ``max_by`` aggregate, partial on the map side; the streaming state is a row
    for each key."""
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order(order)).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def changes_sink(path: str):
    """``foreachBatch`` function appending a micro-batch's rows as
    ``path/batch_id=N``; a retried batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_upserted(spark: SparkSession, path: str, schema, keys: Sequence[str], order: Sequence[str], initial: DataFrame | None = None) -> DataFrame:
    """The table that :func:`changes_sink` keeps: of the rows of each key, and
    those of an ``initial`` table, the last by ``order``."""
    rows = spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])
    return stream_upsert(rows if initial is None else rows.unionByName(initial), keys, order)


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def run_available_now(stream_df: DataFrame, checkpoint: str, sink=None, output_mode: str = "append",
                      fmt: str = "parquet", path: str | None = None):
    """Run a streaming query over everything available, then stop (the
    ``availableNow`` trigger: all input in bounded micro-batches, progress in
    ``checkpoint``). Returns the finished query."""
    from nimbusframe.session import split_code

    w = stream_df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    with split_code(stream_df.sparkSession):  # a query takes the settings of its start
        q = w.foreachBatch(sink).start() if sink is not None else w.format(fmt).option("path", path).start()
    q.awaitTermination()
    return q


def file_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = 1, max_bytes: int | None = None) -> DataFrame:
    """A parquet file stream with the schema of ``like`` over a folder of part
    files or a single file (a file source needs a folder, so a single file is
    read through its own name in its folder). All files are picked up,
    ``max_files`` per micro-batch, or files of ``max_bytes`` (one at least), so
    that the number of micro-batches does not follow that of the files."""
    r = spark.readStream.schema(like.schema)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    elif max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    fs, p = _files(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
