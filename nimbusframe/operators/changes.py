"""Table changes as set operations (M1-M20): state in -> state out.

Each operator takes the current table and a DataFrame of changes and returns
a :class:`Change` holding the new state and, where the reference reports
them, the accepted rows and the rejected rows (with a ``status``). No
transactional store is built: writing the new state (and cutting lineage) is
the caller's ``save_table``.

Duplicate keys inside one change batch: the last row by ``order`` wins (the
row written last). Without ``order``, one deterministic row per key is kept.
Per-key choice is ``max_by``/``min_by`` - a partial aggregate, so a hot key
does not gather its rows into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import is_truthy, now_or


class Change(NamedTuple):
    state: DataFrame
    accepted: DataFrame | None = None
    rejected: DataFrame | None = None


def _pick_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None, last: bool = True) -> DataFrame:
    """One row per key: the last (or first) by ``order``; all columns kept."""
    vals = [c for c in rows.columns if c not in keys]
    if not vals:
        return rows.select(*keys).distinct()
    # without an order any row is fine, but the pick must be deterministic:
    # order by the row's JSON text (works for map columns, which are not orderable)
    ordering = F.struct(*[F.col(c) for c in order]) if order else F.to_json(F.struct(*[F.col(c) for c in vals]))
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in vals]), ordering).alias("_r")).select(*keys, "_r.*")


def _align(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like`` in its order and types; missing ones NULL."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def next_ids(rows: DataFrame, state: DataFrame, id_col: str, order: Sequence[str] | None = None) -> DataFrame:
    """F21 for inserts: ids ``max(existing)+1, +2, ...`` with no gaps.

    The current maximum is a scalar subquery (one value); the new rows are
    numbered by per-partition counts and offsets (:func:`with_dense_id`), so
    no global window gathers them into one task. Ids follow ``order`` (any
    orderable columns of ``rows``), else the rows' partition order."""
    from nimbusframe.functions.scalars import with_dense_id

    base = F.coalesce(state.agg(F.max(id_col)).scalar(), F.lit(0))
    numbered = with_dense_id(rows.drop(id_col) if id_col in rows.columns else rows, "_seq", start=1, order=order)
    return numbered.withColumn(id_col, (base + F.col("_seq")).cast(state.schema[id_col].dataType)).drop("_seq")


def insert(
    state: DataFrame,
    rows: DataFrame,
    id_col: str | None = None,
    defaults: Mapping[str, object] | None = None,
    order: Sequence[str] | None = None,
) -> Change:
    """M1: insert rows; fill ``defaults`` for absent/NULL fields (M14) and, with
    ``id_col``, generate ids after the current maximum. Returns the created rows."""
    new = with_defaults(rows, defaults or {})
    if id_col:
        new = next_ids(new, state, id_col, order or [c for c in new.columns if c != id_col])
    created = _align(new, state)
    return Change(state.unionByName(created), accepted=created)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Defaults for absent or NULL fields (``Column`` values allowed)."""
    out = df
    for c, v in defaults.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), val) if c in df.columns else val)
    return out


def put(state: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> Change:
    """M2: replace the whole row by key, insert when new (last write per key
    wins). Keys compare NULL-safe: a NULL key is a key like any other."""
    latest = _align(_pick_per_key(rows, keys, order), state)
    k = latest.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    same = reduce(and_, [state[c].eqNullSafe(k[f"_k_{c}"]) for c in keys])
    kept = state.join(k, same, "left_anti")
    return Change(kept.unionByName(latest), accepted=latest)


def put_if_absent(state: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> Change:
    """M3: conditional put - only when the key is absent. The first request per
    new key succeeds; later ones for that key and all for existing keys are
    rejected (``status`` 'ConditionalCheckFailed')."""
    existing = rows.join(state.select(*keys), list(keys), "left_semi")
    fresh = rows.join(state.select(*keys), list(keys), "left_anti")
    first = _pick_per_key(fresh, keys, order, last=False).select(*rows.columns)
    # every other request for a new key fails: an exact multiset difference
    # (NULL-safe, duplicates counted), not an anti-join on all columns
    later = fresh.exceptAll(first)
    rejected = existing.unionByName(later).withColumn("status", F.lit("ConditionalCheckFailed"))
    accepted = _align(first, state)
    return Change(state.unionByName(accepted), accepted=accepted, rejected=rejected)


def update(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    stamp: tuple[str, object] | None = None,
) -> Change:
    """M4: set the change's non-key columns on matching rows (all new values
    are returned as ``accepted``); changes without a row are rejected with
    status 404. ``stamp=(col, now)`` sets a modification time."""
    ch = _pick_per_key(changes, keys, order)
    setc = [c for c in ch.columns if c not in keys and c in state.columns]
    chr_ = ch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in setc], F.lit(True).alias("_hit"))
    j = state.join(chr_, list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = []
    for f in state.schema.fields:
        c = f.name
        if c in setc:
            cols.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).cast(f.dataType).alias(c))
        elif stamp and c == stamp[0]:
            cols.append(F.when(hit, now_or(stamp[1])).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            cols.append(F.col(c))
    new_state = j.select(*cols, hit.alias("_hit"))
    accepted = new_state.where("_hit").drop("_hit")
    rejected = ch.join(state.select(*keys), list(keys), "left_anti").withColumn("status", F.lit(404))
    return Change(new_state.drop("_hit"), accepted=accepted, rejected=rejected)


def update_if(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    condition: Column,
    order: Sequence[str] | None = None,
) -> Change:
    """M5: conditional update. ``condition`` is evaluated on the old row (its
    column names) and the requested values (``new_<col>``); failing or unmatched
    requests are rejected with status 'ConditionalCheckFailed'."""
    ch = _pick_per_key(changes, keys, order)
    setc = [c for c in ch.columns if c not in keys and c in state.columns]
    chr_ = ch.select(*keys, *[F.col(c).alias(f"new_{c}") for c in setc], F.lit(True).alias("_hit"))
    j = state.join(chr_, list(keys), "left")
    ok = F.coalesce(F.col("_hit"), F.lit(False)) & F.coalesce(condition, F.lit(False))
    j = j.withColumn("_ok", ok)
    cols = [
        (F.when(F.col("_ok"), F.col(f"new_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name))
        if f.name in setc
        else F.col(f.name)
        for f in state.schema.fields
    ]
    new_state = j.select(*cols, "_ok")
    accepted = new_state.where("_ok").drop("_ok")
    ok_keys = j.where("_ok").select(*keys)
    rejected = ch.join(ok_keys, list(keys), "left_anti").withColumn("status", F.lit("ConditionalCheckFailed"))
    return Change(new_state.drop("_ok"), accepted=accepted, rejected=rejected)


def update_where(state: DataFrame, condition: Column, assignments: Mapping[str, object]) -> Change:
    """M6: set columns on every row matching ``condition``; a column that does
    not exist yet is added (NULL on other rows), widening the schema."""
    out = state
    cond = F.coalesce(condition, F.lit(False))
    out = out.withColumn("_m", cond)
    for c, v in assignments.items():
        val = v if isinstance(v, Column) else F.lit(v)
        other = F.col(c) if c in state.columns else F.lit(None)
        out = out.withColumn(c, F.when(F.col("_m"), val).otherwise(other))
    accepted = out.where("_m").drop("_m")
    return Change(out.drop("_m"), accepted=accepted)


def delete(state: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> Change:
    """M7: delete by key; the deleted rows are returned (``ReturnValues=ALL_OLD``).
    Keys that match nothing are rejected with status 404, each once however
    often it was asked for; a NULL key matches nothing."""
    k = keys_df.select(*keys).distinct()
    deleted = state.join(k, list(keys), "left_semi")
    rejected = k.join(state.select(*keys), list(keys), "left_anti").withColumn("status", F.lit(404))
    return Change(state.join(k, list(keys), "left_anti"), accepted=deleted, rejected=rejected)


def delete_cascade(
    parent: DataFrame,
    child: DataFrame,
    keys_df: DataFrame,
    parent_key: str,
    child_fk: str,
) -> tuple[Change, Change]:
    """M8: delete parents and, by the foreign key, their children
    (``ON DELETE CASCADE``). Returns (parent change, child change)."""
    k = keys_df.select(F.col(parent_key).alias("_pk"))
    p_del = parent.join(k, parent[parent_key] == k["_pk"], "left_semi")
    p_new = parent.join(k, parent[parent_key] == k["_pk"], "left_anti")
    c_del = child.join(k, child[child_fk] == k["_pk"], "left_semi")
    c_new = child.join(k, child[child_fk] == k["_pk"], "left_anti")
    return Change(p_new, accepted=p_del), Change(c_new, accepted=c_del)


def upsert(
    state: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    id_col: str | None = None,
    stamp: tuple[str, object] | None = None,
    order: Sequence[str] | None = None,
) -> Change:
    """M9: ``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    One full outer join on the unique key: matched rows keep their id and
    other columns and take ``update_cols``; new keys are inserted with ids
    after the current maximum; ``stamp=(col, now)`` is set on both. Duplicate
    keys in ``rows``: the last by ``order`` wins. ``accepted`` holds the
    returned rows (like ``RETURNING``)."""
    latest = _pick_per_key(rows, keys, order)
    new_only = latest.join(state.select(*keys), list(keys), "left_anti")
    if id_col:
        # one row per key here, so the key order is unique
        new_only = next_ids(new_only, state, id_col, list(keys))
    new_aligned = _align(new_only, state)
    if stamp:
        new_aligned = new_aligned.withColumn(stamp[0], now_or(stamp[1]).cast(state.schema[stamp[0]].dataType))
    upd = latest.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update_cols], F.lit(True).alias("_hit"))
    j = state.join(upd, list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = []
    for f in state.schema.fields:
        c = f.name
        if c in update_cols:
            cols.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).cast(f.dataType).alias(c))
        elif stamp and c == stamp[0]:
            cols.append(F.when(hit, now_or(stamp[1])).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            cols.append(F.col(c))
    merged = j.select(*cols, hit.alias("_hit"))
    updated = merged.where("_hit").drop("_hit")
    new_state = merged.drop("_hit").unionByName(new_aligned)
    return Change(new_state, accepted=updated.unionByName(new_aligned))


def insert_ignore(state: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> Change:
    """Insert rows whose key is absent; the others are ignored (first per key wins)."""
    first = _align(_pick_per_key(rows, keys, order, last=False), state)
    new = first.join(state.select(*keys), list(keys), "left_anti")
    return Change(state.unionByName(new), accepted=new)


def seed_if_empty(state: DataFrame, rows: DataFrame) -> Change:
    """Add ``rows`` only when the table is empty (an ``EXISTS`` subquery,
    evaluated once; no join)."""
    seeded = _align(rows, state).where(~state.exists())
    return Change(state.unionByName(seeded), accepted=seeded)


def batch_write(
    state: DataFrame,
    ops: DataFrame,
    keys: Sequence[str],
    op_col: str = "op",
    order: Sequence[str] | None = None,
) -> Change:
    """A batch of ``PUT``/``DELETE`` requests. Per key the last request wins;
    then puts replace rows and deletes remove them - one anti-join and one union.

    The reference's service takes at most 25 requests per call; that is a
    transport limit with no meaning for a set operation, so batches of any
    size are applied at once."""
    last = _pick_per_key(ops, keys, order)
    puts = _align(last.where(F.upper(F.col(op_col)) == "PUT"), state)
    kept = state.join(last.select(*keys), list(keys), "left_anti")
    return Change(kept.unionByName(puts), accepted=last)


def patch(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    fields_col: str,
    columns: Mapping[str, str],
    require_any: bool = False,
    overflow_col: str | None = None,
    stamp: tuple[str, object] | None = None,
    order: Sequence[str] | None = None,
) -> Change:
    """Partial update from a request map (``map<string,string>``: absent
    and NULL are different). Per column a policy:

    * ``"truthy"`` - set when the value is truthy, else keep (``x || old``);
    * ``"present"`` - set when the key is present, even to NULL (``!== undefined``);
    * ``"replace"`` - always set; absent gives NULL (full replace).

    ``require_any`` rejects (400) a request that would set nothing;
    ``overflow_col`` receives the JSON of request fields that are not columns
    (F20). Unknown keys are rejected with 404. Request values are texts, so
    ``truthy`` means not empty: ``"0"`` is set.

    Requests for one key apply one after the other in ``order`` (without it,
    in the order of their JSON text): every column takes the value of the last
    request that sets it, the overflow is that of the last valid request, and
    each request that sets nothing or has no row is rejected by itself. All
    of it is one partial aggregation per key."""
    m = F.col(fields_col)
    sets = {}
    for c, pol in columns.items():
        v = m.getItem(c)
        if pol == "truthy":
            sets[c] = (is_truthy(v), v)
        elif pol == "present":
            sets[c] = (F.map_contains_key(m, c), v)
        elif pol == "replace":
            sets[c] = (F.lit(True), v)
        else:
            raise ValueError(f"unknown policy {pol}")
    any_set = None
    for cond, _ in sets.values():
        any_set = cond if any_set is None else any_set | cond
    rank = F.struct(*[F.col(c) for c in order]) if order else F.to_json(m)
    ch = changes.select(
        *keys, rank.alias("_rank"), F.coalesce(any_set if require_any else F.lit(True), F.lit(False)).alias("_valid"),
        m.alias("_m"), *[cond.alias(f"_s_{c}") for c, (cond, _) in sets.items()],
        *[v.alias(f"_v_{c}") for c, (_, v) in sets.items()])
    known = F.array(*[F.lit(k) for k in list(columns) + list(keys)])
    rest = F.to_json(F.map_filter(F.col("_m"), lambda k, _v: ~F.array_contains(known, k)))
    exprs = [F.max("_valid").alias("_valid")]
    for c in sets:
        # the struct is NULL, and skipped, for requests that do not set the column
        hit = F.when(F.col("_valid") & F.col(f"_s_{c}"), F.struct(F.col(f"_v_{c}").alias("v")))
        last = F.max_by(hit, F.when(hit.isNotNull(), F.col("_rank")))
        exprs += [last.isNotNull().alias(f"_s_{c}"), last.getField("v").alias(f"_v_{c}")]
    if overflow_col:
        exprs.append(F.max_by(rest, F.when(F.col("_valid"), F.col("_rank"))).alias("_overflow"))
    prepared = ch.groupBy(*keys).agg(*exprs, F.lit(True).alias("_hit"))
    j = state.join(prepared, list(keys), "left")
    apply_ = F.coalesce(F.col("_hit"), F.lit(False)) & F.coalesce(F.col("_valid"), F.lit(False))
    out_cols = []
    for f in state.schema.fields:
        c = f.name
        if c in sets:
            newv = F.when(apply_ & F.col(f"_s_{c}"), F.col(f"_v_{c}").cast(f.dataType)).otherwise(F.col(c))
            out_cols.append(newv.alias(c))
        elif overflow_col and c == overflow_col:
            out_cols.append(F.when(apply_, F.col("_overflow")).otherwise(F.col(c)).alias(c))
        elif stamp and c == stamp[0]:
            out_cols.append(F.when(apply_, now_or(stamp[1])).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            out_cols.append(F.col(c))
    new_state = j.select(*out_cols, apply_.alias("_applied"))
    accepted = new_state.where("_applied").drop("_applied")
    missing = ch.join(state.select(*keys), list(keys), "left_anti").select(*keys, F.lit(404).alias("status"))
    invalid = ch.join(state.select(*keys), list(keys), "left_semi").where(~F.col("_valid")).select(
        *keys, F.lit(400).alias("status")
    )
    return Change(new_state.drop("_applied"), accepted=accepted, rejected=missing.unionByName(invalid))


#: Shares that rows are dealt to when they meet the keys of a violated rule.
SALTS = 32


def check_constraints(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    checks: Mapping[str, Column] | None = None,
    enums: Mapping[str, Sequence[str]] | None = None,
    foreign: Sequence[tuple[str, DataFrame, str]] = (),
) -> Change:
    """Validate rows against NOT NULL, UNIQUE (incl. composite keys),
    CHECK, ENUM and FOREIGN KEY rules. Returns the valid rows as ``state`` and
    one row per (row, violated rule) as ``rejected`` with a ``rule`` column.

    UNIQUE and FOREIGN KEY work in two phases: first the keys that repeat, or
    miss in the parent, are found by an aggregation (a hot key is one row a
    task there), and only these are joined back. Rows are salted for that and
    the found keys repeated for every salt, so that neither a hot key nor rows
    with NULL keys, which match nothing, meet in one task."""
    flags: dict[str, Column] = {}

    def marked(rows: DataFrame, found: DataFrame, cols: list[str], name: str) -> DataFrame:
        found = found.select(*cols, F.lit(True).alias(name), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        # Any salt gives the same result, so it need not be the same on a retry. Rows with a NULL key have salts of their own.
        none = reduce(or_, [F.col(c).isNull() for c in cols])
        at = F.monotonically_increasing_id()
        dealt = rows.withColumn("_salt", F.when(none, SALTS + at % 4096).otherwise(at % SALTS).cast("int"))
        return dealt.join(found, [*cols, "_salt"], "left").drop("_salt")

    for c in not_null:
        flags[f"not_null:{c}"] = F.col(c).isNull()
    for name, cond in (checks or {}).items():
        # SQL CHECK passes when the condition is NULL
        flags[f"check:{name}"] = ~F.coalesce(cond, F.lit(True))
    for c, allowed in (enums or {}).items():
        flags[f"enum:{c}"] = F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))
    out = df
    for i, cols in enumerate(unique):
        whole = df.select(*cols).dropna()  # NULLs never collide in a UNIQUE constraint
        again = whole.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        out = marked(out, again, list(cols), f"_u{i}")
        flags[f"unique:{','.join(cols)}"] = F.coalesce(F.col(f"_u{i}"), F.lit(False))
    for i, (fk, parent, pk) in enumerate(foreign):
        missing = df.select(fk).dropna().distinct().join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
        out = marked(out, missing, [fk], f"_f{i}")
        flags[f"foreign:{fk}"] = F.coalesce(F.col(f"_f{i}"), F.lit(False))
    names = list(flags)
    viol = F.filter(
        F.array(*[F.when(flags[n], F.lit(n)) for n in names]), lambda x: x.isNotNull()
    )
    out = out.withColumn("_viol", viol)
    base = [c for c in df.columns]
    valid = out.where(F.size("_viol") == 0).select(*base)
    rejected = out.where(F.size("_viol") > 0).select(*base, F.explode("_viol").alias("rule"))
    return Change(valid, accepted=valid, rejected=rejected)


def touch(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    col: str,
    now: object = None,
) -> DataFrame:
    """Set ``col`` (``updated_at``) to ``now`` on rows whose values changed
    (null-safe comparison of all other columns); unchanged rows keep theirs,
    new rows get ``now``."""
    cmp_cols = [c for c in new.columns if c not in keys and c != col and c in old.columns]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cmp_cols + [col]], F.lit(True).alias("_had"))
    j = new.join(o, list(keys), "left")
    same = F.lit(True)
    for c in cmp_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    stamp = F.when(F.col("_had").isNotNull() & same, F.col(f"_o_{col}")).otherwise(now_or(now))
    t = new.schema[col].dataType if col in new.columns else old.schema[col].dataType
    return j.withColumn(col, stamp.cast(t)).select(*new.columns if col in new.columns else new.columns + [col])


def audit_log(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    actor: object,
    now: object = None,
    key_out: str | None = None,
) -> DataFrame:
    """One audit row per inserted, updated or deleted row:
    ``action, <keys>, changed_by, change_timestamp, old_data, new_data`` with the
    row images as JSON. Unchanged rows give no row. One full outer join."""
    cols = [c for c in new.columns]
    o = old.select(*keys, F.to_json(F.struct(*[F.col(c) for c in old.columns])).alias("old_data"), F.lit(True).alias("_o"),
                   *[F.col(c).alias(f"_oc_{c}") for c in cols if c not in keys and c in old.columns])
    n = new.select(*keys, F.to_json(F.struct(*[F.col(c) for c in cols])).alias("new_data"), F.lit(True).alias("_n"),
                   *[F.col(c).alias(f"_nc_{c}") for c in cols if c not in keys])
    j = o.join(n, list(keys), "full_outer")
    same = F.lit(True)
    for c in cols:
        if c not in keys and c in old.columns:
            same = same & F.col(f"_oc_{c}").eqNullSafe(F.col(f"_nc_{c}"))
    action = (
        F.when(F.col("_o").isNull(), F.lit("INSERT"))
        .when(F.col("_n").isNull(), F.lit("DELETE"))
        .when(~same, F.lit("UPDATE"))
    )
    actor_c = actor if isinstance(actor, Column) else F.lit(actor)
    out = j.withColumn("action", action).where(F.col("action").isNotNull())
    return out.select(
        "action",
        *keys,
        actor_c.alias("changed_by"),
        now_or(now).alias("change_timestamp"),
        F.when(F.col("action") != "INSERT", F.col("old_data")).alias("old_data"),
        F.when(F.col("action") != "DELETE", F.col("new_data")).alias("new_data"),
    )


def replay_audit(old: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply an audit log to ``old`` (property: replay(old, audit(old, new)) == new)."""
    schema = old.schema
    ins_upd = log.where(F.col("action").isin("INSERT", "UPDATE")).select(
        F.from_json("new_data", schema).alias("_r")
    ).select("_r.*")
    touched = log.select(*keys)
    return old.join(touched, list(keys), "left_anti").unionByName(ins_upd)


# --- object versions and lifecycle (M19, M20) -------------------------------


def mark_deleted(versions: DataFrame, keys_df: DataFrame, key: str, version_col: str, modified: str, now: object = None) -> DataFrame:
    """A delete without a version id appends a delete marker (a new,
    newest version flagged ``is_delete_marker``); the older versions stay."""
    markers = keys_df.select(
        F.col(key),
        F.concat(F.lit("dm-"), F.sha2(F.concat_ws("|", F.col(key), now_or(now).cast("string")), 256).substr(1, 16)).alias(version_col),
        now_or(now).cast(versions.schema[modified].dataType).alias(modified),
        F.lit(True).alias("is_delete_marker"),
    )
    return versions.unionByName(markers, allowMissingColumns=True)


def delete_version(versions: DataFrame, key: str, version_col: str, targets: DataFrame) -> DataFrame:
    """Deleting a specific version id removes that version for good."""
    return versions.join(targets.select(key, version_col), [key, version_col], "left_anti")


def current_objects(
    versions: DataFrame, key: str, modified: str, marker_col: str = "is_delete_marker", as_of: object = None, tie: Sequence[str] = ()
) -> DataFrame:
    """What a plain listing shows: per key the newest version (at
    ``as_of`` when given) unless that version is a delete marker."""
    v = versions
    if as_of is not None:
        v = v.where(F.col(modified) <= F.lit(as_of).cast(versions.schema[modified].dataType))
    vals = [c for c in versions.columns if c != key]
    newest = v.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in vals]), F.struct(F.col(modified), *[F.col(t) for t in tie])).alias("_v")
    ).select(key, "_v.*")
    return newest.where(~F.coalesce(F.col(marker_col), F.lit(False)))


# The reference's lifecycle policy (two rules).
REFERENCE_LIFECYCLE_RULES = [
    {
        "id": "Move-to-IA-Then-Glacier",
        "prefix": "documents/",
        "transitions": [(30, "STANDARD_IA"), (90, "GLACIER")],
        "expiration_days": 365,
    },
    {"id": "Delete-Old-Versions", "prefix": "", "noncurrent_days": 30},
]


def lifecycle_actions(
    objects: DataFrame,
    rules: Sequence[Mapping[str, object]],
    key: str,
    modified: str,
    now: object,
    noncurrent_since: str | None = None,
) -> DataFrame:
    """Lifecycle plan per object version.

    ``rules`` is the policy (a configuration list like
    :data:`REFERENCE_LIFECYCLE_RULES`): ``prefix``, optional ``transitions``
    ``[(days, class), ...]``, ``expiration_days``, ``noncurrent_days``. A rule
    covers a key that starts with its prefix. The rules are compiled into
    column expressions, so the plan is a single projection - no join.

    For a current version (``noncurrent_since`` NULL) the strongest due action
    of all covering rules wins: ``EXPIRE`` (age >= expiration days), else the
    latest due transition (``TRANSITION:<class>``). For a noncurrent version:
    ``DELETE_NONCURRENT`` when noncurrent for >= noncurrent days. Otherwise
    ``NONE``. Adds ``age_days``, ``action`` and ``rule_id``."""
    now_c = now_or(now)
    age = F.datediff(now_c, F.col(modified))
    is_nc = F.col(noncurrent_since).isNotNull() if noncurrent_since else F.lit(False)
    nc_age = F.datediff(now_c, F.col(noncurrent_since)) if noncurrent_since else F.lit(None).cast("int")
    # candidate (strength, action, rule) per rule; strength orders the actions
    cands = []
    for r in rules:
        covers = F.col(key).startswith(F.lit(r.get("prefix", "")))
        rid = F.lit(r.get("id"))
        if r.get("expiration_days") is not None:
            due = covers & ~is_nc & (age >= F.lit(r["expiration_days"]))
            cands.append(F.when(due, F.struct(F.lit(1000).alias("s"), F.lit("EXPIRE").alias("a"), rid.alias("r"))))
        for days, cls in r.get("transitions", []) or []:
            due = covers & ~is_nc & (age >= F.lit(days))
            cands.append(F.when(due, F.struct(F.lit(int(days)).alias("s"), F.lit(f"TRANSITION:{cls}").alias("a"), rid.alias("r"))))
        if r.get("noncurrent_days") is not None:
            due = covers & is_nc & (nc_age >= F.lit(r["noncurrent_days"]))
            cands.append(F.when(due, F.struct(F.lit(2000).alias("s"), F.lit("DELETE_NONCURRENT").alias("a"), rid.alias("r"))))
    if not cands:
        return objects.withColumn("age_days", age).withColumn("action", F.lit("NONE")).withColumn(
            "rule_id", F.lit(None).cast("string"))
    best = F.greatest(*cands) if len(cands) > 1 else cands[0]
    return (
        objects.withColumn("age_days", age)
        .withColumn("_best", best)
        .withColumn("action", F.coalesce(F.col("_best.a"), F.lit("NONE")))
        .withColumn("rule_id", F.col("_best.r"))
        .drop("_best")
    )
