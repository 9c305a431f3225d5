"""Table changes on the key-value seed rows and property tests."""

import random

import json

from pyspark.sql import functions as F

from helpers import rows
from nimbusframe.operators import aggregates as A
from nimbusframe.operators import changes as M
from nimbusframe.operators import windows as W
from nimbusframe.plans import reports as R

SCHEMA = "StudentID string, CourseID string, Name string, Grade int"
# the five items the reference loads
SEED = [("S1001", "CS101", "a", 85), ("S1001", "MATH201", "a", 92), ("S1002", "CS101", "b", 91),
        ("S1003", "PHYS101", "c", 78), ("S1002", "PHYS101", "b", 88)]
KEYS = ["StudentID", "CourseID"]


def seed(spark):
    return spark.createDataFrame(SEED, SCHEMA)


def test_update_then_delete_matches_reference_table(spark):
    s = seed(spark)
    s = M.update(s, spark.createDataFrame([("S1001", "CS101", 90)], "StudentID string, CourseID string, Grade int"), KEYS).state
    s = M.delete(s, spark.createDataFrame([("S1003", "PHYS101")], "StudentID string, CourseID string"), KEYS).state
    assert rows(s, "StudentID", "CourseID", "Grade") == [
        ("S1001", "CS101", 90), ("S1001", "MATH201", 92), ("S1002", "CS101", 91), ("S1002", "PHYS101", 88)]


def test_key_value_challenges(spark):
    s = seed(spark)
    assert rows(R.at_risk(s, "Grade", 80), "StudentID", "CourseID") == [("S1003", "PHYS101")]
    freq = [(r.CourseID, r.n) for r in R.course_popularity(s, "CourseID").collect()]
    assert freq == [("CS101", 2), ("PHYS101", 2), ("MATH201", 1)]
    lsi = s.unionByName(spark.createDataFrame([("S1001", "PHYS101", "a", 78)], SCHEMA))
    got = [(r.CourseID, r.Grade) for r in W.partition_desc(lsi, F.col("StudentID") == "S1001", "Grade").collect()]
    assert got == [("MATH201", 92), ("CS101", 85), ("PHYS101", 78)]


def test_conditional_update(spark):
    s = seed(spark)
    ch = spark.createDataFrame([("S1003", "PHYS101", 82), ("S1002", "CS101", 10)], "StudentID string, CourseID string, Grade int")
    r = M.update_if(s, ch, KEYS, F.col("Grade") < 90)
    assert rows(r.accepted, "StudentID", "Grade") == [("S1003", 82)]
    assert rows(r.rejected, "StudentID", "status") == [("S1002", "ConditionalCheckFailed")]


def test_put_idempotent_and_put_if_absent(spark):
    s = seed(spark)
    new = spark.createDataFrame([("S1001", "CS101", "a", 70), ("S2000", "ART1", "z", 60)], SCHEMA)
    once = M.put(s, new, KEYS).state
    twice = M.put(once, new, KEYS).state
    assert rows(once) == rows(twice) and once.count() == 6
    r = M.put_if_absent(s, new, KEYS)
    assert rows(r.accepted, "StudentID") == [("S2000",)]
    assert rows(r.rejected, "StudentID", "status") == [("S1001", "ConditionalCheckFailed")]
    assert r.accepted.count() + r.rejected.count() == new.count()


def test_batch_write_last_op_wins(spark):
    s = seed(spark)
    ops = spark.createDataFrame(
        [("S1001", "CS101", "a", 1, "PUT", 1), ("S1001", "CS101", None, None, "DELETE", 2), ("S9", "X", "q", 5, "PUT", 1)],
        SCHEMA + ", op string, seq int")
    out = M.batch_write(s, ops, KEYS, order=["seq"]).state
    assert rows(out, "StudentID", "CourseID") == [("S1001", "MATH201"), ("S1002", "CS101"), ("S1002", "PHYS101"),
                                                 ("S1003", "PHYS101"), ("S9", "X")]


def test_upsert_one_row_per_key_with_ids(spark):
    state = spark.createDataFrame([(1, 10, "diesel", 3.5), (2, 10, "regular", 3.0)], "gas_price_id long, store_id int, fuel_type string, price double")
    req = spark.createDataFrame([(10, "diesel", 3.9, 1), (10, "diesel", 4.1, 2), (11, "premium", 4.5, 1)], "store_id int, fuel_type string, price double, seq int")
    ch = M.upsert(state, req, ["store_id", "fuel_type"], ["price"], id_col="gas_price_id", order=["seq"])
    got = rows(ch.state, "gas_price_id", "store_id", "fuel_type", "price")
    assert got == [(1, 10, "diesel", 4.1), (2, 10, "regular", 3.0), (3, 11, "premium", 4.5)]


def test_patch_policies(spark):
    state = spark.createDataFrame([(1, "pen", 2.0, "d1", "img1"), (2, "cup", 5.0, "d2", "img2")],
                                  "id int, name string, price double, description string, image string")
    req = spark.createDataFrame([(1, {"name": "", "price": "3.0", "description": None}), (3, {"name": "x"})],
                                "id int, fields map<string,string>")
    r = M.patch(state, req, ["id"], "fields", {"name": "truthy", "price": "truthy", "description": "present", "image": "present"})
    got = {x.id: (x.name, x.price, x.description, x.image) for x in r.state.collect()}
    assert got[1] == ("pen", 3.0, None, "img1") and got[2] == ("cup", 5.0, "d2", "img2")
    assert rows(r.rejected, "id", "status") == [(3, 404)]
    none = spark.createDataFrame([(2, {"name": ""})], "id int, fields map<string,string>")
    r2 = M.patch(state, none, ["id"], "fields", {"name": "truthy", "price": "truthy"}, require_any=True)
    assert rows(r2.rejected, "id", "status") == [(2, 400)]


def test_audit_log_replays_to_new(spark):
    rnd = random.Random(7)
    old_rows = [(i, f"n{i}", rnd.randint(0, 5)) for i in range(40)]
    new_rows = [(i, n, v + (1 if i % 3 == 0 else 0)) for i, n, v in old_rows if i % 5 != 0] + [(100 + i, "new", 1) for i in range(5)]
    old = spark.createDataFrame(old_rows, "id int, name string, v int")
    new = spark.createDataFrame(new_rows, "id int, name string, v int")
    log = M.audit_log(old, new, ["id"], actor="t", now="2024-01-01 00:00:00")
    acts = {r.action: r["count"] for r in log.groupBy("action").count().collect()}
    assert acts == {"DELETE": 8, "INSERT": 5, "UPDATE": 11}
    assert rows(M.replay_audit(old, log, ["id"])) == rows(new)


def test_touch_only_changed_rows(spark):
    old = spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-01 00:00:00")], "id int, v string, updated_at string")
    old = old.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "id int, v string")
    got = {r.id: str(r.updated_at) for r in M.touch(old, new, ["id"], "updated_at", now="2024-06-01 00:00:00").collect()}
    assert got == {1: "2024-01-01 00:00:00", 2: "2024-06-01 00:00:00", 3: "2024-06-01 00:00:00"}


def test_constraints_and_cascade(spark):
    parent = spark.createDataFrame([(1,), (2,)], "store_id int")
    child = spark.createDataFrame([(10, 1, 5), (11, 2, -1), (12, 3, 1), (12, 1, 2)], "item_id int, store_id int, quantity int")
    r = M.check_constraints(child, unique=[["item_id"]], checks={"qty": F.col("quantity") >= 0},
                            foreign=[("store_id", parent, "store_id")])
    bad = rows(r.rejected, "item_id", "rule")
    assert bad == [(11, "check:qty"), (12, "foreign:store_id"), (12, "unique:item_id"), (12, "unique:item_id")]
    assert rows(r.state, "item_id") == [(10,)]
    p, c = M.delete_cascade(parent, child, spark.createDataFrame([(1,)], "store_id int"), "store_id", "store_id")
    assert rows(p.state) == [(2,)] and rows(c.state, "item_id") == [(11,), (12,)]


def test_seed_if_empty_and_insert_ignore(spark):
    rows_df = spark.createDataFrame([(1, "x")], "id int, n string")
    empty = spark.createDataFrame([], "id int, n string")
    assert M.seed_if_empty(empty, rows_df).state.count() == 1
    assert M.seed_if_empty(rows_df, spark.createDataFrame([(2, "y")], "id int, n string")).state.count() == 1
    ig = M.insert_ignore(rows_df, spark.createDataFrame([(1, "z"), (2, "y")], "id int, n string"), ["id"]).state
    assert rows(ig) == [(1, "x"), (2, "y")]


def test_versions_and_lifecycle(spark):
    v = spark.createDataFrame([
        ("documents/a", "v1", "2023-01-01 00:00:00", False), ("documents/a", "v2", "2024-01-20 00:00:00", False),
        ("logs/b", "v1", "2024-02-01 00:00:00", False), ("logs/b", "dm", "2024-02-10 00:00:00", True),
    ], "key string, version_id string, last_modified string, is_delete_marker boolean").withColumn(
        "last_modified", F.col("last_modified").cast("timestamp"))
    cur = rows(M.current_objects(v, "key", "last_modified"), "key", "version_id")
    assert cur == [("documents/a", "v2")]
    v2 = W.noncurrent_since(v, ["key"], "last_modified")
    plan = {(r.key, r.version_id): r.action for r in
            M.lifecycle_actions(v2, M.REFERENCE_LIFECYCLE_RULES, "key", "last_modified", "2024-03-15 00:00:00", "noncurrent_since").collect()}
    assert plan[("documents/a", "v1")] == "DELETE_NONCURRENT"
    assert plan[("documents/a", "v2")] == "TRANSITION:STANDARD_IA"
    # noncurrent since 2024-02-10: 34 days, and the empty-prefix rule covers every key
    assert plan[("logs/b", "v1")] == "DELETE_NONCURRENT"
    assert plan[("logs/b", "dm")] == "NONE"


def test_basket_totals(spark):
    df = spark.createDataFrame([("c1", "p1", 2, "1.10"), ("c1", "p1", 1, "1.10"), ("c1", "p2", 1, "0.05")],
                               "basket string, product string, qty int, price string")
    df = df.withColumn("price", F.col("price").cast("decimal(10,2)"))
    r = A.basket_totals(df, "basket", "product", "qty", "price").first()
    assert (r.products, r.items, str(r.grand_total)) == (2, 4, "3.35")


def test_put_if_absent_null_attributes_and_duplicates(spark):
    s = seed(spark)
    new = spark.createDataFrame([("S7", "X", None, 1), ("S7", "X", None, 1), ("S8", "Y", None, 2), ("S1001", "CS101", None, 3)], SCHEMA)
    r = M.put_if_absent(s, new, KEYS)
    assert rows(r.accepted, "StudentID") == [("S7",), ("S8",)]
    assert rows(r.rejected, "StudentID") == [("S1001",), ("S7",)]
    assert r.accepted.count() + r.rejected.count() == new.count()
    none = M.lifecycle_actions(spark.createDataFrame([("a", "2024-01-01 00:00:00")], "key string, m string")
                               .withColumn("m", F.col("m").cast("timestamp")), [], "key", "m", "2024-02-01 00:00:00")
    assert none.first().action == "NONE"


def test_evaluate_requests_statuses_and_state(spark):
    from nimbusframe.operators.requests import evaluate_requests

    stores = spark.createDataFrame([(1, "Main", "1 Road")], "store_id long, name string, address string")
    items = spark.createDataFrame([(10, 1, "milk", 5, 1.5)], "item_id long, store_id long, item_name string, quantity int, price double")
    prices = spark.createDataFrame([], "gas_price_id long, store_id long, fuel_type string, price double, last_updated timestamp")
    reqs = [
        ("r1", 1, '{"action": "addStore", "name": "North", "address": "2 Lane"}'),
        ("r2", 2, '{"action": "addStore", "name": "Nowhere"}'),
        ("r3", 3, '{"action": "getStore", "store_id": 99}'),
        ("r4", 4, '{"action": "addItemToStore", "payload": {"store_id": 1, "item_name": "bread", "quantity": 3, "price": 2.25}}'),
        ("r5", 5, '{"action": "addItemToStore", "payload": {"store_id": 7, "item_name": "eggs"}}'),
        ("r6", 6, '{"action": "updateItemQuantity", "payload": {"item_id": 10, "quantity": 9}}'),
        ("r7", 7, '{"action": "updateItemQuantity", "payload": {"item_id": 77, "quantity": 1}}'),
        ("r8", 8, 'not json'),
        ("r9", 9, '{"action": "dropStore"}'),
        ("r10", 10, '{"action": "updateGasPrice", "payload": {"store_id": 1, "fuel_type": "diesel", "price": 3.1}}'),
        ("r11", 11, '{"action": "updateGasPrice", "payload": {"store_id": 1, "fuel_type": "diesel", "price": 0}}'),
        ("r12", 12, '{"action": "getStoreInventory", "payload": {"store_id": 0}}'),
        ("r13", 13, '{"action": "listStores"}'),
    ]
    r = evaluate_requests(spark.createDataFrame(reqs, "request_id string, seq int, body string"), stores, items, prices,
                          order=["seq"], now="2024-01-01 00:00:00")
    got = {x.request_id: x.status for x in r.responses.collect()}
    assert got == {"r1": 201, "r2": 400, "r3": 404, "r4": 200, "r5": 404, "r6": 200, "r7": 404, "r8": 400,
                   "r9": 400, "r10": 200, "r11": 200, "r12": 400, "r13": 200}
    assert rows(r.stores, "store_id", "name") == [(1, "Main"), (2, "North")]
    assert rows(r.items, "item_id", "item_name", "quantity") == [(10, "milk", 9), (11, "bread", 3)]
    # the later price request wins, and a price of 0 is accepted (``is not None``)
    assert rows(r.prices, "gas_price_id", "store_id", "fuel_type", "price") == [(1, 1, "diesel", 0.0)]


def _ops(spark):
    """(name, fn(state, changes) -> Change) for the keyed change operators."""
    return [
        ("put", lambda s, c: M.put(s, c, KEYS)),
        ("put_if_absent", lambda s, c: M.put_if_absent(s, c, KEYS)),
        ("update", lambda s, c: M.update(s, c, KEYS)),
        ("update_if", lambda s, c: M.update_if(s, c, KEYS, F.col("Grade") < 100)),
        ("delete", lambda s, c: M.delete(s, c, KEYS)),
        ("insert_ignore", lambda s, c: M.insert_ignore(s, c, KEYS)),
        ("upsert", lambda s, c: M.upsert(s, c, KEYS, ["Grade"])),
        ("batch_write", lambda s, c: M.batch_write(s, c.withColumn("op", F.lit("PUT")), KEYS)),
    ]


def test_change_operators_with_empty_inputs(spark):
    s = seed(spark)
    empty = spark.createDataFrame([], SCHEMA)
    for name, op in _ops(spark):
        assert rows(op(s, empty).state) == rows(s), name  # nothing to apply: state unchanged
        out = op(empty, s).state  # everything new (or nothing to touch)
        expect = [] if name in ("update", "update_if", "delete") else rows(s)
        assert rows(out) == expect, name


def test_change_operators_with_duplicate_keys_in_batch(spark):
    s = seed(spark)
    dup = spark.createDataFrame([("S1001", "CS101", "a", 60, 1), ("S1001", "CS101", "a", 70, 2)], SCHEMA + ", seq int")
    for name, op in (("put", lambda st, c: M.put(st, c, KEYS, order=["seq"])),
                     ("update", lambda st, c: M.update(st, c, KEYS, order=["seq"])),
                     ("upsert", lambda st, c: M.upsert(st, c, KEYS, ["Grade"], order=["seq"]))):
        out = op(s, dup).state
        assert out.count() == s.count(), name  # one row per key
        assert out.where("StudentID = 'S1001' AND CourseID = 'CS101'").first().Grade == 70, name  # last by seq wins


def test_patches_of_one_key_apply_in_order(spark):
    state = spark.createDataFrame([(1, "old", 1.0), (2, "two", 2.0)], "k int, name string, price double")
    ch = spark.createDataFrame([(1, 1, {"name": "0"}), (1, 2, {"price": "7"}), (1, 3, {"price": ""}), (1, 4, {"x": "y"}), (9, 5, {"name": "n"})],
                               "k int, seq int, f map<string,string>")
    r = M.patch(state, ch, ["k"], "f", {"name": "truthy", "price": "truthy"}, require_any=True, order=["seq"])
    assert rows(r.state) == [(1, "0", 7.0), (2, "two", 2.0)]
    assert rows(r.rejected, "k", "status") == [(1, 400), (1, 400), (9, 404)]


def test_null_keys_and_repeated_unknown_keys(spark):
    state = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    assert rows(M.put(state, spark.createDataFrame([(None, "c")], "k int, v string"), ["k"]).state, "v") == [("b",), ("c",)]
    gone = M.delete(state, spark.createDataFrame([(7,), (7,), (1,)], "k int"), ["k"])
    assert rows(gone.rejected, "k", "status") == [(7, 404)] and rows(gone.state, "v") == [("a",)]


def test_requests_follow_their_order_and_roll_back(spark):
    from nimbusframe.operators.requests import evaluate_requests

    stores = spark.createDataFrame([(1, "Main", "1 Road")], "store_id long, name string, address string")
    items = spark.createDataFrame([], "item_id long, store_id long, item_name string, quantity int, price decimal(10,2)")
    prices = spark.createDataFrame([(5, 1, "diesel", 3.0)], "gas_price_id long, store_id long, fuel_type string, price double").select(
        "*", F.lit("2023-01-01 00:00:00").cast("timestamp").alias("last_updated"))
    p = lambda a, **f: json.dumps({"action": a, "payload": f})
    bodies = [
        p("updateItemQuantity", item_id=1, quantity=4), p("addItemToStore", store_id=1, item_name="x", quantity="x"),
        p("addItemToStore", store_id=2, item_name="early"), '{"action":"addStore","store":{"name":"North","address":""}}',
        p("addItemToStore", store_id=2, item_name="late", quantity="3", price=1.25), p("updateItemQuantity", item_id=1, quantity=9),
        p("updateGasPrice", store_id=1, fuel_type="diesel", price="abc"), p("getGasPricesForStore", store_id=1),
        p("updateGasPrice", store_id=1, fuel_type="diesel", price=3.1255), p("getStoreInventory", store_id=2),
        p("getStore", store_id=2), '{"action":"addStore","store":{"name":null,"address":"a"}}', p("getStore", store_id="0"), "[1]",
    ]
    reqs = spark.createDataFrame([(f"r{i}", i, b) for i, b in enumerate(bodies)], "request_id string, seq int, body string")
    r = evaluate_requests(reqs, stores, items, prices, now="2024-01-01 00:00:00")
    got = {x.request_id: x.status for x in r.responses.collect()}
    assert [got[f"r{i}"] for i in range(14)] == [404, 500, 404, 201, 200, 200, 500, 200, 200, 200, 200, 500, 404, 400]
    assert [(x.item_id, x.item_name, x.quantity) for x in r.items.collect()] == [(1, "late", 9)]
    assert [(x.gas_price_id, x.price) for x in r.prices.collect()] == [(5, 3.126)]
    assert rows(r.bodies, "request_id", "line", "name", "quantity") == [("r10", 1, "North", None), ("r7", 1, "diesel", None), ("r9", 1, "late", 9)]
    assert {x.request_id: float(x.price) for x in r.bodies.where("action = 'getGasPricesForStore'").collect()} == {"r7": 3.0}


def test_constraints_on_null_and_hot_keys_are_spread(spark):
    # 30 % NULL keys, one key on 30 % of the rows that repeats and misses in the parent
    n = 40_000
    kind = F.col("id") % 10
    df = spark.range(n, numPartitions=8).select(
        F.col("id").alias("row"), F.when(kind < 3, None).when(kind < 6, -1).otherwise(F.col("id")).alias("k"),
        F.when(kind < 3, None).when(kind < 6, -1).otherwise(F.col("id") % 100).alias("fk"))
    parent = spark.range(99).withColumnRenamed("id", "pk")
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "-1", "20")):
            spark.conf.set(k, v)
        r = M.check_constraints(df, unique=[["k"]], foreign=[("fk", parent, "pk")])
        whole = r.state.withColumn("p", F.spark_partition_id()).groupBy("p").count()
        broken = r.rejected.withColumn("p", F.spark_partition_id()).groupBy("p").count()
        sizes = sorted(x["n"] for x in whole.unionByName(broken).groupBy("p").agg(F.sum("count").alias("n")).collect())
        rules = dict(r.rejected.groupBy("rule").count().collect())
        assert r.state.count() == n * 7 // 10 - n // 100 and rules == {"unique:k": n * 3 // 10, "foreign:fk": n * 3 // 10 + n // 100}
        assert max(sizes) <= 4 * sizes[len(sizes) // 2]
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_bodies_are_numbered_over_several_lists(spark, monkeypatch):
    from nimbusframe.operators import requests as RQ

    monkeypatch.setattr(RQ, "LINES", 3)
    stores = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "store_id long, name string, address string")
    items = spark.createDataFrame([(i, 1 + i % 2, None if i == 4 else f"n{i % 5}", i, 1.0) for i in range(1, 24)],
                                  "item_id long, store_id long, item_name string, quantity int, price double")
    items = items.withColumn("price", F.col("price").cast("decimal(10,2)"))
    prices = spark.createDataFrame([], "gas_price_id long, store_id long, fuel_type string, price decimal(10,3), last_updated timestamp")
    p = lambda a, **f: json.dumps({"action": a, "payload": f})
    bodies = [("a", p("getStoreInventory", store_id=1)), ("b", p("updateItemQuantity", item_id=2, quantity=99)),
              ("c", p("getStoreInventory", store_id=1)), ("d", p("getStoreInventory", store_id=2)),
              ("c", p("getStore", store_id=2)), ("e", p("addItemToStore", store_id=2, item_name="n0")), ("f", p("getStoreInventory", store_id=2))]
    reqs = spark.createDataFrame([(r, i, b) for i, (r, b) in enumerate(bodies)], "request_id string, seq int, body string")
    got = RQ.evaluate_requests(reqs, stores, items, prices).bodies.collect()
    order = lambda x: (x[0] is not None, x[0] or "", x[1])
    held = {s: [(None if i == 4 else f"n{i % 5}", i, i) for i in range(1, 24) if 1 + i % 2 == s] for s in (1, 2)}
    later = [(n, i, 99 if i == 2 else q) for n, i, q in held[1]]
    want = {"a": held[1], "c": [*later, ("B", 2, None)], "d": held[2], "f": [*held[2], ("n0", 24, 0)]}
    for rid, lines in want.items():
        mine = sorted((x for x in got if x.request_id == rid), key=lambda x: x.line)
        assert [(x.line, x.name, x.id, x.quantity) for x in mine] == [(k, *x) for k, x in enumerate(sorted(lines, key=order), 1)]
    assert {x.request_id for x in got} == set(want)


def test_bodies_over_blocks_of_reads_take_little_disk(spark, monkeypatch):
    import os

    from nimbusframe.operators import requests as RQ
    from nimbusframe.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)
    n = 12_000  # one store that every fourth request adds to, and that is read 20 times
    stores = spark.createDataFrame([(1, "A", "a")], "store_id long, name string, address string")
    items = spark.createDataFrame([], "item_id long, store_id long, item_name string, quantity int, price decimal(10,2)")
    prices = spark.createDataFrame([], "gas_price_id long, store_id long, fuel_type string, price decimal(10,3), last_updated timestamp")
    kind = F.when(F.col("id") % 600 == 599, '"getStoreInventory"').when(F.col("id") % 4 == 0, '"addItemToStore"').otherwise('"updateGasPrice"')
    text = F.concat(F.lit('{"action":'), kind, F.lit(',"payload":{"store_id":1,"quantity":2,"price":1.5,"fuel_type":"f"'),
                    F.lit(',"item_name":"item-'), F.lpad((F.col("id") * 7 % n).cast("string"), 6, "0"), F.lit('"}}'))
    reqs = spark.range(n, numPartitions=4).select(F.concat(F.lit("request-"), "id").alias("request_id"), F.col("id").alias("seq"), text.alias("body"))
    want = {f"request-{i}": [(f"item-{j * 7 % n:06d}", j // 4 + 1) for j in sorted(range(0, i, 4), key=lambda j: j * 7 % n)] for i in range(599, n, 600)}
    monkeypatch.setattr(RQ, "LINES", 700)
    monkeypatch.setattr(RQ, "READS", 7, raising=False)
    before = size()
    bodies = RQ.evaluate_requests(reqs, stores, items, prices).bodies.select("request_id", "line", "name", "id").collect()
    assert size() - before < 50 * n
    got = {}
    for r in sorted(bodies, key=lambda r: (r.request_id, r.line)):
        got.setdefault(r.request_id, []).append((r.name, r.id))
        assert r.line == len(got[r.request_id])
    assert got == want


def test_wide_projections_are_split_for_the_jit(spark):
    from nimbusframe.session import split_code

    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with split_code(spark):
        assert int(spark.conf.get(key)) <= 8000
    assert spark.conf.get(key) == before
