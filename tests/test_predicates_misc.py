"""Predicates, array helpers, ordering, and the remaining sources/sinks."""

import json
import os

from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from nimbusframe.functions import nested as N
from nimbusframe.functions import scalars as S
from nimbusframe.operators import predicates as P
from nimbusframe.operators import windows as W
from nimbusframe.sources import io as IO
from nimbusframe.streaming import streams as T


def _items(spark):
    return spark.createDataFrame([("S1001", "CS101", 85), ("S1001", "MATH201", 92), ("S1003", "PHYS101", 78)],
                                 "StudentID string, CourseID string, Grade int")


def test_lookup_scan_exists_since(spark):
    items = _items(spark)
    assert rows(P.lookup(items, StudentID="S1001", CourseID="MATH201"), "Grade") == [(92,)]
    assert rows(P.scan(items, "Grade < :g AND StudentID = :s", {"g": 90, "s": "S1001"}), "CourseID") == [("CS101",)]
    assert P.key_exists(items, StudentID="S1003").first().exists is True
    assert P.key_exists(items, StudentID="S9").first().exists is False
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:45:00")], "id int, ts string")
    got = rows(P.since(ev, "ts", "30 minutes", now="2024-01-01 11:00:00"), "id")
    assert got == [(2,)]


def test_in_values_and_missing(spark):
    df = spark.createDataFrame([("-1", None), ("tcp", 22), ("all", None)], "p string, port int")
    assert rows(df.where(P.in_values("p", ["-1", "all"]) & P.is_missing("port")), "p") == [("-1",), ("all",)]


def test_array_helpers(spark):
    df = spark.createDataFrame(
        [([{"Name": "a", "State": {"Code": 16}}, {"Name": "b", "State": {"Code": 80}}],)],
        "xs array<struct<Name:string, State:struct<Code:int>>>")
    r = df.select(
        N.filter_project("xs", lambda x: x.State.Code == 16, "Name").alias("running"),
        N.any_element("xs", lambda x: x.State.Code == 80).alias("any_stopped"),
        N.array_length("xs").alias("n"), N.array_length(F.lit(None).cast("array<int>")).alias("n0"),
        S.element_or_null("xs", 0).Name.alias("first"), S.element_or_null("xs", -1).Name.alias("last"),
        S.element_or_null("xs", 5).alias("none"),
        N.reshape("xs", {"id": "Name", "code": "State.Code"}).alias("shaped"),
    ).first()
    assert r.running == ["a"] and r.any_stopped and r.n == 2 and r.n0 == 0
    assert (r.first, r.last, r.none) == ("a", "b", None)
    assert [(x.id, x.code) for x in r.shaped] == [("a", 16), ("b", 80)]


def test_sort_by_null_order(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, 1.0)], "id int, v double")
    assert [r.id for r in W.sort_by(df, [("v", "desc", "first")]).collect()] == [1, 2, 3]
    assert [r.id for r in W.sort_by(df, [("v", "asc", "last")]).collect()] == [3, 2, 1]


def test_read_table_parquet_path(spark):
    df = IO.read_table(spark, SF_SMALL, "region")
    assert df.count() == 5


def test_change_stream_source_and_notification_sink(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/in")
    recs = [
        {"eventName": "INSERT", "NewImage": json.dumps({"id": {"S": "a1"}, "price": {"N": "9.5"}})},
        {"eventName": "REMOVE", "OldImage": json.dumps({"id": {"S": "a2"}})},
        {"eventName": "OTHER", "NewImage": json.dumps({"id": {"S": "a3"}})},
    ]
    with open(f"{tmpdir_path}/in/batch1.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    src = IO.read_changes(spark, f"{tmpdir_path}/in", "eventName string, OldImage string, NewImage string")
    T.run_available_now(T.to_notifications(src, env="dev", now="2024-01-01 00:00:00"), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    out = spark.read.parquet(f"{tmpdir_path}/out")
    assert rows(out, "subject") == [("[dev] Item Deleted: a2",), ("[dev] New Item Created: a1",)]
    IO.write_notifications(out, f"{tmpdir_path}/sns")
    assert spark.read.json(f"{tmpdir_path}/sns").count() == 2


def test_version_deletes_and_markers(spark):
    from nimbusframe.operators import changes as M

    v = spark.createDataFrame([("a", "v1", "2024-01-01 00:00:00"), ("a", "v2", "2024-01-02 00:00:00"), ("b", "v1", "2024-01-01 00:00:00")],
                              "key string, version_id string, last_modified string").withColumn(
        "last_modified", F.col("last_modified").cast("timestamp")).withColumn("is_delete_marker", F.lit(False))
    marked = M.mark_deleted(v, spark.createDataFrame([("a",)], "key string"), "key", "version_id", "last_modified", now="2024-01-03 00:00:00")
    assert marked.count() == 4
    assert rows(M.current_objects(marked, "key", "last_modified"), "key") == [("b",)]
    # removing the marker version brings the object back
    gone = M.delete_version(marked, "key", "version_id", marked.where("is_delete_marker"))
    assert rows(M.current_objects(gone, "key", "last_modified"), "key", "version_id") == [("a", "v2"), ("b", "v1")]


def test_join_chain_and_inline_rows(spark):
    from nimbusframe.operators import joins as J

    fact = IO.inline_table(spark, [(1, 10, 100), (2, 20, 200)], "e int, s int, c int")
    s = IO.inline_table(spark, [(10, "ann")], "s int, name string")
    c = IO.inline_table(spark, [(100, "CS101"), (200, "MATH1")], "c int, code string")
    out = J.join_chain(fact, [(s, "s", "left"), (c, "c", "inner")])
    assert rows(out, "e", "name", "code") == [(1, "ann", "CS101"), (2, None, "MATH1")]


def test_small_scalars(spark):
    df = spark.createDataFrame([("12.345", 0, "")], "t string, z int, e string")
    r = df.select(
        S.to_decimal("t", 10, 3).alias("d"), S.round_half_up(F.lit(2.675), 2).alias("r"),
        S.row_to_json("z", "e").alias("j"), S.is_present("z", "truthy").alias("zt"), S.is_present("z").alias("zn"),
        S.is_present("e", "non_empty").alias("en"), S.to_date_literal("2024-02-29").alias("day"),
    ).first()
    assert str(r.d) == "12.345" and r.r == 2.68 and r.j == '{"z":0,"e":""}'
    assert (r.zt, r.zn, r.en) == (False, True, False) and str(r.day) == "2024-02-29"
