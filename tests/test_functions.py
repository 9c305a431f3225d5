import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import rows
from nimbusframe.functions import nested as N
from nimbusframe.functions import scalars as S
from nimbusframe.operators import predicates as P


def test_letter_grades_match_reference_samples(spark):
    # sample scores and letters stated by the reference's function test
    scores = [98, 95, 91, 88, 85, 81, 78, 75, 71, 68, 65, 61, 55]
    expected = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "F"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, score int")
    got = [r.g for r in df.orderBy("i").select(S.letter_grade("score").alias("g")).collect()]
    assert got == expected


def test_sql_functions_inline(spark):
    S.register_sql_functions(spark)
    r = spark.sql("SELECT calculate_letter_grade(87) AS l, calculate_gpa('B+') AS p, calculate_gpa('zz') AS z").first()
    assert r.l == "B+" and r.p == Decimal("3.33") and r.z == Decimal("0.00")


def test_map_values_null_takes_default(spark):
    df = spark.createDataFrame([("A",), (None,), ("Q",)], "g string")
    got = rows(df.select(S.grade_points("g", S.GRADE_POINTS_6).alias("p")))
    assert got == [(Decimal("0.00"),), (Decimal("0.00"),), (Decimal("4.00"),)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("https://a.example.com/en/25?page=2",)], "u string")
    r = df.select(
        S.nth_path_element("u", 2).alias("host"), S.base_name("u").alias("base"),
        S.last_regex_match("u", "[0-9]+").alias("num"), S.composite_key(F.lit("x"), F.lit("y")).alias("k"),
        S.split_key(S.composite_key(F.lit("x"), F.lit("y")), 1).alias("k1"),
        S.iso_timestamp(F.lit("2024-01-02 03:04:05.678").cast("timestamp")).alias("iso"),
        S.money_text(F.lit(12.345)).alias("m"), S.safe_cast(F.lit("x1"), "int").alias("bad"),
    ).first()
    assert (r.host, r.base, r.num, r.k, r.k1) == ("a.example.com", "25?page=2", "2", "x|y", "y")
    assert r.iso == "2024-01-02T03:04:05.678Z" and r.m == "12.35" and r.bad is None


def test_truthy_default(spark):
    df = spark.createDataFrame([("", "old"), ("new", "old"), (None, "old"), ("0", "old")], "a string, b string")
    assert rows(df.select(S.truthy_or("a", "b").alias("v"))) == [("0",), ("new",), ("old",), ("old",)]


def test_cidr_bounds_and_sub_block(spark):
    df = spark.createDataFrame([("10.0.0.0/16",), ("192.168.1.77",)], "c string")
    lo, hi = S.cidr_bounds("c")
    got = rows(df.select(S.ip_text(lo).alias("lo"), S.ip_text(hi).alias("hi")))
    assert got == [("10.0.0.0", "10.0.255.255"), ("192.168.1.77", "192.168.1.77")]
    r = df.limit(1).select(S.sub_block("c", 24, 3).alias("s")).first()
    assert r.s == "10.0.3.0/24"


def test_glob_and_prefix(spark):
    df = spark.createDataFrame([("web-1",), ("web.2",), ("db-1",), ("webx",)], "n string")
    assert rows(df.where(P.glob_match("n", "web-*"))) == [("web-1",)]
    assert rows(df.where(P.under_prefix("n", "web"))) == [("web-1",), ("web.2",), ("webx",)]


def test_unmarshal_marshal_round_trip(spark):
    df = spark.createDataFrame([("S1001", "CS101", 85, True)], "StudentID string, CourseID string, Grade int, Active boolean")
    typed = df.select(N.marshal(df, ["StudentID", "CourseID", "Grade", "Active"]).alias("j"))
    assert typed.first().j == '{"StudentID":{"S":"S1001"},"CourseID":{"S":"CS101"},"Grade":{"N":"85"},"Active":{"BOOL":true}}'
    plain = typed.select(N.unmarshal("j").alias("m"))
    r = plain.select(N.attribute("m", "Grade", "int").alias("g"), N.attribute("m", "Active").alias("a")).first()
    assert r.g == 85 and r.a == "true"


def _typed(v):
    if v is None:
        return {"NULL": True}
    if isinstance(v, bool):
        return {"BOOL": v}
    if isinstance(v, Decimal):
        return {"N": str(v)}
    if isinstance(v, str):
        return {"S": v}
    if isinstance(v, tuple):
        return {"NS": [str(x) for x in v]} if isinstance(v[0], Decimal) else {"SS": list(v)}
    if isinstance(v, list):
        return {"L": [_typed(x) for x in v]}
    return {"M": {k: _typed(x) for k, x in v.items()}}


def _listed(v):
    if isinstance(v, (tuple, list)):
        return [_listed(x) for x in v]
    return {k: _listed(x) for k, x in v.items()} if isinstance(v, dict) else v


def test_typed_items_come_back_exact(spark):
    rng = random.Random(1)
    keys = ["S", "N", "M", "L", "a b", '"q"', "{x}", ":", ",", "\\", "BOOL", "NS", "[1]", "é", ""]
    numbers = "1.5E10 1.0E+20 -0 2.50 100 12345678901234567890123456789012345678 0.000 1.0E-10 -1.50500e100".split()
    leaves = [None, True, False, *map(Decimal, numbers), "x", "", '{"S":"x"}', 'a"b\\"c\\', '[{}]:,"', '{"M":{', "\n\t\x07 é", "\\",
              (Decimal("1"), Decimal("2.50")), ("a,b", "]}"), ('{"N":"1"}',)]

    def value(depth):
        r = rng.random()
        if depth and r < 0.3:
            return {rng.choice(keys): value(depth - 1) for _ in range(rng.randrange(4))}
        return [value(depth - 1) for _ in range(rng.randrange(4))] if depth and r < 0.5 else rng.choice(leaves)

    items = [{rng.choice(keys): value(rng.choice([0, 1, 3, 6])) for _ in range(rng.randrange(5))} for _ in range(800)]
    deep = Decimal("1.0E20")
    for i in range(40):
        deep = {"M": deep} if i % 2 else [deep]
    items.append({"d": deep})
    data = [(i, json.dumps({k: _typed(x) for k, x in v.items()}, ensure_ascii=i % 2 == 0)) for i, v in enumerate(items)]
    df = spark.createDataFrame(data, "i int, j string").select("i", N.plain_json("j").alias("p"), N.unmarshal("j").alias("m"))
    for r in df.collect():
        read = lambda text: json.loads(text, parse_float=Decimal, parse_int=Decimal)
        assert read(r.p) == _listed(items[r.i]), data[r.i]
        for k, v in items[r.i].items():
            got = r.m[k]
            if isinstance(v, (dict, list, tuple)):
                assert read(got) == _listed(v)
            else:
                assert got == (v if v is None or isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v))


def test_untyped_items_and_odd_names(spark):
    bad = ["x", '{"a":"plain"}', '{"a":{"L":["x"]}}', '{"a":{"L":[{"S":"x"},"y"]}}', "[]", None, '{"a":1}', '{"M":{}}', '{"a":{"X":"1"}}']
    df = spark.createDataFrame([(j,) for j in bad], "j string")
    assert [r.p for r in df.select(N.plain_json("j").alias("p")).collect()] == [None] * len(bad)
    df = spark.createDataFrame([(15000000000.5, "v", 7)], 'a double, `b"c.d` string, `e\'f` int')
    typed = df.select(N.marshal(df, df.columns).alias("j"))
    r = typed.select(N.plain_json("j").alias("p"), N.typed_attribute("j", 'b"c.d').alias("x"), N.typed_attribute("j", "e'f").alias("y"),
                     N.unmarshal("j").alias("m")).first()
    assert json.loads(r.p) == {"a": 15000000000.5, 'b"c.d': "v", "e'f": 7} and float(r.m["a"]) == 15000000000.5
    assert (r.x, r.y) == ("v", "7")


def test_split_overflow(spark):
    df = spark.createDataFrame([({"name": "n", "price": "1.5", "color": "red"},)], "m map<string,string>")
    cols, over = N.split_overflow("m", ["name", "price"])
    r = df.select(cols["name"].alias("name"), over.alias("data")).first()
    assert r.name == "n" and r.data == '{"color":"red"}'


def test_unnest_inner_drops_empty_and_outer_keeps(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert rows(N.unnest(df, "xs", "x"), "id", "x") == [(1, 1), (1, 2)]
    assert len(N.unnest(df, "xs", "x", outer=True).collect()) == 4


def test_dense_ids_are_consecutive_in_order(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7 % 1000).alias("k"))
    out = S.with_dense_id(df, "rid", start=1, order=["k"])
    got = rows(out, "k", "rid")
    assert [r[1] for r in got] == list(range(1, 1001))
    assert all(a[0] < b[0] for a, b in zip(got, got[1:]))


def test_dense_ids_on_many_wide_partitions(spark, tmpdir_path):
    wide = F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(str(i)))) for i in range(4)])
    df = spark.range(300_000, numPartitions=7).select(F.xxhash64("id").alias("k"), wide.alias("x"), F.concat(wide, F.lit("y")).alias("y"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        S.with_dense_id(df, "rid", start=1, order=["k"]).write.parquet(f"{tmpdir_path}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    out = spark.read.parquet(f"{tmpdir_path}/out")
    r = out.agg(F.count("rid").alias("n"), F.countDistinct("rid").alias("d"), F.min("rid").alias("lo"), F.max("rid").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (300_000, 300_000, 1, 300_000)
    ks = [x.k for x in out.orderBy("rid").select("k").collect()]
    assert ks == sorted(ks)


def test_truth_by_type_and_utc_text(spark):
    from decimal import Decimal

    df = spark.createDataFrame([("0", "", "false", 0, -0.0, float("nan"), Decimal("0.00"), False)],
                               "a string, b string, c string, d int, e double, f double, g decimal(5,2), h boolean")
    got = df.select(*[S.is_truthy(c).alias(c) for c in df.columns], S.is_truthy(F.lit(None)).alias("n"),
                    S.is_truthy(F.lit(7)).alias("p"), S.is_truthy(F.lit(True)).alias("q")).first()
    assert [got[c] for c in "abcdefghnpq"] == [True, False, True] + [False] * 6 + [True, True]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = spark.range(1).select(S.iso_timestamp(F.timestamp_seconds(F.lit(0))).alias("x"),
                                   S.iso_timestamp(F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")).alias("y")).first()
        assert tuple(at) == ("1970-01-01T00:00:00.000Z", "2024-01-01T05:00:00.000Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
