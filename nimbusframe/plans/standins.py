"""Stand-in inputs built from the driver tables.

The reference's queries read nested inventory documents, a student roster,
key-value items, change records and object versions; the driver provides a
star schema. The builders below only give rows in the schema each job
expects - one output row per input row, no grouping and none of the jobs'
work - so every job runs over whole tables and grows with them. Each builder
has a flat SQL twin (``*_SQL``) used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.nested import marshal
from nimbusframe.functions.scalars import LETTER_BANDS, LETTER_BELOW, letter_grade
from nimbusframe.plans.reports import Roster

# --- security inventory --------------------------------------------------------


# The nested builders are single SQL projections: one expression tree sent to
# the JVM at once (instead of one py4j call per Column operation).
_SG_DOC_SQL = """
array(named_struct(
  'GroupId', concat('sg-', CAST(l_orderkey AS STRING)),
  'GroupName', concat('group-', CAST(l_suppkey AS STRING)),
  'Description', concat('rules of supplier ', CAST(l_suppkey AS STRING)),
  'VpcId', concat('vpc-', CAST(l_suppkey AS STRING)),
  'IpPermissions', CASE WHEN l_discount > 0 THEN array(named_struct(
      'IpProtocol', CASE l_returnflag WHEN 'R' THEN '-1' WHEN 'A' THEN 'udp' ELSE 'tcp' END,
      'FromPort', CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS BIGINT) ELSE pmod(floor(l_extendedprice), 4000) END,
      'ToPort', CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS BIGINT)
                     ELSE pmod(floor(l_extendedprice), 4000) + floor(l_tax * 1000) END,
      'IpRanges', CASE WHEN l_linestatus = 'O' AND l_tax > 0.05
                       THEN array(named_struct('CidrIp', '0.0.0.0/0'), named_struct('CidrIp', '10.0.0.0/8'))
                       WHEN l_linestatus = 'O' THEN array(named_struct('CidrIp', '0.0.0.0/0'))
                       ELSE array(named_struct('CidrIp', concat('10.', CAST(pmod(l_suppkey, 256) AS STRING), '.0.0/16'))) END))
    ELSE CAST(array() AS ARRAY<STRUCT<IpProtocol: STRING, FromPort: BIGINT, ToPort: BIGINT, IpRanges: ARRAY<STRUCT<CidrIp: STRING>>>>)
  END
)) AS SecurityGroups"""


_SG_COLUMNS = ["l_orderkey", "l_suppkey", "l_discount", "l_returnflag", "l_extendedprice", "l_tax", "l_linestatus"]


def security_group_docs(lineitem: DataFrame) -> DataFrame:
    """One document per lineitem row holding one group (id ``sg-<order>``) with
    zero or one permission (none when the discount is 0) and one or two
    address ranges. All-traffic rules (protocol ``-1``) carry no ports."""
    return lineitem.selectExpr(_SG_DOC_SQL)


SG_RULES_SQL = """
sg_rules AS (
  SELECT GroupId, GroupName, Description, VpcId, IpProtocol, FromPort, ToPort, unnest(ranges) AS CidrIp
  FROM (
    SELECT 'sg-' || l_orderkey AS GroupId, 'group-' || l_suppkey AS GroupName,
           'rules of supplier ' || l_suppkey AS Description, 'vpc-' || l_suppkey AS VpcId,
           CASE l_returnflag WHEN 'R' THEN '-1' WHEN 'A' THEN 'udp' ELSE 'tcp' END AS IpProtocol,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(FLOOR(l_extendedprice) AS BIGINT) % 4000 END AS FromPort,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(FLOOR(l_extendedprice) AS BIGINT) % 4000
                + CAST(FLOOR(l_tax * 1000) AS BIGINT) END AS ToPort,
           CASE WHEN l_linestatus = 'O' AND l_tax > 0.05 THEN ['0.0.0.0/0', '10.0.0.0/8']
                WHEN l_linestatus = 'O' THEN ['0.0.0.0/0']
                ELSE ['10.' || (l_suppkey % 256) || '.0.0/16'] END AS ranges
    FROM lineitem WHERE l_discount > 0
  )
)"""


_INSTANCE_DOC_SQL = """
array(named_struct(
  'ReservationId', concat('r-', CAST(o_custkey AS STRING)),
  'Instances', array(named_struct(
    'InstanceId', concat('i-', CAST(o_orderkey AS STRING)),
    'InstanceType', o_orderpriority,
    'SubnetId', concat('subnet-', CAST(o_custkey AS STRING)),
    'VpcId', concat('vpc-', CAST(o_custkey AS STRING)),
    'PrivateIpAddress', concat('ip-', CAST(o_orderkey AS STRING)),
    'PublicIpAddress', CASE WHEN o_orderstatus = 'O' THEN concat('203.0.113.', CAST(pmod(o_custkey, 256) AS STRING)) END,
    'State', named_struct('Name', CASE WHEN o_orderstatus = 'F' THEN 'stopped' ELSE 'running' END),
    'SecurityGroups', array(named_struct('GroupId', concat('sg-', CAST(o_orderkey AS STRING)))),
    'Tags', CASE WHEN o_orderpriority = '1-URGENT' THEN array(named_struct('Key', 'env', 'Value', 'prod'))
                 ELSE CAST(array() AS ARRAY<STRUCT<Key: STRING, Value: STRING>>) END
  ))
)) AS Reservations"""


_INSTANCE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"]


def instance_docs(orders: DataFrame) -> DataFrame:
    """One reservation per order row with one instance attached to group
    ``sg-<order>``; open orders have a public address; urgent ones carry a tag."""
    return orders.selectExpr(_INSTANCE_DOC_SQL)


def inventory_documents(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same groups, instances and databases as documents of several: a
    document has the groups of an order, a group the permissions of its lines; a
    document has the reservations of four customers, a reservation the instances
    of one, of which every second is attached to the next order's group too; ten
    databases share a document. Spark groups the rows: they are shuffled once, as
    they are read, and nested where their document comes together."""
    lineitem = lineitem.select(*_SG_COLUMNS).repartition("l_orderkey")
    lines = lineitem.selectExpr("l_orderkey AS doc", _SG_DOC_SQL).select("doc", F.col("SecurityGroups")[0].alias("g"))
    names = ["GroupId", "GroupName", "Description", "VpcId"]
    groups = lines.groupBy("doc", *[F.col(f"g.{n}").alias(n) for n in names]).agg(F.flatten(F.collect_list("g.IpPermissions")).alias("IpPermissions"))
    groups = groups.groupBy("doc").agg(F.collect_list(F.struct(*names, "IpPermissions")).alias("SecurityGroups"))
    orders = orders.select(*_INSTANCE_COLUMNS, F.floor(F.col("o_custkey") / 4).alias("doc")).repartition("doc")
    one = orders.selectExpr("doc", "o_custkey AS customer", "o_orderkey AS key", _INSTANCE_DOC_SQL).select("doc", "customer", "key", F.col("Reservations")[0].alias("r"))
    i = F.col("r.Instances")[0]
    second = F.struct(F.concat(F.lit("sg-"), (F.col("key") + 1).cast("string")).alias("GroupId"))
    attached = F.when(F.col("key") % 2 == 0, F.concat(i["SecurityGroups"], F.array(second))).otherwise(i["SecurityGroups"])
    held = one.groupBy("doc", "customer", F.col("r.ReservationId").alias("ReservationId")).agg(F.collect_list(i.withField("SecurityGroups", attached)).alias("Instances"))
    held = held.groupBy("doc").agg(F.collect_list(F.struct("ReservationId", "Instances")).alias("Reservations"))
    dbs = database_docs(customer).select(F.col("DBInstances")[0].alias("d"))
    number = F.try_to_number(F.regexp_extract("d.DBInstanceIdentifier", r"(\d+)$", 1), F.lit("999999999999")).cast("long")
    dbs = dbs.groupBy(F.floor(number / 10).alias("doc")).agg(F.collect_list("d").alias("DBInstances"))
    return groups.drop("doc"), held.drop("doc"), dbs.drop("doc")


EC2_SQL = """
ec2_instances AS (
  SELECT 'r-' || o_custkey AS ReservationId, 'i-' || o_orderkey AS InstanceId, o_orderpriority AS InstanceType,
         'subnet-' || o_custkey AS SubnetId, 'vpc-' || o_custkey AS VpcId, 'ip-' || o_orderkey AS PrivateIpAddress,
         CASE WHEN o_orderstatus = 'O' THEN '203.0.113.' || (o_custkey % 256) END AS PublicIpAddress,
         CASE WHEN o_orderstatus = 'F' THEN 'stopped' ELSE 'running' END AS State,
         'sg-' || o_orderkey AS SecurityGroupId,
         o_orderpriority = '1-URGENT' AS tagged
  FROM orders
)"""


def database_docs(customer: DataFrame) -> DataFrame:
    """One database instance per customer row. Negative balances leave
    ``StorageEncrypted`` missing."""
    seg = F.col("c_mktsegment")
    engine = (F.when(seg == "BUILDING", "mysql").when(seg == "AUTOMOBILE", "postgres").when(seg == "MACHINERY", "oracle-ee")
              .when(seg == "HOUSEHOLD", "sqlserver-ex").otherwise("mariadb"))
    dbi = F.struct(
        F.col("c_name").alias("DBInstanceIdentifier"),
        engine.alias("Engine"),
        F.concat(F.lit("db.t3."), F.lower(seg)).alias("DBInstanceClass"),
        (F.col("c_acctbal") > 8000).alias("PubliclyAccessible"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") >= 1000).alias("StorageEncrypted"),
        (F.col("c_nationkey") >= 12).alias("MultiAZ"),
    )
    return customer.select(F.array(dbi).alias("DBInstances"))


DB_SQL = """
db_instances AS (
  SELECT c_name AS DBInstanceIdentifier,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'mysql' WHEN 'AUTOMOBILE' THEN 'postgres' WHEN 'MACHINERY' THEN 'oracle-ee'
              WHEN 'HOUSEHOLD' THEN 'sqlserver-ex' ELSE 'mariadb' END AS Engine,
         'db.t3.' || lower(c_mktsegment) AS DBInstanceClass,
         c_acctbal > 8000 AS PubliclyAccessible,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal >= 1000 END AS StorageEncrypted,
         c_nationkey >= 12 AS MultiAZ
  FROM customer
)"""

# --- student roster ------------------------------------------------------------


def roster(customer: DataFrame, part: DataFrame, lineitem: DataFrame, orders: DataFrame) -> Roster:
    """students = customer, courses = part, enrolments = lineitem rows joined
    to their order (student = ordering customer, course = part, score =
    2 x quantity turned into a letter grade)."""
    students = customer.select(
        F.col("c_custkey").alias("student_id"), F.col("c_name").alias("name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("major"), F.col("c_acctbal").alias("gpa"),
    )
    courses = part.select(
        F.col("p_partkey").alias("course_id"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("course_code"),
        F.col("p_name").alias("course_name"), F.col("p_type").alias("department"), F.col("p_brand").alias("professor"),
        F.col("p_size").alias("credits"),
    )
    enrollments = lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("l_orderkey").alias("enrollment_id"), F.col("o_custkey").alias("student_id"), F.col("l_partkey").alias("course_id"),
        F.col("o_orderdate").alias("enrollment_date"), letter_grade(F.col("l_quantity") * 2).alias("grade"),
    )
    return Roster(students, courses, enrollments, name_cols=("name",))


def letter_sql(expr: str) -> str:
    """SQL twin of ``letter_grade`` built from the same fixed bands."""
    whens = " ".join(f"WHEN {expr} >= {b} THEN '{l}'" for b, l in LETTER_BANDS)
    return f"CASE {whens} ELSE '{LETTER_BELOW}' END"


def points100_sql(expr: str, scale: dict[str, str]) -> str:
    """SQL twin of ``grade_points`` in hundredths (integer)."""
    whens = " ".join(f"WHEN '{k}' THEN {int(round(float(v) * 100))}" for k, v in scale.items())
    return f"CASE {expr} {whens} ELSE 0 END"


def mean2_sql(sum100: str, n: str) -> str:
    """HALF_UP mean to 2 decimals of values given in hundredths (non-negative)."""
    return f"(((2 * ({sum100}) + ({n})) // (2 * ({n}))) / 100.0)"


ROSTER_SQL = f"""
students AS (
  SELECT c_custkey AS student_id, c_name AS name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_mktsegment AS major, c_acctbal AS gpa FROM customer
),
courses AS (
  SELECT p_partkey AS course_id, 'P-' || p_partkey AS course_code, p_name AS course_name, p_type AS department,
         p_brand AS professor, p_size AS credits FROM part
),
enrollments AS (
  SELECT l_orderkey AS enrollment_id, o_custkey AS student_id, l_partkey AS course_id, o_orderdate AS enrollment_date,
         {letter_sql('l_quantity * 2')} AS grade
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

# --- change records and versions -------------------------------------------------

# Fixed values of the driver mapping: event types playing change-record names.
CHANGE_NAME_OF_EVENT = {"signup": "INSERT", "purchase": "MODIFY", "error": "REMOVE"}


def change_records(events: DataFrame) -> DataFrame:
    """Change records from events: signup -> INSERT, purchase -> MODIFY,
    error -> REMOVE, other types keep their (upper-cased) name and produce no
    notification. Images are typed-attribute JSON: the new image has the
    event's value, the old image the ``k`` of its props."""
    et = F.col("event_type")
    name = F.coalesce(*[F.when(et == k, F.lit(v)) for k, v in CHANGE_NAME_OF_EVENT.items()], F.upper(et))
    base = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.col("event_id").cast("string").alias("id"), F.col("user_id").alias("user"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), name.alias("eventName"),
    )
    # besides the columns, a boolean, a map that holds a number and a list, a number with an exponent that ends in 0,
    # and for one user in sixteen a number 32 levels down
    user = F.col("user").cast("string")
    deep = F.when(F.col("user") % 16 == 0, F.concat(F.lit(',"deep":' + '{"M":{"d":' * 31 + '{"N":"'), user, F.lit('"}' + "}}" * 31))).otherwise("")
    more = F.concat(
        F.lit(',"late":{"BOOL":'), (F.col("value") > 25).cast("string"), F.lit('},"big":{"N":"'), user, F.lit('.50E10"}'), deep,
        F.lit(',"about":{"M":{"user":{"N":"'), user, F.lit('"},"kinds":{"L":[{"S":"'), F.col("event_type"), F.lit('"},{"NULL":true}]}}}}'))
    nested = lambda cols: F.concat(F.regexp_replace(marshal(base, cols), r"\}$", ""), more)
    return base.select(
        "event_id", "ts", "eventName",
        F.when(F.col("eventName") != "INSERT", nested(["id", "user", "k"])).alias("OldImage"),
        F.when(F.col("eventName") != "REMOVE", nested(["id", "user", "value"])).alias("NewImage"),
    )


CHANGE_NAME_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CHANGE_NAME_OF_EVENT.items()) + " ELSE upper(event_type) END"


def event_versions(events: DataFrame) -> DataFrame:
    """Object versions from events: key ``documents/u<user>/<type>`` for
    purchases and signups, ``logs/u<user>/<type>`` otherwise; a version with
    value < 5 is a delete marker."""
    prefix = F.when(F.col("event_type").isin("purchase", "signup"), F.lit("documents/")).otherwise(F.lit("logs/"))
    return events.select(
        F.concat(prefix, F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type")).alias("key"),
        F.col("event_id").alias("version_id"), F.col("ts").alias("last_modified"),
        F.floor(F.col("value") * 100).alias("size"), (F.col("value") < 5).alias("is_delete_marker"),
    )


VERSIONS_SQL = """
versions AS (
  SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'documents/' ELSE 'logs/' END || 'u' || user_id || '/' || event_type AS key,
         event_id AS version_id, ts AS last_modified, CAST(FLOOR(value * 100) AS BIGINT) AS size, value < 5 AS is_delete_marker
  FROM events
)"""
