"""Security-posture queries (Q1-Q9) over nested inventory documents.

Inputs are the documents as read by ``read_documents``: a
``SecurityGroups`` array, a ``Reservations`` array and a ``DBInstances``
array per document row. The flattened views are lateral unnests (J5); the
queries are filters, one 1:N join and a single-pass issue count.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.nested import has_tags, unnest_path
from nimbusframe.operators.aggregates import count_issues, risk_score
from nimbusframe.operators.predicates import in_values, range_covers, range_overlaps

# Ports and labels of the reference's posture queries.
SSH_PORT = 22
RDP_PORT = 3389
DATABASE_PORTS = (3306, 5432, 1521, 1433)
ALL_TRAFFIC_PROTOCOLS = ("-1", "all")
OPEN_CIDR = "0.0.0.0/0"
ISSUE_LABELS = (
    "SSH Open to World",
    "RDP Open to World",
    "Database Ports Open to World",
    "All Traffic Allowed",
    "Public EC2 Instances",
    "Public RDS Instances",
    "Unencrypted RDS Instances",
)
RULE_COLUMNS = ["GroupId", "GroupName", "Description", "IpProtocol", "FromPort", "ToPort", "CidrIp"]


def sg_rules(security_groups: DataFrame) -> DataFrame:
    """View: one row per (group, permission, address range). Groups without
    permissions and permissions without ranges drop out (inner unnest)."""
    u = unnest_path(security_groups, "SecurityGroups.IpPermissions.IpRanges", ["sg", "ip", "ip_range"], keep=["SecurityGroups"])
    return u.select(
        F.col("sg.GroupId").alias("GroupId"),
        F.col("sg.GroupName").alias("GroupName"),
        F.col("sg.Description").alias("Description"),
        F.col("sg.VpcId").alias("VpcId"),
        F.col("ip.IpProtocol").alias("IpProtocol"),
        F.col("ip.FromPort").alias("FromPort"),
        F.col("ip.ToPort").alias("ToPort"),
        F.col("ip_range.CidrIp").alias("CidrIp"),
    )


def ec2_instances(instances: DataFrame) -> DataFrame:
    """View: one row per (reservation, instance, attached group)."""
    u = unnest_path(instances, "Reservations.Instances.SecurityGroups", ["r", "i", "sg"], keep=["Reservations"])
    return u.select(
        F.col("r.ReservationId").alias("ReservationId"),
        F.col("i.InstanceId").alias("InstanceId"),
        F.col("i.InstanceType").alias("InstanceType"),
        F.col("i.SubnetId").alias("SubnetId"),
        F.col("i.VpcId").alias("VpcId"),
        F.col("i.PrivateIpAddress").alias("PrivateIpAddress"),
        F.col("i.PublicIpAddress").alias("PublicIpAddress"),
        F.col("i.State.Name").alias("State"),
        F.col("sg.GroupId").alias("SecurityGroupId"),
        F.col("i.Tags").alias("Tags"),
    )


def db_instances(rds: DataFrame) -> DataFrame:
    """View: one row per database instance (booleans kept as BOOLEAN)."""
    u = unnest_path(rds, "DBInstances", ["dbi"], keep=["DBInstances"])
    return u.select("dbi.*")


def _tcp_open(ports: Iterable[int], cidr: str) -> Column:
    return (F.col("IpProtocol") == "tcp") & range_covers("FromPort", "ToPort", ports) & (F.col("CidrIp") == cidr)


def open_port(rules: DataFrame, ports: int | Iterable[int], cidr: str = OPEN_CIDR) -> DataFrame:
    """Q1-Q3: tcp rules whose port range covers any of ``ports``, open to ``cidr``.
    All-traffic rules carry no ports, so they never match here (as in SQL)."""
    pts = [ports] if isinstance(ports, int) else list(ports)
    return rules.where(_tcp_open(pts, cidr)).select(*RULE_COLUMNS)


def all_traffic(rules: DataFrame, cidr: str = OPEN_CIDR) -> DataFrame:
    """Q4: rules allowing every protocol from ``cidr``."""
    return rules.where(in_values("IpProtocol", ALL_TRAFFIC_PROTOCOLS) & (F.col("CidrIp") == cidr)).select(*RULE_COLUMNS)


def public_instances(instances: DataFrame, rules: DataFrame) -> DataFrame:
    """Q5: instances with a public address, once per rule of each attached
    group (the fan-out of the reference's join is kept, no DISTINCT)."""
    i = instances.where(F.col("PublicIpAddress").isNotNull())
    r = rules.select(F.col("GroupId").alias("SecurityGroupId"), F.col("GroupName").alias("SecurityGroupName"),
                     F.col("Description").alias("SecurityGroupDescription"))
    return i.join(r, "SecurityGroupId").select(
        "InstanceId", "InstanceType", "State", "PublicIpAddress", "SecurityGroupName", "SecurityGroupDescription"
    )


def _bool_text(c: str) -> Column:
    return F.col(c).cast("string")


def public_databases(dbs: DataFrame) -> DataFrame:
    """Q6: publicly accessible databases; flags as text like ``->>``."""
    return dbs.where(F.col("PubliclyAccessible") == F.lit(True)).select(
        F.col("DBInstanceIdentifier").alias("DBInstanceId"), "Engine", "DBInstanceClass",
        _bool_text("PubliclyAccessible").alias("PubliclyAccessible"),
        _bool_text("StorageEncrypted").alias("StorageEncrypted"),
        _bool_text("MultiAZ").alias("MultiAZ"),
    )


def unencrypted_databases(dbs: DataFrame) -> DataFrame:
    """Q7: storage encryption false or missing."""
    return dbs.where((F.col("StorageEncrypted") == F.lit(False)) | F.col("StorageEncrypted").isNull()).select(
        F.col("DBInstanceIdentifier").alias("DBInstanceId"), "Engine", "DBInstanceClass",
        _bool_text("StorageEncrypted").alias("StorageEncrypted"),
    )


def issue_predicates() -> dict[str, Column]:
    return {
        ISSUE_LABELS[0]: _tcp_open([SSH_PORT], OPEN_CIDR),
        ISSUE_LABELS[1]: _tcp_open([RDP_PORT], OPEN_CIDR),
        ISSUE_LABELS[2]: _tcp_open(DATABASE_PORTS, OPEN_CIDR),
        ISSUE_LABELS[3]: in_values("IpProtocol", ALL_TRAFFIC_PROTOCOLS) & (F.col("CidrIp") == OPEN_CIDR),
    }


def issue_summary(rules: DataFrame, instances: DataFrame, dbs: DataFrame) -> DataFrame:
    """Q8: the seven labelled counts, highest first (ties by label). Each view
    is scanned once - all of its predicates are counted in one aggregation."""
    return count_issues(
        [
            (rules, issue_predicates()),
            (instances, {ISSUE_LABELS[4]: F.col("PublicIpAddress").isNotNull()}),
            (dbs, {
                ISSUE_LABELS[5]: F.col("PubliclyAccessible") == F.lit(True),
                ISSUE_LABELS[6]: (F.col("StorageEncrypted") == F.lit(False)) | F.col("StorageEncrypted").isNull(),
            }),
        ]
    ).orderBy(F.desc("count"), F.asc("issue"))


def all_traffic_instances(instances: DataFrame, rules: DataFrame) -> DataFrame:
    """Exercise 1: instances attached to a group that allows all traffic from
    anywhere (semi-join: each attachment row once, however many such rules)."""
    bad = all_traffic(rules).select(F.col("GroupId").alias("SecurityGroupId"))
    return instances.join(bad, "SecurityGroupId", "left_semi").select(
        "InstanceId", "InstanceType", "State", "PublicIpAddress", "SecurityGroupId"
    )


# Fixed values of this library (the exercise leaves them open): issue weights.
DEFAULT_WEIGHTS = {
    "ALL_TRAFFIC": 10, "SSH_OPEN": 8, "RDP_OPEN": 8, "DB_PORT_OPEN": 9,
    "PUBLIC_INSTANCE": 5, "PUBLIC_DB": 9, "UNENCRYPTED_DB": 6,
}


def findings(rules: DataFrame, instances: DataFrame, dbs: DataFrame) -> DataFrame:
    """All findings as ``(resource_id, resource_type, issue)`` rows."""
    preds = {
        "SSH_OPEN": _tcp_open([SSH_PORT], OPEN_CIDR),
        "RDP_OPEN": _tcp_open([RDP_PORT], OPEN_CIDR),
        "DB_PORT_OPEN": _tcp_open(DATABASE_PORTS, OPEN_CIDR),
        "ALL_TRAFFIC": in_values("IpProtocol", ALL_TRAFFIC_PROTOCOLS) & (F.col("CidrIp") == OPEN_CIDR),
    }
    # one pass over the rules: an array of the issues each rule raises, exploded
    issues = F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in preds.items()]), lambda x: x.isNotNull())
    g = rules.select(F.col("GroupId").alias("resource_id"), F.lit("security_group").alias("resource_type"),
                     F.explode(issues).alias("issue"))
    i = instances.where(F.col("PublicIpAddress").isNotNull()).select(
        F.col("InstanceId").alias("resource_id"), F.lit("instance").alias("resource_type"), F.lit("PUBLIC_INSTANCE").alias("issue")
    ).distinct()
    dissues = F.filter(
        F.array(
            F.when(F.col("PubliclyAccessible") == F.lit(True), F.lit("PUBLIC_DB")),
            F.when((F.col("StorageEncrypted") == F.lit(False)) | F.col("StorageEncrypted").isNull(), F.lit("UNENCRYPTED_DB")),
        ),
        lambda x: x.isNotNull(),
    )
    d = dbs.select(F.col("DBInstanceIdentifier").alias("resource_id"), F.lit("database").alias("resource_type"),
                   F.explode(dissues).alias("issue"))
    return g.unionByName(i).unionByName(d)


def resource_risk(rules: DataFrame, instances: DataFrame, dbs: DataFrame, weights: Mapping[str, int] | None = None) -> DataFrame:
    """Exercise 2: risk score per resource = sum of its findings' weights."""
    spark = rules.sparkSession
    w = weights or DEFAULT_WEIGHTS
    wdf = spark.createDataFrame([(k, int(v)) for k, v in w.items()], "issue string, weight int")
    f = findings(rules, instances, dbs)
    return risk_score(f.withColumn("resource", F.concat_ws(":", "resource_type", "resource_id")), wdf,
                      "resource", "issue", weights_max_rows=len(w))


def tagged_instances(instances: DataFrame, tagged: bool = True) -> DataFrame:
    """Exercise 3: instances with (or without) tags."""
    cond = has_tags("Tags")
    return instances.where(cond if tagged else ~cond).select("InstanceId", "InstanceType", "State").distinct()


def privileged_ports_open(rules: DataFrame, lo: int = 0, hi: int = 1024, cidr: str = OPEN_CIDR) -> DataFrame:
    """Exercise 4: tcp rules whose port range overlaps ``[lo, hi]``, open to ``cidr``."""
    return rules.where(
        (F.col("IpProtocol") == "tcp") & range_overlaps("FromPort", "ToPort", lo, hi) & (F.col("CidrIp") == cidr)
    ).select(*RULE_COLUMNS)
