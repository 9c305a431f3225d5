"""Posture queries on a small inventory fixture in the reference's document shape.

The fixture holds what the reference's deployment creates (one group of each
kind: SSH, RDP, database port, all traffic), plus the edge cases the survey
asks for: an all-traffic rule without ports, a group without rules, a
database without ``StorageEncrypted`` and an instance without a public address.
"""

import json
import os

from helpers import rows
from nimbusframe.plans import posture as PO
from nimbusframe.sources.io import read_documents

GROUPS = {
    "SecurityGroups": [
        {"GroupId": "sg-ssh", "GroupName": "ssh", "Description": "ssh open", "VpcId": "v1",
         "IpPermissions": [{"IpProtocol": "tcp", "FromPort": 22, "ToPort": 22, "IpRanges": [{"CidrIp": "0.0.0.0/0"}]}]},
        {"GroupId": "sg-rdp", "GroupName": "rdp", "Description": "rdp open", "VpcId": "v1",
         "IpPermissions": [{"IpProtocol": "tcp", "FromPort": 3389, "ToPort": 3389, "IpRanges": [{"CidrIp": "0.0.0.0/0"}]}]},
        {"GroupId": "sg-db", "GroupName": "db", "Description": "mysql open", "VpcId": "v1",
         "IpPermissions": [{"IpProtocol": "tcp", "FromPort": 3306, "ToPort": 3306,
                            "IpRanges": [{"CidrIp": "0.0.0.0/0"}, {"CidrIp": "10.0.0.0/8"}]}]},
        {"GroupId": "sg-all", "GroupName": "all", "Description": "everything", "VpcId": "v1",
         "IpPermissions": [{"IpProtocol": "-1", "IpRanges": [{"CidrIp": "0.0.0.0/0"}]}]},
        {"GroupId": "sg-empty", "GroupName": "empty", "Description": "no rules", "VpcId": "v1", "IpPermissions": []},
        {"GroupId": "sg-private", "GroupName": "private", "Description": "internal web", "VpcId": "v1",
         "IpPermissions": [{"IpProtocol": "tcp", "FromPort": 80, "ToPort": 443, "IpRanges": [{"CidrIp": "10.0.0.0/8"}]}]},
    ]
}
INSTANCES = {
    "Reservations": [
        {"ReservationId": "r-1", "Instances": [
            {"InstanceId": "i-pub", "InstanceType": "t3.micro", "SubnetId": "s1", "VpcId": "v1", "PrivateIpAddress": "10.0.0.5",
             "PublicIpAddress": "203.0.113.5", "State": {"Name": "running"},
             "SecurityGroups": [{"GroupId": "sg-ssh"}, {"GroupId": "sg-all"}], "Tags": [{"Key": "env", "Value": "prod"}]},
            {"InstanceId": "i-priv", "InstanceType": "t3.small", "SubnetId": "s2", "VpcId": "v1", "PrivateIpAddress": "10.0.1.5",
             "State": {"Name": "running"}, "SecurityGroups": [{"GroupId": "sg-all"}]},
        ]}
    ]
}
DBS = {
    "DBInstances": [
        {"DBInstanceIdentifier": "db-public", "Engine": "mysql", "DBInstanceClass": "db.t3.micro",
         "PubliclyAccessible": True, "StorageEncrypted": True, "MultiAZ": False},
        {"DBInstanceIdentifier": "db-plain", "Engine": "postgres", "DBInstanceClass": "db.t3.micro",
         "PubliclyAccessible": False, "MultiAZ": False},
        {"DBInstanceIdentifier": "db-ok", "Engine": "postgres", "DBInstanceClass": "db.t3.micro",
         "PubliclyAccessible": False, "StorageEncrypted": True, "MultiAZ": True},
    ]
}


def _views(spark, d):
    for name, doc in (("sg", GROUPS), ("inst", INSTANCES), ("db", DBS)):
        os.makedirs(f"{d}/{name}", exist_ok=True)
        with open(f"{d}/{name}/part.json", "w") as f:
            json.dump(doc, f, indent=2)
    rules = PO.sg_rules(read_documents(spark, f"{d}/sg"))
    inst = PO.ec2_instances(read_documents(spark, f"{d}/inst"))
    dbs = PO.db_instances(read_documents(spark, f"{d}/db"))
    return rules, inst, dbs


def test_flatten_and_findings(spark, tmpdir_path):
    rules, inst, dbs = _views(spark, tmpdir_path)
    # sg-empty vanishes (inner unnest); sg-db has two ranges
    assert rules.count() == 6
    assert rows(PO.open_port(rules, PO.SSH_PORT), "GroupId") == [("sg-ssh",)]
    assert rows(PO.open_port(rules, PO.RDP_PORT), "GroupId") == [("sg-rdp",)]
    assert rows(PO.open_port(rules, PO.DATABASE_PORTS), "GroupId", "CidrIp") == [("sg-db", "0.0.0.0/0")]
    at = PO.all_traffic(rules).collect()
    assert [r.GroupId for r in at] == ["sg-all"] and at[0].FromPort is None
    pub = PO.public_databases(dbs).collect()
    assert [(r.DBInstanceId, r.PubliclyAccessible) for r in pub] == [("db-public", "true")]
    assert rows(PO.unencrypted_databases(dbs), "DBInstanceId", "StorageEncrypted") == [("db-plain", None)]


def test_issue_summary_counts(spark, tmpdir_path):
    rules, inst, dbs = _views(spark, tmpdir_path)
    got = {r.issue: r["count"] for r in PO.issue_summary(rules, inst, dbs).collect()}
    assert got == {
        "SSH Open to World": 1, "RDP Open to World": 1, "Database Ports Open to World": 1, "All Traffic Allowed": 1,
        # i-pub is attached to two groups: the instance view has a row per attachment
        "Public EC2 Instances": 2, "Public RDS Instances": 1, "Unencrypted RDS Instances": 1,
    }


def test_public_instances_fan_out_and_exercises(spark, tmpdir_path):
    rules, inst, dbs = _views(spark, tmpdir_path)
    pi = rows(PO.public_instances(inst, rules), "InstanceId", "SecurityGroupName")
    assert pi == [("i-pub", "all"), ("i-pub", "ssh")]
    assert rows(PO.all_traffic_instances(inst, rules), "InstanceId") == [("i-priv",), ("i-pub",)]
    assert rows(PO.tagged_instances(inst), "InstanceId") == [("i-pub",)]
    assert rows(PO.tagged_instances(inst, tagged=False), "InstanceId") == [("i-priv",)]
    assert rows(PO.privileged_ports_open(rules), "GroupId") == [("sg-ssh",)]
    risk = {r.resource: r.risk_score for r in PO.resource_risk(rules, inst, dbs).collect()}
    assert risk["security_group:sg-all"] == 10 and risk["database:db-public"] == 9 and risk["instance:i-pub"] == 5
