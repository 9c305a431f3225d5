"""URL rules by host-suffix and path-prefix expressions, Spark SQL functions only.

Every URL becomes the expressions ``host suffix + path stem`` it could be
ruled by. Expressions and rules meet in an equi-join on the first four bytes
of their SHA-256; the full digest, then the rule's own path, confirm a hit.
The longest rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusframe.llm.common import column, free_name

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of the digest that the join compares.
SHORT_BYTES = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL. Host: after the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or
    the end. Null, or no ``://``: both empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path) as a table."""
    return spark.createDataFrame(rules, "rule_verdict string, rule_host string, rule_path string")


def _stem(path: Column) -> Column:
    """The path up to and with its last slash; empty if it has none."""
    return F.regexp_extract(path, r"^(?s:.*/)?", 0)


def _digest(host: Column, stem: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, stem), 256))


def host_suffixes(host: Column, most: int) -> Column:
    """The host and its parent domains, of at most ``most`` labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), ".")
    )


def path_stems(path: Column, most: int) -> Column:
    """The empty stem and the prefixes of the path that end in a slash, up to
    the ``most``-th slash."""
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return F.transform(
        F.sequence(F.lit(0), F.least(slashes, F.lit(most))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/"))
        ),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` by its URL.

    ``rules`` has ``rule_verdict`` (``allow`` or ``block``), ``rule_host`` and
    ``rule_path``. A rule fits its host and all subdomains if the URL's path
    starts with the rule's path; of those that fit the longest wins (host and
    path together; of equal ones ``block``). Adds ``host``, ``path``, ``rule``
    (the rule's text, null if none fits) and ``verdict`` (``default`` where no
    rule fits) to the columns of ``pages``; a clash in names is resolved by
    underscores before the new ones.

    Null or malformed URLs have empty host and path and get the default unless
    a rule has an empty host. Rules with null parts never fit; repeated rules
    count once; no rules or no pages is no error. Rows are judged alike when
    their host and path agree, so repeated rows stay repeated.

    How deep rules go (labels, slashes) is read from the rules, two numbers;
    deeper expressions of a URL could meet no rule. Rules are joined without
    a hint: Spark broadcasts them only below its size threshold. Each distinct
    (host, path) is judged once, and the verdicts join back by an exchange
    that adaptive execution can split for a hot URL.
    """
    names = {k: free_name(pages, k) for k in ("host", "path", "rule", "verdict")}
    rules = rules.select("rule_verdict", "rule_host", "rule_path").dropna().distinct()
    deep = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.length("rule_path") - F.length(F.replace("rule_path", F.lit("/"), F.lit("")))).alias("slashes"),
    ).first()
    keyed = rules.withColumn("digest", _digest(F.col("rule_host"), _stem(F.col("rule_path")))).withColumn(
        "short", F.substring("digest", 1, SHORT_BYTES)
    )
    host, path = url_parts(column(pages, url).cast("string"))
    # Columns go under names of their own, by their places: none can clash with those below.
    parted = pages.select(*[column(pages, c).alias(f"c{i}") for i, c in enumerate(pages.columns)], host.alias("host"), path.alias("path"))
    asked = parted.select(F.col("host").alias("h"), F.col("path").alias("p")).distinct()
    said = (
        asked.withColumn("suffix", F.explode(host_suffixes(F.col("h"), deep["labels"] or 1)))
        .withColumn("stem", F.explode(path_stems(F.col("p"), deep["slashes"] or 0)))
        .withColumn("full", _digest(F.col("suffix"), F.col("stem")))
        .withColumn("short", F.substring("full", 1, SHORT_BYTES))
        .join(keyed, "short")
        .where((F.col("full") == F.col("digest")) & F.startswith(F.col("p"), F.col("rule_path")))
        .where(F.col("suffix") == F.col("rule_host"))
        .withColumn("n", F.length("p"))
        .groupBy("h", "p", "n")
        .agg(
            F.max(
                F.struct(
                    (F.length("rule_host") + F.length("rule_path")).alias("long"),
                    F.col("rule_verdict").alias("verdict"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                )
            ).alias("best")
        )
    )
    out = parted.join(
        said.select("h", "p", "best"),
        (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")),
        "left",
    )
    out = out.select(*parted.columns, F.col("best.rule"), F.coalesce(F.col("best.verdict"), F.lit(default)))
    return out.toDF(*pages.columns, *names.values())
