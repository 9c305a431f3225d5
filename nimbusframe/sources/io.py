"""Sources and sinks.

Readers take an explicit schema where the shape is known (no inference pass
over 100 TB); writers are plain DataFrameWriter calls, so output is written in
parallel by every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from nimbusframe.functions.nested import has_attribute, parsed_item, scalar_attribute, unmarshal


def read_documents(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = True, corrupt: str | None = None
) -> DataFrame:
    """Nested JSON documents. ``multiline=True`` reads one object, or one
    array of objects, per file (the export format; a file is one task's work);
    ``False`` reads JSON Lines, which splits across tasks - prefer it for large
    exports. Give ``schema`` to skip inference.

    Parsing is permissive: what is no JSON, or does not fit the schema, is a row
    of nulls. With ``corrupt`` such a row has its text in a column of that name
    (null in all others), for :func:`split_corrupt`; it needs a ``schema``."""
    r = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    if corrupt is not None:
        if schema is None:
            raise ValueError("corrupt needs a schema")
        kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        r = r.option("columnNameOfCorruptRecord", corrupt)
        schema = StructType([*kinds.fields, StructField(corrupt, StringType())])
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def split_corrupt(documents: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """(documents without the column, texts of the corrupt ones as ``record``)."""
    # Spark reads that column only together with others, so the condition names them.
    seen = F.size(F.array(*[F.col(c).isNull() for c in documents.columns if c != corrupt])) > 0
    bad = documents.where(F.col(corrupt).isNotNull() & seen).select(F.col(corrupt).alias("record"))
    return documents.where(F.col(corrupt).isNull()).drop(corrupt), bad


def write_document_files(documents: DataFrame, path: str, docs_per_file: int = 10_000, file_bytes: int = 16 << 20) -> None:
    """Documents as multi-line files, each an indented JSON array of about
    ``docs_per_file`` objects, or of ``file_bytes`` of text if that is less (one
    object at least): a reader holds all objects of such a file at once. The files
    are written in parallel, document by document, compressed. Documents are dealt
    by a hash of their text; equal documents share a file."""
    text = documents.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("doc"))
    docs, size = text.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("doc")), F.lit(0))).first()
    files = max(1, -(-docs // docs_per_file), -(-size // file_bytes))
    # a task is a file: an aggregation would hold the texts of all files of a task
    dealt = text.withColumn("file", F.pmod(F.xxhash64("doc"), F.lit(files)).cast("int")).repartitionById(files, F.col("file"))
    place = Window.partitionBy("file").orderBy("file")
    first, last = F.lag("file").over(place).isNull(), F.lead("file").over(place).isNull()
    line = F.concat(F.when(first, "[\n").otherwise(""), "doc", F.when(last, "\n]").otherwise(","))
    dealt.select(line.alias("value")).write.text(path, compression="gzip")


def inline_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: StructType | str) -> DataFrame:
    """Rows given inline (seed data, ``VALUES``)."""
    return spark.createDataFrame(list(rows), schema=schema)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """S3: scan a relational table over JDBC, split into ``num_partitions``
    range reads on ``partition_column`` so every task reads its own slice.
    Parquet paths (``url`` starting with ``file:`` or a plain path) are read
    directly - used in tests, where no database is reachable."""
    if not url.startswith("jdbc:"):
        return spark.read.parquet(url if table in ("", None) else f"{url.rstrip('/')}/{table}.parquet")
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return r.load()


def read_items(spark: SparkSession, path: str, attributes: dict[str, str] | None = None) -> DataFrame:
    """Full scan of a key-value table export (JSON Lines, one item per line
    in wire form ``{"Item": {"Grade": {"N": "85"}, ...}}`` or the bare item).

    Items are unmarshalled (F19) into a ``map<string,string>``; with
    ``attributes={"Grade": "int", ...}`` those become typed columns. A scalar
    attribute is read from the parsed item by its name; only where it is none is
    it looked up in the map, and only a query that uses the map converts items."""
    raw = spark.read.text(path)
    body = F.coalesce(F.get_json_object("value", "$.Item"), F.col("value"))
    items = raw.select(body.alias("body"))
    if not attributes:
        return items.select(unmarshal("body").alias("item"))
    # A row of its own for each parsed item: a filter on an attribute is not moved below, where it would parse the item again.
    items = items.select("body", F.explode(F.array(parsed_item("body"))).alias("parsed"))
    item, whole = F.col("parsed"), unmarshal("body")
    read = {a: F.coalesce(scalar_attribute(item, a), F.when(has_attribute(item, a), whole.getItem(a))) for a in attributes}
    return items.select(*[read[a].try_cast(t).alias(a) for a, t in attributes.items()], whole.alias("item"))


def read_changes(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """Change-record stream (file source; the same code takes ``kafka`` on
    a cluster). ``maxFilesPerTrigger`` bounds one micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log text source, one row per line with its file, the file's
    modification time, where in the file its split starts, and ``pos``, which
    orders the lines of one split."""
    meta = F.col("_metadata")
    return spark.read.text(path).select(
        F.input_file_name().alias("file"), meta["file_modification_time"].alias("file_time"),
        meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line")
    )


def find_lines(df: DataFrame, text: str, limit: int | None = None, newest_first: bool = False,
               stamp: str | None = None) -> DataFrame:
    """Lines containing ``text``; ``limit`` keeps the first (or newest) N -
    the limit is the feature here (``grep -m`` / ``tail``). Lines are in the
    order of ``stamp``, a regular expression whose match in the line sorts by
    time as text, if given; then of the files' modification times, the files'
    names and the place in the file. Without a limit and ``newest_first`` no
    order is asked for, and nothing is sorted."""
    out = df.where(F.col("line").contains(text))
    if not limit and not newest_first:
        return out
    by = ([F.regexp_extract("line", stamp, 0)] if stamp else []) + [F.col(c) for c in ("file_time", "file", "block", "pos")]
    out = out.orderBy(*[c.desc() if newest_first else c.asc() for c in by])
    return out.limit(limit) if limit else out


VERSION_LISTING_SCHEMA = (
    "Versions array<struct<Key: string, VersionId: string, IsLatest: boolean, LastModified: timestamp, Size: bigint>>, "
    "DeleteMarkers array<struct<Key: string, VersionId: string, IsLatest: boolean, LastModified: timestamp>>"
)


def object_versions(listing: DataFrame) -> DataFrame:
    """Versions and delete markers of a listing as one table
    ``key, version_id, last_modified, is_latest, size, is_delete_marker``."""
    v = listing.select(F.inline("Versions")).select(
        F.col("Key").alias("key"), F.col("VersionId").alias("version_id"), F.col("LastModified").alias("last_modified"),
        F.col("IsLatest").alias("is_latest"), F.col("Size").alias("size"), F.lit(False).alias("is_delete_marker"),
    )
    d = listing.select(F.inline("DeleteMarkers")).select(
        F.col("Key").alias("key"), F.col("VersionId").alias("version_id"), F.col("LastModified").alias("last_modified"),
        F.col("IsLatest").alias("is_latest"), F.lit(None).cast("bigint").alias("size"), F.lit(True).alias("is_delete_marker"),
    )
    return v.unionByName(d)


def read_object_versions(spark: SparkSession, path: str) -> DataFrame:
    """Read version listings (one JSON object per file) into one table."""
    return object_versions(read_documents(spark, path, VERSION_LISTING_SCHEMA))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and every field quoted (the export quotes numbers too)."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).csv(path)


def export_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Dump a table (parquet, optionally partitioned for pruning on restore)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def restore_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a dump back."""
    return spark.read.parquet(path)


def write_notifications(df: DataFrame, path: str, mode: str = "append") -> None:
    """Notification sink (subject, message) as JSON Lines. For a stream use
    :func:`nimbusframe.streaming.streams.notifications_sink`."""
    df.select("subject", "message").write.mode(mode).json(path)


def append_history(df: DataFrame, path: str, stamp_col: str = "logged_at", now: object = None) -> None:
    """Append stamped lines to a history (text)."""
    from nimbusframe.functions.scalars import iso_timestamp, now_or

    line = F.concat_ws(" ", iso_timestamp(now_or(now)), F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    df.select(line.alias("value")).write.mode("append").text(path)


def save_table(
    df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None,
    buckets: int | None = None, bucket_by: Sequence[str] = (),
) -> None:
    """Create a table from a query. ``mode='ignore'`` = create if absent;
    ``'overwrite'`` = replace. With ``path`` the table is external (shared storage).

    With ``buckets`` rows are dealt to that many buckets by ``bucket_by`` and
    sorted in them: tables bucketed alike join and group on these columns
    without an exchange. Rows are shuffled to their buckets first, so there is
    one file a bucket, and a join need not sort it again."""
    if buckets:
        df = df.repartition(buckets, *bucket_by)
    w = df.write.mode(mode).format("parquet")
    if buckets:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], distinct: int | None = None, row_group: int = 128 << 20) -> None:
    """A layout for lookups by key (P4, J8): rows range-partitioned and sorted
    by ``keys``, so that row-group statistics tell most of them apart, and a
    Parquet Bloom filter on every key for keys that lie between others or are
    not the first. ``distinct`` is how many values of a key a row group holds at
    most (default: a million). Spark prunes by both when it reads the files."""
    w = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("parquet.block.size", row_group)
    for k in keys:
        w = w.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.bloom.filter.expected.ndv#{k}", distinct or 1_000_000)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a (temporary) view; returns the frame for chaining."""
    df.createOrReplaceTempView(name)
    return df


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table (or view) if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.dropTempView(name)
