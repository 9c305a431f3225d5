"""Session construction, table loading and the shared checkpoint folder.

The settings here are the ones every job in the library relies on:

* ``spark.sql.session.timeZone=UTC`` so timestamp text and windows do not
  depend on the machine zone.
* AQE on, with partition coalescing and skew-join splitting, so shuffle sizes
  follow the data at run time instead of a fixed ``shuffle.partitions``.
* The UI is off: no port beyond what the session itself needs.

On a cluster the caller passes its own builder/master; ``get_session`` only
fills in settings that are not already set.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # files of a checkpoint go with the last frame that reads them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "nimbusframe",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``shuffle_partitions`` is the starting point for AQE; on a cluster set it
    to 2-3x the total executor cores and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Starting settings for a large cluster run, from the expected shuffle
    volume (after pruning and partial aggregation - usually far below the
    input size) and the total executor cores.

    * initial shuffle partitions = shuffle bytes / ``partition_bytes``, at
      least 3 x cores; AQE coalesces from there to
      ``advisoryPartitionSizeInBytes`` and splits skewed partitions;
    * input splits of 512 MB, so a 100 TB scan is ~200k tasks, not millions;
    * a 64 MB broadcast limit: AQE converts a join only when the measured side
      is below it, and every side broadcast by hint has a proven row bound.

    Pass the result to ``get_session(conf=...)`` or ``spark-submit --conf``."""
    initial = max(3 * total_cores, math.ceil(shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system; it is
    read, never overridden. Only when it is unset and the master is local
    (tests) a fresh scratch folder is created and registered; on a cluster an
    unset folder is an error, since node-local files are not shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a folder all executors share"
            )
        configured = tempfile.mkdtemp(prefix="nimbus-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def split_code(spark: SparkSession) -> Iterator[None]:
    """Jobs that are run inside evaluate wide projections piece by piece: a
    generated method of more than 8,000 bytes, which the JVM would interpret
    for every row, is not used. The session's own setting is put back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 8000)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A copy of ``df`` in the checkpoint folder, read back. Unlike a checkpoint,
    which holds whole rows plain, it is compressed, and a query reads only the
    columns it uses; the lineage ends there likewise."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet file or folder of part files) lazily;
    column pruning and filter pushdown happen when the plan is optimised. The
    listing is read anew on each call, so a rewritten table is seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
