"""Helpers shared by the operators: words, Arrow chunks, connected components."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusframe.session import ensure_checkpoint_dir

#: A word is a longest run of characters other than space and the five ASCII
#: white-space controls (code points 9 to 13).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_WORD = re.compile(WORD_PATTERN)
#: White space for ``str.split`` that is part of a word here.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ODD_ASCII = ("\x1c", "\x1d", "\x1e", "\x1f")


def words(text: str | None) -> list[str]:
    """The words of a text; none for null."""
    if not text:
        return []
    odd = any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD_SPACE.search(text)
    return _WORD.findall(text) if odd else text.split()


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows ``[lo, hi)`` of about ``limit`` in total
    size (a single row may exceed it), so that arrays built for a run are bounded."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda _: None


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on for tasks
    of other stages and operators."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a partition that forgets what it has
    remembered, and gives memory back, when the partition ends. ``forget`` is a
    function of a module: a cache itself would travel as a copy."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            give_back()

    return wrapped


def column(df: DataFrame, name: str):
    """A column by its exact name, whatever characters the name has."""
    return df["`" + name.replace("`", "``") + "`"]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that does not clash with the columns of ``df``."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name = "_" + name
    return name


def with_computed(df: DataFrame, run: Callable[[Iterator], Iterator], added: dict[str, str]) -> DataFrame:
    """The columns of ``df`` and what ``run`` adds to them. It gets Arrow batches
    and yields batches of their columns and the new ones, in the order of
    ``added`` (name: type). Inside, columns have plain names, whatever theirs
    are; a clash gets an underscore before the new name. Batches are named by
    :func:`batch_of`."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = plain.limit(0)
    for i, kind in enumerate(added.values()):
        schema = schema.withColumn(f"x{i}", F.lit(None).cast(kind))
    out = plain.mapInArrow(run, schema.schema)
    return out.toDF(*df.columns, *[free_name(df, k) for k in added])


def batch_of(own: list, new: list) -> pa.RecordBatch:
    """A batch for :func:`with_computed`: given columns and new ones."""
    names = [*(f"c{i}" for i in range(len(own))), *(f"x{i}" for i in range(len(new)))]
    return pa.RecordBatch.from_arrays([*own, *new], names=names)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a copy in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cleaned(spark: SparkSession) -> None:
    """Let Spark drop what earlier steps of an iterative job left: shuffle files
    and checkpoints go when the driver's garbage collector finds that nothing
    refers to them, which a mostly idle driver is slow to do by itself."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def both_ways(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The columns ``a`` and ``b`` of ``pairs``, every row also turned round.
    Rows are read once: a union would plan and run all that comes before twice."""
    turned = F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)), F.struct(F.col(b).alias(a), F.col(a).alias(b)))
    return pairs.select(F.inline(turned))


def components(edges: DataFrame, a: str = "a", b: str = "b", salts: int = 8) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` links the values of two columns of one orderable type. Returns
    ``(node, component)`` for every node with an edge, but for the smallest of
    each component, which names it: ``component`` is the smallest node reachable. Each step is one partial
    aggregation and one equi-join whose hot nodes are salted; every step is
    written to the checkpoint folder, so that no plan holds another step's, and
    the driver only sees one number a round. Null ends and self links are ignored.
    """

    def lowest(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("u").agg(F.min("v").alias("low"))
        low = low.withColumn("low", F.least("low", "u"))
        spread = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(
            spread.hint("merge"), ["u", "s"]  # never gathered by the driver for a broadcast
        )

    linked = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    cur = edges.where(linked).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    cur = checkpointed(cur.distinct())
    while True:
        large = lowest(both_ways(cur, "u", "v")).where(F.col("v") > F.col("u"))
        large = checkpointed(large.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        # Both ends hang on the lowest now, which is below u, and may be v itself.
        small = lowest(large).select("low", F.explode(F.array("u", "v")).alias("u")).where(F.col("u") != F.col("low"))
        cur = checkpointed(small.select("u", F.col("low").alias("v")).distinct())
        # Done when every node hangs on one root: none has two rows, and no root hangs on another.
        ends = cur.select(
            F.inline(F.array(
                F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            ))
        )
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        open_ = ends.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).limit(1).count()
        del large, small, ends
        cleaned(cur.sparkSession)
        if not open_:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
