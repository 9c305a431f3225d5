"""Mixing sources to target weights by a low-discrepancy schedule, Spark SQL only.

Every source is cut into blocks of equal length, and its target is a number of
slots. Points of the golden-ratio sequence are mapped through the cumulative
slots of the sources; those that fall to a source are ranked and take, in turn,
the blocks of the source's shuffled documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import with_dense_id
from nimbusframe.llm.common import WORD_PATTERN, checkpointed, column

#: Weights of the sources in code-point order, repeating (fixed by the task).
WEIGHTS = (5, 2, 1)
#: No source is read more often than this (fixed by the task).
MAX_PASSES = 3
#: Blocks of a source, or as many as it has words.
BLOCKS = 1 << 14
#: Points of the sequence: i * GOLDEN modulo RING, the golden ratio's fraction in
#: whole numbers, so that every point is exact.
RING, GOLDEN = 1 << 48, 173961102589771
#: Points for each slot. Gaps between N points of the sequence are at most
#: 1.9 / N wide, so a source of k slots has k among twice as many.
SPARE = 2
#: Slots in one run, and sources in one chunk, of the two-level sums.
RUN = 4096


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, shuffle): words of each text (null: none) and the
    hash that fixes the document's place in its source's shuffled order."""
    d, t = column(docs, doc_id), column(docs, text)
    return docs.select(
        d.alias("doc_id"),
        column(docs, source).alias("source"),
        F.coalesce(F.regexp_count(t, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(d.cast("string"), F.lit(""))).alias("shuffle"),
    )


def _div(a: Column, b: Column) -> Column:
    """Whole division of numbers that are not negative."""
    return F.call_function("div", a, b)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """(source, place, source_size, target): how many words of each source the
    mix takes. Sources by code point, null last, weigh ``weights`` in turn and
    share the sum of all sizes; a target stops at ``passes`` times its source's
    size and the excess is shared by weight among the others until none is above.

    That is ``least(passes * size, level * weight)`` with one level for all,
    found in rounds: sources that are full below the level go out with what they
    hold, the rest share anew. A round is one aggregation over a row a source
    and sends two numbers to the driver; there are few, as each fills a source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = with_dense_id(by_source.withColumn("last", F.col("source").isNull()), "place", 0, ["last", "source"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)
    t = t.withColumn("weight", weight).withColumn("most", F.col("source_size") * passes)
    t = checkpointed(t.withColumn("fills", F.col("most").cast("double") / F.col("weight")))
    total = t.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level: float | None = 0.0
    while True:
        full = F.col("fills") < F.lit(level)
        held, open_ = t.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        new = (total - held) / open_ if open_ else None
        if new is None or new <= level:
            break
        level = new
    most = F.col("most").cast("double")
    target = most if new is None else F.least(most, F.lit(level) * F.col("weight"))
    return t.select("source", F.col("place").cast("long").alias("place"), "source_size", target.alias("target"))


def divided(shares: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``shares`` with ``blocks`` (of a source, each of ``source_size / blocks``
    words, one word at least) and ``slots`` (how many of them make its target).
    Sources without words have none."""
    s = shares.withColumn("blocks", F.least("source_size", F.lit(blocks).cast("long")))
    doubled = F.lit(2).cast("long") * F.round("target").cast("long") * F.col("blocks") + F.col("source_size")
    return s.withColumn("slots", F.when(F.col("source_size") > 0, _div(doubled, 2 * F.col("source_size"))).otherwise(F.lit(0)))


def schedule(parts: DataFrame, passes: int = MAX_PASSES, spare: int = SPARE) -> DataFrame:
    """(slot, place, rank, block, pass): which block each slot takes.

    ``parts`` is the result of :func:`divided`. Point ``i`` of the golden-ratio
    sequence falls to the source whose share of the cumulated slots holds it;
    there are ``spare`` points a slot, and a source takes the first of them
    that fall to it, as many as it has slots. Its ``r``-th slot takes block ``r
    mod blocks`` on pass ``r div blocks``."""
    spark = parts.sparkSession
    upto = Window.partitionBy("chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = parts.where("slots > 0").withColumn("chunk", _div(F.col("place"), F.lit(RUN)))
    # A row for every RUN sources.
    chunks = p.groupBy("chunk").agg(F.sum("slots").alias("n"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    total, sources = p.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    cells = 4096 + 4 * sources
    cell = lambda at: _div(at * F.lit(cells), F.lit(max(total, 1)))
    edges = p.join(chunks, "chunk").withColumn("hi", F.col("skip") + F.sum("slots").over(upto))
    edges = edges.withColumn("lo", F.col("hi") - F.col("slots"))
    edges = edges.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    edges = edges.select("cell", "place", "lo", "hi", "blocks", "slots")
    wide = lambda x: F.lit(x).cast("decimal(20,0)")
    ring = F.col("id").cast("decimal(18,0)") * wide(GOLDEN) % wide(RING)
    points = spark.range(spare * total).select(
        F.col("id").alias("slot"), _div(ring.cast("decimal(18,0)") * wide(total), wide(RING)).cast("long").alias("at")
    )
    near = points.withColumn("cell", cell(F.col("at"))).join(edges, "cell")
    near = near.where((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).withColumn("run", _div(F.col("slot"), F.lit(RUN)))
    per_run = near.groupBy("place", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    per_run = per_run.select("place", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    in_run = Window.partitionBy("place", "run").orderBy("slot")
    ranked = near.join(per_run, ["place", "run"]).withColumn("rank", F.col("skip") + F.row_number().over(in_run) - 1)
    return ranked.where((F.col("rank") < F.col("slots")) & (F.col("rank") < F.col("blocks") * passes)).select(
        "slot", "place", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
        _div(F.col("rank"), F.col("blocks")).cast("int").alias("pass"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    passes: int = MAX_PASSES,
    blocks: int = BLOCKS,
) -> DataFrame:
    """How many words the mix takes of each document.

    Returns one row per row of ``docs``: ``doc_id, source, size, source_size,
    target, taken``; ``taken`` counts repeats, at most ``passes`` times the
    size. A source's documents stand in the order of the MD5 of their id (then
    id, size) as one stream of words, cut into ``blocks`` blocks of equal length
    (of one word if it has fewer); :func:`schedule` says how often each block is
    taken, and a document gets its words in each block times that number. Every
    source has its own number of slots, so it comes within half a block of its
    target, a small one to the word, at any size of the corpus.

    Null source is a source of its own, the last. Null and empty texts have
    size 0 and take nothing, and so do all when there are no words. Rows equal
    in id, source and size may swap their places, which gives the same rows.
    Extra columns do not matter. The same input gives the same result on every
    run and any partitioning. Empty in, empty out.

    At scale: texts of any length are read once and never shuffled; the sized
    rows (id, source, size, hash) are written to the checkpoint folder. Prefix
    sums are made in two levels, over 4096 hash ranges of a source and then
    within one, so a hot source is split. A few sums come to the driver.
    """
    sized = checkpointed(
        sizes(docs, doc_id, text, source).withColumn("range", F.conv(F.substring("shuffle", 1, 3), 16, 10).cast("int"))
    )
    parts = checkpointed(divided(targets(sized, weights, passes), blocks))
    placed = sized.withColumnRenamed("source", "src").join(
        parts, F.col("src").eqNullSafe(F.col("source"))
    ).select("doc_id", "source", "size", "source_size", "target", "place", "blocks", "range", "shuffle")
    per_range = placed.groupBy("place", "range").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.select("place", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    inside = (
        Window.partitionBy("place", "range")
        .orderBy("shuffle", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    streamed = placed.join(per_range, ["place", "range"]).withColumn(
        "start", F.col("skip") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    full = streamed.where("size > 0").withColumn("end", F.col("start") + F.col("size"))
    holding = lambda word: _div((word + 1) * F.col("blocks") - 1, F.col("source_size"))
    edge = lambda block: _div(block * F.col("source_size"), F.col("blocks"))
    pieces = full.withColumn("block", F.explode(F.sequence(holding(F.col("start")), holding(F.col("end") - 1))))
    pieces = pieces.withColumn("words", F.least("end", edge(F.col("block") + 1)) - F.greatest("start", edge(F.col("block"))))
    times = schedule(parts, passes).groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))
    own = ["doc_id", "source", "size", "source_size", "target"]
    taken = (
        pieces.join(times, ["place", "block"], "left")
        .groupBy("place", "start", *own)
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    )
    return taken.select(*own, "taken").unionByName(streamed.where("size = 0").select(*own, F.lit(0).cast("long").alias("taken")))


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix as documents: the columns of ``docs``, each row as many times as
    the mix takes it, rounded to whole documents (not at all: the row goes).

    Rows equal in id, source and size share what was taken of them evenly.
    Nulls, ties, long texts and empty tables are as in :func:`mix`; columns may
    have any names, and pass through. Texts are shuffled once, with their rows;
    the number of copies is joined by id, source and size."""
    taken = mix(docs, doc_id, text, source, **options)
    taken = taken.where("size > 0").groupBy("doc_id", "source", "size").agg(F.avg("taken").alias("taken"))
    taken = taken.select(
        F.col("doc_id").alias("id"), F.col("source").alias("src"), F.col("size").alias("n"),
        F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("times"),
    ).where("times > 0")
    # The columns go under names of their own, by their places.
    at = {c: f"c{docs.columns.index(c)}" for c in (doc_id, text, source)}
    rows = docs.select(*[column(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    size = F.coalesce(F.regexp_count(F.col(at[text]), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    joined = rows.withColumn("size", size).join(
        taken,
        F.col(at[doc_id]).eqNullSafe(F.col("id")) & F.col(at[source]).eqNullSafe(F.col("src")) & (F.col("size") == F.col("n")),
    )
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return copies.select(*rows.columns).toDF(*docs.columns)
