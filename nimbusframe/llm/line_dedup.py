"""Line dedup by overlapping three-line windows, Spark SQL functions only.

Windows of three consecutive lines are hashed, windows found more than once
are looked up over all documents, and every occurrence but the first is
removed; overlapping windows merge into one covered range of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import WORD_PATTERN, column, free_name

#: Lines in a window: the method's number.
WINDOW = 3
#: Spaces that do not count at the ends of a line (tab, CR, VT, FF).
EDGE = " \t\r\x0b\x0c"


def _line_hashes(lines: Column, size: int) -> Column:
    """Array of (position, two 64-bit hashes) of the lines that have a word."""
    marked = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(EDGE)).alias("x"))),
        lambda e: e["x"] != "",
    )
    hashed = F.transform(
        marked,
        lambda e: F.struct(
            e["at"].alias("at"), F.xxhash64(e["x"]).alias("a"), F.xxhash64(F.lit(size), e["x"]).alias("b")
        ),
    )
    return hashed


def line_windows(docs: DataFrame, keys: list[str], lines: str = "lines", size: int = WINDOW) -> DataFrame:
    """One row per window: ``keys``, ``lo`` and ``hi`` (its first and last line,
    0-based) and the 128-bit hash ``wa``, ``wb`` of its lines."""
    part = docs.select(*keys, _line_hashes(F.col(lines), size).alias("h")).where(F.size("h") >= size)
    step = F.transform(
        F.sequence(F.lit(0), F.size("h") - size),
        lambda i: F.struct(
            F.get("h", i)["at"].alias("lo"),
            F.get("h", i + (size - 1))["at"].alias("hi"),
            F.xxhash64(*[F.get("h", i + k)["a"] for k in range(size)]).alias("wa"),
            F.xxhash64(*[F.get("h", i + k)["b"] for k in range(size)]).alias("wb"),
        ),
    )
    return part.select(*keys, F.inline(step))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Remove repeated passages of lines; returns the columns of ``docs`` with
    the text mended, plus ``n_lines`` and ``n_removed``.

    Lines are cut at ``\\n``. Lines without a word join no window. A window is
    ``size`` consecutive other lines of one document, compared without the
    white space at their ends by a 128-bit hash. The first occurrence in order
    of (doc_id, nulls last; hash of the text; line) stays; at every later one
    the lines from the window's first to its last (blank lines between them
    included) are removed. Within one document too, so of a run of equal lines
    the first remains.

    Null text stays null with zero lines; an empty text is one line without a
    word. Documents with fewer than ``size`` lines that count lose nothing.
    Rows equal in doc_id and text are judged alike: both keep what the first
    occurrence keeps. Extra columns pass through; a clash of ``n_lines`` or
    ``n_removed`` gets an underscore before the new name. Empty in, empty out.

    At scale: texts cross one shuffle (the join back); windows cross as four
    numbers and the key. The repeat table is a partial aggregate, so a hot
    window is one row per task; its join back can be split by adaptive
    execution. Lists exist per document only.
    """
    d, t = column(docs, doc_id), column(docs, text)
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    key = docs.select(
        d.alias("id"), F.xxhash64(t).alias("ta"), F.xxhash64(F.lit(size), t).alias("tb"),
        F.split(t, "\n", -1).alias("lines"),
    )
    where = F.struct(
        F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"), F.col("ta"), F.col("tb"), F.col("lo")
    )
    found = line_windows(key, ["id", "ta", "tb"], size=size).withColumn("place", where)
    repeats = (
        found.withColumn("mix", F.col("wa").bitwiseXOR(F.col("wb")))
        .groupBy("wa", "wb", "mix")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("wa", "wb", "first")
    )
    later = found.join(repeats, ["wa", "wb"]).where(F.col("place") > F.col("first"))
    # Covered ranges of a document, in order: a range starts where the one
    # before it ends earlier, and ends where the next starts later.
    spans = later.groupBy("id", "ta", "tb").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("w"))
    count = F.size("w")
    starts = F.filter("w", lambda e, i: (i == 0) | (e["lo"] > F.get("w", i - 1)["hi"] + 1))
    ends = F.filter("w", lambda e, i: (i == count - 1) | (F.get("w", i + 1)["lo"] > e["hi"] + 1))
    spans = spans.select(
        F.col("id").alias("_id"), F.col("ta").alias("_ta"), F.col("tb").alias("_tb"),
        F.transform(starts, lambda e: e["lo"]).alias("_lo"), F.transform(ends, lambda e: e["hi"]).alias("_hi"),
    )
    mine = docs.select(*[column(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    body = F.col(at[text])
    mine = mine.withColumn("ka", F.xxhash64(body)).withColumn("kb", F.xxhash64(F.lit(size), body))
    joined = mine.join(
        spans,
        F.col(at[doc_id]).eqNullSafe(F.col("_id"))
        & (F.col("ka") == F.col("_ta"))
        & (F.col("kb") == F.col("_tb")),
        "left",
    ).withColumn("_lines", F.split(body, "\n", -1))
    n = F.size("_lo")
    total = F.size("_lines")
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n),
            lambda k: F.slice(
                "_lines",
                F.when(k == 0, F.lit(1)).otherwise(F.get("_hi", k - 1) + 2),
                F.when(k == n, total).otherwise(F.get("_lo", k))
                - F.when(k == 0, F.lit(0)).otherwise(F.get("_hi", k - 1) + 1),
            ),
        )
    )
    gone = F.aggregate(F.zip_with("_lo", "_hi", lambda a, b: b - a + 1), F.lit(0), lambda s, x: s + x)
    return joined.select(
        *[
            F.when(F.col("_lo").isNull(), F.col(at[c])).otherwise(F.array_join(kept, "\n")).alias(c)
            if c == text
            else F.col(at[c]).alias(c)
            for c in docs.columns
        ],
        F.when(body.isNull(), F.lit(0)).otherwise(total).cast("long").alias(n_lines),
        F.when(F.col("_lo").isNull(), F.lit(0)).otherwise(gone).cast("long").alias(n_removed),
    )


def mended_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The columns of ``docs`` with repeated passages of lines removed. Rows
    that lose all their words go; ``n_chars``, if there is such a column, is
    counted anew for texts that lost lines."""
    mended = dedup_lines(docs, text=text, **options)
    cut = column(mended, mended.columns[-1]) > 0
    left = mended.where(~cut | column(mended, text).rlike(WORD_PATTERN))
    return left.select(
        *[
            F.when(cut, F.length(column(mended, text)).cast("long")).otherwise(column(mended, c)).alias(c)
            if c == n_chars
            else column(mended, c)
            for c in docs.columns
        ]
    )
