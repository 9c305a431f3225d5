"""Near-duplicate documents by Order MinHash.

A text is a sequence of occurrence-labelled shingles of five words. Each of
several hash functions picks the few shingles with the smallest values and
keeps them in text order; texts that share such a tuple are candidates. They
are verified by a banded alignment of their shingle sequences.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import (
    WORD_PATTERN, both_ways, checkpointed, chunks, cleaned, column, components, give_back, tidy, words
)

#: Words in a shingle and the least similarity of near duplicates (fixed by the task).
SHINGLE, SIMILAR = 5, 0.8
#: Sketches of a text, and shingles in each. Two texts that share 0.8 of their
#: shingles agree in one sketch with probability 0.8 ** 4 = 0.41, and in none
#: of 24 with 0.000003.
SKETCHES, PICKED = 24, 4
#: Texts of one tuple that are compared with each other outright, as pairs. A
#: larger group meets in blocks, where pairs that are connected by others, or
#: have too few shingles in common by a bound that is never below their number,
#: are left out.
CROWD = 4
#: Cells in which the shingles of a text are counted for that bound, and the
#: greatest count; a cell that is full in both texts bounds nothing.
CELLS, FULL = 1024, 255
#: Shares that the rows of one label are dealt to.
SALTS = 16
#: Times that the texts of a tuple that are not connected yet meet around a new
#: centre before they are compared in pairs.
ROUNDS = 4
#: Texts, and shingles, in a block of a larger group, which is worked on block
#: against block; a task holds two blocks.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
#: Characters of texts worked on at once, and words a task remembers.
CHUNK, REMEMBERED = 4_000_000, 150_000

_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """64-bit hashes of words, kept when first asked for."""

    def __missing__(self, word: str) -> int:
        got = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = got
        return got


_HASHES = _Words()


def forget() -> None:
    """Empty the remembered words."""
    _HASHES.clear()


def hashed_words(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word of a text."""
    split = words(text)
    return np.fromiter(map(_HASHES.__getitem__, split), dtype=np.uint64, count=len(split))


def shingles(h: np.ndarray) -> np.ndarray:
    """A hash of every five words in a row; of all words of a shorter text."""
    size = min(SHINGLE, len(h))
    if not size:
        return h[:0]
    x = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for k in range(size):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def labelled(x: np.ndarray) -> np.ndarray:
    """Shingles made distinct by how often each came before."""
    order = np.argsort(x, kind="stable")
    sorted_ = x[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(x) else order
    nth = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    out = x.copy()
    out[order] += nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return out


def sketches(x: np.ndarray) -> np.ndarray:
    """For each hash function a hash of the ``PICKED`` shingles with the
    smallest values, in text order (all of them if there are fewer)."""
    x = labelled(x)
    at_once = SKETCHES if len(x) < 50_000 else 1
    out = []
    for j in range(0, SKETCHES, at_once):
        by = _MULTIPLIERS[j : j + at_once, None]
        if len(x) > PICKED:
            value = x[None, :] * by
            value ^= value >> np.uint64(32)
            value *= np.uint64(0xD6E8FEB86659FD93)
            picked = x[np.sort(np.argpartition(value, PICKED - 1, axis=1)[:, :PICKED], axis=1)]
        else:
            picked = np.repeat(x[None, :], len(by), axis=0)
        total = by[:, 0]
        for k in range(picked.shape[1]):
            total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + picked[:, k]
        out.append(total)
    return np.concatenate(out)


def short_tuples(x: np.ndarray) -> np.ndarray:
    """A hash of all shingles of a text of ``PICKED``, and of those of a text of
    one more without each one in turn, so that similar texts of these two sizes
    always share one; none for other sizes, which are never similar to a text
    of another size below (fewer) or are found by :func:`sketches` (more)."""
    if len(x) == PICKED:
        parts = [x]
    elif len(x) == PICKED + 1:
        parts = [np.delete(x, i) for i in range(len(x))]
    else:
        return x[:0]
    total = np.full(len(parts), SKETCHES, dtype=np.uint64)
    for column_ in np.stack([labelled(y) for y in parts]).T:
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + column_
    return np.unique(total)


def counted(x: np.ndarray) -> np.ndarray:
    """How many of a text's shingles fall in each of ``CELLS`` cells, a byte each."""
    cells = np.bincount((x >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS)
    return np.minimum(cells, FULL).astype(np.uint8)


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence whose matches lie within
    ``band`` of the diagonal: the rows of the table are bit strings (a zero bit
    is a step up), cut to a window of ``2 * band + 1`` that moves along."""
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    crowded = max(64, len(a) // 256)
    masks = {x: sum(1 << i for i in at) for x, at in places.items() if len(at) > crowded}
    width = 2 * band + 1
    full = (1 << width) - 1
    row, steps = full, 0
    for j, x in enumerate(b):
        low = j - band
        if j:
            steps += 1 - (row & 1)
            row = (row >> 1) | (1 << (width - 1))
        if x in masks:
            here = masks[x]
            match = (here >> low if low >= 0 else here << -low) & full
        else:
            match = 0
            for i in places.get(x, ()):
                if 0 <= i - low < width:
                    match |= 1 << (i - low)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return steps + width - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Aligned shingles of two texts over all their shingles: ``c / (n + m -
    c)`` for a longest common subsequence of ``c``; 0.0 if it is below
    ``least``. Exact at and above ``least``: fewer shingles then stay out of
    the alignment than the band is wide."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1]) if rest else differ[:0]
    tail = (int(differ[0]) if len(differ) else rest) if rest else 0
    x, y = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    common = head + tail
    if x and y and common + min(len(x), len(y)) >= need:
        if common + (Counter(x) & Counter(y)).total() < need:
            return 0.0
        common += aligned(x, y, n + m - 2 * need)
    return common / (n + m - common) if common >= need else 0.0


def sketch_texts(docs: DataFrame) -> DataFrame:
    """``docs`` has ``text`` (not null); adds ``digest`` (16 bytes, of the
    text), ``n`` (shingles), ``sketch`` (array of long, empty without words; of
    a short text :func:`short_tuples` follow) and drops the text."""
    at = docs.columns.index("text")
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in chunks([len(x) for x in texts], CHUNK):
                nodes, sizes, found = [], [], []
                for x in texts[lo:hi]:
                    s = shingles(hashed_words(x))
                    nodes.append(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest())
                    sizes.append(len(s))
                    found.append(np.append(sketches(s), short_tuples(s)).view(np.int64) if len(s) else s.view(np.int64))
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(part.num_columns) if i != at),
                        pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found))),
                    ], names=[*rest, "digest", "n", "sketch"],
                )

    schema = docs.select(*rest).limit(0).withColumn("digest", F.lit(b"")).withColumn("n", F.lit(0))
    return docs.mapInArrow(tidy(run, forget), schema.withColumn("sketch", F.lit(None).cast("array<long>")).schema)


def texts_of(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``pairs``, each once. A node's text is read
    from its row of the smallest id, so that copies stay where they are."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked = nodes.select("node", F.col("digest").alias("_n"), F.col("id").alias("_i")).join(asked, "node")
    named = rows.where("text IS NOT NULL").withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    own = named.join(asked.hint("merge"), (F.col("digest") == F.col("_n")) & F.col("id").eqNullSafe(F.col("_i")))
    return checkpointed(own.dropDuplicates(["_n", "_i"]).select("node", "text"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar. ``texts`` has (node,
    text), one row a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[int, np.ndarray] = {}  # the node at which a star meets its leaves
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("left"), batch.column("right")
            keep = []
            for i, (u, v) in enumerate(zip(a, b, strict=True)):
                if v not in remembered:
                    remembered.clear()
                    remembered[v] = shingles(hashed_words(right[i].as_py()))
                if similarity(shingles(hashed_words(left[i].as_py())), remembered[v]):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(tidy(run, forget), "a long, b long")


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent.setdefault(parent[x], parent[x])
    return x


def _linked(table: pa.Table) -> pa.Table:
    """Links within one pair of blocks of a tuple's texts that connect what is
    similar there. Candidates are pairs that are not connected, of fitting
    length, that have this as their first tuple, and that may have enough
    shingles in common by their counts in CELLS cells."""
    j, lo, hi = (table.column(c)[0].as_py() for c in ("j", "lo", "hi"))
    table = table.sort_by("node")
    node, n, c, block = (table.column(x).to_numpy() for x in ("node", "n", "c", "block"))
    sketch = np.array([x[:SKETCHES] for x in table.column("sketch").to_pylist()], dtype=np.int64).reshape(len(node), SKETCHES)
    texts = [shingles(hashed_words(x)) for x in table.column("text").to_pylist()]
    cells = np.stack([counted(x) for x in texts])
    first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    parent: dict[int, int] = {}
    links = []
    for i in range(0, len(first), 64):
        a, b = first[i : i + 64], second
        open_ = np.minimum.outer(n[a], n[b]) >= np.maximum.outer(n[a], n[b]) * SIMILAR
        open_ &= c[a][:, None] != c[b][None, :]
        if lo == hi:
            open_ &= node[a][:, None] > node[b][None, :]
        if j == SKETCHES:  # texts of one size here are similar only if all their sketches agree
            open_ &= n[a][:, None] != n[b][None, :]
        for k in range(j):
            open_ &= sketch[a, k][:, None] != sketch[b, k][None, :]
        u, v = np.nonzero(open_)
        u, v = a[u], b[v]
        for k in range(0, len(u), 1 << 12):
            x, y = u[k : k + (1 << 12)], v[k : k + (1 << 12)]
            both = np.minimum(cells[x], cells[y])
            need = np.ceil(SIMILAR * (n[x].astype(np.int64) + n[y]) / (1 + SIMILAR) - 1e-9)
            keep = (both.sum(axis=1, dtype=np.int64) >= need) | (both == FULL).any(axis=1)
            for p, q in zip(x[keep].tolist(), y[keep].tolist(), strict=True):
                left, right = _root(parent, int(c[p])), _root(parent, int(c[q]))
                if left != right and similarity(texts[p], texts[q]):
                    parent[left] = right
                    links.append((max(int(node[p]), int(node[q])), min(int(node[p]), int(node[q]))))
    if len(node) > BLOCK:
        forget()
        give_back()
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def link_texts(nodes: DataFrame, rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between similar texts that connect every pair of similar
    texts, if not each directly. ``nodes`` has (node, digest, n, id, sketch), one row a
    node, ``rows`` has (id, text).

    First every text is compared with one text of each of its tuples, the
    one of the smallest node; near copies are thereby linked in a star without pairs. Then
    the tuples whose texts do not all hang on one node are worked through: in
    a few rounds large ones meet around a new centre, which connects copies
    that are too far from the first, and then texts on different nodes are
    compared with each other. One shared tuple makes a pair a candidate in groups
    of any size. In tuples of more than ``crowd`` texts these meet block against
    block: a text is sent once for each pair of blocks, pairs that other links
    of the block connect are left out, and only the links that connect come back.
    """
    tuples = checkpointed(nodes.select("node", "n", F.posexplode("sketch").alias("j", "h")))
    tuples = tuples.withColumn("j", F.least("j", F.lit(SKETCHES)))  # tuples of short texts are one kind
    shared = tuples.withColumn("jh", F.xxhash64("j", "h")).groupBy("j", "h", "jh").agg(
        F.min("node").alias("b"), F.max("node").alias("top")
    ).where(F.col("b") != F.col("top"))
    star = (
        tuples.join(shared.select("j", "h", "b").hint("merge"), ["j", "h"])
        .where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct()
    )
    star = checkpointed(star)
    links = checkpointed(verified(star, texts_of(star, nodes, rows)))
    cleaned(nodes.sparkSession)
    # One step is enough here: near copies hang on the smallest node they share a
    # tuple with. Where it is not, more pairs are compared, none fewer.
    labels = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("c"))
    placed = tuples.join(shared.select("j", "h").hint("merge"), ["j", "h"]).join(labels.hint("merge"), "node", "left")
    placed = placed.withColumn("c", F.coalesce("c", "node")).withColumn("key", F.xxhash64("j", "h"))
    placed = checkpointed(placed.select("key", "j", "node", "n", "c"))
    del tuples, shared, labels
    cleaned(nodes.sparkSession)  # often, so that the driver's heap need not grow over plans that are done with
    seen, kept = star, None
    for again in range(ROUNDS + 1):
        # Tuples whose texts hang on more than one node, and of each a centre on the last of these.
        mixed = placed.groupBy("key").agg(
            F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"),
            F.max(F.struct("c", "node")).alias("centre"),
        ).where(F.col("low") != F.col("high"))
        open_ = checkpointed(placed.join(mixed.select("key", "size", "weight", "centre").hint("merge"), "key"))
        del mixed
        cleaned(nodes.sparkSession)
        if again == ROUNDS:
            break
        if kept is None:  # all later comparisons are among these texts
            kept = texts_of(open_.select(F.col("node").alias("a"), F.col("node").alias("b")), nodes, rows)
        ring = open_.where((F.col("c") != F.col("centre.c")) & (F.col("size") > crowd)).select(
            F.greatest("node", "centre.node").alias("a"), F.least("node", "centre.node").alias("b")
        )
        ring = checkpointed(ring.distinct().join(seen, ["a", "b"], "left_anti"))
        seen = seen.unionByName(ring)
        more = checkpointed(verified(ring, kept))
        links = links.unionByName(more)
        cleaned(nodes.sparkSession)
        # What hangs on linked nodes hangs on the smallest within two steps.
        # Labels are few: copies of them keep the plan of the large rows, which holds every step twice, short.
        own = open_.select("node", "c").distinct()
        ends = more.join(own.select(F.col("node").alias("a"), F.col("c").alias("l")), "a").join(
            own.select(F.col("node").alias("b"), F.col("c").alias("r")), "b"
        )
        ends = checkpointed(both_ways(ends, "l", "r").distinct())
        one = ends.groupBy("l").agg(F.least(F.min("r"), "l").alias("m"))
        two = ends.join(one.withColumnRenamed("l", "r"), "r").groupBy("l").agg(F.least(F.min("m"), "l").alias("m"))
        two = checkpointed(two)
        # A large component is one label; its rows are salted.
        two = two.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = open_.select("key", "j", "node", "n", "c", F.pmod(F.xxhash64("key", "node"), F.lit(SALTS)).cast("int").alias("s"))
        moved = salted.join(two.hint("merge"), (F.col("c") == F.col("l")) & (F.col("s") == F.col("salt")), "left")
        placed = moved.select("key", "j", "node", "n", F.coalesce("m", "c").alias("c"))
        del own, more, ends, one, two, salted, moved
    small = open_.where(F.col("size") <= crowd)
    x, y = (small.select("key", F.col("node").alias(v), F.col("n").alias(f"n{v}"), F.col("c").alias(f"c{v}")) for v in "ab")
    near = x.join(y, "key").where(
        (F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb"))
        & (F.least("na", "nb") >= F.greatest("na", "nb") * SIMILAR)
    ).select("a", "b")
    near = checkpointed(near.distinct().join(seen, ["a", "b"], "left_anti"))
    found = checkpointed(verified(near, kept))
    del small, x, y, near
    cleaned(nodes.sparkSession)
    large = open_.where(F.col("size") > crowd).join(nodes.select("node", "sketch").hint("merge"), "node")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    large = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "j", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "n", "c", "sketch"
    )
    met = large.join(kept.hint("merge"), "node").groupBy("key", "lo", "hi").applyInArrow(_linked, "a long, b long")
    return links.unionByName(found).unionByName(checkpointed(met))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, class_id, kept): one row per row of ``docs``; ``digest``
    is the MD5 of the text (null where the text is alone by rule).

    Texts are linked if ``c / (n + m - c)`` is 0.8 or more, for shingle
    sequences of ``n`` and ``m`` whose longest common subsequence is ``c``.
    Classes are the connected components of the links; equal texts are one
    node. ``class_id`` is the smallest doc_id of the class, ``kept`` whether it
    is the row's own.

    Null texts, and texts without a word, belong to no class but their own:
    the class is the row's id, and it is kept. A text of fewer than five words
    is one shingle. Null ids: the class is the smallest id that is not null;
    the row is kept only if all ids of its class are null. Repeated rows (same
    id and text) are kept or dropped alike. Extra columns do not matter. Empty
    in, empty out. ``doc_id`` must be an integer.

    One shared sketch makes a pair a candidate, whatever else shares its tuple.
    By the hypergeometric draw a similar pair shares one with probability
    0.99994 or more (the least: 5 shingles against 6, 9 against 9 with 8 in
    common; 0.999997 in long texts), and 4 shingles against 5 always do.
    Copies never form pairs: equal texts share a node, near copies meet in
    stars, and only texts of a tuple that hang on different nodes are compared. Texts are read three times and
    shuffled for the verification alone.
    """
    rows = docs.select(column(docs, doc_id).cast("long").alias("id"), column(docs, text).cast("string").alias("text"))
    sketched = checkpointed(sketch_texts(rows.where("text IS NOT NULL")))
    nodes = sketched.where("n > 0").groupBy("digest", "n").agg(
        F.min("id").alias("id"), F.first("sketch").alias("sketch")
    )
    # Numbers for the nodes: fixed by the copy in the checkpoint folder.
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    found = components(link_texts(nodes, rows))
    placed = nodes.select("node", "digest", "id").join(found.hint("merge"), "node", "left")
    placed = checkpointed(placed.select("digest", "id", F.coalesce("component", "node").alias("c")))
    least = placed.groupBy("c").agg(F.min("id").alias("class_id"))
    classes = placed.join(least, "c").select("digest", "class_id")
    done = sketched.where("n > 0").select("id", "digest").join(classes, "digest").select(
        "id", "digest", "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )
    alone = sketched.where("n = 0").select("id").unionByName(rows.where("text IS NULL").select("id"))
    nothing = F.lit(None).cast("binary").alias("digest")
    out = done.unionByName(alone.select("id", nothing, F.col("id").alias("class_id"), F.lit(True).alias("kept")))
    return out.select(F.col("id").alias(doc_id), "digest", "class_id", "kept")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: one of each class, that
    of the smallest id, and all rows whose text is null or has no word."""
    kept = near_duplicates(docs, doc_id, text).where("kept AND digest IS NOT NULL")
    kept = kept.select(column(kept, doc_id).alias("_i"), F.col("digest").alias("_n")).distinct()
    numbered = docs.select(*[column(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    d, t = (F.col(f"c{docs.columns.index(c)}") for c in (doc_id, text))
    worded = F.coalesce(t.rlike(WORD_PATTERN), F.lit(False))
    named = numbered.where(worded).withColumn("digest", F.unhex(F.md5(t.cast("binary"))))
    one = named.join(kept, (F.col("digest") == F.col("_n")) & d.cast("long").eqNullSafe(F.col("_i")))
    one = one.dropDuplicates(["_n", "_i"]).select(*numbered.columns)
    out = one.unionByName(numbered.where(~worded))
    return out.toDF(*docs.columns)
