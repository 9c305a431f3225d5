"""Hard negatives by inner product, searched in cover trees.

Inner products become distances when every vector gets one more component that
lifts it to the length of the longest. Vectors are dealt to blocks around
centres that cover a sample, and every block is a cover tree: a node has a
centre, the radius that covers what hangs below it, and children whose radii
shrink level by level. An angle between an anchor and a centre then bounds the
inner products of a whole node from both sides. Search goes down best bound
first, leaves out nodes that lie outside the windows of scores it still needs,
and scores what is in the leaves exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusframe.llm.common import checkpointed, column

#: Positives of an anchor, negatives of a positive, and the window of a
#: negative's score in hundredths of the positive's (fixed by the task).
POSITIVES, NEGATIVES, WINDOW = 5, 5, (80, 100)
#: Components are scaled by this and rounded down (fixed by the task).
SCALE = 256
#: Vectors in a block (one tree, one task) and in a leaf, children of a node.
BLOCK, LEAF, CHILDREN = 8192, 512, 16
#: Centres of the top level, at most, and vectors of the sample for each.
MOST_CENTRES, SAMPLED = 1024, 8
#: Anchors that meet a block in one task.
CHUNK = 2048

_EXACT = float(1 << 53)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """``rows`` has ``id``, ``label``, ``anchor`` and ``v`` (array of double).
    Keeps rows with a label and a vector of finite components, as ``v`` (the
    rounded components, doubles as bytes; components beyond 2 ** 1015 stay as
    they are and are rounded when scored), ``width`` and ``square``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("v")
            values = col.values.to_numpy(zero_copy_only=False)  # nulls come as NaN
            ends = col.offsets.to_numpy()
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(values * SCALE)
            fine = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            ok = (fine[ends[1:]] == fine[ends[:-1]]) & col.is_valid().to_numpy(zero_copy_only=False)
            ok &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            vs, widths, squares = [], [], []
            for i in np.flatnonzero(ok).tolist():
                lo, hi = ends[i], ends[i + 1]
                x = whole[lo:hi]
                vs.append(x.tobytes() if np.isfinite(x).all() else b"*" + values[lo:hi].tobytes())
                widths.append(int(hi - lo))
                with np.errstate(over="ignore"):
                    squares.append(float(x @ x))
            keep = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays(
                [keep.column("id"), keep.column("label"), keep.column("anchor"), pa.array(vs, pa.binary()),
                 pa.array(widths, pa.int32()), pa.array(squares, pa.float64())],
                names=["id", "label", "anchor", "v", "width", "square"],
            )

    return rows.mapInArrow(run, "id long, label long, anchor boolean, v binary, width int, square double")


def _numbers(data: list[bytes], width: int) -> np.ndarray:
    """Vectors as a matrix: doubles where those are exact, else whole Python numbers."""
    if any(len(d) % 8 for d in data):
        return np.array([
            [int(c) * SCALE for c in np.frombuffer(d[1:])] if len(d) % 8 else [int(c) for c in np.frombuffer(d)] for d in data
        ], dtype=object).reshape(len(data), width)
    return np.frombuffer(b"".join(data)).reshape(len(data), width)


def _largest(x: np.ndarray) -> float:
    return float(min(max((abs(c) for c in x.ravel()), default=0), 1e300)) if x.dtype == object else float(np.abs(x).max(initial=0))


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that brings them to squared length ``top``."""
    rest = np.maximum(top - np.einsum("ij,ij->i", x, x), 0)
    return np.hstack([x, np.sqrt(rest)[:, None]])


def farthest_first(x: np.ndarray, most: int, radius: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres (rows of ``x``, the first row first, then always the row farthest
    from all so far) until all are within ``radius`` or there are ``most``;
    the centre of every row, and its distance."""
    centres, owner = [0], np.zeros(len(x), dtype=np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(centres) < most:
        k = int(far.argmax())
        if far[k] <= radius:
            break
        own = np.sqrt(((x - x[k]) ** 2).sum(1))
        nearer = own < far
        nearer[k] = True
        owner[nearer] = len(centres)
        far = np.minimum(far, own)
        centres.append(k)
    return np.array(centres), owner, far


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float, list[int]]]]:
    """(order, nodes) of a tree over the lifted vectors ``x``. A node is (from,
    to, covering radius, children): the rows ``order[from:to]`` hang below it and
    the first is its centre. Level by level the rows of a node are covered by
    centres within half its radius, the node's own centre among them, or by
    CHILDREN centres if that would take more; a centre stays the first of its
    rows on every level below."""
    order = np.arange(len(x))
    nodes = [(0, len(x), float(np.sqrt(((x - x[0]) ** 2).sum(1)).max()), [])]
    at = 0
    while at < len(nodes):
        lo, hi, radius, children = nodes[at]
        at += 1
        if hi - lo <= LEAF or radius == 0:
            continue
        rows = order[lo:hi]
        centres, owner, far = farthest_first(x[rows], CHILDREN, radius / 2)
        no_centre = np.ones(len(rows), dtype=bool)
        no_centre[centres] = False
        by = np.lexsort((no_centre, owner))
        order[lo:hi], owner, far = rows[by], owner[by], far[by]
        edges = (lo + np.searchsorted(owner, np.arange(len(centres) + 1))).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            children.append(len(nodes))
            nodes.append((a, b, float(far[a - lo : b - lo].max()), []))
    return order, nodes


class Block:
    """A block's vectors of one length, in the order of their tree."""

    def __init__(self, uids: np.ndarray, ids: list, labels: np.ndarray, x: np.ndarray):
        self.largest = _largest(x)
        self.top = 0.0
        order, self.nodes = np.arange(len(x)), [(0, len(x), np.inf, [])]
        if self._fits(x):
            self.top = float(np.einsum("ij,ij->i", x, x).max())
            order, self.nodes = cover_tree(lifted(x, self.top))
        self.x, self.uids, self.labels = x[order], uids[order], labels[order]
        self.ids = [ids[k] for k in order.tolist()]
        self.centres = np.array([n[0] for n in self.nodes])
        self.radius = np.array([n[2] for n in self.nodes])

    def _fits(self, other: np.ndarray) -> bool:
        """Whether inner products with vectors like ``other`` are exact in doubles."""
        if object in (other.dtype, getattr(self, "x", other).dtype):
            return False
        return _largest(other) * self.largest * max(other.shape[-1], 1) < _EXACT

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) inner product of every anchor with the rows of every node."""
        if not (self._fits(anchors) and self._fits(self.x)):
            shape = (len(anchors), len(self.nodes))
            return np.full(shape, -np.inf), np.full(shape, np.inf)
        scale = np.sqrt(np.einsum("ij,ij->i", anchors, anchors) * self.top)[:, None]
        angle = np.arccos(np.clip(anchors @ self.x[self.centres].T / np.where(scale > 0, scale, 1), -1, 1))
        # All lifted vectors have one length, so a radius is a chord.
        reach = 2 * np.arcsin(np.clip(self.radius / (2 * np.sqrt(self.top) if self.top else 1), 0, 1))
        slack = 1e-6 * scale + 1  # far more than rounding can do; scores are whole numbers
        most = scale * np.cos(np.maximum(angle - reach, 0)) + slack
        least = scale * np.cos(np.minimum(angle + reach, np.pi)) - slack
        return least, most

    def scores(self, anchor: np.ndarray, fits: bool, lo: int, hi: int) -> np.ndarray:
        """Exact inner products with the rows of a leaf, at most what a long holds."""
        if fits:
            return (self.x[lo:hi] @ anchor).astype(np.int64)
        own = [int(c) for c in anchor]
        exact = [sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in self.x[lo:hi]]
        return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact], dtype=np.int64)

    def search(self, anchor: np.ndarray, uid: int, wanted: np.ndarray, windows: list[tuple], count: int,
               least: np.ndarray, most: np.ndarray) -> list[list[tuple]]:
        """For every window (lowest, highest score; None: open) the first
        ``count`` of the ``wanted`` rows in it, as (-score, no id, id, uid)."""
        found: list[list[tuple]] = [[] for _ in windows]
        low = [-np.inf if lo is None else lo for lo, _ in windows]
        high = [np.inf if hi is None else hi for _, hi in windows]
        heap = [(-most[0], 0)]
        fits, wanted = self._fits(anchor), wanted & (self.uids != uid)
        while heap:
            up, k = heappop(heap)
            up = -up
            if up < min(low):
                break
            open_ = [j for j in range(len(windows)) if up >= low[j] and least[k] <= high[j]]
            if not open_:
                continue
            lo, hi, _, children = self.nodes[k]
            if children:
                for c in children:
                    heappush(heap, (-most[c], c))
                continue
            score = self.scores(anchor, fits, lo, hi)
            near = (score >= min(low[j] for j in open_)) & (score <= max(high[j] for j in open_)) & wanted[lo:hi]
            own = [(-s, self.ids[lo + i] is None, self.ids[lo + i] or 0, int(self.uids[lo + i]))
                   for i, s in zip(np.flatnonzero(near).tolist(), score[near].tolist(), strict=True)]
            if not own:
                continue
            for j in open_:
                more = [r for r in own if low[j] <= -r[0] <= high[j]]
                if more:
                    found[j] = sorted(found[j] + more)[:count]
                    if len(found[j]) == count:
                        low[j] = max(low[j], -found[j][-1][0])
        return found


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def dealt(members: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """``members`` with ``block``, and the number of blocks. Centres cover a sample of at most 8,192 vectors (the
    smallest hashes); every vector goes to the nearest, and a centre with more
    than ``block`` vectors has them spread over several blocks by hash."""
    spark = members.sparkSession
    size, top = members.agg(F.count(F.lit(1)), F.max("square")).first()
    top = float(top or 0)
    many = max(1, min(MOST_CENTRES, (size or 0) // block))
    sample = members.orderBy(F.xxhash64("v", "uid"), "uid").select("v", "width").limit(many * SAMPLED).collect()
    centres: dict[int, np.ndarray] = {}
    for width in sorted({r["width"] for r in sample}):
        own = [bytes(r["v"]) for r in sample if r["width"] == width and len(r["v"]) % 8 == 0]
        x = _numbers(own, width)
        if len(x) and np.isfinite(top):
            up = lifted(x, top)
            centres[width] = up[farthest_first(up, max(1, many * len(own) // len(sample)))[0]]
    sent = spark.sparkContext.broadcast((centres, top))  # at most MOST_CENTRES vectors

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, top = sent.value
        first = {w: sum(len(known[v]) for v in known if v < w) for w in known}
        for batch in batches:
            widths = batch.column("width").to_numpy()
            vs = batch.column("v").to_pylist()
            out = -1 - (widths % 64).astype(np.int32)  # no centre of that width
            for w in known:
                at = np.flatnonzero((widths == w) & np.array([len(v) % 8 == 0 for v in vs], dtype=bool))
                if len(at):
                    up = lifted(_numbers([vs[i] for i in at], w), top)
                    out[at] = first[w] + np.argmax(up @ known[w].T, axis=1)  # all have one length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.astype(np.int32))], names=[*batch.schema.names, "centre"])

    placed = checkpointed(members.mapInArrow(nearest, members.limit(0).withColumn("centre", F.lit(0)).schema))
    # A row for each centre: at most MOST_CENTRES and 64 more.
    counts = sorted((r["centre"], r["count"]) for r in placed.groupBy("centre").count().collect())
    parts = {c: -(-n // block) for c, n in counts}
    starts, total = {}, 0
    for c, n in parts.items():
        starts[c], total = total, total + n
    if not counts:
        return placed.withColumn("block", F.lit(0)), 0
    lookup = spark.createDataFrame([(c, starts[c], parts[c]) for c in parts], "centre int, start int, parts int")
    number = F.col("start") + F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    return placed.join(F.broadcast(lookup), "centre").withColumn("block", number).drop("start", "parts"), total


def mine(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: the hardest negatives of anchors and their positives.

    ``anchor`` says which rows of ``vectors`` are anchors. Components become
    ``floor(256 * x)``; a score is the inner product of two such vectors, exact
    also beyond doubles, and one beyond a long counts as the long next to it. An anchor's
    positives are the first ``positives`` other rows of its label, the highest
    score first, ties by smaller id; a positive's negatives are the first
    ``negatives`` rows of other labels whose score is within ``window`` percent
    of its own (none if that is negative). Fewer if there are no more.

    Rows with a null label, a null vector or null or non-finite components take
    no part. Vectors of different length have no score with each other. Rows
    with a null id come last among ties; repeated ids are rows of their own, and
    each repeated anchor has its own results. A null ``anchor`` is no anchor.
    Other columns do not matter. Empty in, empty out.

    The search is exact. Blocks and chunks of anchors meet by key, every anchor
    in every block, so the work is anchors times vectors where vectors have no
    structure; a task holds one block's tree and one chunk."""
    rows = vectors.select(
        column(vectors, vec_id).cast("long").alias("id"), column(vectors, label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), column(vectors, vector).cast("array<double>").alias("v"),
    )
    members = checkpointed(whole_vectors(rows).withColumn("uid", F.monotonically_increasing_id()))
    placed, blocks = dealt(members, block)
    asked = members.where("anchor")
    chunks = max(1, -(-asked.count() // chunk))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(chunks)).cast("int"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0))))
    stored = placed.select("block", "uid", "id", "label", "v", "width").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )

    def trees(table: pa.Table) -> dict[int, Block]:
        """A tree for every length of vector in a block."""
        table = table.sort_by("uid")  # rows come in any order, trees shall not differ
        width = table.column("width").to_numpy()
        out = {}
        for w in np.unique(width).tolist():
            own = table.filter(pa.array(width == w))
            x = _numbers(own.column("v").to_pylist(), w)
            out[w] = Block(own.column("uid").to_numpy(), own.column("id").to_pylist(), own.column("label").to_numpy(), x)
        return out

    def searched(stored: pa.Table, asked: pa.Table, windows_of, same: bool, count: int) -> Iterator[tuple]:
        if not stored.num_rows or not asked.num_rows:
            return
        known = trees(stored)
        asked = asked.sort_by("uid")
        width = asked.column("width").to_numpy()
        for w, tree in known.items():
            own = asked.filter(pa.array(width == w))
            if not own.num_rows:
                continue
            anchors = _numbers(own.column("v").to_pylist(), w)
            least, most = tree.bounds(anchors)
            for i, row in enumerate(own.drop_columns(["v"]).to_pylist()):
                wanted = (tree.labels == row["label"]) == same
                got = tree.search(anchors[i], row["uid"], wanted, windows_of(row), count, least[i], most[i])
                for j, best in enumerate(got):
                    for score, no_id, other, uid in best:
                        yield row["uid"], j, -score, None if no_id else other, uid

    names, kinds = ["anchor", "j", "score", "other", "uid"], [pa.int64(), pa.int32(), *[pa.int64()] * 3]
    schema = "anchor long, j int, score long, other long, uid long"

    def near(stored: pa.Table, asked: pa.Table) -> pa.Table:
        found = searched(stored, asked, lambda row: [(None, None)], True, positives)
        return _table(list(found), names, kinds)

    def hard(stored: pa.Table, asked: pa.Table) -> pa.Table:
        def windows_of(row):
            return [(-(-window[0] * s // 100), window[1] * s // 100) for s in row["scores"]]

        return _table(list(searched(stored, asked, windows_of, False, negatives)), names, kinds)

    def first(found: DataFrame, count: int) -> DataFrame:
        """The first of what the blocks found; a block gives ``count`` at most."""
        order = Window.partitionBy("anchor", "j").orderBy(F.desc("score"), F.col("other").asc_nulls_last(), F.col("uid"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    keyed = stored.groupBy("block", "chunk")
    spread = asked.select("uid", "label", "v", "width", "chunk").withColumn("block", everywhere)
    met = keyed.cogroup(spread.groupBy("block", "chunk")).applyInArrow(near, schema)
    best = checkpointed(first(met, positives))
    listed = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("ranked"))
    again = asked.join(listed, asked["uid"] == listed["anchor"]).select(
        "uid", "label", "v", "width", "chunk", F.col("ranked.score").alias("scores")
    )
    spread = again.withColumn("block", everywhere)
    met = keyed.cogroup(spread.groupBy("block", "chunk")).applyInArrow(hard, schema)
    worst = first(met, negatives).select("anchor", (F.col("j") + 1).alias("place"), "rank", "other", "score")
    pairs = best.select("anchor", F.col("rank").alias("place"), F.col("other").alias("positive_id"), F.col("score").alias("positive"))
    told = worst.join(pairs, ["anchor", "place"]).join(asked.select(F.col("uid").alias("anchor"), "id"), "anchor")

    return told.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"),
        F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"),
    )
