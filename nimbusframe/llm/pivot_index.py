"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points in order. Inverted
lists, one for each reference point, hold the vectors that have it in their
description; vectors that share enough points are candidates, and candidates
are verified by their cosine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import checkpointed, column, components

#: Least cosine of a link (fixed by the task).
COSINE = 0.95
#: Reference points in a description, and how many two vectors must share.
DEPTH, SHARED = 16, 2
#: Vectors for each reference point, and the most points there are: the bound
#: of the sample they are drawn from and of what is sent to the tasks.
PER_PIVOT, MOST_PIVOTS = 24, 8192
#: Reference points are less alike than this.
APART = 0.9
#: Vectors in a block of an inverted list; longer lists are compared block by block.
BLOCK = 1024
#: Vectors of a block pair that a point's own list counts as long with.
LONG = 64


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``vectors`` has ``id`` and ``v`` (array of double); adds ``digest`` (of
    the vector at length 1) and ``unit`` (its doubles as bytes), both null
    for null or empty vectors, zero, and null or non-finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units = [], []
            for v in batch.column("v"):
                x = np.array(v.as_py() if v.is_valid else [], dtype=object)
                x = np.array([np.nan if c is None else c for c in x], dtype=np.float64)
                top = np.abs(x).max(initial=0)
                if top and np.isfinite(x).all():
                    x = x / top  # no overflow or underflow in the sum of squares
                    x = x / np.sqrt(x @ x) + 0.0
                    units.append(x.tobytes())
                    nodes.append(hashlib.md5(units[-1]).digest())
                else:
                    units.append(None)
                    nodes.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nodes, pa.binary()), pa.array(units, pa.binary())],
                names=["id", "digest", "unit"],
            )

    return vectors.mapInArrow(run, "id long, digest binary, unit binary")


def choose_pivots(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Reference points by dimension: the ``count`` vectors with the smallest
    digests (a uniform sample), without those that are alike."""
    rows = nodes.orderBy("digest").select("unit").limit(count).collect()
    out: dict[int, np.ndarray] = {}
    for width in sorted({len(r["unit"]) // 8 for r in rows}):
        x = np.stack([np.frombuffer(r["unit"]) for r in rows if len(r["unit"]) == width * 8])
        keep: list[int] = []
        for i in range(len(x)):
            if not keep or (x[keep] @ x[i]).max() < APART:
                keep.append(i)
        out[width] = x[keep]
    return out


def describe(nodes: DataFrame, pivots: dict[int, np.ndarray], depth: int) -> DataFrame:
    """Adds ``near``: the numbers of the ``depth`` nearest reference points,
    the nearest first; a vector of a dimension without points has the one
    point -dimension. Numbers tell dimensions apart."""
    sent = nodes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        first = {w: sum(len(own[v]) for v in own if v < w) for w in own}
        for batch in batches:
            units = batch.column("unit").to_pylist()
            near: list = [None] * len(units)
            widths = np.array([len(u) // 8 for u in units])
            for w in np.unique(widths).tolist():
                at = np.flatnonzero(widths == w)
                if w not in own:
                    for i in at:
                        near[i] = [-w]
                    continue
                for part in np.array_split(at, -(-len(at) // 1000)):
                    cos = np.stack([np.frombuffer(units[i]) for i in part]) @ own[w].T
                    k = min(depth, cos.shape[1])
                    top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                    order = np.argsort(-np.take_along_axis(cos, top, 1), axis=1, kind="stable")
                    top = np.take_along_axis(top, order, 1) + first[w]
                    for i, row in zip(part, top.tolist(), strict=True):
                        near[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=[*batch.schema.names, "near"]
            )

    return nodes.mapInArrow(run, nodes.limit(0).withColumn("near", F.lit(None).cast("array<int>")).schema)


def _common(near: list[list[int]], pivot: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points before ``pivot``, and after it, each row of ``a`` shares
    with each of ``b``. Points of few rows are intersected through their own
    short lists, the others, which are few, by a product of incidence matrices;
    so the work follows the rows and not the number of points there are."""
    row = np.repeat(np.arange(len(near)), [len(r) for r in near])
    point = np.fromiter((p for r in near for p in r), dtype=np.int64, count=len(row))
    row, point = row[point != pivot], point[point != pivot]
    order = np.argsort(point, kind="stable")
    row, point = row[order], point[order]
    first = np.flatnonzero(np.append(True, point[1:] != point[:-1]))[: len(point)]
    count = np.diff(np.append(first, len(point)))
    group = np.repeat(np.arange(len(first)), count)
    out = np.zeros((2, len(a), len(b)), dtype=np.float32)
    at_a, at_b = np.full((2, len(near)), -1)
    at_a[a], at_b[b] = np.arange(len(a)), np.arange(len(b))
    side = (point > pivot).astype(np.int64)
    large = count > LONG
    name = np.cumsum(large) - 1
    for s in (0, 1):
        own = np.flatnonzero(large[group] & (side == s))
        has = np.zeros((len(near), int(large.sum())), dtype=np.float32)
        has[row[own], name[group[own]]] = 1
        out[s] = has[a] @ has[b].T
    # Every entry of a short list with every other of it, in both orders.
    entry = np.flatnonzero(~large[group])
    many = count[group[entry]]
    u = np.repeat(entry, many)
    v = first[group[u]] + np.arange(len(u)) - np.repeat(np.cumsum(many) - many, many)
    keep = (row[u] != row[v]) & (at_a[row[u]] >= 0) & (at_b[row[v]] >= 0)
    u, v = u[keep], v[keep]
    np.add.at(out, (side[u], at_a[row[u]], at_b[row[v]]), 1)
    return out[0], out[1]


def _compare(table: pa.Table, shared: int, cosine: float) -> pa.Table:
    """Links within one pair of blocks of an inverted list: per vector the rows
    linked to it, and edges that connect what is linked. A pair of vectors is
    counted in the list of their first shared point only."""
    pivot, i, j = (table.column(c)[0].as_py() for c in ("pivot", "i", "j"))
    block = table.column("block").to_numpy()
    count = table.column("count").to_numpy()
    nodes = table.column("node").to_pylist()
    x = np.stack([np.frombuffer(u) for u in table.column("unit").to_pylist()])
    near = table.column("near").to_pylist()
    a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
    size = np.array([len(r) for r in near])
    earlier, later = _common(near, pivot, a, b)
    need = np.minimum(shared, np.minimum.outer(size[a], size[b]))
    candidates = (earlier + later + 1 >= need) & (earlier == 0)
    if i == j:
        candidates &= np.triu(np.ones(candidates.shape, dtype=bool), 1)
    u, v = np.nonzero(candidates & (x[a] @ x[b].T >= cosine - 1e-9))
    u, v = a[u], b[v]
    exact = np.einsum("ij,ij->i", x[u], x[v]) >= cosine
    u, v = u[exact], v[exact]
    links = np.bincount(u, weights=count[v], minlength=len(near)) + np.bincount(v, weights=count[u], minlength=len(near))
    root = np.arange(len(near))
    while True:  # smallest row reachable
        low = root.copy()
        np.minimum.at(low, u, root[v])
        np.minimum.at(low, v, root[u])
        low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(links)
    return pa.table(
        {"node": pa.array([nodes[k] for k in at], pa.int64()), "root": pa.array([nodes[root[k]] for k in at], pa.int64()),
         "links": pa.array(links[at].astype(np.int64))}
    )


def link_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
    depth: int = DEPTH, shared: int = SHARED, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    Two rows are linked if the cosine of their vectors, in double precision, is
    at least ``cosine`` and the index finds them: they share ``shared`` of
    their ``depth`` nearest reference points (or all, if they have fewer).
    Nothing below ``cosine`` is linked; what the index misses is measured in
    the tests (recall of links 0.99 and more, with few reference points) and
    was once on 205,128 vectors, embeddings and noisy copies of them (recall
    1.0 on every 20th row against brute force). ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest id reachable by
    links, itself included, ``kept`` whether it is the row's own.

    Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing, nor do vectors of different dimension.
    Equal vectors are one node and always linked, so copies form no pairs.
    Rows with a null id count as links; their component is the smallest id
    that is not null, and they are not kept unless there is none. Repeated ids
    are judged by their own vectors. Other columns do not matter. Empty in,
    empty out.

    Reference points: one for every 24 vectors, at most 8192, so that lists
    stay short while that bound allows; longer lists are cut in blocks of
    1024 and compared block against block, each pair of blocks one task's
    work. Tasks return counts and connecting edges, never pairs.
    """
    rows = vectors.select(
        column(vectors, vec_id).cast("long").alias("id"), column(vectors, vector).cast("array<double>").alias("v")
    )
    members = checkpointed(unit_vectors(rows))
    nodes = members.where("digest IS NOT NULL").groupBy("digest", "unit").agg(
        F.count(F.lit(1)).alias("count"), F.min("id").alias("id")
    )
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    many = nodes.count()
    pivots = choose_pivots(nodes, min(MOST_PIVOTS, max(16, many // PER_PIVOT)))
    listed = checkpointed(describe(nodes.select("node", "unit", "count"), pivots, depth))
    postings = listed.select("node", "unit", "count", "near", F.explode("near").alias("pivot"))
    # One row a reference point: at most MOST_PIVOTS and the dimensions without.
    lengths = postings.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = postings.join(F.broadcast(lengths), "pivot").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
        "node", "unit", "count", "near",
    )
    found = checkpointed(
        paired.groupBy("pivot", "i", "j").applyInArrow(
            lambda table: _compare(table, shared, cosine), "node long, root long, links long"
        )
    )
    joined = components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = nodes.select("node", "digest", "count", "id").join(links.hint("merge"), "node", "left").join(
        joined.hint("merge"), "node", "left"
    )
    per_node = checkpointed(per_node.select(
        "digest", "id", (F.coalesce("links", F.lit(0)) + F.col("count") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "node").alias("c"),
    ))
    least = per_node.groupBy("c").agg(F.min("id").alias("component_id"))
    per_node = per_node.join(least, "c").select("digest", "n_links", "component_id")
    done = members.where("digest IS NOT NULL").select("id", "digest").join(per_node, "digest").drop("digest")
    alone = members.where("digest IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    out = done.unionByName(alone)
    return out.select(
        F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
