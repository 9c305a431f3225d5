"""Substring dedup by fixed-block anchors.

Any passage of ``length`` words holds a whole block of ``length // 2`` words
that starts at a multiple of the block size in its document. These
non-overlapping blocks are the index; every rolling window of a block's size
probes it. Hits anchor longer repeats: the windows of ``length`` words around
an anchor are compared by a 96-bit hash, and neighbours that repeat merge into
maximal exact repeats, which are removed from all documents but the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from nimbusframe.llm.common import chunks, column, free_name, words

#: Words in a passage that counts as a repeat (fixed by the task).
LENGTH = 50
#: Characters of texts hashed at once in a task, and words it remembers.
CHUNK, REMEMBERED = 4_000_000, 300_000
#: Characters of text in a group of documents, and for a bucket of hashes: one
#: task's units; there is about a window for every six characters.
GROUP, BUCKET = 4_000_000, 12_000_000

# Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

class _Hashes(dict):
    """64-bit hashes of words, kept when first asked for."""

    def __missing__(self, word: str) -> int:
        got = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = got
        return got


_HASHES = _Hashes()


def word_hashes(flat: list[str]) -> np.ndarray:
    """A 64-bit hash of every word."""
    return np.fromiter(map(_HASHES.__getitem__, flat), dtype=np.uint64, count=len(flat))


def mixed(h: np.ndarray) -> np.ndarray:
    """Other numbers for the same words, for a second rolling hash."""
    x = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def rolling(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of every run of ``size`` neighbours, by prefix sums of
    ``h[i] * base ** i`` modulo 2 ** 64, scaled back to the start of the run."""
    n = len(h)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    powers = np.full(n, base, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    back = np.full(n - size + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * powers, dtype=np.uint64)])
    x = (sums[size:] - sums[:-size]) * back
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _planes(a: np.ndarray) -> bytes:
    """Bytes of numbers, plane by plane: the high ones are mostly alike and compress."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()


def _numbers(data: bytes, kind: type, count: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, count).T).view(kind).ravel()


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table([pa.array(list(c), k) for c, (_, k) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def _schema(parts: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{n} {'int' if k == pa.int32() else 'binary'}" for n, k in parts)


def _ordered(table: pa.Table) -> tuple[np.ndarray, list[str | None]]:
    """Ids and texts of a group of documents in order of both, which is the
    same whenever the group is read."""
    ids, texts = table.column("id").to_pylist(), table.column("_text").to_pylist()
    rows = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or ""))
    return np.array([ids[i] for i in rows], dtype=np.int64), [texts[i] for i in rows]


def _texts(texts: list[str | None], length: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(words, document of each word, place of each word) of runs of the texts
    that have ``length`` words."""
    for lo, hi in chunks([len(x or "") for x in texts], CHUNK):
        split = [words(x) for x in texts[lo:hi]]
        rows = [i for i, w in enumerate(split) if len(w) >= length]
        if rows:
            sizes = np.array([len(split[i]) for i in rows], dtype=np.int64)
            flat = [w for i in rows for w in split[i]]
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield flat, np.repeat(lo + np.array(rows), sizes), place


def _dealt(key: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number, indices) of the parts that keys are dealt to, in their order."""
    number = ((key >> np.uint64(40)) % np.uint64(count)).astype(np.uint32)
    order = np.argsort(number, kind="stable")
    edges = np.flatnonzero(np.append(True, number[order][1:] != number[order][:-1]))[: len(key)]
    for at in np.split(order, edges[1:]):
        if len(at):
            yield int(number[at[0]]), at


def _firsts(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted columns."""
    new = np.ones(len(sorted_[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_])
    return np.flatnonzero(new)


PROBES = [("bucket", pa.int32()), ("dg", pa.int32()), ("codes", pa.binary()), ("several", pa.binary()), ("index", pa.binary())]
MARKS = [("dg", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary())]
WINDOWS = [("bucket", pa.int32()), ("dg", pa.int32()), ("one", pa.binary()), ("two", pa.binary()), ("least", pa.binary()),
           ("count", pa.binary()), ("doc", pa.binary()), ("start", pa.binary())]
GONE = [("dg", pa.int32()), ("doc", pa.binary()), ("start", pa.binary())]


def find_repeats(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> tuple[GroupedData, GroupedData]:
    """``docs`` has ``id`` (long, not null) and ``_text``. Returns it and the
    places where a window starts that is to go, both grouped by ``dg``, a group
    of documents of some megabytes; a place belongs to a document's number in
    the order of ids and texts of its group.

    A group sends every hash once, with whether several of its documents have
    it; so a passage that many documents hold comes to a bucket once a group."""
    block = length // 2
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length("_text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, groups = max(least, -(-size // bucket)), max(least, -(-size // GROUP))
    own = docs.withColumn("dg", F.pmod(F.xxhash64("id", "_text"), F.lit(groups)).cast("int")).groupBy("dg")

    def windows_of(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place in ``h``) of every window of a block's size within a document."""
        hashed = rolling(h, block, BASES[0])
        whole = np.flatnonzero(doc[: len(hashed)] == doc[block - 1 :])
        return hashed[whole], whole

    def probe(table: pa.Table) -> pa.Table:
        """Every window of a block's size, each hash once; those at multiples of
        the block size are the index."""
        ids, texts = _ordered(table)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))]
        for flat, doc, place in _texts(texts, length):
            hashed, at = windows_of(word_hashes(flat), doc)
            parts.append((hashed, ids[doc[at]], place[at] % block == 0))
        hashed, of, index = map(np.concatenate, zip(*parts, strict=True))
        order = np.argsort(hashed, kind="stable")
        hashed, of, index = hashed[order], of[order], index[order]
        out, dg = [], table.column("dg")[0].as_py()
        if len(hashed):
            first = _firsts(hashed)
            several = np.minimum.reduceat(of, first) != np.maximum.reduceat(of, first)
            index, hashed = np.logical_or.reduceat(index, first), hashed[first]
            for b, at in _dealt(hashed, buckets):
                codes = (hashed[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                at, codes = at[np.argsort(codes, kind="stable")], np.sort(codes)
                bits = (np.packbits(x[at]).tobytes() for x in (several, index))
                out.append((b, dg, _planes(np.diff(codes, prepend=np.uint32(0))), *bits))
        return _table(out, PROBES)

    def anchor(table: pa.Table) -> pa.Table:
        """For each group of documents its hashes that several documents have,
        one of them in the index."""
        b, dgs = table.column("bucket")[0].as_py(), table.column("dg").to_numpy()
        codes = [np.cumsum(_numbers(c, np.uint32, len(c) // 4), dtype=np.uint32) for c in table.column("codes").to_pylist()]
        bits = [
            np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(c)) for x, c in zip(table.column(k).to_pylist(), codes, strict=True)])
            for k in ("several", "index")
        ]
        of = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])
        code = np.concatenate(codes)
        order = np.argsort(code, kind="stable")
        first = _firsts(code[order])
        count = np.diff(np.append(first, len(code)))
        several, index = (np.maximum.reduceat(x[order], first) > 0 for x in bits)
        hit = order[np.repeat(((count > 1) | several) & index, count)]
        code, of = code[hit], of[hit]
        by = np.argsort(of, kind="stable")
        code, of = code[by], of[by]
        out = []
        for at in np.split(np.arange(len(of)), np.flatnonzero(of[1:] != of[:-1]) + 1):
            if len(at):
                out.append((int(dgs[of[at[0]]]), b, _planes(np.diff(code[at], prepend=np.uint32(0)))))
        return _table(out, MARKS)

    def extend(table: pa.Table, marks: pa.Table) -> pa.Table:
        """Hashes of the windows of ``length`` words that hold an anchor, each
        once, with the smallest id that has it and where that document does;
        places in the group's later documents go whatever others have, and are
        passed on through any bucket."""
        if not table.num_rows or not marks.num_rows:
            return _table([], WINDOWS)
        keys = [
            (np.uint64(r["bucket"]) << np.uint64(32)) | np.cumsum(_numbers(r["codes"], np.uint32, len(r["codes"]) // 4), dtype=np.uint32)
            for r in marks.to_pylist()
        ]
        key = np.sort(np.concatenate(keys))
        some = np.zeros(1 << 22, dtype=bool)  # most hashes that are no key fail here
        some[key & np.uint64(len(some) - 1)] = True
        ids, texts = _ordered(table)
        parts = []
        for flat, doc, place in _texts(texts, length):
            h = word_hashes(flat)
            hashed, at = windows_of(h, doc)
            maybe = np.flatnonzero(some[hashed & np.uint64(len(some) - 1)])
            hashed, at = hashed[maybe], at[maybe]
            mine = ((hashed >> np.uint64(40)) % np.uint64(buckets) << np.uint64(32)) | (hashed & np.uint64(0xFFFFFFFF))
            found = at[key[np.minimum(np.searchsorted(key, mine), len(key) - 1)] == mine]
            if not len(found):
                continue
            edge = np.zeros(len(h) + 1, dtype=np.int32)
            np.add.at(edge, found - np.minimum(place[found], length - block), 1)
            np.add.at(edge, found + 1, -1)
            n = len(h) - length + 1
            near = np.flatnonzero((np.cumsum(edge)[:n] > 0) & (doc[:n] == doc[length - 1 :]))
            one, two = (rolling(x, length, b)[near] for x, b in zip((h, mixed(h)), BASES, strict=True))
            parts.append((one, (two >> np.uint64(32)).astype(np.uint32), doc[near].astype(np.uint32), place[near].astype(np.uint32)))
        if not parts:
            return _table([], WINDOWS)
        one, two, doc, start = map(np.concatenate, zip(*parts, strict=True))
        out, dg = [], table.column("dg")[0].as_py()
        if not len(one):
            return _table(out, WINDOWS)
        order = np.argsort(one, kind="stable")  # places stay in order of document and start
        if ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((two, one))
        one, two, doc, start = one[order], two[order], doc[order], start[order]
        first = _firsts(one, two)
        count = np.diff(np.append(first, len(one)))
        low = np.minimum.reduceat(ids[doc], first)
        later = ids[doc] > np.repeat(low, count)
        if later.any():
            out.append((dg % buckets, dg, None, None, None, None, _planes(doc[later]), _planes(start[later])))
        kept = np.flatnonzero(~later)
        group = np.repeat(np.arange(len(first)), count)[kept]
        edges = np.searchsorted(group, np.arange(len(first) + 1))
        for b, at in _dealt(one[first], buckets):
            many = edges[at + 1] - edges[at]
            places = kept[np.repeat(edges[at], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
            head = first[at]
            out.append((b, dg, _planes(one[head]), _planes(two[head]), _planes(low[at]), _planes(many.astype(np.uint32)), _planes(doc[places]), _planes(start[places])))
        return _table(out, WINDOWS)

    def settle(table: pa.Table) -> pa.Table:
        """Windows whose words also start in a document with a smaller id."""
        rows = table.to_pylist()
        out = [(r["dg"], r["doc"], r["start"]) for r in rows if r["one"] is None]
        rows = [r for r in rows if r["one"] is not None]
        if not rows:
            return _table(out, GONE)
        sizes = [len(r["two"]) // 4 for r in rows]
        one, two, low = (
            np.concatenate([_numbers(r[k], kind, n) for r, n in zip(rows, sizes, strict=True)])
            for k, kind in (("one", np.uint64), ("two", np.uint32), ("least", np.int64))
        )
        order = np.lexsort((two, one))
        first = _firsts(one[order], two[order])
        smallest = np.empty(len(one), dtype=np.int64)
        smallest[order] = np.repeat(np.minimum.reduceat(low[order], first), np.diff(np.append(first, len(one))))
        gone = np.split(low > smallest, np.cumsum(sizes)[:-1])
        for r, mark, n in zip(rows, gone, sizes, strict=True):
            mark = np.repeat(mark, _numbers(r["count"], np.uint32, n))
            if mark.any():
                out.append((r["dg"], *(_planes(_numbers(r[k], np.uint32, len(mark))[mark]) for k in ("doc", "start"))))
        return _table(out, GONE)

    marks = own.applyInArrow(probe, _schema(PROBES)).groupBy("bucket").applyInArrow(anchor, _schema(MARKS))
    windows = own.cogroup(marks.groupBy("dg")).applyInArrow(extend, _schema(WINDOWS))
    return own, windows.groupBy("bucket").applyInArrow(settle, _schema(GONE)).groupBy("dg")


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Marks the words that windows of ``length`` at ``starts`` cover."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, bucket: int = BUCKET,
    with_text: bool = True,
) -> DataFrame:
    """Remove passages of ``length`` or more words that an earlier document has.

    Returns ``doc_id, n_words, n_removed, kept_sha256`` for every row, and
    ``text`` (the words kept, joined by one space) if asked for. A word goes if
    a window of ``length`` consecutive words over it has the same words as a
    window that starts in a document with a smaller id; windows are judged on
    the input. ``kept_sha256`` is the hex digest of the kept words.

    Null text has no words. Rows with a null id are neither earlier nor later
    than others and keep everything; so do rows of equal id among themselves
    (each is judged by its own text). Empty in, empty out. Extra columns do not
    matter. ``doc_id`` must be an integer.

    Nothing is sampled or capped. Texts are shuffled once, by groups of
    documents of a few megabytes, and read three times from that exchange. A
    group sends each of its hashes once: four bytes for an anchor, and for the
    exact comparison only windows near an anchor, with the places of the
    group's first document that has them. So a passage that a third of all
    documents hold comes to a bucket once a group, and makes no pairs. Buckets
    and groups grow in number with the input. Lost executors lead to recomputed
    stages only.
    """
    # New names for both: the plans of both meetings are then alike to the letter, and share the exchange.
    named = docs.select(column(docs, doc_id).cast("long").alias("id"), column(docs, text).cast("string").alias("_text"))
    known, hits = find_repeats(named.where("id IS NOT NULL"), length, bucket)

    kinds = [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]

    def row(own: int | None, text: str | None, starts: np.ndarray | None) -> tuple:
        w = words(text)
        n, gone = len(w), 0
        if starts is not None and len(starts):
            mark = covered(n, starts, length)
            gone = int(mark.sum())
            w = [v for v, m in zip(w, mark.tolist(), strict=True) if not m]
        kept = " ".join(w)
        return own, n, gone, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(), kept if with_text else None

    def cut_group(table: pa.Table, gone: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], kinds)
        ids, texts = _ordered(table)
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.uint32))]
        parts += [tuple(_numbers(r[k], np.uint32, len(r[k]) // 4) for k in ("doc", "start")) for r in gone.to_pylist()]
        doc, start = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
        order = np.argsort(doc, kind="stable")
        edges = np.searchsorted(doc[order], np.arange(len(ids) + 1)).tolist()
        start = start[order]
        return _table([row(int(i), x, start[a:b]) for i, x, a, b in zip(ids, texts, edges[:-1], edges[1:], strict=True)], kinds)

    def cut_unnamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _table([row(None, x, None) for x in batch.column("_text").to_pylist()], kinds).to_batches()

    kind = "id long, n_words long, n_removed long, kept_sha256 string, kept string"
    done = known.cogroup(hits).applyInArrow(cut_group, kind)
    done = done.unionByName(named.where("id IS NULL").mapInArrow(cut_unnamed, kind))
    out = done.select(F.col("id").alias(doc_id), "n_words", "n_removed", "kept_sha256", "kept")
    return out.withColumnRenamed("kept", free_name(out, text)) if with_text else out.drop("kept")
