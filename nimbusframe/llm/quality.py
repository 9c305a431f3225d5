"""Quality rules by distribution divergence.

Documents are compared with language references by the Jensen-Shannon
distance of two histograms: classes of characters, and common words. Short
documents are excused from the comparison their length cannot support.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbusframe.llm.common import batch_of, chunks, column, tidy, with_computed, words

#: Characters that count as symbols (fixed by the task).
SYMBOLS = "#*$%&|<>"
#: Base rules (fixed by the task): fewest words, and the percentage of words
#: in repeated three-word windows that is still accepted.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Common words of a language that have a bin of their own.
COMMON = 40
#: Shortest documents (words) for the character and the word comparison.
GUARD_CHARS, GUARD_WORDS = 20, 50
#: A language has a reference if it has so many documents that count for one,
#: with so many words, and one in ``MOST_LANGUAGES`` of all such documents: else
#: a rare or dirty label would be its own measure.
LEAST_DOCS, LEAST_SIZE, MOST_LANGUAGES = 10, 2_000, 500
#: Greatest distances accepted; 0 is equal, 1 has nothing in common. The word
#: histogram of ``n`` words is off by chance by about 1 / sqrt(n), which is
#: allowed for in this proportion.
MOST_CHARS, MOST_COMMON, BY_CHANCE = 0.28, 0.30, 0.9
#: Words of documents worked on at once in a task.
CHUNK = 2_000_000

CLASSES = ("lower", "upper", "other letter", "digit", "space", "stop", "symbol", "other")


def char_classes() -> np.ndarray:
    """Class number of every code point of the Basic Multilingual Plane; those
    beyond it are ``other``."""
    table = np.full(0x10000, 7, dtype=np.uint8)
    for cp in range(0x10000):
        c = chr(cp)
        if c.islower():
            table[cp] = 0
        elif c.isupper():
            table[cp] = 1
        elif c.isalpha():
            table[cp] = 2
        elif c.isdigit():
            table[cp] = 3
        elif c.isspace():
            table[cp] = 4
        elif c in ".,;:'\"-()?":
            table[cp] = 5
        elif c in SYMBOLS + "!+=@^_~\\/[]{}`":
            table[cp] = 6
    return table


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    """Characters of a text by class."""
    if not _TABLE:
        _TABLE.append(char_classes())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(_TABLE[0][np.minimum(points, 0xFFFF)], minlength=len(CLASSES)).astype(np.float64)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) of the
    rows of two arrays of counts. A row without counts is at distance 1."""
    sp, sq = p.sum(-1, keepdims=True), q.sum(-1, keepdims=True)
    p, q = p / np.where(sp == 0, 1, sp), q / np.where(sq == 0, 1, sq)
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(-1)

    d = np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))
    return np.where((sp[..., 0] == 0) | (sq[..., 0] == 0), 1.0, d)


def repeated_words(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks the words that lie in a three-word window found twice or more in
    its document. ``ids`` numbers the words, ``doc`` their documents in order."""
    n = len(ids)
    mark = np.zeros(n, dtype=bool)
    if n < 3:
        return mark
    top = int(ids.max()) + 1
    _, pair = np.unique(ids[:-1] * top + ids[1:], return_inverse=True)
    _, triple = np.unique(pair[:-1] * top + ids[2:], return_inverse=True)
    at = np.flatnonzero(doc[:-2] == doc[2:])  # windows that cross into the next document are none
    key = doc[at] * (int(triple.max()) + 1) + triple[at]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    at = at[count[inverse] > 1]
    for k in range(3):
        mark[at + k] = True
    return mark


def count_corpus(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, kind, item, n) over all documents with a language and
    ``LEAST_WORDS`` words: characters by class (kind ``char``), words in lower
    case (kind ``word``) and documents (kind ``doc``). Tasks sum what a chunk of documents has before
    rows leave Python; Spark sums the rest."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks([len(x) for x in texts], CHUNK * 3):
                char: dict[str, np.ndarray] = {}
                word: dict[str, Counter] = {}
                count: Counter = Counter()
                for lg, x in zip(langs[lo:hi], texts[lo:hi], strict=True):
                    w = words(x.lower())
                    if len(w) < LEAST_WORDS:
                        continue
                    if lg not in char:
                        char[lg], word[lg] = np.zeros(len(CLASSES)), Counter()
                    count[lg] += 1
                    char[lg] += class_counts(x)
                    word[lg].update(w)
                for lg, c in char.items():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lg] * (len(CLASSES) + 1), pa.string()), pa.array(["char"] * len(CLASSES) + ["doc"]),
                            pa.array([*CLASSES, ""]), pa.array([*c.astype(np.int64).tolist(), count[lg]], pa.int64()),
                        ], names=["lang", "kind", "item", "n"],
                    )
                    items = list(word[lg].items())
                    for i in range(0, len(items), 50_000):
                        part = items[i : i + 50_000]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lg] * len(part), pa.string()), pa.array(["word"] * len(part)),
                                pa.array([k for k, _ in part], pa.string()),
                                pa.array([v for _, v in part], pa.int64()),
                            ], names=["lang", "kind", "item", "n"],
                        )

    known = docs.select(column(docs, lang).cast("string").alias("lang"), column(docs, text).alias("text")).dropna()
    parts = known.mapInArrow(tidy(tally), "lang string, kind string, item string, n long")
    return parts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON) -> dict:
    """Language references from the whole corpus: ``{lang: (character counts,
    {common word: bin}, word counts with the rest in the last bin)}``.

    A language needs ``LEAST_DOCS`` documents, ``LEAST_SIZE`` words and its
    share of all documents (one in ``MOST_LANGUAGES``). Only the ``common`` most
    frequent words of each such language (ties by the word) and two sums come
    to the driver: common + 9 rows for at most ``MOST_LANGUAGES``."""
    counted = count_corpus(docs, text, lang)
    sums = counted.groupBy("lang").agg(
        F.sum(F.when(F.col("kind") == "word", F.col("n"))).alias("n"), F.sum(F.when(F.col("kind") == "doc", F.col("n"))).alias("docs")
    )
    # A row for each value of the language column.
    sums = sums.withColumn("all", F.sum("docs").over(Window.partitionBy()))
    known = sums.where((F.col("docs") >= LEAST_DOCS) & (F.col("n") >= LEAST_SIZE) & (F.col("docs") * MOST_LANGUAGES >= F.col("all")))
    top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    ranked = counted.where("kind <> 'doc'").withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= max(common, len(CLASSES)))
    rows = ranked.where((F.col("kind") == "char") | (F.col("rank") <= common)).select("lang", "kind", "item", "n")
    rows = rows.join(known.select("lang"), "lang")
    rows = rows.unionByName(known.select("lang", F.lit("all").alias("kind"), F.lit("").alias("item"), "n"))
    out: dict[str, list] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["kind"], -r["n"], r["item"])):
        char, bins, n, total = out.setdefault(r["lang"], [np.zeros(len(CLASSES)), {}, [], []])
        if r["kind"] == "char":
            char[CLASSES.index(r["item"])] = r["n"]
        elif r["kind"] == "all":
            total.append(r["n"])
        else:
            bins[r["item"]] = len(bins)
            n.append(r["n"])
    return {k: (c, b, np.array([*n, t[0] - sum(n)], dtype=np.float64)) for k, (c, b, n, t) in out.items() if t}


def assess(texts: list[str | None], refs: dict) -> dict[str, np.ndarray]:
    """The features and verdicts of some texts, by numpy over all their words."""
    size = len(texts)
    split = [words(x) for x in texts]
    n_words = np.array([len(w) for w in split], dtype=np.int64)
    ends = np.cumsum(n_words)
    doc = np.repeat(np.arange(size, dtype=np.int64), n_words)
    number: dict[str, int] = {}
    flat = np.fromiter(
        (number.setdefault(w, len(number)) for ws in split for w in ws), dtype=np.int64, count=int(ends[-1]) if size else 0
    )
    mark = repeated_words(flat, doc)
    repeats = np.bincount(doc[mark], minlength=size).astype(np.int64)
    chars = np.fromiter((sum(map(len, w)) for w in split), dtype=np.int64, count=size)
    symbols = np.fromiter((sum(map((x or "").count, SYMBOLS)) for x in texts), dtype=np.int64, count=size)
    lines = np.zeros(size, dtype=np.int64)
    for i, x in enumerate(texts):
        if x and "\n" in x:
            own = [y for y in x.split("\n") if words(y)]
            lines[i] = len(own) - len(set(own))
    base = (n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * n_words)
    hist = np.stack([class_counts(x or "") for x in texts]) if size else np.zeros((0, len(CLASSES)))
    far_chars, far_words = np.ones(size), np.ones(size)
    lower = [w.lower() for w in number]
    for char, bins, counts in refs.values():
        far_chars = np.minimum(far_chars, js_distance(hist, char[None, :]))
        width = len(counts)
        bin_of = np.fromiter((bins.get(w, width - 1) for w in lower), dtype=np.int64, count=len(lower))
        seen = np.bincount(doc * width + bin_of[flat], minlength=size * width) if len(flat) else np.zeros(size * width)
        far_words = np.minimum(far_words, js_distance(seen.reshape(size, width).astype(np.float64), counts[None, :]))
    odd = np.zeros(size, dtype=bool)
    if refs:
        odd = (n_words >= GUARD_CHARS) & (far_chars > MOST_CHARS)
        odd |= (n_words >= GUARD_WORDS) & (far_words > MOST_COMMON + BY_CHANCE / np.sqrt(np.maximum(n_words, 1)))
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines,
        "n_repeat_words": repeats, "base_failed": base, "kept": ~base & ~odd,
        "js_chars": far_chars, "js_words": far_words,
    }


_TYPES = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "kept": "boolean", "js_chars": "double", "js_words": "double",
}


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", refs: dict | None = None) -> DataFrame:
    """The columns of ``docs`` and what :func:`assess` finds for each row:
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, js_chars, js_words`` (the distances to the nearest
    language reference).

    A document fails the base rules with fewer than 50 words or if more than
    half its words lie in repeated three-word windows. Else it is rejected if
    its character classes (20 words or more) or its common words (50 or more)
    are farther than accepted from the reference of every language. References
    come from all documents with a language and 50 words or more (``refs``
    passes them in); with none, only the base rules hold. Shorter documents
    stay out: they fail the base rules, so no reference is needed to judge
    them, and menus and fragments would blur the references of whole texts. A
    language found only in short texts, or in few (:func:`references`), has no
    reference. Texts of any length are looked at whole.

    Null text counts as no words and fails the base rules, like an empty one.
    Null languages join no reference but are judged. Repeated rows are judged
    alike. Extra columns pass through; clashing names get an underscore before
    the new one. Empty in, empty out. The work is two scans without a shuffle
    of texts; the second one keeps rows where they are.
    """
    refs = references(docs, text, lang) if refs is None else refs
    known = docs.sparkSession.sparkContext.broadcast(refs)  # common + 9 numbers a language
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in chunks([len(x or "") for x in texts], CHUNK * 3):
                got = assess(texts[lo:hi], known.value)
                part = batch.slice(lo, hi - lo)
                yield batch_of(part.columns, [pa.array(got[k]) for k in _TYPES])

    return with_computed(docs, tidy(run), _TYPES)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their own columns
    only, whatever these are called. Nulls, long texts, repeated rows and empty
    tables are as there."""
    judged = judge(docs, text, lang)
    kept = judged.columns[len(docs.columns) + list(_TYPES).index("kept")]
    return judged.where(column(judged, kept)).select(*[column(judged, c) for c in docs.columns])
