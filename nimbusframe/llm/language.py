"""Language identification of texts that may mix languages.

The script of a word narrows the languages it may belong to; the words of a
text are scored under each of them, and a Viterbi pass with a penalty for
every switch labels spans of one language. The language with most letters is
the text's prediction.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import batch_of, chunks, column, tidy, with_computed

UNKNOWN = "und"
#: Labelled documents per language that the model is fitted on, about (the
#: bound of the sample); the sample is by a hash of the id.
SAMPLE = 2_000
#: Cells that letter groups of a word are hashed to; the model has this many
#: rows for each language, whatever the sample.
CELLS = 1 << 16
#: Fewest documents of a language that is learned, and least share of all
#: labelled documents, one in so many: a dirty label is none, and a model has
#: at most so many languages.
LEAST_DOCS, MOST_LANGUAGES = 10, 500
#: Letters in a group, from one to this many.
GROUP = 4
#: What a language must gain on its neighbours for a span of its own.
SWITCH = 8.0
#: Most that one word can say against a language.
MOST = 6.0
#: A script is a language's if it has this share of the letters in its sample.
SCRIPT_SHARE = 0.01
#: Characters worked on at once, and words a task remembers.
CHUNK, REMEMBERED = 12_000_000, 400_000

# First and last code points of the letters of scripts.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2B8),
              (0x1D00, 0x1D25), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA722, 0xA787), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "burmese": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "mongolian": [(0x1800, 0x18AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
_STARTS = sorted((lo, hi, name) for name, ranges in SCRIPTS.items() for lo, hi in ranges)
_LOW = np.array([x[0] for x in _STARTS])

_LETTERS = re.compile(r"[^\W\d_]+")


def script_of(word: str) -> str:
    """The script of a word's first letter; ``other`` outside the table."""
    point = ord(word[0])
    k = int(np.searchsorted(_LOW, point, side="right")) - 1
    return _STARTS[k][2] if k >= 0 and point <= _STARTS[k][1] else "other"


def letter_words(text: str | None) -> list[str]:
    """Runs of letters of a text in lower case."""
    found = _LETTERS.findall(text.lower()) if text else []
    if text and not text.isascii():  # number forms such as superscripts match, but are no letters
        found = [w for w in found if any(map(str.isalpha, w))]
    return found


def groups(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, cell) of all groups of 1 to ``GROUP`` letters of the words, each
    word with a mark before and after it; its whole form is one more group."""
    marked = [f"\x02{w}\x03" for w in words]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(marked)), size)
    mixed = (points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    own, cells = [], []
    value = np.zeros(len(points), dtype=np.uint64)
    for k in range(GROUP):
        n = len(points) - k
        if n <= 0:
            break
        value = value[:n] * np.uint64(0x100000001B3) + mixed[k:]
        whole = word[:n] == word[k:]
        cell = ((value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
        own.append(word[:n][whole])
        cells.append(cell[whole])
    full = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in marked), dtype=np.uint64, count=len(marked))
    own.append(np.arange(len(marked)))
    cells.append((full * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48))
    return np.concatenate(own), np.concatenate(cells).astype(np.int64)


class Model:
    """Log odds of the cells by language, and the languages of every script."""

    def __init__(self, counts: dict[str, np.ndarray], scripts: dict[str, Counter]):
        self.languages = sorted(counts)
        if not self.languages:
            return
        table = np.stack([counts[k] for k in self.languages]).astype(np.float64) + 0.5
        table = np.log(table / table.sum(1, keepdims=True))
        self.table = np.ascontiguousarray((table - table.max(0)).T, dtype=np.float32)
        self.candidates: dict[str, np.ndarray] = {}
        for name in [*SCRIPTS, "other"]:
            share = np.array([scripts[k][name] / max(1, scripts[k].total()) for k in self.languages])
            mask = share >= SCRIPT_SHARE
            self.candidates[name] = mask if mask.any() else np.ones(len(mask), dtype=bool)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.languages)), dtype=np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores of words, 0 for the best language; those that the script
        rules out are at minus infinity."""
        own, cells = groups(words)
        total = np.zeros((len(words), len(self.languages)), dtype=np.float64)
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(own, weights=self.table[cells, k], minlength=len(words))
        total /= GROUP  # the groups of a word overlap
        masks = np.stack([self.candidates[script_of(w)] for w in words])
        total[~masks] = -np.inf
        total -= total.max(1, keepdims=True)
        return np.where(masks, np.maximum(total, -MOST), -np.inf).astype(np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Row numbers of words in :attr:`rows`, which is filled as needed."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
            self.rows = self.rows[:0]
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            first = len(known)
            known.update(zip(new, range(first, first + len(new)), strict=True))
            self.rows = np.concatenate(
                [self.rows, *(self.word_scores(new[i : i + 50_000]) for i in range(0, len(new), 50_000))]
            )
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def label(self, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The language number of every word, by Viterbi over each text. All
        texts advance together, the longest first; a step works on those that
        have a word left."""
        order = np.argsort(-sizes, kind="stable")
        start = (np.cumsum(sizes) - sizes)[order]
        longest = int(sizes.max(initial=0))
        left = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # texts longer than t
        scores = self.rows[numbers]
        came = np.zeros((len(numbers), len(self.languages)), dtype=np.uint8)  # where each language came from
        value = np.zeros((len(sizes), len(self.languages)), dtype=np.float32)
        lanes = np.arange(len(self.languages), dtype=np.uint8)
        for t in range(longest):
            n = left[t]
            at = start[:n] + t
            if t:
                best = value[:n].argmax(1)
                top = value[np.arange(n), best] - SWITCH
                stay = value[:n] >= top[:, None]
                came[at] = np.where(stay, lanes, best[:, None])
                value[:n] = np.where(stay, value[:n], top[:, None])
            value[:n] += scores[at]
            value[:n] -= value[:n].max(1, keepdims=True)
        out = np.zeros(len(numbers), dtype=np.uint8)
        state = value.argmax(1).astype(np.uint8)
        for t in range(longest - 1, -1, -1):
            n = left[t]
            at = start[:n] + t
            out[at] = state[:n]
            state[:n] = came[at, state[:n]]
            if t == 0:
                break
        return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", by: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit a model on rows with text and language: about ``sample`` documents
    of each language, chosen by a hash of ``by`` (whole texts).

    A language needs ``LEAST_DOCS`` labelled documents and one in
    ``MOST_LANGUAGES`` of all. Tasks add up cells and scripts; the driver gets
    at most ``CELLS`` numbers a language. Without any labelled text the model
    knows no language."""
    rows = docs.select(
        column(docs, by).cast("string").alias("by"), column(docs, lang).cast("string").alias("lang"),
        column(docs, text).alias("text"),
    ).dropna(subset=["lang", "text"])
    labels = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.sum("n")).scalar()
    known = labels.where((F.col("n") >= LEAST_DOCS) & (F.col("n") * MOST_LANGUAGES >= total))  # MOST_LANGUAGES rows at most
    sizes = {r["lang"]: r["n"] for r in known.collect()}
    draw = F.pmod(F.xxhash64(F.coalesce("by", F.lit(""))), F.lit(1 << 30))
    chosen = F.lit(False)
    for name, n in sizes.items():
        chosen = chosen | ((F.col("lang") == name) & (draw < int(min(1.0, sample / n) * (1 << 30))))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, np.ndarray] = {}
        scripts: dict[str, Counter] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks([len(x) for x in texts], CHUNK):
                for name in set(langs[lo:hi]):
                    words = Counter(w for lg, x in zip(langs[lo:hi], texts[lo:hi], strict=True) if lg == name for w in letter_words(x))
                    if not words:
                        continue
                    own, cell = groups([*words])
                    n = np.fromiter(words.values(), dtype=np.int64, count=len(words))
                    got = np.bincount(cell, weights=n[own], minlength=CELLS).astype(np.int64)
                    cells[name] = cells.get(name, 0) + got
                    count = scripts.setdefault(name, Counter())
                    for w, k in words.items():
                        count[script_of(w)] += k * len(w)
        for name, got in cells.items():
            at = np.flatnonzero(got)
            names = [*map(str, at), *scripts[name]]
            n = [*got[at].tolist(), *scripts[name].values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(n)), pa.array(names), pa.array(n, pa.int64())], names=["lang", "item", "n"]
            )

    parts = rows.where(chosen).select("lang", "text").mapInArrow(tally, "lang string, item string, n long")
    counts: dict[str, np.ndarray] = {}
    scripts: dict[str, Counter] = {}
    for r in parts.groupBy("lang", "item").agg(F.sum("n").alias("n")).toLocalIterator():
        if r["item"].isdigit():
            counts.setdefault(r["lang"], np.zeros(CELLS, dtype=np.int64))[int(r["item"])] = r["n"]
        else:
            scripts.setdefault(r["lang"], Counter())[r["item"]] = r["n"]
    return Model(counts, {k: scripts.get(k, Counter()) for k in counts})


def predict(docs: DataFrame, model: Model, text: str = "text", spans: bool = False) -> DataFrame:
    """The columns of ``docs`` with ``lang_pred``, ``score`` and ``n_spans``.

    ``lang_pred`` has most letters of the text among the labelled spans (ties:
    the first by name), ``score`` is its share of the letters, ``n_spans`` the
    number of spans. With ``spans``, also ``spans``: an array of (lang, first
    and last word, counted over runs of letters). Null texts, texts without a
    letter and models without a language give ``und``, score 0 and no span.
    Only the text is looked at. Texts of any length are labelled whole, word by word.
    Rows are independent, so repeats and ties do not matter; an empty table
    gives an empty one; other columns pass through, and clashing names get an
    underscore before the new one. One pass without a shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # CELLS numbers a language
    kinds = {"lang_pred": "string", "score": "double", "n_spans": "int"}
    if spans:
        kinds["spans"] = "array<struct<lang:string,first:int,last:int>>"
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in chunks([len(x or "") for x in texts], CHUNK):
                got = label_texts(own, texts[lo:hi], spans)
                arrays = [pa.array(got[0], pa.string()), pa.array(got[1]), pa.array(got[2], pa.int32())]
                if spans:
                    kind = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())])
                    arrays.append(pa.array(got[3], pa.list_(kind)))
                yield batch_of(batch.slice(lo, hi - lo).columns, arrays)

    return with_computed(docs, tidy(run), kinds)


def label_texts(model: Model, texts: list[str | None], spans: bool = False) -> tuple[list, np.ndarray, np.ndarray, list]:
    """(language, score, number of spans, spans) of each text."""
    n = len(texts)
    names, score, count = [UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=np.int64)
    lists: list[list] = [[] for _ in texts]
    if not model.languages:
        return names, score, count, lists
    split = [letter_words(x) for x in texts]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=n)
    flat = [w for ws in split for w in ws]
    if not flat:
        return names, score, count, lists
    labels = model.label(sizes, model.numbers(flat)).astype(np.int64)
    doc = np.repeat(np.arange(n), sizes)
    letters = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    width = len(model.languages)
    share = np.bincount(doc * width + labels, weights=letters, minlength=n * width).reshape(n, width)
    best = share.argmax(1)
    any_ = sizes > 0
    score[any_] = share[any_, best[any_]] / share[any_].sum(1)
    names = [model.languages[b] if a else UNKNOWN for a, b in zip(any_, best, strict=True)]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])
    count = np.bincount(doc[new], minlength=n)
    if spans:
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(flat)) - 1
        base = np.cumsum(sizes) - sizes
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            d = int(doc[a])
            lists[d].append(
                {"lang": model.languages[labels[a]], "first": a - int(base[d]), "last": b - int(base[d])}
            )
    return names, score, count, lists
