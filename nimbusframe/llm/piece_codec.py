"""Sub-word pieces by a weighted finite-state transducer.

A model file compiles into three machines: the normaliser rewrites the input,
the piece transducer maps character strings to pieces, and byte fallback maps
any other character to its bytes. Composed with an input they give a lattice;
the shortest path in the tropical semiring (min, +) is the encoding.

For a unigram model an arc weighs minus the score of its piece. In a model of
ranked merges weights are 0 or infinite: two pieces may follow each other only
if merging their joined text by rank gives just these two again. Exactly one
path then has weight 0, which is the result of the merges.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import batch_of, chunks, column, tidy, with_computed

#: Short parts of texts, and starts of them, whose path a task remembers (up to
#: twice as many; those not used for longest go first), and lengths of the starts.
REMEMBERED, REMEMBERED_STARTS = 150_000, 100_000
SHORT = 32
STARTS = (8, 5)
#: Pairs of pieces whose weight a task remembers.
PAIRS = 1_000_000
#: Largest model file that is sent to the executors.
MOST_MODEL_BYTES = 64 << 20
#: Bytes of text worked on between two yields of a task.
CHUNK = 1_000_000
SPACE = "\u2581"
INF = math.inf
_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: The same, cut between Latin letters and what is none, too.
LETTERS = "A-Za-z\u00c0-\u024f"
_LETTER_PARTS = re.compile(f"{SPACE}*(?:[{LETTERS}]+|[^{SPACE}{LETTERS}]+)|{SPACE}+")
_ACROSS = re.compile(f"[{LETTERS}][^{LETTERS}]|[^{LETTERS}][{LETTERS}]")

# Fixed values of the model file: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What an unknown character costs beyond the worst piece of a unigram model.
UNKNOWN_COST = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""
    pos = 0

    def varint() -> int:
        nonlocal pos
        shift = value = 0
        while True:
            byte = data[pos]
            pos += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while pos < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[pos : pos + size]
        pos += size


class Normaliser:
    """The rewriting machine: longest match in the character map, white space
    to the space mark, a mark before the text, extra spaces removed if the
    model says so."""

    def __init__(self, spec: bytes):
        flags = {3: 1, 4: 1, 5: 1}
        charsmap = b""
        for number, value in _fields(spec):
            if number == 2:
                charsmap = bytes(value)
            elif number in flags:
                flags[number] = value
        self.prefix, self.squeeze, self.mark = (bool(flags[k]) for k in (3, 4, 5))
        self.rewrites: dict[bytes, bytes] = {}
        self.longest = 0
        if charsmap:
            size = struct.unpack("<I", charsmap[:4])[0]
            units = struct.unpack(f"<{size // 4}I", charsmap[4 : 4 + size])
            self._read(units, charsmap[4 + size :])

    def _read(self, units: tuple[int, ...], pool: bytes) -> None:
        """All keys of the double-array trie, with what they are rewritten to."""

        def base(unit: int) -> int:
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)

        todo = [(base(units[0]), b"")]
        while todo:
            at, key = todo.pop()
            for label in range(1, 256):
                to = at ^ label
                if to >= len(units) or units[to] & 0x800000FF != label:
                    continue
                here, name = to ^ base(units[to]), key + bytes([label])
                if (units[to] >> 8) & 1:
                    start = units[here] & 0x7FFFFFFF
                    self.rewrites[name] = pool[start : pool.index(b"\0", start)]
                    self.longest = max(self.longest, len(name))
                todo.append((here, name))

    def __call__(self, text: str) -> str:
        if self.rewrites:
            raw, out, pos = text.encode("utf-8", "replace"), [], 0
            while pos < len(raw):
                for size in range(min(self.longest, len(raw) - pos), 0, -1):
                    got = self.rewrites.get(raw[pos : pos + size])
                    if got is not None:
                        out.append(got)
                        pos += size
                        break
                else:
                    size = 1
                    while pos + size < len(raw) and raw[pos + size] & 0xC0 == 0x80:
                        size += 1
                    out.append(raw[pos : pos + size])
                    pos += size
            text = b"".join(out).decode("utf-8", "replace")
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        if self.prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.mark else text


class _Recent(dict):
    """A bounded memory of two generations: a full one becomes the older, whose
    entries come back when they are asked for."""

    def __init__(self, most: int):
        super().__init__()
        self.older: dict = {}
        self.most = most

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key):
        got = self.older.get(key)
        if got is not None:
            self.keep(key, got)
        return got


class _Paths(_Recent):
    """The paths of short parts, found when first asked for."""

    def __init__(self, machine: Codec):
        super().__init__(REMEMBERED)
        self.machine = machine

    def __missing__(self, part: str) -> tuple[int, ...]:
        got = self.older.get(part)
        if got is None:
            got, spelled = self.machine.traced(part)
            if not spelled and self.machine.decoded(got) != part:
                self.machine.lossy = True  # not remembered, so that every text hears of it
                return got
        if len(part) <= SHORT:
            self.keep(part, got)
        return got


class Codec:
    """A compiled model: :meth:`encode` and :meth:`decode`."""

    def __init__(self, model: bytes):
        pieces, trainer, normaliser = [], b"", b""
        for number, value in _fields(model):
            if number == 1:
                pieces.append(self._piece(bytes(value)))
            elif number == 2:
                trainer = bytes(value)
            elif number == 3:
                normaliser = bytes(value)
        self._build(pieces, int(next((v for k, v in _fields(trainer) if k == 3), UNIGRAM)), Normaliser(normaliser))

    @classmethod
    def of(cls, pieces: list[tuple[str, float, int]], kind: int, normaliser: Normaliser | None = None) -> Codec:
        """A codec from (piece, score, kind) in the order of their ids."""
        self = cls.__new__(cls)
        self._build(pieces, kind, normaliser or Normaliser(b""))
        return self

    @staticmethod
    def _piece(data: bytes) -> tuple[str, float, int]:
        text, score, kind = "", 0.0, NORMAL
        for number, value in _fields(data):
            if number == 1:
                text = bytes(value).decode("utf-8")
            elif number == 2:
                score = struct.unpack("<f", value)[0]
            elif number == 3:
                kind = value
        return text, score, kind

    def _build(self, pieces: list[tuple[str, float, int]], kind: int, normaliser: Normaliser) -> None:
        self.kind, self.normaliser = kind, normaliser
        self.text = [p[0] for p in pieces]
        self.type = [p[2] for p in pieces]
        self.score = [p[1] for p in pieces]
        self.sizes = [*map(len, self.text)]
        self.unknown = next((i for i, t in enumerate(self.type) if t == UNKNOWN), 0)
        usable = [i for i, t in enumerate(self.type) if t in (NORMAL, USER_DEFINED)]
        self.ids = {self.text[i]: i for i in usable}
        self.bytes_ = {int(self.text[i][3:5], 16): i for i, t in enumerate(self.type) if t == BYTE}
        self.fallback = len(self.bytes_) == 256
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        self.worst = min((self.score[i] for i in usable), default=0.0) - UNKNOWN_COST
        # Text may be cut before a space mark that no piece continues into.
        self.cuts = not any(SPACE in x.lstrip(SPACE) for x in self.ids)
        # And between letters and other characters, if no piece has both (but for the marks it starts with).
        self.cut = _PARTS if any(_ACROSS.search(x.lstrip(SPACE)) for x in self.ids) else _LETTER_PARTS
        self.plain = [x if t not in (BYTE, UNKNOWN, CONTROL) else None for x, t in zip(self.text, self.type, strict=True)]
        self.pairs: dict[int, bool] = {}
        self.starts = _Recent(REMEMBERED_STARTS)  # lists of the last pieces up to every place
        self.paths = _Paths(self)
        self.lossy = False
        if kind == BPE:
            # Order of the merges: single characters are there from the start.
            order = sorted(usable, key=lambda i: -self.score[i])
            self.rank = dict.fromkeys(usable, -1)
            self.rank.update((i, r) for r, i in enumerate(order) if len(self.text[i]) > 1)
            self.split = {i: self._split(self.text[i]) for i in usable if len(self.text[i]) > 1}
            # Pieces whose merges come about in the order of their ranks.
            self.ordered = {i for i in usable if len(self.text[i]) == 1}
            for i in order:
                parts = self.split.get(i)
                if parts and self.ordered.issuperset(parts) and self.rank[i] > max(map(self.rank.get, parts)):
                    self.ordered.add(i)
        # The piece transducer, read from the end of a piece: every end of a
        # piece is a state; -1 where it is no piece that can be used.
        self.ends: dict[str, int] = {}
        for x, i in self.ids.items():
            for k in range(1, len(x)):
                self.ends.setdefault(x[k:], -1)
            if kind != BPE or self.rank[i] < 0 or self.split[i] is not None:
                self.ends[x] = i

    def _split(self, piece: str) -> tuple[int, int] | None:
        """The two pieces whose merge gives ``piece`` out of its characters;
        None if merging them ends elsewhere."""
        symbols = self.merged(piece, 2)
        a, b = (self.ids.get(x) for x in symbols) if len(symbols) == 2 else (None, None)
        return None if a is None or b is None else (a, b)

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merge neighbours by rank, the leftmost of equals first, until none
        joins or ``least`` symbols are left."""
        symbols = [*text]
        while len(symbols) > least:
            best, at = -INF, -1
            for i in range(len(symbols) - 1):
                k = self.ids.get(symbols[i] + symbols[i + 1])
                if k is not None and self.score[k] > best:
                    best, at = self.score[k], i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def forget(self) -> None:
        """Drop the remembered paths, starts and pairs."""
        for kept in (self.paths, self.paths.older, self.starts, self.starts.older, self.pairs):
            kept.clear()

    # -- weights ---------------------------------------------------------
    def follows(self, a: int, b: int) -> bool:
        """Whether piece ``b`` after piece ``a`` weighs 0 (else infinite).

        The merges of both are undone from the last: between them stand the
        last symbol ``x`` of ``a`` and the first symbol ``y`` of ``b``. If
        these join in a merge that ranks before the one that used up ``x`` or
        ``y``, the pieces would not have come about. Of equal ranks the left
        merge is first: inside ``a`` before the joint, the joint before ``b``.
        """
        x, y = a, b
        limit: float = INF
        got = a in self.ordered and b in self.ordered
        if not got:  # ranks do not tell the order of these merges
            got = self.merged(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
            x = y = -1
        while x >= 0:
            joint = self.ids.get(self.text[x] + self.text[y])
            if joint is not None and self.rank[joint] < limit:
                got = False
                break
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                limit, x = rx, self.split[x][1]
            else:
                limit, y = ry + 0.5, self.split[y][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[a << 32 | b] = got
        return got

    # -- composition and shortest path -------------------------------------
    def arcs(self, text: str, end: int) -> Iterator[tuple[int, int]]:
        """The arcs into ``end``: (start, piece) for the pieces that stand
        before it, and (end - 1, -1), byte fallback, if its last character is
        no piece."""
        ends, at = self.ends, end - 1
        if text[at] not in self.ids:
            yield at, -1
        while at >= 0 and (k := ends.get(text[at:end])) is not None:
            if k >= 0:
                yield at, k
            at -= 1

    def _lightest(self, text: str) -> list[int]:
        """The last piece of the lightest path to every place of a text."""
        n = len(text)
        cost, last = [0.0] + [INF] * n, [-1] * (n + 1)
        for end in range(1, n + 1):
            for at, k in self.arcs(text, end):
                total = cost[at] - (self.worst if k < 0 else self.score[k])
                if total < cost[end]:
                    cost[end], last[end] = total, k
        return last

    def _weightless(self, text: str) -> list[int]:
        """The same where weights are 0 or infinite: an arc counts if its piece
        follows the last piece before it, and there is one such arc only."""
        ends, pairs, ids, starts = self.ends, self.pairs, self.ids, self.starts
        n, last = len(text), None
        if n <= SHORT:  # texts with a common start share the paths through it
            for size in STARTS:
                if n > size and (last := starts[text[:size]]) is not None:
                    break
        last = [-1] if last is None else last.copy()
        for end in range(len(last), n + 1):
            best, at = -1, end - 1
            if text[at] in ids:
                while at >= 0:
                    k = ends.get(text[at:end])
                    if k is None:
                        break
                    if k >= 0:
                        prior = last[at]
                        if prior < 0:
                            best = k
                            break
                        fits = pairs.get(prior << 32 | k)
                        if self.follows(prior, k) if fits is None else fits:
                            best = k
                            break
                    at -= 1
            last.append(best)
            if end in STARTS and n <= SHORT:
                starts.keep(text[:end], last.copy())
        return last

    def path(self, text: str) -> tuple[int, ...]:
        """Pieces of the shortest path through ``text``, already normalised."""
        return self.traced(text)[0]

    def traced(self, text: str) -> tuple[tuple[int, ...], bool]:
        """The same, and whether the pieces spell all of ``text``, none being
        put for a character that is no piece."""
        last = self._weightless(text) if self.kind == BPE else self._lightest(text)
        out: list[int] = []
        at, sizes, spelled = len(text), self.sizes, True
        while at:
            k = last[at]
            if k >= 0:
                out.append(k)
                at -= sizes[k]
                continue
            at -= 1
            spelled = False
            if self.fallback:
                out.extend(self.bytes_[b] for b in reversed(text[at].encode("utf-8", "replace")))
            else:
                out.append(self.unknown)
        out.reverse()
        return tuple(out), spelled

    def parts(self, text: str) -> list[str]:
        """Cut a normalised text where no piece can cross: before the space
        marks that start a piece, between letters and other characters."""
        return self.cut.findall(text) if self.cuts else [text]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for null or empty."""
        return self.encoded(text)[0]

    def encoded(self, text: str | None) -> tuple[list[int], bool]:
        """(ids, whether decoding them gives the normalised text again). Each
        part is decoded when its path is found; where all give themselves again
        the decoded text is the normalised one."""
        marked = self.normaliser(text) if text else ""
        if not marked:
            return [], True
        self.lossy = False
        ids = [*chain.from_iterable(map(self.paths.__getitem__, self.parts(marked)))]
        if self.fallback and not self.lossy:
            again = self._unmarked(marked)
        else:
            again = self.decode(ids)
        return ids, again == text or self.normaliser(again) == marked

    def decoded(self, ids: tuple[int, ...] | list[int]) -> str:
        """Pieces and bytes joined; control pieces give nothing."""
        pieces = [*map(self.plain.__getitem__, ids)]
        if None not in pieces:
            return "".join(pieces)
        out = bytearray()
        for k in ids:
            kind = self.type[k]
            if kind == BYTE:
                out.append(self.byte_of[k])
            elif kind == UNKNOWN:
                out += b" \xe2\x81\x87 "
            elif kind != CONTROL:
                out += self.text[k].encode("utf-8")
        return out.decode("utf-8", "replace")

    def _unmarked(self, text: str) -> str:
        if self.normaliser.mark:
            text = text.replace(SPACE, " ")
        return text[1:] if self.normaliser.prefix and text[:1] == " " else text

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces and bytes joined, marks to spaces, the mark
        put before the text taken off; control pieces give nothing."""
        return self._unmarked(self.decoded(ids))


_CODECS: dict[str, Codec] = {}


def codec(model: bytes) -> Codec:
    """The compiled model; a task's process compiles it once."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _forget() -> None:
    """Drop what the compiled model remembers of texts; the model itself stays."""
    for machine in _CODECS.values():
        machine.forget()


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver; its size is checked, as it goes
    to every executor."""
    with open(path, "rb") as f:
        model = f.read(MOST_MODEL_BYTES + 1)
    if len(model) > MOST_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MOST_MODEL_BYTES} bytes")
    return model


def encode_texts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``ids`` (array of int), ``n_tokens`` and
    ``decodes`` (whether decoding the ids gives the normalised text again).

    ``model`` is the path of a model file. Null text has null ids, no tokens
    and null ``decodes``; an empty text has no ids and decodes. Whole texts are
    encoded, of any length, cut only where no piece can cross; an empty table
    gives an empty one. Rows are treated
    one by one, so ties, repeats and order do not matter; other columns pass
    through and clashing names get an underscore before the new one. One pass
    without a shuffle; a task remembers a bounded number of word paths.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_model(model))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(sent.value)
        for batch in batches:
            texts = batch.column(at)
            for lo, hi in chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHUNK):
                flat, ends, none, same = array("i"), [0], [], []
                for x in texts.slice(lo, hi - lo).to_pylist():
                    ids, again = machine.encoded(x)
                    flat.extend(ids)
                    ends.append(len(flat))
                    none.append(x is None)
                    same.append(None if x is None else again)
                offsets = np.array(ends, dtype=np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.frombuffer(flat, dtype=np.int32)), mask=pa.array(none, pa.bool_())
                )
                new = [lists, pa.array(np.diff(offsets).astype(np.int64)), pa.array(same, pa.bool_())]
                yield batch_of(batch.slice(lo, hi - lo).columns, new)

    return with_computed(docs, tidy(run, _forget), {"ids": "array<int>", "n_tokens": "long", "decodes": "boolean"})


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The columns of ``rows`` with the text of their ids in ``into`` (null
    ids: null)."""
    sent = rows.sparkSession.sparkContext.broadcast(read_model(model))
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(sent.value)
        for batch in batches:
            got = [None if k is None else machine.decode(k) for k in batch.column(at).to_pylist()]
            yield batch_of(batch.columns, [pa.array(got, pa.string())])

    return with_computed(rows, run, {into: "string"})
