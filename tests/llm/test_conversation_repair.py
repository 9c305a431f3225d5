"""Conversation repair against enumeration and a plain version of the whole contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from nimbusframe.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?\Z")


def enumerated(codes):
    """Cheapest (cost, audit) over all edit sequences with up to two insertions at each place."""
    best = (10**9, "")
    inserts = ["", "u", "a", "ua", "au"]
    for kept in itertools.product(range(4), repeat=len(codes)):  # 0 keep, 1 to u, 2 to a, 3 delete
        if any(e != 3 and c & cr.MUST_GO for e, c in zip(kept, codes)):
            continue
        for extra in itertools.product(inserts, repeat=len(codes) + 1):
            cost, audit, roles = 0, "", ""
            for i in range(len(codes) + 1):
                cost, audit, roles = cost + 2 * len(extra[i]), audit + "I" * len(extra[i]), roles + extra[i]
                if i < len(codes):
                    e, c = kept[i], codes[i]
                    cost += (0, 2, 2, 3)[e] + (1 if c & cr.CUT_OFF and e != 3 else 0)
                    audit += "KRRD"[e]
                    roles += ("suax"[c & 3], "u", "a", "")[e]
            if GOOD.match(roles):
                best = min(best, (cost, audit))
    return best


def labelled(codes):
    """The same by one table from left to right, for longer conversations."""
    far = (10**9, "")
    p = [(0, ""), far, far, far]

    def closed(p):
        plus = lambda x, s: (x[0] + 2 * len(s), x[1] + s)
        return [p[0], p[1], min(p[2], plus(p[0], "I"), plus(p[1], "I"), plus(p[3], "I")),
                min(p[3], plus(p[2], "I"), plus(p[0], "II"), plus(p[1], "II"))]

    for c in codes:
        p = closed(p)
        t = 1 if c & 8 else 0
        new = [(x[0] + 3, x[1] + "D") for x in p]
        if not c & 4:
            step = lambda x, keep: (x[0] + t + (0 if keep else 2), x[1] + ("K" if keep else "R"))
            if c & 3 == 0:
                new[1] = min(new[1], step(p[0], True))
            new[2] = min(new[2], *(step(p[q], c & 3 == 1) for q in (0, 1, 3)))
            new[3] = min(new[3], step(p[2], c & 3 == 2))
        p = new
    p = closed(p)
    return min(p[0], p[3])


def test_search_equals_enumeration():
    for n in range(4):
        for classes in itertools.product((0, 1, 2, 3, 5, 9, 10), repeat=n):
            assert cr.cheapest_edits(bytes(classes)) == enumerated(classes) == labelled(classes), classes


def test_search_equals_a_table_on_long_conversations():
    rng = random.Random(5)
    for n in [5, 8, 20, 60, 200, 1500]:
        for _ in range(40 if n < 300 else 2):
            codes = bytes(rng.choice((0, 1, 2, 1, 2, 1, 2, 3, 5, 6, 9, 10, 11)) for _ in range(n))
            assert cr.cheapest_edits(codes) == labelled(codes)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 4, "user", "And?"),
    (2, 0, "user", "a."), (2, 1, "user", "b"), (2, 2, "user", "a."), (2, 3, None, "c."), (2, 3, "assistant", None),
    (3, None, "assistant", " \n"), (3, 5, "tool", "x.  "), (3, 5, "tool", "x.  "), (3, 2, "", "end "),
    (None, 1, "user", "No id."), (None, 1, "assistant", "Same."), (None, None, "user", "No id."),
    (4, 0, "assistant", "long " * 200_000), (4, 1, "user", "."), (5, None, None, None),
    *((6, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(300)),
    *((7, t, ("user", "assistant")[t % 3 > 0], f"{t % 50}" + "." * (t % 4)) for t in range(300)),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows, damage):
    """The contract, plainly."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own.extend([(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1))
    out = {}
    for conv, own in convs.items():
        key = lambda m: hashlib.md5("\0".join([str(len(m[1])), m[1], m[2]]).encode()).digest()
        own.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], key(m)))
        faults, seen = [], set()
        for _, role, text in own:
            body = text.rstrip("\x20\t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        codes = [{"s": 0, "u": 1, "a": 2}.get(m[1][:1], 3) + (4 if f in ("blank", "duplicate") else 8 if f else 0)
                 for m, f in zip(own, faults)]
        cost, audit = labelled(codes)
        turns = [m[0] for m in own if m[0] is not None]
        lines, at, odd = [], iter(own), len(audit.replace("D", "")) % 2
        for letter in audit:
            m = None if letter == "I" else next(at)
            if letter != "D":
                role = m[1] if letter == "K" else ("user", "assistant")[(len(lines) - odd) % 2]
                lines.append(role + ":" + (m[2] if m else ""))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("damage", [False, True])
def test_whole_contract(spark, damage):
    from pyspark.sql import functions as F

    rows = ROWS + ROWS[4:12]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("conv", "key", "fault", "n", "part", "audit", "copy", "what", "a.b"):
        df = df.withColumn(name, F.lit(1))
    found = cr.digests(cr.damaged(df) if damage else df)
    got = cr.with_all(df, found).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows, damage)


def test_repaired_messages(spark):
    df = spark.createDataFrame(ROWS[:13], SCHEMA)
    plans, messages = cr.repaired(df)
    by = {}
    for r in sorted(messages.collect(), key=lambda r: (r.conv_id, r.place)):
        by.setdefault(r.conv_id, []).append((r.edit, r.turn, r.role, r.text))
    assert by[1] == [("K", 0, "system", "Be kind."), ("K", 1, "user", "Hi!"), ("K", 2, "assistant", "Hello."),
                     ("K", 4, "user", "And?"), ("I", None, "assistant", "")]
    for conv, own in by.items():
        assert GOOD.match("".join(m[2][0] for m in own))
    audits = {r.conv_id: r.audit for r in plans.collect()}
    assert all(audits[c].replace("D", "") == "".join(m[0] for m in own) for c, own in by.items())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cr.with_all(df, cr.digests(cr.damaged(df))).collect() == []
    assert cr.repaired(df)[1].collect() == []
