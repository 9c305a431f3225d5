import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_data import awkward, awkward_rows, sentence, words
from nimbusframe.llm import common, line_dedup, order_minhash, pivot_index, substring_dedup
from nimbusframe.llm.common import components

key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")


# -- lines ---------------------------------------------------------------
def lines_by_hand(rows):
    places = defaultdict(list)
    cut = [set() for _ in rows]
    for i, r in enumerate(rows):
        at = [k for k, x in enumerate((r[1] or "").split("\n")) if x.strip(" \t\r\x0b\x0c")]
        split = (r[1] or "").split("\n")
        for a, b, c in zip(at, at[1:], at[2:]):
            places[tuple(split[k].strip(" \t\r\x0b\x0c") for k in (a, b, c))].append(((r[0] is None, r[0] or 0, a), i, a, c))
    for found in places.values():
        first = min(p[0] for p in found)
        for place, i, a, c in found:
            if place > first:
                cut[i] |= set(range(a, c + 1))
    out = []
    for r, gone in zip(rows, cut):
        if r[1] is None:
            out.append((r[0], None, 0, 0))
            continue
        split = r[1].split("\n")
        out.append((r[0], "\n".join(x for k, x in enumerate(split) if k not in gone), len(split), len(gone)))
    return sorted(out, key=key)


@pytest.mark.parametrize("clash", [False, True])
def test_lines_like_brute_force(spark, clash):
    rows = awkward_rows()
    got = line_dedup.dedup_lines(awkward(spark, clash))
    assert got.columns[: 5] == ["doc_id", "text", "lang", "source", "n_chars"]
    n, cut = got.columns[-2:]
    assert (n, cut) == (("_n_lines", "_n_removed") if clash else ("n_lines", "n_removed"))
    out = sorted([(r["doc_id"], r["text"], r[n], r[cut]) for r in got.collect()], key=key)
    assert out == lines_by_hand(rows)


def test_lines_of_an_empty_table_and_one_hot_window(spark):
    empty = awkward(spark, rows=[])
    assert line_dedup.dedup_lines(empty).count() == 0
    hot = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb\nc\n"), F.col("id").cast("string")).alias("text"))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(hot).collect()}
    assert got[0] == "a\nb\nc\n0" and all(got[i] == str(i) for i in range(1, 300))


def test_documents_without_words_left_go(spark):
    rows = [(1, "a b\nc d\ne f", None, None, 11), (2, "a b\nc d\ne f", None, None, 11), (3, "", None, None, 0)]
    got = line_dedup.mended_documents(awkward(spark, rows=rows))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()) == [(1, "a b\nc d\ne f", 11)] or sorted(
        (r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()
    ) == [(1, "a b\nc d\ne f", 11), (3, "", 0)]


# -- substrings ------------------------------------------------------------
def substrings_by_hand(rows, length):
    first = defaultdict(list)
    for r in rows:
        w = words(r[1])
        if r[0] is not None:
            for i in range(len(w) - length + 1):
                first[tuple(w[i : i + length])].append(r[0])
    least = {k: min(v) for k, v in first.items()}
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        if r[0] is not None:
            for i in range(len(w) - length + 1):
                if least[tuple(w[i : i + length])] < r[0]:
                    gone |= set(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


@pytest.mark.parametrize("length", [50, 7])
def test_substrings_like_brute_force(spark, length):
    rng = random.Random(length)
    rows = awkward_rows()
    pool = [sentence(rng, rng.randrange(3, 80), ["a", "b"]) for _ in range(6)]
    for i in range(40):
        rows.append((100 + rng.randrange(30), " ".join([rng.choice(pool), sentence(rng, 5), rng.choice(pool)]), "en", "s", 1))
    got = substring_dedup.dedup_substrings(awkward(spark, clash=True, rows=rows), length=length, bucket=2000)
    out = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    assert out == substrings_by_hand(rows, length)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "text"]


def test_substrings_of_an_empty_table(spark):
    assert substring_dedup.dedup_substrings(awkward(spark, rows=[])).count() == 0


def test_rolling_hashes_tell_windows_apart():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 4, 5000).astype(np.uint64) * np.uint64(0x1234567890ABCDEF) + np.uint64(99)
    got = substring_dedup.rolling(h, 9, substring_dedup.BASES[0])
    windows = [tuple(h[i : i + 9].tolist()) for i in range(len(got))]
    assert len(set(windows)) == len(set(got.tolist())) == len(set(zip(windows, got.tolist())))


# -- near duplicates -----------------------------------------------------------
def test_alignment_like_the_table():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(rng.choice([2, 5, 300])) for _ in range(rng.randrange(0, 90))]
        b = [x for x in a if rng.random() > 0.1] if rng.random() < 0.7 else [rng.randrange(5) for _ in range(40)]
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j + 1], new[j], row[j] + (x == y)))
            row = new
        assert order_minhash.aligned(a, b, max(len(a), len(b))) == row[-1]
        n, m, c = len(a), len(b), row[-1]
        full = c / (n + m - c) if n + m - c else 0.0
        got = order_minhash.similarity(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == (pytest.approx(full) if full >= 0.8 else 0.0)


def classes_by_hand(rows):
    texts = sorted({r[1] for r in rows if words(r[1])})
    s = [order_minhash.shingles(order_minhash.hashed_words(t)) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if order_minhash.similarity(s[i], s[j]):
                root[find(i)] = find(j)
    number = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for r in rows:
        if r[1] in number and r[0] is not None:
            k = number[r[1]]
            least[k] = min(least.get(k, r[0]), r[0])
    out = []
    for r in rows:
        c = least.get(number[r[1]]) if r[1] in number else r[0]
        out.append((r[0], c, r[0] == c))
    return sorted(out, key=str)


def test_texts_of_eight_and_nine_words_share_a_tuple(spark):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        w = [rng.choice("abcdefghij" if i % 2 else "ab") for _ in range(9)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[1:] if i % 3 else w[:-1]))]
    got = order_minhash.sketch_texts(spark.createDataFrame(rows, "id long, text string").coalesce(1))
    sketch = {r["id"]: (r["n"], r["sketch"]) for r in got.collect()}
    shared = lambda x, y: any(a == b for a, b in zip(x, y)) or set(x[24:]) & set(y[24:])
    pairs = [(sketch[2 * i], sketch[2 * i + 1]) for i in range(3000)]
    assert {(x[0], y[0]) for x, y in pairs} == {(5, 4)}
    assert all(shared(x[1], y[1]) for x, y in pairs)


def test_one_shared_sketch_is_enough_in_a_crowd(spark):
    rng = random.Random(12)
    texts = []
    for k in range(8):
        own = sentence(rng, (8, 9, 12, 22, 40, 90, 160, 300)[k]).split() if k else ["same"] * 400
        for _ in range(25):
            w = list(own)
            for _ in range(rng.randrange(0, 1 + len(w) // 30 + (len(w) > 8))):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(w[: len(w) - rng.randrange(2)]))
    rows = [(i, x) for i, x in enumerate(dict.fromkeys(texts))]
    got = order_minhash.sketch_texts(spark.createDataFrame(rows, "id long, text string").coalesce(1)).collect()
    texts = dict(rows)
    s = {i: order_minhash.shingles(order_minhash.hashed_words(x)) for i, x in rows}
    tuples = defaultdict(list)
    for r in got:
        for j, h in enumerate(r["sketch"]):
            tuples[min(j, 24), h].append(r)
    found, want = set(), set()
    for (j, _), group in tuples.items():
        at = {"j": [j], "lo": [0], "hi": [0], "block": [0]}
        table = {k: v * len(group) for k, v in at.items()}
        table |= {"node": [r["id"] for r in group], "c": [r["id"] for r in group]}
        table |= {k: [r[k] for r in group] for k in ("n", "sketch")} | {"text": [texts[r["id"]] for r in group]}
        out = order_minhash._linked(pa.table(table))
        own = set(zip(*(out.column(c).to_pylist() for c in "ab")))
        assert len(own) < len(group)  # links that connect, not all
        found |= own
        ids = [r["id"] for r in group]
        want |= {(max(x, y), min(x, y)) for x in ids for y in ids if x < y and order_minhash.similarity(s[x], s[y])}
    assert len(want) > 200
    assert found <= want
    at = {i: i for i, _ in rows}
    for a, b in found:  # what is similar is connected
        old, new = at[a], at[b]
        at = {i: new if c == old else c for i, c in at.items()}
    assert all(at[a] == at[b] for a, b in want)
    few = [sum(p == q for p, q in zip(got[x]["sketch"][:24], got[y]["sketch"][:24])) < 3 for x, y in want]
    assert any(few)


@pytest.mark.parametrize("crowd", [24, 1])
def test_near_duplicates_like_brute_force(spark, crowd, monkeypatch):
    rng = random.Random(11)
    rows = awkward_rows()
    for k in range(12):  # groups of near copies that share a passage with the other groups
        own = (sentence(rng, 30) if k % 3 else "shared passage " * 10 + "of all") + " " + sentence(rng, 60)
        for j in range(rng.randrange(1, 7)):
            w = own.split()
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((100 + 10 * k + j, " ".join(w), "en", "s", 1))
    monkeypatch.setattr(order_minhash.link_texts, "__defaults__", (crowd,))
    got = order_minhash.near_duplicates(awkward(spark, clash=True, rows=rows)).select("doc_id", "class_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == classes_by_hand(rows)


def test_no_plan_holds_the_steps_of_others(spark, monkeypatch):
    rng = random.Random(21)
    rows = []
    for k in range(6):
        own = "shared passage " * 10 + "of all " + sentence(rng, 60)
        for j in range(4):
            w = own.split()
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((10 * k + j, " ".join(w), "en", "s", 1))
    steps = []

    def noted(df, run=common.checkpointed):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        steps.append(len(re.findall(r"\b(?:Join|Aggregate) ", plan)))
        return run(df)

    monkeypatch.setattr(common, "checkpointed", noted)
    monkeypatch.setattr(order_minhash, "checkpointed", noted)
    monkeypatch.setattr(order_minhash.link_texts, "__defaults__", (1,))
    got = order_minhash.near_duplicates(awkward(spark, rows=rows)).select("doc_id", "class_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == classes_by_hand(rows)
    assert max(steps) <= 8, steps  # the driver plans and keeps each of them


def test_one_of_each_class_stays(spark):
    rows = awkward_rows()
    kept = order_minhash.keep_one(awkward(spark, clash=True, rows=rows))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    got = Counter(r["doc_id"] for r in kept.collect())
    assert got[1] == 1 and not {2, 3, 12} & set(got)
    assert got[8] == got[9] == got[10] == 1 and got[None] == 2 and got[11] == 2
    assert order_minhash.near_duplicates(awkward(spark, rows=[])).count() == 0


# -- vectors --------------------------------------------------------------------
def test_vectors_like_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 24))
    x[300:600] = x[:300] + rng.normal(size=(300, 24)) * 0.2
    x[600:750] = x[0] + rng.normal(size=(150, 24)) * 0.05  # a large group
    x[750:800] = x[5]  # copies
    x[800:810] = x[6] * 3
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, [None] * 24, 1), (904, [], 1),
             (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (None, rows[0][1], 1), (907, [1e300] * 24, 1), (908, [1e-300] * 24, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int").repartition(3)
    got = {r["vec_id"]: r for r in pivot_index.link_vectors(df, block=64).collect()}
    u = {}
    for i, v, _ in rows:
        v = None if not v or None in v else np.array(v)
        if v is not None and np.isfinite(v).all() and np.abs(v).max() > 0:
            v = v / np.abs(v).max()
            u[i] = v / np.linalg.norm(v)
    names = list(u)
    linked = {i: {j for j in names if j != i and len(u[i]) == len(u[j]) and u[i] @ u[j] >= 0.95} for i in names}
    links = sum(map(len, linked.values()))
    found = sum(r["n_links"] for r in got.values())
    assert len(got) == len(rows) and 0.99 * links <= found <= links
    assert all(got[i]["n_links"] <= len(linked[i]) for i in names)
    for i in (900, 901, 902, 903, 904):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[906]["component_id"] == 905 and got[908]["component_id"] == 907
    assert got[None]["component_id"] == 0 and not got[None]["kept"] and got[805]["component_id"] == 6
    assert pivot_index.link_vectors(df.limit(0)).count() == 0


def test_recall_on_the_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    noise = F.transform("embedding", lambda c, i: c + 0.1 * F.sin(i + F.col("vec_id")) * F.aggregate(
        F.transform("embedding", lambda y: F.abs(y)), F.lit(0.0).cast("double"), lambda s, y: s + y) / 64)
    both = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).unionByName(
        df.select((F.col("vec_id") + 1_000_000).alias("vec_id"), noise.cast("array<double>").alias("embedding"))
    )
    got = both.join(pivot_index.link_vectors(both).withColumnRenamed("vec_id", "v"), F.col("vec_id") == F.col("v")).toPandas()
    x = np.stack(got.embedding)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.95).sum(1) - 1
    assert links.sum() >= 2000 and got.n_links.sum() >= 0.9 * links.sum()
    assert (got.n_links.to_numpy() <= links).all()


def test_components_like_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(900, i) for i in range(700, 800)] + [(None, 3), (4, 4)]
    root = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a int, b int")).collect()))
    linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked if find(x) != x}
