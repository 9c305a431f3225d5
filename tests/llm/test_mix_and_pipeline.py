import os
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_data import awkward, awkward_rows, words
from nimbusframe.llm import mixing, order_minhash, quality
from nimbusframe.llm.suite import ORACLE, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"


def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: 3 * sizes[s] for s in over})


@pytest.mark.parametrize("clash", [False, True])
def test_mix_of_awkward_rows(spark, clash):
    rows = awkward_rows()
    got = mixing.mix(awkward(spark, clash)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets_by_hand(sizes)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], len(words(r[1]))) for r in rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, target in want.items():
        assert abs(taken[s] - target) <= 30
    again = mixing.mix(awkward(spark, clash).repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_mix_without_words_or_rows(spark):
    assert mixing.mix(awkward(spark, rows=[])).count() == 0
    got = mixing.mix(awkward(spark, rows=[(1, None, "en", "a", 1), (2, "", "en", None, 1)])).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_blocks_of_a_coarse_schedule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(docs, blocks=15).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w"), F.sum("size").alias("n"))
    assert all(abs(r["t"] - r["w"]) <= r["n"] / 15 / 2 + 15 for r in got.collect())
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(docs).where("size > 0").collect()}
    copies = Counter(r["doc_id"] for r in rows.select("doc_id").collect())
    assert all(abs(copies[i] - x) <= 0.5 for i, x in taken.items())


@pytest.mark.parametrize("weights", [(5, 2, 1), (4_000_000, 7, 1)])
def test_small_sources_of_a_large_corpus(spark, weights):
    """Sources of 1e-7 and more of all words, smaller than a block and a few
    blocks, capped at three passes or below that."""
    big = spark.range(100).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x ', 200000)").alias("text"), F.lit("a").alias("source")
    )
    small = [(1000 + i, "y " * n, source) for source, n in (("b", 1), ("c", 9), ("e", 43), ("f", 700)) for i in (0, 1)]
    docs = big.unionByName(spark.createDataFrame(small, "doc_id long, text string, source string"))
    sizes = {"a": 20_000_000, "b": 2, "c": 18, "e": 86, "f": 1400}
    got = mixing.mix(docs, weights=weights).collect()
    assert len(got) == 108 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert {s for s in sizes if target[s] < 3 * sizes[s]} > {"a"} or weights == (5, 2, 1)
    for s in "bcef":
        assert abs(taken[s] - target[s]) <= 0.5
    assert abs(taken["a"] - target["a"]) <= 1e-4 * target["a"]
    copies = Counter(r["source"] for r in mixing.mixed_documents(docs, weights=weights).select("source").collect())
    if weights == (5, 2, 1):
        assert all(copies[s] == 6 for s in "bcef")


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_queries_like_their_sql(spark, name, sf):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
    import oracle_check

    sf_dir = f"/root/testdata/sf{sf}"
    ok, _, _, detail = oracle_check.compare(spark, oracle_check.duck(sf_dir), name, QUERIES[name], ORACLE[name], sf_dir)
    assert ok, detail


def test_every_operator_has_one_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage, written and read again, against what its operator says of
    its own input; the brute-force versions of the operators are in the other
    test files."""
    import sentencepiece

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{k}")
        tables.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(t.columns == docs.columns for t in tables[:5])
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert Counter(r["doc_id"] for r in tables[1].collect()) == Counter(i for i, kept in judged.items() if kept)
    from test_deduplication import classes_by_hand, lines_by_hand

    before = [tuple(r) for r in tables[1].collect()]
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in tables[2].collect()}
    n_chars = {r[0]: r[4] for r in before}
    want = {i: (x, len(x) if cut else n_chars[i]) for i, x, _, cut in lines_by_hand(before) if words(x) or not cut}
    assert after == want
    rows = [tuple(r) for r in tables[2].collect()]
    assert sorted(r["doc_id"] for r in tables[3].collect()) == sorted(i for i, c, kept in classes_by_hand(rows) if kept)
    taken = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(tables[3]).where("size > 0").collect()}
    assert Counter(r["doc_id"] for r in tables[4].collect()) == Counter({i: n for i, n in taken.items() if n})
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in tables[5].collect():
        assert r["ids"] == sp.encode(r["text"]) and r["decodes"]
    run = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["ids"]) for r in run.collect()) == sorted((r["doc_id"], r["ids"]) for r in tables[5].collect())


def test_pipeline_on_awkward_and_empty_input(spark):
    import corpus_pipeline

    for rows in (awkward_rows(), []):
        docs = awkward(spark, clash=True, rows=rows)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns, k
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() <= 3 * len(rows)
    assert order_minhash.keep_one(awkward(spark, rows=[])).count() == 0
