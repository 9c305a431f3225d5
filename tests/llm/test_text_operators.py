import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import awkward, awkward_rows, sentence, words
from nimbusframe.llm import common, html_text, language, piece_codec, quality, url_filter
from nimbusframe.llm.suite import PIECE_MODEL, URL_RULES

SF = "/root/testdata/sf0.001"


def test_words_and_chunks():
    for text in ("a  b\tc\r\nd", "x\x1cy z　w\x85v", "", None, " \x0b\x0c", "é\x1fé b"):
        assert common.words(text) == words(text)
    assert [*common.chunks([5, 5, 5, 100, 1], 10)] == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert [*common.chunks([], 10)] == []


# -- quality ---------------------------------------------------------------
def base_by_hand(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(marked), len(w) < 50 or 100 * len(marked) > 50 * len(w),
    )


def js_by_hand(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    return math.sqrt((kl(p) + kl(q)) / 2)


def test_quality_base_features_by_hand(spark):
    got = quality.judge(awkward(spark, clash=True)).toPandas()
    names = ["_n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = sorted(map(tuple, got[names].itertuples(index=False)))
    assert out == sorted(base_by_hand(r[1]) for r in awkward_rows())
    assert not got["_kept"][got.base_failed].any()
    assert quality.judge(awkward(spark, rows=[])).count() == 0


def test_repeats_do_not_cross_documents(spark):
    texts = ["a b c a b", "c d", "a b", "c a b c", "", "x y", "x y x y", "x", None, "a b c a b c", "a b c"]
    want = [base_by_hand(x)[4] for x in texts]
    assert want == [0, 0, 0, 0, 0, 0, 0, 0, 0, 6, 0]
    assert quality.assess(texts, {})["n_repeat_words"].tolist() == want
    assert [int(quality.assess([x], {})["n_repeat_words"][0]) for x in texts] == want
    docs = spark.createDataFrame([(i, x, None) for i, x in enumerate(texts)], "doc_id long, text string, lang string")
    for parts in (1, 4):
        got = quality.judge(docs.coalesce(1) if parts == 1 else docs.repartition(parts)).collect()
        assert [r["n_repeat_words"] for r in sorted(got, key=lambda r: r["doc_id"])] == want


def test_quality_verdicts_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    local = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    char, common_words = {}, {}
    for _, text, lang in local:
        w = words(text.lower())
        if len(w) >= 50:
            char[lang] = char.get(lang, 0) + quality.class_counts(text)
            common_words.setdefault(lang, Counter()).update(w)
    refs = {}
    for lang, c in common_words.items():
        top = sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON]
        refs[lang] = (dict(top), c.total() - sum(n for _, n in top))
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    for i, text, _ in local:
        w = [x.lower() for x in words(text)]
        far_c = min(js_by_hand(quality.class_counts(text), char[k]) for k in refs)
        far_w = 1.0
        for top, rest in refs.values():
            c = Counter(x for x in w if x in top)
            mine = [c[x] for x in top] + [len(w) - c.total()]
            far_w = min(far_w, js_by_hand(mine, [*top.values(), rest]))
        assert got[i]["js_chars"] == pytest.approx(far_c) and got[i]["js_words"] == pytest.approx(far_w)
        odd = len(w) >= 20 and far_c > quality.MOST_CHARS
        odd |= len(w) >= 50 and far_w > quality.MOST_COMMON + quality.BY_CHANCE / math.sqrt(len(w))
        assert got[i]["kept"] == (not base_by_hand(text)[-1] and not odd)


def test_quality_agrees_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").select("quality", "kept").toPandas()
    good, bad = got[got.quality == 1].kept, got[got.quality == 0].kept
    assert good.mean() >= 0.99 and bad.mean() <= 0.1


def test_rare_labels_are_no_reference(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    junk = [(10_000 + i, " ".join(f"Zq{i}x#{k}" for k in range(80)), lang) for i, lang in enumerate(["xx", None, *["yy"] * 5])]
    both = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    assert set(quality.references(both)) == set(quality.references(docs)) == {r["lang"] for r in docs.select("lang").dropna().distinct().collect()}
    got = {r["doc_id"]: r["kept"] for r in quality.judge(both).where("doc_id >= 10000").collect()}
    assert len(got) == 7 and not any(got.values())
    dirty = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("l"), "doc_id")).otherwise(F.col("lang")))
    assert len(quality.references(dirty)) <= 5
    model = language.learn(dirty)
    assert not any(k[1:].isdigit() for k in model.languages) and model.languages


def test_names_of_columns_do_not_matter(spark):
    docs = awkward(spark, clash=True)
    rows = len(awkward_rows())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() <= rows
    coded = piece_codec.encode_texts(docs, PIECE_MODEL)
    assert coded.columns == [*docs.columns, "_ids", "_n_tokens", "_decodes"]
    assert piece_codec.decode_ids(coded, PIECE_MODEL, "_ids", "a.b").columns[-1] == "_a.b"
    pages = docs.withColumn("url", F.lit("http://example.com/en/x")).withColumn("html", F.lit("<p>some text</p>"))
    got = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))
    assert got.columns == [*pages.columns, "_host", "_path", "_rule", "_verdict"]
    assert {tuple(r[-4:]) for r in got.collect()} == {("example.com", "/en/x", "example.com/en/", "block")}
    text = html_text.extract(pages)
    assert text.count() == rows and {r["_text_"] if "_text_" in text.columns else r[-2] for r in text.collect()} == {"some text"}


def test_quality_without_languages_keeps_the_base_rules(spark):
    docs = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    got = quality.judge(docs).toPandas()
    assert (got.kept == ~got.base_failed).all()
    assert quality.keep_good(docs).columns == docs.columns


# -- pieces ----------------------------------------------------------------------
def test_pieces_like_the_library_and_back(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(1)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [r[1] for r in awkward_rows() if r[1]]
    texts += [" " * n + "x" + "\n" * n for n in range(40)] + ["a" * n for n in range(0, 200, 7)]
    texts += ["".join(rng.choice("ab c\n  déß梦▁the in\x00\U0001f389") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    machine = piece_codec.Codec(piece_codec.read_model(PIECE_MODEL))
    for x, ids in zip(texts, sp.encode(texts)):
        assert machine.encode(x) == ids
        assert machine.decode(ids) == sp.decode(ids)


def test_pieces_in_spark(spark):
    docs = awkward(spark, clash=True)
    got = piece_codec.encode_texts(docs, PIECE_MODEL)
    assert got.columns[-3:] == ["_ids", "_n_tokens", "_decodes"]
    for r in got.collect():
        if r["text"] is None:
            assert (r["_ids"], r["_n_tokens"], r["_decodes"]) == (None, 0, None)
        else:
            assert r["_decodes"] and len(r["_ids"]) == r["_n_tokens"]
    back = piece_codec.decode_ids(got, PIECE_MODEL, ids="_ids")
    assert all(r["decoded"] == r["text"] for r in back.collect())
    assert piece_codec.encode_texts(awkward(spark, rows=[]), PIECE_MODEL).count() == 0


def test_unigram_pieces_by_enumeration():
    rng = random.Random(4)
    pieces = [("<unk>", 0.0, 2)] + [(x, -rng.random() * 9, 1) for x in ("a", "b", "ab", "ba", "aab", "bb", "abab", "▁", "▁a", "c")]
    plain = piece_codec.Normaliser(b"\x18\x00\x20\x00")
    machine = piece_codec.Codec.of(pieces, piece_codec.UNIGRAM, plain)
    score = {x: s for x, s, _ in pieces[1:]}
    worst = min(score.values()) - piece_codec.UNKNOWN_COST

    def best(text):
        if not text:
            return 0.0
        out = -math.inf if text[-1] in score else best(text[:-1]) + worst
        for x, s in score.items():
            if text.endswith(x):
                out = max(out, best(text[: -len(x)]) + s)
        return out

    for _ in range(200):
        text = "".join(rng.choice("abcz ") for _ in range(rng.randrange(0, 11)))
        ids = machine.encode(text)
        total = sum(worst if k == 0 else pieces[k][1] for k in ids)
        assert total == pytest.approx(best(text.replace(" ", "▁")))


def test_merges_by_brute_force():
    """Ranked merges of a made-up vocabulary: the path is what merging gives."""
    rng = random.Random(9)
    for _ in range(30):
        known = ["a", "b", "c"]
        while len(known) < 14:
            x = rng.choice(known) + rng.choice(known)
            if x not in known:
                known.append(x)
        pieces = [("<unk>", 0.0, 2)] + [(x, -float(i), 1) for i, x in enumerate(known)]
        machine = piece_codec.Codec.of(pieces, piece_codec.BPE, piece_codec.Normaliser(b"\x18\x00\x20\x00\x28\x00"))
        for _ in range(60):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 45)))
            assert [machine.text[k] for k in machine.encode(text)] == machine.merged(text)


def test_character_map():
    import struct

    # One key "A" -> "b": units of a double array, root offset 0x80.
    units = [0] * 512
    offset = lambda n: n << 10
    units[0] = offset(0x80)
    units[0x80 ^ 0x41] = 0x41 | (1 << 8) | offset((0x80 ^ 0x41) ^ 0x100)
    units[0x100] = 0x80000000 | 0
    table = struct.pack("<I", len(units) * 4) + struct.pack(f"<{len(units)}I", *units) + b"b\0"
    size = len(table)
    spec = b"\x12" + bytes([size & 0x7F | 0x80, size >> 7]) + table
    machine = piece_codec.Normaliser(spec)
    assert machine.rewrites == {b"A": b"b"} and machine("  xAé  A ") == "▁xbé▁b"


# -- pages ----------------------------------------------------------------------------
def test_main_text_is_the_article(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r["html"], re.S)[1]
        lines = re.sub(r"</?(?:p|h1)>", "\n", inner).replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        lines = [" ".join(x.split()) for x in html.unescape(lines).split("\n")]
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])


LONG = "A paragraph that is long enough to be a surge of text on a page, with a number of words in it."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p> </p>", ""), ("just\n  text &amp; more", "just text & more"),
        (f"<nav>Menu</nav><article><p>Short.</p><p>{LONG}</p><p>End.</p></article><footer>f</footer>", f"Short.\n{LONG}\nEnd."),
        (f"<body><div class='menu'><a href=x>Home</a></div><div id=main><h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>End</p></div>"
         f"<div class='comments'><p>{LONG}</p></div><div>Copyright</div></body>", f"T\n{LONG}\n{LONG}\nEnd"),
        (f"<article><header><h1>T</h1></header><p>{LONG}<script>var x='</p>';</script> a<br>b</p>"
         f"<aside>{LONG}</aside><form>{LONG}</form><!-- {LONG} --></article>", f"T\n{LONG} a b"),
        (f"<main><p>{LONG}<p>two &lt;b&gt; &eacute;&nbsp;&#33;<p>three</main><section class='cookie-notice'>{LONG}</section>",
         f"{LONG}\ntwo <b> é !\nthree"),
        (f"<article><p>{LONG}</p><p>cut <b", f"{LONG}\ncut"),
    ],
)
def test_main_text_by_hand(page, text):
    assert html_text.main_text(page) == text


BODY = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>End</p>"


@pytest.mark.parametrize(
    "page",
    [
        *(f"<body><div class='menu'>Home</div><div {a}>{BODY}</div><div class='footer'>f</div></body>" for a in (
            'style="overflow:hidden"', 'class="overflow-hidden"', 'class="content has-sidebar"', 'class="with-sidebar"',
            'class="post has-comments"', 'class="no-header menu-open"', "class=share", "class=form", "class=alert", "id=legal",
            "data-x='hidden'", "class='post form'")),
        f"<article class='post has-comments'>{BODY}</article><div class=comments><article>{LONG * 3}</article></div>",
        f"<div class=post><header class='entry-header'><h1>T</h1></header><p>{LONG}</p><p>{LONG}</p><p>End</p></div>",
        f"<article><div class='article-header'><h1>T</h1></div><p>{LONG}</p><p>{LONG}</p><p>End</p></article>",
        f"<form id=aspnet><nav>Menu</nav><div class=widget><main>{BODY}</main></div><div class=ad>{LONG}</div></form>",
        f"<div class='sidebar'><article>{BODY}</article></div>",
        f"<div id=main>{BODY}</div><div class=comments><p>{LONG * 9}</p></div>",
        f"<div id=main>{BODY}</div><div hidden>{LONG}</div><div style='display: none'>{LONG * 9}</div>",
    ],
)
def test_main_text_in_containers_of_loose_names(page):
    assert html_text.main_text(page) == f"T\n{LONG}\n{LONG}\nEnd"


def test_something_is_left_of_a_page():
    assert html_text.main_text(f"<nav>Menu</nav><div class=comments><p>{LONG}</p></div>") == LONG
    assert html_text.main_text("<nav>Menu</nav>") == "Menu"
    assert html_text.main_text(f"<div hidden><p>{LONG}</p></div>") == ""


def test_pages_with_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, None, "t"), (None, "u", "<p>" + "long text " * 30_000 + "</p>", "t"), (1, None, None, "t")],
        "page_id long, url string, html string, text string",
    )
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "_text", "n_chars"]
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, 299_999]
    assert html_text.extract(df.limit(0)).count() == 0


# -- URLs ---------------------------------------------------------------------------
def judged_by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [
        (len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_urls_like_brute_force(spark):
    rng = random.Random(3)
    rules = [*URL_RULES, ("block", "com", "/en"), ("block", "org", ""), ("allow", "b.org", "/x/y/z.htm"), ("block", "com", "/"),
             ("allow", "b.org", "/x//y")]
    urls = [None, "", "no scheme", "http://", "https://COM/", "http://com", "http://com?/", "x://y://z.com/en/", "http://b.org/x/y/z.html",
            "http://a.b.org/x//yes", "http://.com/a", "http://com./", "http://É.com/EN/", "http://" + "a." * 500 + "com/" + "en/" * 500]
    for _ in range(400):
        host = ".".join(rng.choice(["www", "example", "com", "net", "org", "b", "xcom"]) for _ in range(rng.randrange(1, 5)))
        path = "".join(rng.choice(["/", "en", "/en/", "es/", "/fr", "x", "?q", "#t"]) for _ in range(rng.randrange(0, 5)))
        urls.append(f"http://{host}{path}")
    urls += urls[:20]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id int, url string, rule string").repartition(4)
    for own in (URL_RULES, rules):
        got = url_filter.filter_urls(df, url_filter.rule_table(spark, own))
        assert got.columns == ["page_id", "url", "rule", "host", "path", "_rule", "verdict"]
        out = {r["page_id"]: (r["host"], r["path"], r["_rule"], r["verdict"]) for r in got.collect()}
        assert len(out) == len(urls)
        for i, u in enumerate(urls):
            assert out[i] == judged_by_hand(u, own), u
    none = url_filter.filter_urls(df, url_filter.rule_table(spark, []))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert url_filter.filter_urls(df.limit(0), url_filter.rule_table(spark, rules)).count() == 0


# -- languages -----------------------------------------------------------------------
def test_languages_of_held_out_documents(spark):
    from nimbusframe.llm.suite import QUERIES

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_language_id"](spark, sf).join(truth, "doc_id").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got[got.held_out].lang == got[got.held_out].lang_pred).mean() >= 0.98


def test_spans_scripts_and_odd_rows(spark):
    latin = ["the cat and the dog were in the house with a bird", "this is an old story that was told by the people"]
    other = ["el perro y el gato estaban en la casa con un pájaro", "esta es una vieja historia que contaba la gente"]
    greek = ["ο σκύλος και η γάτα ήταν στο σπίτι", "αυτή είναι μια παλιά ιστορία"]
    rows = [(i, x, lang) for i, (x, lang) in enumerate([(x, k) for k, xs in (("en", latin), ("es", other), ("el", greek)) for x in xs * 5])]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["el", "en", "es"]
    assert [model.languages[k] for k in np.flatnonzero(model.candidates["greek"])] == ["el"]
    mixed = " ".join(latin) + ". " + " ".join(other) + "! " + greek[0]
    names, score, n, spans = language.label_texts(model, [mixed, None, "", "123 ² ½ !", greek[1], "梦梦"], spans=True)
    assert [s["lang"] for s in spans[0]] == ["en", "es", "el"] and n[0] == 3
    assert spans[0][0] == {"lang": "en", "first": 0, "last": 22} and spans[0][2]["first"] == 44
    assert names[1:4] == ["und"] * 3 and list(score[1:4]) == [0, 0, 0] and list(n[1:4]) == [0, 0, 0]
    assert names[4] == "el" and score[4] == 1 and names[5] in model.languages
    got = language.predict(awkward(spark, clash=True), model, spans=True)
    assert got.columns[-4:] == ["_lang_pred", "_score", "n_spans", "spans"] and got.count() == len(awkward_rows())
    nothing = language.learn(awkward(spark, rows=[]))
    assert {r["lang_pred"] for r in language.predict(awkward(spark), nothing).collect()} == {"und"}


def test_viterbi_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    model = language.Model({"a": np.ones(language.CELLS), "b": np.ones(language.CELLS), "c": np.ones(language.CELLS)},
                           {k: Counter(latin=1) for k in "abc"})
    for sizes in ([3, 0, 6, 1], [5], [0], [6, 6]):
        sizes = np.array(sizes)
        n = int(sizes.sum())
        model.rows = -rng.integers(0, 30, (n, 3)).astype(np.float32)
        got = model.label(sizes, np.arange(n))
        start = 0
        for size in sizes:
            rows = model.rows[start : start + size]
            cost = lambda p: sum(rows[i, k] for i, k in enumerate(p)) - language.SWITCH * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731,B023
            best = max(map(cost, product(range(3), repeat=int(size))))
            assert cost(got[start : start + size].tolist()) == pytest.approx(best)
            start += size


def test_remembered_paths_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 20)
    monkeypatch.setattr(piece_codec, "REMEMBERED_STARTS", 10)
    model = piece_codec.read_model(PIECE_MODEL)
    machine, rng = piece_codec.Codec(model), random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 11))) for _ in range(30)) for _ in range(20)]
    first = [machine.encode(x) for x in texts]
    for kept, most in ((machine.paths, 20), (machine.starts, 10)):
        assert 0 < len(kept) <= most and 0 < len(kept.older) <= most
    machine.forget()
    assert not (machine.paths or machine.paths.older or machine.starts or machine.starts.older or machine.pairs)
    monkeypatch.setattr(piece_codec, "REMEMBERED", 1000)
    assert [machine.encode(x) for x in texts] == first == [piece_codec.Codec(model).encode(x) for x in reversed(texts)][::-1]


def test_texts_are_cut_where_no_piece_crosses():
    machine, rng = piece_codec.Codec(piece_codec.read_model(PIECE_MODEL)), random.Random(6)
    assert machine.parts("▁one.\nTwo***▁▁3é") == ["▁one", ".\n", "Two", "***", "▁▁3", "é"]
    for _ in range(300):
        text = "▁" + "".join(rng.choice("abeéñß▁.,\n*3×中") for _ in range(rng.randint(1, 20)))
        whole = machine.path(text)
        assert [k for x in machine.parts(text) for k in machine.path(x)] == [*whole]
        assert machine.traced(text)[1] == all(machine.plain[k] is not None for k in whole)
    # a piece of a letter and another character: only the marks cut
    plain = piece_codec.Normaliser(b"\x18\x00\x20\x00")
    mixed = piece_codec.Codec.of([("<unk>", 0.0, 2), ("a", -1.0, 1), (".", -2.0, 1), ("a.", -0.5, 1)], piece_codec.UNIGRAM, plain)
    assert mixed.parts("▁a.a▁a") == ["▁a.a", "▁a"] and [mixed.text[k] for k in mixed.encode("a.a")] == ["a.", "a"]
