"""The registered queries of the operators and their DuckDB SQL.

Each query applies its operator to a whole table and derives the columns that
its contract names. ``ORACLE`` has SQL where SQL can express the result; the
others are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusframe.llm import (
    conversation_repair,
    hard_negatives,
    html_text,
    language,
    line_dedup,
    mixing,
    order_minhash,
    piece_codec,
    pivot_index,
    quality,
    substring_dedup,
    suffix_dedup,
    url_filter,
)
from nimbusframe.session import read_table

#: The public piece model the tokenizing queries use.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Rules of the URL query (fixed by the task): verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from those with a language
    whose crc32(doc_id as text) mod 4 is not 2 (a null id is not held out)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.learn(docs.where(~held_out))
    told = language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return told.select("doc_id", "held_out", "lang_pred", "score", "n_spans")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features and verdicts of all documents."""
    return quality.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "js_chars", "js_words",
    )


@query
def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, and whether they decode to the text again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_codec.encode_texts(docs, PIECE_MODEL).select("doc_id", "n_tokens", "ids", "decodes")


@query
def op4_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return pivot_index.link_vectors(read_table(spark, sf_dir, "embeddings"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without passages that an earlier document has."""
    docs = read_table(spark, sf_dir, "documents")
    return substring_dedup.dedup_substrings(docs, with_text=False)


ORACLE["op5_substring_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t)),
firsts AS (SELECT s, min(doc_id) AS d FROM wins GROUP BY s HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM wins JOIN firsts USING (s) WHERE doc_id > d),
n AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM t),
kept AS (SELECT n.doc_id, count(gone.i) AS cut, string_agg(x, ' ' ORDER BY n.i) FILTER (WHERE gone.i IS NULL) AS s
    FROM n LEFT JOIN gone ON n.doc_id = gone.doc_id AND n.i = gone.i GROUP BY n.doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(cut, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page under :data:`URL_RULES`."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_filter"] = """
WITH rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (SELECT page_id, CASE WHEN coalesce(strpos(url, '://'), 0) = 0 THEN ''
    ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h0, rest FROM cut),
parts AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM split),
best AS (SELECT DISTINCT host, path, first(h || p ORDER BY length(h || p) DESC) OVER w AS rule,
    first(v ORDER BY length(h || p) DESC) OVER w AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    WINDOW w AS (PARTITION BY host, path))
SELECT page_id, a.host, a.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts a LEFT JOIN best b ON a.host = b.host AND a.path = b.path
"""


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later occurrences of repeated line windows."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


ORACLE["op8_line_dedup"] = r"""
WITH l AS (SELECT doc_id, t.i - 1 AS pos, string_split(text, chr(10))[t.i] AS line
    FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i) t),
marked AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x FROM l
    WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
w AS (SELECT doc_id, pos AS lo, lead(pos, 2) OVER d AS hi, x AS a, lead(x, 1) OVER d AS b, lead(x, 2) OVER d AS c
    FROM marked WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, lo) AS r
    FROM w WHERE hi IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM ranked WHERE r > 1),
marks AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS cut
    FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos),
done AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '') AS text,
    count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed FROM marks GROUP BY doc_id)
SELECT d.doc_id, done.text, coalesce(done.n_lines, 0) AS n_lines, coalesce(done.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN done ON d.doc_id = done.doc_id
"""


@query
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return order_minhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op10_source_mix"] = r"""
WITH sized AS (SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS shuffle FROM documents),
total AS (SELECT coalesce(sum(size), 0)::BIGINT AS n FROM sized),
src AS (SELECT source, sum(size)::BIGINT AS s,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, 3 * s AS most, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM src),
filled AS (SELECT *, most::DOUBLE / weight AS fills FROM weighed),
levels AS (SELECT *, ((SELECT n FROM total) - coalesce(sum(most) OVER (ORDER BY fills, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY fills, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM filled),
lvl AS (SELECT first(level ORDER BY fills, place) AS level FROM levels WHERE level <= fills),
shares AS (SELECT source, place, s, least(most::DOUBLE, coalesce(lvl.level * weight, most::DOUBLE)) AS target,
    least(s, 16384) AS blocks FROM levels LEFT JOIN lvl ON true),
counted AS (SELECT *, CASE WHEN s > 0 THEN (2 * round(target)::BIGINT * blocks + s) // (2 * s) ELSE 0 END AS slots FROM shares),
edges AS (SELECT *, sum(slots) OVER (ORDER BY place)::BIGINT AS hi, sum(slots) OVER ()::BIGINT AS alls FROM counted),
points AS (SELECT i, ((i::HUGEINT * 173961102589771 % 281474976710656) * (SELECT max(alls) FROM edges) // 281474976710656)::BIGINT AS pos
    FROM (SELECT unnest(range(0, 2 * coalesce(max(alls), 0))) AS i FROM edges)),
ranked AS (SELECT place, blocks, slots, row_number() OVER (PARTITION BY place ORDER BY i) - 1 AS rank
    FROM points JOIN edges ON pos >= hi - slots AND pos < hi),
times AS (SELECT place, rank % blocks AS block, count(*) AS times FROM ranked WHERE rank < least(slots, 3 * blocks) GROUP BY ALL),
streamed AS (SELECT doc_id, size, place, s, target, blocks, coalesce(sum(size) OVER (PARTITION BY place
    ORDER BY shuffle, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized JOIN edges ON sized.source IS NOT DISTINCT FROM edges.source),
pieces AS (SELECT *, unnest(range(((start + 1) * blocks - 1) // s, ((start + size) * blocks - 1) // s + 1)) AS b
    FROM streamed WHERE size > 0),
summed AS (SELECT doc_id, pieces.place, start,
    sum((least(start + size, (b + 1) * s // blocks) - greatest(start, b * s // blocks)) * coalesce(times, 0))::BIGINT AS taken
    FROM pieces LEFT JOIN times ON pieces.place = times.place AND pieces.b = times.block
    GROUP BY doc_id, pieces.place, start)
SELECT t.doc_id, t.size, t.s AS source_size, t.target, coalesce(c.taken, 0) AS taken
FROM streamed t LEFT JOIN summed c ON t.size > 0 AND t.place = c.place AND t.start = c.start
"""


@query
def op11_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without strings that an earlier document has."""
    return suffix_dedup.dedup_bytes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE["op11_suffix_array"] = """
WITH t AS (SELECT doc_id, row_number() OVER () AS uid, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
wins AS (SELECT uid, doc_id, i, array_to_string(b[i : i + 49], '') AS s
    FROM (SELECT uid, doc_id, b, unnest(range(1, len(b) - 48)) AS i FROM t)),
firsts AS (SELECT s, min(doc_id) AS d FROM wins GROUP BY s HAVING min(doc_id) <> max(doc_id)),
starts AS (SELECT uid, i FROM wins JOIN firsts USING (s) WHERE doc_id > d),
edges AS (SELECT *, lag(i) OVER (PARTITION BY uid ORDER BY i) AS before FROM starts),
spans AS (SELECT uid, lo, max(i) + 49 AS hi FROM (SELECT uid, i, max(CASE WHEN before IS NULL OR i > before + 50 THEN i END)
    OVER (PARTITION BY uid ORDER BY i) AS lo FROM edges) GROUP BY uid, lo),
cut AS (SELECT uid, list([lo, hi] ORDER BY lo) AS runs, count(*) AS n_spans, sum(hi - lo + 1)::BIGINT AS n_removed FROM spans GROUP BY uid),
kept AS (SELECT uid, b, n_spans, n_removed, flatten(list_transform(range(1, len(runs) + 2), lambda k:
    b[CASE WHEN k = 1 THEN 1 ELSE runs[k - 1][2] + 1 END : CASE WHEN k > len(runs) THEN len(b) ELSE runs[k][1] - 1 END])) AS left_ FROM cut JOIN t USING (uid))
SELECT t.doc_id, len(t.b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(array_to_string(coalesce(left_, t.b), ''))) AS kept_sha256
FROM t LEFT JOIN kept USING (uid)
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired messages of all conversations, damaged first."""
    given = read_table(spark, sf_dir, "conversations")
    found = conversation_repair.digests(conversation_repair.damaged(given))
    return conversation_repair.with_all(given, found)


ORACLE["op12_conversation_repair"] = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 20 AS what
    FROM conversations, tab),
damaged AS (SELECT conv_id AS conv, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE what <> 0),
placed AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv
        ORDER BY turn NULLS FIRST, role, md5(concat(length(role), chr(0), role, chr(0), text)), copy) AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM placed),
coded AS (SELECT *, (CASE initial WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END
    + CASE WHEN fault IN ('blank', 'duplicate') THEN 4 WHEN fault = 'truncated' THEN 8 ELSE 0 END)::BIGINT AS code FROM faulty),
counted AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list_append(flatten(list([-1, code] ORDER BY i)), -1) AS steps FROM coded GROUP BY conv),
solved AS (SELECT *, list_reduce(steps, lambda s, r: CASE WHEN r = -1 THEN {
        'p0': s.p0, 'p1': s.p1,
        'p2': list_min([s.p2, {'c': s.p0.c + 2, 'a': s.p0.a || 'I'}, {'c': s.p1.c + 2, 'a': s.p1.a || 'I'}, {'c': s.p3.c + 2, 'a': s.p3.a || 'I'}]),
        'p3': list_min([s.p3, {'c': s.p2.c + 2, 'a': s.p2.a || 'I'}, {'c': s.p0.c + 4, 'a': s.p0.a || 'II'}, {'c': s.p1.c + 4, 'a': s.p1.a || 'II'}])
    } ELSE {
        'p0': {'c': s.p0.c + 3, 'a': s.p0.a || 'D'},
        'p1': list_min([{'c': s.p1.c + 3, 'a': s.p1.a || 'D'}, {'c': s.p0.c + CASE WHEN r & 7 = 0 THEN r >> 3 ELSE 1000000000 END, 'a': s.p0.a || 'K'}]),
        'p2': list_min([{'c': s.p2.c + 3, 'a': s.p2.a || 'D'},
            {'c': s.p0.c + CASE WHEN r & 4 = 4 THEN 1000000000 WHEN r & 3 = 1 THEN r >> 3 ELSE 2 + (r >> 3) END, 'a': s.p0.a || CASE WHEN r & 3 = 1 THEN 'K' ELSE 'R' END},
            {'c': s.p1.c + CASE WHEN r & 4 = 4 THEN 1000000000 WHEN r & 3 = 1 THEN r >> 3 ELSE 2 + (r >> 3) END, 'a': s.p1.a || CASE WHEN r & 3 = 1 THEN 'K' ELSE 'R' END},
            {'c': s.p3.c + CASE WHEN r & 4 = 4 THEN 1000000000 WHEN r & 3 = 1 THEN r >> 3 ELSE 2 + (r >> 3) END, 'a': s.p3.a || CASE WHEN r & 3 = 1 THEN 'K' ELSE 'R' END}]),
        'p3': list_min([{'c': s.p3.c + 3, 'a': s.p3.a || 'D'},
            {'c': s.p2.c + CASE WHEN r & 4 = 4 THEN 1000000000 WHEN r & 3 = 2 THEN r >> 3 ELSE 2 + (r >> 3) END, 'a': s.p2.a || CASE WHEN r & 3 = 2 THEN 'K' ELSE 'R' END}])
    } END, {'p0': {'c': 0::BIGINT, 'a': ''}, 'p1': {'c': 1000000000::BIGINT, 'a': ''},
        'p2': {'c': 1000000000::BIGINT, 'a': ''}, 'p3': {'c': 1000000000::BIGINT, 'a': ''}}) AS f FROM counted),
best AS (SELECT *, list_min([f.p0, f.p3]) AS b FROM solved),
letters AS (SELECT conv, j, b.a[j] AS letter, length(replace(b.a[:j], 'I', '')) AS i, length(replace(b.a[:j], 'D', '')) - 1 AS place,
    length(replace(b.a, 'D', '')) % 2 AS odd FROM (SELECT conv, b, unnest(range(1, length(b.a) + 1)) AS j FROM best)),
lines AS (SELECT l.conv, j, CASE WHEN letter = 'K' THEN c.role WHEN (place - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE c.text END AS line
    FROM letters l LEFT JOIN coded c ON l.conv IS NOT DISTINCT FROM c.conv AND l.i = c.i WHERE letter <> 'D'),
texts AS (SELECT conv, string_agg(line, chr(10) ORDER BY j) AS s FROM lines GROUP BY conv)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
    sha256(coalesce(s, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN best ON d.conv_id IS NOT DISTINCT FROM best.conv
LEFT JOIN texts ON d.conv_id IS NOT DISTINCT FROM texts.conv
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    given = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    seventh = F.col("vec_id") % 7 == 0
    given = given.withColumn("label", F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(given, F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.uid <> b.uid AND len(a.v) = len(b.v)),
positives AS (SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, uid) <= 5),
ranked AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.uid)::INTEGER AS rank
    FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
