"""Small inputs with every awkward case, and brute-force helpers."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators would give their own columns.
CLASHING = [
    "n_words", "kept", "text_", "n_lines", "n_removed", "ids", "node", "lang_pred", "score", "id", "h", "c0", "p", "best", "_d", "_s",
    "_n", "_i", "times", "size", "size_", "src", "n", "copy", "a.b", "a`b", "digest", "class_id", "host", "path", "rule", "verdict", "short",
    "rule_host", "taken", "block", "start", "place", "js_chars", "decodes", "n_tokens", "raw", "dg", "_text", "held_out", "n_chars_",
]


def sentence(rng, n, words=None):
    words = words or "the of and to in a is that for it on as with by this be at from or an was are".split()
    return " ".join(rng.choice(words) if rng.random() < 0.5 else f"w{rng.randrange(4000)}" for _ in range(n))


def awkward_rows(seed=7):
    """Nulls in every column, empty and blank texts, ties, repeated rows, one
    very long text, copies and near copies."""
    rng = random.Random(seed)
    base = sentence(rng, 160)
    edited = base.split()
    edited[80] = "changed"
    passage = sentence(rng, 60)
    lines = [sentence(rng, 9) for _ in range(6)]
    rows = [
        (1, base, "en", "b", 10), (2, base, "en", "a", 10), (3, " ".join(edited), "en", "a", None),
        (4, sentence(rng, 30) + " " + passage + " " + sentence(rng, 30), None, "a", 1),
        (5, passage + "\n" + sentence(rng, 70), "en", None, 1),
        (6, "\n".join(lines), "en", "c", 1), (7, "\n".join([sentence(rng, 9), *lines[1:5], "", lines[5]]), "fr", "c", 1),
        (8, "", "en", "a", 0), (9, None, "en", "a", None), (10, " \n\t ", "en", "b", 4), (None, "no id here " * 3, "en", "a", 1),
        (None, None, None, None, None), (11, "a", "en", "zz", 1), (11, "another text of one id", "en", "zz", 1),
        (12, base, "en", "b", 10), (12, base, "en", "b", 10), (13, "x\n" * 40, "en", "b", 10),
        (14, sentence(rng, 30_000), "en", "b", 1), (15, "one word\x1cstill 　   end", "en", "b", 1),
        (16, "\U0001f389 梦梦 ²", None, "c", 2), (17, "### $$$ %% " * 40, "en", "c", 2),
    ]
    return rows


def awkward(spark, clash=False, rows=None):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        for i, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(i))  # dots and backquotes are part of a name here
    return df.repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
