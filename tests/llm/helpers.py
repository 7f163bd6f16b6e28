"""Small document tables with the edge rows that every operator has to bear."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the and of thing ation stone river under walks blue seven quiet market ostrich window paper yellow candle early".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_documents(seed=1, n=40):
    """Rows (doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows and ids, copies and near copies."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(n)]
    texts[3] = texts[2]
    texts[5] = texts[4] + " end"
    texts[6] = sentence(rng, 6000)
    texts[7] = texts[6][:-40] + sentence(rng, 5)
    texts[8:14] = ["", None, "x", "  \n\t ", "ééé 日本語 🙂 ñ", "a" * 3000]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], rows[6], (None, "no id at all here", None, None, None), (None, texts[2], "en", None, 3), (15, "another text with an id seen before", "en", "s", 1)]
    return rows


def documents(spark, rows=None):
    """The rows as a table with extra columns whose names clash with what operators add."""
    found = spark.createDataFrame(edge_documents() if rows is None else rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("score", "bits", "spans", "run", "key", "length", "rank", "label", "_bits", "_key", "_score", "shard", "held_out",
                 "keep_id", "keep_bits", "keep_key", "_keep_id", "n_headers", "licence", "own_licence", "cosine", "licensed_by", "from_dir", "granted",
                 "group", "at", "n", "copy", "pair", "phrase", "words", "c", "digest", "root", "node", "first_id"):
        found = found.withColumn(name, F.lit("clash"))
    return found


def table(spark, df_rows):
    """Rows in one order whatever their types."""
    return sorted(df_rows, key=lambda r: [(x is not None, str(x)) for x in r])
