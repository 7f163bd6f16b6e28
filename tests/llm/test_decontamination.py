import hashlib
import random
import re

import pytest

from perispark.llm import decontamination
from tests.llm.helpers import DOCS, documents, edge_documents, sentence, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return WORD.findall(lower(text))


def by_hand(rows, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        if w:
            for i in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for row in rows:
        w, hit, seen = words_of(row[1]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found is not None:
                    hit |= set(range(i, i + n))
                    seen |= {str(x) for x in found if x is not None}
        out.append((row[0], len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return out


def case(seed=5):
    rng = random.Random(seed)
    items = [(i, sentence(rng, n)) for i, n in enumerate([25, 12, 10, 9, 3, 40, 60, 1])]
    items[7] = (7, "Zebra9")
    items += [(20, items[0][1]), (None, sentence(rng, 15)), (21, None), (22, " ... "), (23, ""), (5, sentence(rng, 11)), (100, items[1][1].upper())]
    rows = edge_documents(n=40)
    for k, (_, text) in enumerate(items):
        if text:
            rows.append((1000 + k, f"{sentence(rng, 8)}. {text.replace(' ', ', ')}! {sentence(rng, 30)}", "en", "s", 1))
            rows.append((2000 + k, f"é{text.upper()}", "en", "s", 1))
    a, b = items[0][1], items[5][1]
    rows += [(3000, " ".join(a.split()[3:16]) + " x " + b + " " + b, "en", "s", 1), (3001, a + a, "en", "s", 1), (3002, f"🙂 {a}🙂{b}", None, None, None)]
    return rows, items


@pytest.mark.parametrize("block", [200_000, 20])
def test_same_as_by_hand(spark, block):
    rows, items = case()
    found = decontamination.report(documents(spark, rows), documents_like(spark, items), block_windows=block)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert table(spark, [tuple(r) for r in found.collect()]) == table(spark, by_hand(rows, items))


def documents_like(spark, items):
    from pyspark.sql import functions as F

    found = spark.createDataFrame(items, ITEMS)
    for name in ("item", "window", "windows", "spans", "items", "n_words", "digest"):
        found = found.withColumn(name, F.lit("clash"))
    return found


@pytest.mark.parametrize("block", [200_000, 20])
def test_spans_are_the_words_in_the_text(spark, block):
    rows, items = case(6)
    texts = {(r[0], r[1]) for r in rows}
    seen = 0
    for r in decontamination.scan(documents(spark, rows), documents_like(spark, items), block_windows=block).collect():
        last = -2
        for s in r.spans:
            assert s.first > last + 1 and s.last >= s.first  # runs are apart
            last = s.last
            seen += any(doc_id == r.doc_id and words_of(text)[s.first:s.last + 1] == words_of(text[s.start:s.end]) for doc_id, text in texts if text)
    assert seen > 20


def test_hot_window_and_long_text(spark):
    rng = random.Random(3)
    passage = sentence(rng, 50)
    rows = [(i, f"{sentence(rng, 5)} {passage}" if i % 3 == 0 else sentence(rng, 20), "en", "s", 1) for i in range(300)]
    rows.append((999, sentence(rng, 100_000) + " " + passage + " " + sentence(rng, 100_000), "en", "s", 1))
    items = [(i, passage) for i in range(50)]
    found = {r.doc_id: r for r in decontamination.report(documents(spark, rows), spark.createDataFrame(items, ITEMS), block_windows=100).collect()}
    assert found[999].n_hit == 50 and found[999].n_items == 50
    assert sum(r.contaminated for r in found.values()) == 101


def test_empty_tables(spark):
    rows, items = case()
    none = decontamination.report(documents(spark, rows), spark.createDataFrame([], ITEMS))
    assert not any(r.contaminated for r in none.collect()) and none.count() == len(rows)
    assert decontamination.report(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
