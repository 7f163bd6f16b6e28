import random
import re
from collections import Counter

import pytest

from perispark.llm import collocations
from tests.llm.helpers import DOCS, documents, edge_documents, sentence, table


def by_hand(rows, least, top):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i:i + n] for p, a in found.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= 80 * f[p[i:i + n]]}
        ranked = []
        for p, a in found.items():
            if p not in covered:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def same(spark, rows, least=3, top=2000, **settings):
    found = collocations.collocations(documents(spark, rows), least, top, **settings)
    assert found.columns == COLUMNS
    got = [tuple(r) for r in found.collect()]
    assert table(spark, got) == table(spark, by_hand(rows, least, top))
    return got


def corpus(seed=2, n=120):
    rng = random.Random(seed)
    marks = [". ", ", ", "; ", "\n", " \t ", "  ", "! ", ":", "\x0b", "\r\n", "\x1c", "\xa0", " ", "\x85"]
    rows = []
    for i in range(n):
        text = "".join(sentence(rng, rng.randint(0, 12)) + rng.choice(marks) for _ in range(rng.randint(0, 9)))
        rows.append((i, text.title() if i % 7 == 0 else text, rng.choice(["en", "de", None, "und", "xx"]), "s", 1))
    return rows + edge_documents()


def test_same_as_by_hand(spark):
    got = same(spark, corpus())
    assert len({r[0] for r in got}) >= 4 and max(len(r[2].split(" ")) for r in got) == 4


def test_top_and_ties(spark):
    same(spark, corpus(3), top=5)
    same(spark, corpus(4), least=2, top=40, buckets=3)


def test_a_full_bitmap_loses_and_adds_nothing(spark):
    same(spark, corpus(5), bits=4)


@pytest.mark.parametrize("tokens, size", [(7, 30), (50, 1 << 20), (1 << 22, 11)])
def test_chunks_and_slices_do_not_matter(spark, monkeypatch, tokens, size):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(collocations, "SLICE_BYTES", size)
    rows = [("und" if r[2] is None else r[2], r[1]) for r in corpus(6, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], type=pa.string())], names=["lang", "text"])
    hashed = Counter()
    for out in collocations._count_hashes(iter([batch])):
        for run, c in zip(*[x.to_pylist() for x in out.columns]):
            hashed[run] += c
    want, phrases = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang, x) for x in w)
            for n in (2, 3, 4):
                phrases.update((lang, " ".join(w[i:i + n]), n) for i in range(len(w) - n + 1))
    assert sorted(hashed.values()) == sorted(c for (_, _, n), c in phrases.items() if n < 4)

    class Every:
        value = b"\xff" * 8

    got = Counter()
    for out in collocations._count_phrases(Every, 6)(iter([batch])):
        for lang, phrase, n, c in zip(*[x.to_pylist() for x in out.columns]):
            got[lang, phrase, n] += c
    totals = {lang: c for (lang, _, n), c in got.items() if n == 0}
    assert totals == {lang: sum(c for (x, _), c in want.items() if x == lang) for lang in totals}
    assert {k: c for k, c in got.items() if k[2] == 1} == {(lang, w, 1): c for (lang, w), c in want.items()}
    assert {k: c for k, c in got.items() if k[2] > 1} == phrases


def test_scores_are_exact_past_64_bits(spark):
    a, big = 6_000_000_000_000_000_001, 6_000_000_000_000_000_007
    rows = [("en", "x y", 2, a), ("en", "x", 1, big), ("en", "y", 1, big + 2)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")
    found = collocations.kept(collocations.scored(phrases), phrases).first()
    assert found.score == 2000000 * a // (2 * big + 2)
    longer = phrases.unionByName(spark.createDataFrame([("en", "x y z", 3, 4_800_000_000_000_000_001), ("en", "z", 1, big), ("en", "y z", 2, big)], phrases.schema))
    found = {r.phrase for r in collocations.kept(collocations.scored(longer), longer).collect()}
    assert found == {"y z", "x y z"}  # 100 times the longer one passes 80 times the shorter one by 20
    less = phrases.unionByName(spark.createDataFrame([("en", "x y z", 3, 4_800_000_000_000_000_000), ("en", "z", 1, big), ("en", "y z", 2, big)], phrases.schema))
    assert {r.phrase for r in collocations.kept(collocations.scored(less), less).collect()} == {"x y", "y z", "x y z"}


def test_streams_are_merged(spark):
    phrases = spark.createDataFrame([("en", "x y", 2, 30), ("en", "x", 1, 40), ("en", "y", 1, 50)], "lang string, phrase string, words int, f bigint")
    plan = collocations.scored(phrases)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "HashJoin" not in plan


def test_an_empty_table(spark):
    found = collocations.collocations(spark.createDataFrame([], DOCS))
    assert found.columns == COLUMNS and found.count() == 0
