import hashlib
import random

import numpy as np

from perispark.llm import chunks
from tests.llm.helpers import DOCS, documents, edge_documents, sentence


def slow_ends(data):
    """The same borders from a hash rolled byte by byte."""
    marks, h = [], 0
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        marks.append(h)
    ends, start = [], 0
    while len(data) - start > chunks.LEAST:
        end = min(start + chunks.MOST, len(data))
        for k in range(start + chunks.LEAST, end):
            mask = chunks.STRICT if k <= start + chunks.NORMAL else chunks.LOOSE
            if marks[k - 1] & int(mask) == 0:
                end = k
                break
        ends.append(end)
        start = end
    return ends + ([len(data)] if start < len(data) else [])


def test_borders_match_the_rolled_hash(monkeypatch):
    rng = random.Random(1)
    for n in (0, 1, 24, 25, 100, 5000):
        data = bytes(rng.randrange(97, 123) for _ in range(n))
        assert chunks.chunk_ends(data) == slow_ends(data)
    monkeypatch.setattr(chunks, "SPAN", 100)
    data = sentence(rng, 2000).encode()
    assert chunks.chunk_ends(data) == slow_ends(data)


def test_an_insertion_moves_few_borders():
    rng = random.Random(2)
    text = sentence(rng, 3000)
    assert chunks.containment(chunks.fingerprint(text), chunks.fingerprint(text[:4000] + " inserted words " + text[4000:])) > 0.95
    assert chunks.containment(chunks.fingerprint(text), chunks.fingerprint(text)) == 1.0
    sizes = np.diff([0, *chunks.chunk_ends(text.encode())])
    assert sizes.max() <= chunks.MOST and 40 < sizes.mean() < 140


def brute(rows):
    """In the order of descending ids; equal ids here have texts whose order the result does not depend on."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for r, following in zip(order, order[1:] + order[:1]):
        text, nxt = r[1] or "", following[1] or ""
        changed = chunks.edited(text, nxt)
        mine, new, theirs = (chunks.fingerprint(t) for t in (text, changed, nxt))
        out[r[0]] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), chunks.as_text(mine), chunks.as_text(new), chunks.containment(mine, new), chunks.containment(mine, theirs))
    return out


def test_table_matches_brute_force_for_any_number_of_runs(spark):
    rows = [r for i, r in enumerate(edge_documents()) if r[0] is not None and i < 40]
    want = brute(rows)
    for runs in (2, 7, 100):
        got = {r.doc_id: tuple(r)[1:] for r in chunks.compare_with_next(documents(spark, rows), runs).collect()}
        assert got == want


def test_repeated_and_missing_ids_keep_their_rows(spark):
    rows = edge_documents()
    got = chunks.compare_with_next(documents(spark)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == sorted((r[0] is not None, r[0] or 0, len(r[1] or "")) for r in rows)
    last = [r for r in got if r.doc_id is None]
    assert len(last) == 2
    only_missing = chunks.compare_with_next(documents(spark, [(None, "one text", None, None, 1), (None, "two", None, None, 1)])).collect()
    assert sorted(r.n_chars for r in only_missing) == [3, 8]


def test_alone_and_empty(spark):
    alone = chunks.compare_with_next(documents(spark, [(4, "a lone text of some words", "en", "s", 1)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert chunks.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0
