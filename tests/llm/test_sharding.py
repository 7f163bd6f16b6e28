import hashlib
import math
import zlib

from perispark.llm import sharding
from tests.llm.helpers import DOCS, documents, edge_documents


def slow_place(key, node):
    while node.shard is None:
        def draw(c):
            u = (int(hashlib.md5(f"{c.name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            return -math.log(u) / c.weight

        node = min((c for c in node.children if c.weight > 0), key=draw)
    return node.shard


def test_rows_match_brute_force(spark):
    rows = edge_documents()
    got = sharding.assign(documents(spark), 40).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    before, after, slots = sharding.tree(40), sharding.tree(41), {}
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == slow_place(key, before) and r.grown_shard == slow_place(key, after) and r.law == "key"
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself():
    for n in (40, 41, 57):
        before, after = sharding.tree(n), sharding.tree(n + 1)
        moved = [(slow_place(k, before), slow_place(k, after)) for k in range(4000)]
        moved = [m for m in moved if m[0] != m[1]]
        assert {m[1] for m in moved} == {n} and 0.5 * 4000 / (n + 1) < len(moved) < 1.5 * 4000 / (n + 1)


def test_a_weight_change_moves_rows_only_along_its_subtree():
    before, after = sharding.tree(40), sharding.tree(40, {7: 3.0})  # shard 7: rack 1 (5-9), region 0 (0-9)
    region, rack = lambda s: s // 10, lambda s: s // 5
    for k in range(4000):
        a, b = slow_place(k, before), slow_place(k, after)
        if region(a) != region(b):
            assert region(b) == 0
        elif rack(a) != rack(b):
            assert rack(b) == 1
        elif a != b:
            assert b == 7
    assert all(slow_place(k, sharding.tree(40, {7: 0.0})) != 7 for k in range(500))


def test_shares_follow_weights(spark):
    docs = spark.range(8000).selectExpr("id AS doc_id", "'x' AS text")
    sizes = {r.shard: r["count"] for r in sharding.assign(docs, 40, {3: 2.0}).groupBy("shard").count().collect()}
    assert sorted(sizes) == list(range(40))
    assert 300 < sizes[3] < 490 and all(130 < n < 270 for s, n in sizes.items() if s != 3)


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], DOCS)).count() == 0
