import random

import numpy as np
import xxhash

from perispark.llm import simhash
from perispark.llm.graph import components
from tests.llm.helpers import DOCS, documents, edge_documents, sentence, table


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    span = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + span]).encode(), 42) for i in range(len(words) - span + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(bits):
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if bin(bits[i] ^ bits[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


def test_fingerprints_by_hand():
    for _, text, *_ in edge_documents():
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint("ÀB  C D\x1cE") == slow_fingerprint("ÀB  C D\x1cE")


def test_groups_match_brute_force(spark):
    rows = edge_documents()
    bits = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_components(bits)
    ids = {}
    for r, root in zip(rows, roots):
        ids.setdefault(root, []).append(r[0])
    least = {root: min([i for i in found if i is not None], default=None) for root, found in ids.items()}
    got = simhash.groups(documents(spark)).select("doc_id", simhash.fingerprint_hex().alias("f"), "component_id").collect()
    assert table(spark, map(tuple, got)) == table(spark, [(r[0], f"{b:016x}", least[root]) for r, b, root in zip(rows, bits, roots)])


def links_partition(spark, bits, limit):
    before, simhash.GROUP = simhash.GROUP, limit
    try:
        points = spark.createDataFrame([(int(np.uint64(b).astype(np.int64)),) for b in bits], "bits bigint")
        pairs = [(int(np.int64(r.a).astype(np.uint64)), int(np.int64(r.b).astype(np.uint64))) for r in simhash.near_links(points).collect()]
        grouped = components(simhash.near_links(points)).collect()
    finally:
        simhash.GROUP = before
    return pairs, {int(np.int64(r.node).astype(np.uint64)): r.root for r in grouped}


def test_links_of_dense_groups_are_whole_at_every_level(spark):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    bits = {centre}
    while len(bits) < 300:  # a large group of near copies, and chains that leave it
        base = rng.choice(list(bits))
        for _ in range(rng.randint(1, 4)):
            base ^= 1 << rng.randrange(64)
        bits.add(base)
    bits |= {rng.getrandbits(64) for _ in range(100)} | {0, 1, (1 << 64) - 1, (1 << 63) - 1}
    bits = sorted(bits)
    want = slow_components(bits)
    for limit in (1024, 20, 2):  # small limits send the same rows through the second and third cut
        pairs, root = links_partition(spark, bits, limit)
        got = [root.get(b, f"alone {b}") for b in bits]
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
        assert limit < 1024 or len(pairs) < len(bits) * 70


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows, bits = edge_documents(), [slow_fingerprint(r[1]) for r in edge_documents()]
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    groups = {}
    for r, root in zip(rows, slow_components(bits)):
        groups.setdefault(root, []).append(r[0])
    assert ids == sorted((i is not None, i or 0) for i in (min([x for x in g if x is not None], default=None) for g in groups.values()))


def test_groups_without_ids_and_with_one_id_stay_apart(spark):
    rng = random.Random(8)
    texts = [sentence(rng, 60) for _ in range(6)]
    rows = [(None, t, "en", "s", 1) for t in texts[:4] + texts[:2]] + [(7, t, "en", "s", 1) for t in texts[4:] + texts[4:5]]
    assert len(set(slow_components([slow_fingerprint(t) for t in texts]))) == 6
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.deduplicate(documents(spark, rows)).collect())
    assert kept == sorted([(0, t) for t in texts[:4]] + [(7, t) for t in texts[4:]])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.groups(empty).count() == 0
    assert simhash.deduplicate(empty).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (6000, None)] + [(7001, 7000), (7000, 7001)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    roots = {}
    for r in found:
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [2, 200, 201]


def test_groups_as_runs_over_any_batches():
    """A group may begin in one batch and end in a later one; one above the limit comes out as its key."""
    import pyarrow as pa

    rows = [(1, 8), (2, 16), (2, 17), (3, 0), (3, 1), (3, 3), (3, 255), (5, 4), (5, 1 << 40), (6, 1), (6, 2), (6, 3), (6, 4), (6, 5), (7, 9), (7, 9), (8, 6), (8, 7)]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in part], pa.int64()), "bits": pa.array([b for _, b in part], pa.int64())})
                   for part in [rows[i:i + size] for i in range(0, len(rows), size)] + [[]]]
        got = sorted(map(str, (tuple(r.values()) for out in simhash._groups(4)(iter(batches)) for r in out.to_pylist())))
        assert got == sorted(map(str, [(16, 17), (0, 1), (0, 3), (4, 1 << 40), (None, 6), (6, 7)]))
