import hashlib
import zlib

import pytest

from perispark.llm import merkle
from tests.llm.helpers import DOCS, documents, edge_documents, table


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tampered(row):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1]) if row[1] is not None else None
    return leaf_of((row[0], low, *row[2:]))


def climb(digests):
    """Levels of nodes from the leaves up."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[k:k + 16]) for k in range(0, len(below), 16)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        run = level[at // 16 * 16:at // 16 * 16 + 16]
        found.append((at % 16, run[:at % 16] + run[at % 16 + 1:]))
        at //= 16
    return found


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = climb([leaf_of(r) for r in groups[name]])
    top = climb([trees[n][-1][0] for n in names])
    root, out = top[-1][0], []
    for k, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            steps = path(trees[name], i) + path(top, k)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            value = tampered(row) if hit else leaf_of(row)
            for place, others in steps:
                value = digest(*others[:place], value, *others[place:])
            out.append((row[0], leaf_of(row), trees[name][-1][0], root, digest(*[x for _, o in steps for x in o]), value, value == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(spark, rows):
    found = merkle.report(documents(spark, rows))
    assert found.columns == COLUMNS
    assert table(spark, [tuple(r) for r in found.collect()]) == table(spark, by_hand(rows))


def test_edge_rows(spark):
    same(spark, edge_documents())


def test_groups_of_many_sizes_and_a_hot_one(spark):
    rows = [(i, f"Text {i}", "en", "hot", i) for i in range(5000)]  # more than one block of 4,096
    for n in (1, 2, 15, 16, 17, 256, 257, 273):
        rows += [(i * 3, f"T{i}", None if i % 3 else "de", f"s{n}", None) for i in range(n)]
    rows += [(None, f"Null {i}", "en", None, 1) for i in range(40)] + [(7, "Same Row", "en", "twice", 1)] * 33
    same(spark, rows)


def test_many_groups_have_a_deep_upper_tree(spark):
    same(spark, [(i, "Ab" * (i % 5), "en", f"source {i % 300} ü" if i % 2 else f"source {i}", i) for i in range(1200)])


def test_a_last_block_of_one_row(spark):
    same(spark, [(i, f"X{i}", "en", "s", i) for i in range(16 ** 3 + 1)])


def test_one_row_and_an_empty_table(spark):
    same(spark, [(3, "Alone", "en", "s", 5)])
    found = merkle.report(spark.createDataFrame([], DOCS))
    assert found.columns == COLUMNS and found.count() == 0


def test_full_proofs_lead_to_the_root(spark):
    rows = edge_documents()
    for r in merkle.manifest(documents(spark, rows), full=True).collect():
        assert merkle.fold(r.leaf, [(s.place, s.others) for s in r.proof]) == r.root
        assert r.proof_sha256 == digest(*[s.others for s in r.proof])


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4096])
def test_sweeps_of_one_block(n):
    leaves = [digest(str(i)) for i in range(n)]
    top, nodes = merkle.sweep_up(leaves, merkle.heights(n))
    assert top == climb(leaves)[-1][0]
    assert [x[:2] for x in nodes] == sorted(x[:2] for x in nodes)
    if nodes:
        for i, proof in enumerate(merkle.sweep_down(nodes, None)):
            assert merkle.fold(leaves[i], list(merkle.steps(proof))) == top


def test_changed_rows_are_found(spark):
    found = {r.doc_id: r.verified for r in merkle.report(documents(spark, [(i, "Upper" if i % 2 else "lower", "en", "s", 5) for i in range(60)])).collect()}
    for i, verified in found.items():
        assert verified == (not (zlib.crc32(str(i).encode()) % 5 == 0 and i % 2))
