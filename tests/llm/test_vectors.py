import math

import numpy as np

from perispark.llm import vectors
from tests.llm.helpers import table

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold):
    n = len(rows)
    usable = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x) for x in r[1]) and any(x for x in r[1]) for r in rows]
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], dtype=np.float32).astype(np.float64) for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    seen, out = {}, []
    for i in range(n):
        if i not in seen:
            part, front = {i}, [i]
            while front:
                front = [j for k in front for j in links[k] if j not in part]
                part |= set(front)
            least = min([rows[k][0] for k in part if rows[k][0] is not None], default=None)
            seen |= {k: least for k in part}
        out.append((rows[i][0], len(links[i]), seen[i], seen[i] is not None and rows[i][0] == seen[i]))
    return out


def sample(seed=1, n=150, d=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rng.standard_normal(d) if i % 3 == 0 or not rows else np.array(rows[rng.integers(len(rows))][1]) + 0.25 * rng.standard_normal(d)
        rows.append((i, [float(np.float32(x)) for x in base], int(rng.integers(2))))
    zero, nan = [0.0] * d, [float("nan")] + [1.0] * (d - 1)
    rows += [(n, None, 1), (n + 1, zero, 1), (n + 2, nan, 1), (n + 3, [None] + [1.0] * (d - 1), 1), (n + 4, rows[0][1], None), (n + 5, [float("inf")] * d, 0), (n + 6, [], 0),
             (n + 7, [1.0, 0.0], 0), (n + 8, [2.0, 0.0], 0), (None, rows[1][1], rows[1][2]), (None, [7.0] * d, 1)]
    rows += [rows[2]] * 3 + [(n + 20 + i, [3e38 * x for x in ([1.0] + [0.0] * (d - 1))], 0) for i in range(4)]
    return rows


def test_matches_brute_force(spark):
    rows = sample()
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.93).collect()
    assert table(spark, map(tuple, got)) == table(spark, brute(rows, 0.93))


def test_blocks_and_lists_find_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "LIST_ROWS", 20)
    rows = sample(seed=2, n=240)
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.93).collect()
    assert table(spark, map(tuple, got)) == table(spark, brute(rows, 0.93))


def test_links_along_the_line_between_two_lists(spark, monkeypatch):
    """Vectors around two centroids and on the arc between them: those links cross the border head on."""
    monkeypatch.setattr(vectors, "LIST_ROWS", 120)
    rng = np.random.default_rng(5)
    a, b = np.eye(64)[0], np.eye(64)[1]
    points = [c + 0.03 * rng.standard_normal(64) for c in (a, b) for _ in range(110)]
    points += [math.cos(t) * a + math.sin(t) * b + 0.005 * rng.standard_normal(64) for t in np.linspace(0, math.pi / 2, 69)]
    rows = [(i, [float(x) for x in p], 0) for i, p in enumerate(points)]
    for seed_order in (rows, rows[::-1]):
        got = vectors.near_duplicates(spark.createDataFrame(seed_order, SCHEMA), 0.93).collect()
        assert table(spark, map(tuple, got)) == table(spark, brute(rows, 0.93))


def test_one_group_holds_most_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(32)
    rows = [(i, [float(x) for x in base + 0.01 * rng.standard_normal(32)], 0) for i in range(300)] + [(1000 + i, [float(x) for x in base], 0) for i in range(300)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.93).collect()
    assert all(r.n_links == 599 and r.component_id == 0 and r.kept == (r.vec_id == 0) for r in got)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA), 0.93).count() == 0
