import os

import pytest

from perispark.llm import licenses, queries
from tests.llm.helpers import DOCS

FILES = [
    (1, "LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/x.txt", "no notice here"), (3, "a/b/LICENSE.md", "Some words.\nReleased under the MIT License.\nmore"),
    (4, "a/b/c/d/y.txt", None), (5, "a/z.txt", ""), (6, "a/b/c/own.txt", "text\nThis work is licensed under the GNU General Public License, version 3.\nAll rights reserved."),
    (7, None, "nothing"), (8, "a/bb/q.txt", "x"), (9, "a/COPYING", "a licence to speak of quite different things altogether, and at some length"),
    (10, "LICENSE.d/e.txt", "x"), (2, "a/b/x.txt", "no notice here"),
]
SCHEMA = "doc_id bigint, path string, text string"


def scanned(spark, rows):
    files = spark.createDataFrame(rows, SCHEMA)
    return {r.doc_id: r for r in licenses.scan(files).collect()}, licenses.scan(files).count()


def test_headers_and_inheritance(spark):
    got, n = scanned(spark, FILES)
    assert n == len(FILES)
    own = {i: got[i].own_licence for i in got}
    assert own == {1: "Apache-2.0", 2: None, 3: "MIT", 4: None, 5: None, 6: "GPL-3.0", 7: None, 8: None, 9: None, 10: None}
    assert {i: (got[i].licence, got[i].licensed_by) for i in (2, 4, 5, 6, 7, 8, 9, 10)} == {
        2: ("MIT", "a/b"), 4: ("MIT", "a/b"), 5: ("Apache-2.0", ""), 6: ("GPL-3.0", "header"), 7: ("Apache-2.0", ""), 8: ("Apache-2.0", ""), 9: ("Apache-2.0", ""), 10: ("Apache-2.0", "")}
    assert got[6].n_headers == 2 and got[9].n_headers == 1 and got[1].cosine > 0.99


def test_no_headers_and_no_rows(spark):
    got, n = scanned(spark, [(1, "a/b", "text"), (2, None, None)])
    assert n == 2 and all(r.licence is None and r.licensed_by is None and r.n_headers == 0 for r in got.values())
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    plan = licenses.scan(spark.createDataFrame(FILES, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_files_that_share_a_path_keep_their_own_headers(spark):
    mit = "Released under the MIT License.\nAll rights reserved."
    rows = [(None, None, mit), (None, None, "no notice"), (5, None, None), (2, "a/x", mit), (2, "a/x", mit), (2, "a/x", "Licensed under CC BY 4.0"), (2, "a/x", "none")]
    got = sorted((r.path or "", r.own_licence or "", r.n_headers) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [g[:1] + g[2:] for g in got if not g[1]] == [("", 0), ("", 0), ("a/x", 0)]
    assert sorted((p, n) for p, o, n in got if o) == [("", 2), ("a/x", 1), ("a/x", 2), ("a/x", 2)]


def test_documents_with_missing_parts_of_a_path_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    notices = ["Released under the MIT License", "Licensed under CC BY 4.0", "This work is licensed under the GNU General Public License, version 3"]
    rows = [(i, f"Words {i}.\n" + (notices[i // 10 % 3] + ".\n" if i % 10 == 0 and i % 40 or i % 17 == 0 else "") + "end", None if i % 3 == 1 else f"l{i % 2}", None if i % 4 == 2 else f"s{i % 5}", 9) for i in range(400)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    columns = ["doc_id", "path", "own_licence", "cosine", "n_headers", "licence", "licensed_by"]
    want = con.sql(licenses.ORACLE_SQL).select(*columns).fetchall()
    got = [tuple(r) for r in queries.op10_licenses(spark, str(tmp_path)).select(*columns).collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])
    assert sum(r[1].startswith("/") for r in got) == 100


LONG = "/usr/share/common-licenses"
NAMES = ["GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "Apache-2.0", "MPL-2.0"]


@pytest.mark.skipif(not all(os.path.isfile(f"{LONG}/{n}") for n in NAMES), reason="no licence texts on this machine")
def test_full_texts_of_one_family_are_told_apart(spark, tmp_path):
    texts = {n: open(f"{LONG}/{n}", encoding="utf-8").read() for n in NAMES}
    texts["AGPL-3"] = texts["GPL-3"].replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE").replace("GNU General Public", "GNU Affero General Public")
    for n, t in texts.items():
        (tmp_path / n).write_text(t, encoding="utf-8")
    wrap = lambda t: "Copyright 2020 Somebody\n\n" + " ".join(t.split())
    rows = [(i, f"p{i}/LICENSE", wrap(t)) for i, t in enumerate(texts.values())] + [(100 + i, f"p{i}/src/a.c", "int x;") for i in range(len(texts))]
    rows += [(200, "other/COPYING", "a long text about quite other things than permissions " * 50), (201, "plain/readme", texts["GPL-3"])]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA), licenses.licence_texts(spark, str(tmp_path))).collect()}
    for i, n in enumerate(texts):
        assert (found[i].own_licence, found[i].licensed_by) == (n, "file") and found[i].cosine > 0.99
        assert (found[100 + i].licence, found[100 + i].licensed_by) == (n, f"p{i}")
    assert found[200].licence is None and found[201].licensed_by != "file"  # only files named so are licence files


def test_short_licences_as_whole_files(spark):
    rows = [(i, f"d{i}/LICENSE.txt", "Copyright (c) 2021 A. Uthor\n" + t.replace("(c) ", "")) for i, (_, t) in enumerate(licenses.FULL_TEXTS)]
    rows += [(50, "d1/LICENSE.txt", None), (51, "d0/x/y.py", "code"), (52, None, licenses.FULL_TEXTS[0][1])]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [found[i].own_licence for i in range(len(licenses.FULL_TEXTS))] == [n for n, _ in licenses.FULL_TEXTS]
    assert found[51].licence == "MIT" and found[50].own_licence is None


def test_clashing_columns_give_way_or_stay(spark):
    from pyspark.sql import functions as F

    files = spark.createDataFrame(FILES, SCHEMA)
    plain = sorted(map(str, licenses.scan(files).collect()))
    for name in ("own_licence", "cosine", "n_headers", "licence", "licensed_by"):
        files = files.withColumn(name, F.lit("clash"))
    assert sorted(map(str, licenses.scan(files).collect())) == plain
    kept = files.withColumn("_by", F.lit("b")).withColumn("granted", F.lit("g")).withColumn("key", F.lit("k"))
    got = licenses.scan(kept)
    assert {"_by", "granted", "key"} <= set(got.columns) and got.where("_by = 'b' AND granted = 'g' AND key = 'k'").count() == len(FILES)
