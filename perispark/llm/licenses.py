"""Licence scans: headers matched to templates by TF-IDF cosine, then inherited from the nearest licensed directory.

A header is a sentence or line with a licensing word. Equal headers are scored once however many files carry them.
A file named like a licence file that has a licensing word anywhere is also a vector of its own, of its whole text, and is held
to full licence texts; that match counts before its headers'. Document frequencies count the headers (or licence files) and the templates. Vectors and
templates meet in a sparse join of their tokens; the template side is as small as the template list. A file named like a
licence file that matches a template licenses its directory; files without a licence of their own take the licence of the nearest directory above them, by a
join of each distinct directory's ancestors with the licensed directories.

Defined results: a null text has no headers; a null path is a file in the root; a path with a leading slash is under another root; of several matching headers the one with
the largest cosine counts, then the first licence by name; repeated rows are files of their own, and so
are files that share a path; without any header the
result has only nulls. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, fresh

#: Licence notices as their publishers word them, one sentence each.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law the author has waived all copyright under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
]
WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS ")
BSD_CLAUSES = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
               "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
               "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
               "and/or other materials provided with the distribution. ")
BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
             "without specific prior written permission. ")
BSD_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
                "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
                "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
                "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
                "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
#: Whole texts of short licences. Long ones are a parameter (see ``licence_texts``), as files of any distribution hold them.
FULL_TEXTS = [
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + WARRANTY
            + "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
              "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Copyright (c) All rights reserved. " + BSD_CLAUSES + BSD_WARRANTY),
    ("BSD-3-Clause", "Copyright (c) All rights reserved. " + BSD_CLAUSES + BSD_NAMES + BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
            "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT "
            "OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
                  "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
                  "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this "
                  "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
                  "relinquishment in perpetuity of all present and future rights to this software under copyright law. " + WARRANTY
                  + "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
]
ANCHOR = r"licen[cs]|copyright|rights reserved|redistribut|permission is hereby granted|spdx|cc0"
BREAK = r"\n|[.;!?]\s+"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
LICENCE_FILE = r"^(?i)(?:licen[cs]e|copying|notice|unlicense)(?:[.-].*)?$"
LEAST_COSINE, LEAST_FILE_COSINE = 0.6, 0.8  # of a header; of a whole file


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def headers(files: DataFrame, keep: list[str]) -> DataFrame:
    """``header``: the sentences and lines with a licensing word, of files that have any, and ``n_headers`` of each file."""
    anchored = lambda x: F.lower(x).rlike(ANCHOR)
    some = files.where(anchored(F.col("text"))).select(*keep, F.filter(F.split("text", BREAK, -1), anchored).alias("found"))
    return some.select(*keep, F.size("found").alias("n_headers"), F.explode("found").alias("header"))


def licence_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Full licence texts (licence, text) from a folder of files named after their licences, for ``scan``."""
    found = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("licence"), F.col("value").alias("text"))
    return found.unionByName(spark.createDataFrame(FULL_TEXTS, "licence string, text string"))


def match(found: DataFrame, templates: DataFrame, least: float) -> DataFrame:
    """``key``, ``licence``, ``cosine`` of each text that reaches ``least``; ``found``: key, n (how often it occurs), text."""
    templates = templates.select(F.xxhash64("licence", "text").alias("template"), "licence", "text")
    of_text = found.select("key", "n", F.explode(tokens(F.col("text"))).alias("token")).groupBy("key", "n", "token").agg(F.count(F.lit(1)).alias("tf"))
    of_template = templates.select("template", "licence", F.explode(tokens(F.col("text"))).alias("token")).groupBy("template", "licence", "token").agg(F.count(F.lit(1)).alias("tf"))
    of_text = cut_lineage(of_text)
    total = found.select("n").unionByName(templates.select(F.lit(1).cast("bigint").alias("n"))).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    df = of_text.select("token", "n").unionByName(of_template.select("token", F.lit(1).cast("bigint").alias("n"))).groupBy("token").agg(F.sum("n").alias("df"))
    idf = cut_lineage(df.select("token", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf")))
    weighted = of_text.join(idf, "token").withColumn("w", F.col("tf") * F.col("idf"))
    templated = of_template.join(idf, "token").withColumn("tw", F.col("tf") * F.col("idf"))
    norms = templated.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    # as many rows as the templates have tokens
    postings = cut_lineage(templated.join(norms, "template").select("token", "template", "licence", "tw", "tnorm"))
    norm = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.join(F.broadcast(postings), "token").groupBy("key", "template", "licence", "tnorm").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 9)
    scored = dots.join(norm, "key").select("key", "licence", cosine.alias("cosine")).where(F.col("cosine") >= least)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "licence")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), (-F.col("b.less")).alias("cosine"))


def directory(path: Column) -> Column:
    """All of a path before its last slash, after ``./`` if the path is relative: ``.`` is its root, the empty text that of paths with a leading slash."""
    path = F.coalesce(path, F.lit(""))
    return F.regexp_extract(F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("./"), path)), r"(?s)^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and all those above it, the root included."""
    parts = F.split(folder, "/", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def scan(files: DataFrame, full_texts: DataFrame | None = None) -> DataFrame:
    """``files`` (path, text and other columns; the text is dropped) with own_licence, cosine, n_headers, licence, licensed_by.

    ``licensed_by`` is ``file`` (the whole file is a licence), ``header``, or the directory whose licence is inherited, or
    null. ``full_texts`` (licence, text; a list of licences, so small) replaces the short licences' texts. Columns of the new
    names give way; others stay, whatever they are called. An empty table stays empty. A licence file is read whole.
    """
    spark = files.sparkSession
    files = files.drop("own_licence", "cosine", "n_headers", "licence", "licensed_by")
    text_key, dir_, own_path, own_key, from_dir, granted, by = fresh(files, "_text_key", "_dir", "_own_path", "_own_key", "_from_dir", "_granted", "_by")
    keyed = files.withColumn(text_key, F.sha2("text", 256))  # files of one path and one text have the same headers
    lines = headers(keyed.select("path", text_key, "text"), ["path", text_key])
    lines = cut_lineage(lines.groupBy("path", text_key, "header").agg(F.count(F.lit(1)).alias("n"), F.max("n_headers").alias("n_headers")))
    notices = spark.createDataFrame(TEMPLATES, "licence string, text string")
    matched = cut_lineage(match(cut_lineage(lines.groupBy(F.col("header").alias("key")).agg(F.sum("n").alias("n")).withColumn("text", F.col("key"))), notices, LEAST_COSINE))
    of_lines = (lines.join(matched.withColumnRenamed("key", "header"), "header", "left").groupBy("path", text_key)
                .agg(F.min(F.when(F.col("licence").isNotNull(), F.struct((-F.col("cosine")).alias("less"), "licence"))).alias("b"), F.max("n_headers").alias("n_headers"))
                .select("path", text_key, F.lit("header").alias("by"), "b", "n_headers"))
    # licence files as vectors: equal texts are one; like a header, a licence has a licensing word
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    named = keyed.where(name.rlike(LICENCE_FILE) & F.lower("text").rlike(ANCHOR))
    texts = cut_lineage(named.groupBy(F.col(text_key).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text")))
    whole = cut_lineage(match(texts, spark.createDataFrame(FULL_TEXTS, "licence string, text string") if full_texts is None else full_texts, LEAST_FILE_COSINE))
    of_files = (named.select("path", text_key).distinct().join(whole.withColumnRenamed("key", text_key), text_key)
                .select("path", text_key, F.lit("file").alias("by"), F.struct((-F.col("cosine")).alias("less"), "licence").alias("b"), F.lit(0).alias("n_headers")))
    # a match of the whole file comes before those of its headers
    own = of_lines.unionByName(of_files).groupBy("path", text_key).agg(
        F.min(F.when(F.col("b").isNotNull(), F.struct("by", "b"))).alias("best"), F.max("n_headers").alias("n_headers"))
    own = cut_lineage(own.select(F.col("path").alias(own_path), F.col(text_key).alias(own_key), F.col("best.b.licence").alias("own_licence"),
                                 (-F.col("best.b.less")).alias("cosine"), "n_headers", F.col("best.by").alias(by)))
    own_name = F.regexp_extract(own_path, r"([^/]*)$", 1)
    grants = (own.where(F.col("own_licence").isNotNull() & own_name.rlike(LICENCE_FILE)).withColumn("dir", directory(F.col(own_path)))
              .groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("less"), F.col("own_licence").alias("licence"))).alias("b"))
              .select(F.col("dir").alias("above"), F.col("b.licence").alias("granted")))
    rest = keyed.drop("text").withColumn(dir_, directory(F.col("path")))
    dirs = rest.select(F.col(dir_).alias("dir")).distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("above"))
    nearest = (dirs.join(cut_lineage(grants), "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "granted")).alias("g"))
               .select(F.col("dir").alias(dir_), F.regexp_replace("g.above", r"^\./?", "").alias(from_dir), F.col("g.granted").alias(granted)))
    same = rest["path"].eqNullSafe(own[own_path]) & (rest[text_key] == own[own_key])
    found = (rest.join(own, same, "left").drop(own_path, own_key, text_key)
             .join(cut_lineage(nearest), dir_, "left").drop(dir_))
    return found.select("*", F.coalesce("own_licence", granted).alias("licence"),
                        F.when(F.col("own_licence").isNotNull(), F.col(by)).otherwise(F.col(from_dir)).alias("licensed_by")
                        ).withColumn("n_headers", F.coalesce("n_headers", F.lit(0)).cast("bigint")).drop(from_dir, granted, by)


#: The documents have no paths; this rule, for both engines, gives them: a source is a project, a language a folder in it,
#: and some documents are the licence files of a project, a language folder or a folder below.
PATH_SQL = """CASE WHEN doc_id % 50 = 0 THEN concat(source, '/LICENSE-', CAST(doc_id AS VARCHAR(20)))
 WHEN doc_id % 20 = 0 THEN concat(source, '/', lang, '/LICENSE-', CAST(doc_id AS VARCHAR(20)))
 WHEN doc_id % 10 = 0 THEN concat(source, '/', lang, '/d', CAST(doc_id % 8 AS VARCHAR(20)), '/LICENSE-', CAST(doc_id AS VARCHAR(20)))
 ELSE concat(source, '/', lang, '/d', CAST(doc_id % 8 AS VARCHAR(20)), '/doc-', CAST(doc_id AS VARCHAR(20)), '.txt') END"""


def document_path() -> Column:
    """``PATH_SQL`` as DuckDB reads it: a null part of a path is left out of it (Spark's own ``concat`` would make the path null)."""
    return F.expr(PATH_SQL.replace("concat(", "concat_ws('', "))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _match_sql(name: str, found: str, templates: str, least: float) -> str:
    """Expressions up to ``name`` (key, licence, cosine) over ``found`` (key, n, text) and ``templates`` (template, licence, text)."""
    return f"""{name}_ht AS MATERIALIZED (SELECT key, n, token, count(*) AS tf FROM (SELECT key, n, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM {found}) GROUP BY ALL),
 {name}_tt AS MATERIALIZED (SELECT template, licence, token, count(*) AS tf FROM (SELECT template, licence, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM {templates}) GROUP BY ALL),
 {name}_idf AS MATERIALIZED (SELECT token, ln(((SELECT coalesce(sum(n), 0) FROM {found}) + (SELECT count(*) FROM {templates}) + 1) / (sum(n) + 1)) + 1 AS idf
  FROM (SELECT token, n FROM {name}_ht UNION ALL SELECT token, 1 FROM {name}_tt) GROUP BY token),
 {name}_hw AS (SELECT key, token, tf * idf AS w FROM {name}_ht JOIN {name}_idf USING (token)),
 {name}_tw AS (SELECT template, licence, token, tf * idf AS w FROM {name}_tt JOIN {name}_idf USING (token)),
 {name}_scored AS (SELECT d.key, d.licence, round(d.dot / (h.norm * t.norm), 9) AS cosine
  FROM (SELECT h.key, t.template, t.licence, sum(h.w * t.w) AS dot FROM {name}_hw h JOIN {name}_tw t USING (token) GROUP BY ALL) d
  JOIN (SELECT key, sqrt(sum(w * w)) AS norm FROM {name}_hw GROUP BY key) h USING (key)
  JOIN (SELECT template, sqrt(sum(w * w)) AS norm FROM {name}_tw GROUP BY template) t USING (template)),
 {name} AS MATERIALIZED (SELECT key, licence, cosine FROM {name}_scored WHERE cosine >= {least} QUALIFY row_number() OVER (PARTITION BY key ORDER BY cosine DESC, licence) = 1)"""


def _values_sql(templates: list[tuple[str, str]]) -> str:
    return f"(SELECT * FROM (VALUES {', '.join(f'({i}, {_quoted(n)}, {_quoted(t)})' for i, (n, t) in enumerate(templates))}) v(template, licence, text))"


#: Rows are files by their number, so a repeated or missing id does not mix them.
ORACLE_SQL = f"""WITH files AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, path, text, regexp_extract(path, '([^/]*)$', 1) AS name FROM (SELECT doc_id, {PATH_SQL} AS path, text FROM documents)),
 notices AS {_values_sql(TEMPLATES)}, full_texts AS {_values_sql(FULL_TEXTS)},
 lines AS MATERIALIZED (SELECT rid, header AS key FROM (SELECT rid, unnest(string_split_regex(text, '{BREAK}')) AS header FROM files) WHERE regexp_matches(lower(header), '{ANCHOR}')),
 distinct_lines AS MATERIALIZED (SELECT key, count(*) AS n, key AS text FROM lines GROUP BY key),
 licence_files AS MATERIALIZED (SELECT rid, text AS key FROM files WHERE starts_with(name, 'LICENSE') AND regexp_matches(lower(text), '{ANCHOR}')),
 distinct_files AS MATERIALIZED (SELECT key, count(*) AS n, key AS text FROM licence_files GROUP BY key),
 {_match_sql("by_line", "distinct_lines", "notices", LEAST_COSINE)},
 {_match_sql("by_file", "distinct_files", "full_texts", LEAST_FILE_COSINE)},
 of_lines AS MATERIALIZED (SELECT rid, count(*) AS n_headers, max(cosine) AS cosine, arg_min(licence, (-cosine, licence)) AS licence FROM lines LEFT JOIN by_line USING (key) GROUP BY rid),
 of_files AS MATERIALIZED (SELECT rid, licence, cosine FROM licence_files JOIN by_file USING (key)),
 placed AS MATERIALIZED (SELECT f.rid, doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, name, coalesce(w.licence, l.licence) AS own_licence,
  CASE WHEN w.licence IS NOT NULL THEN w.cosine ELSE l.cosine END AS cosine, CASE WHEN w.licence IS NOT NULL THEN 'file' ELSE 'header' END AS found_by, coalesce(n_headers, 0) AS n_headers
  FROM files f LEFT JOIN of_lines l ON f.rid = l.rid LEFT JOIN of_files w ON f.rid = w.rid),
 grants AS (SELECT dir AS above, arg_min(own_licence, (-cosine, own_licence)) AS granted FROM placed WHERE own_licence IS NOT NULL AND starts_with(name, 'LICENSE') GROUP BY dir),
 nearest AS (SELECT d.dir, above, granted FROM (SELECT DISTINCT dir FROM placed) d JOIN grants ON d.dir = above OR starts_with(d.dir, concat(above, '/'))
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(above) DESC) = 1)
 SELECT doc_id, path, own_licence, round(cosine, 6) AS cosine, CAST(n_headers AS BIGINT) AS n_headers, coalesce(own_licence, granted) AS licence,
  CASE WHEN own_licence IS NOT NULL THEN found_by ELSE above END AS licensed_by FROM placed LEFT JOIN nearest USING (dir)"""
