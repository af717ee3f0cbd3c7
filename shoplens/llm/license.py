"""Licence scan with DataFrame functions only.

1. *Notices.*  Lines that speak of a licence, and the lines between two of them that are
   no more than ``GAP`` lines apart, form a passage: a one-line notice, a header, a
   licence file.  Each line that speaks of a licence, each run of at most ``RUN``
   paragraphs of a passage and each whole passage is a notice of its own, so other
   lines do not dilute it.
2. *Scores.*  Each distinct notice is compared with each template (one-line notices,
   whole standard headers, licence files and openings of long ones) by the cosine of
   their TF-IDF vectors, kept sparse as (text, term, weight) rows and joined on the
   term; a notice that millions of files carry is scored once.  IDF comes from the
   templates, a fixed table.  An SPDX tag needs no cosine: it names its licence.  The
   best notice of a file gives its licence.
3. *Directories.*  A licence file speaks for its directory.  A file without a
   licence of its own takes the licence of the nearest ancestor directory that has
   one: the directories' paths are joined with each file's ancestor paths, and the
   longest wins.

Edge cases: null or empty texts and texts without such a line have no own licence
(score 0); a null path inherits nothing; a tie between templates or notices goes to the
alphabetically first; several licence files of one directory give a sorted, distinct,
comma-joined licence; an SPDX expression, or an identifier without a template, is kept
as written; repeated rows are judged alike; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import ascii_lower, stage
from shoplens.llm.license_texts import TEXTS

THRESHOLD = 0.5
GAP = 4             # other lines between two lines of a passage, at most
RUN = 5             # paragraphs that are read together, at most

# Short public licence statements by SPDX id.
TEMPLATES = {
    "AGPL-3.0": "This program is free software licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0, the Creative Commons Attribution NonCommercial 4.0 License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0, the Creative Commons Attribution ShareAlike 4.0 License.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0, No Rights Reserved.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "Copyright. All rights reserved. Unauthorized copying and distribution is prohibited.",
}
KEYWORDS = (r"(?i)licen[cs]e|copyright|all rights reserved|public domain|spdx-|creative commons|redistribution|permission is hereby|"
            r"hereby granted|free software|warrant|liab(le|ility)|neither the name|permission notice|gnu\.org|"
            r"subject to the terms|mozilla|obtain (?:one|a copy)")
TERM_SEPARATORS = r"[^a-z0-9.]+"
MARKERS = r"^(?:[\s/*#;%!<>'\"|-]+|(?i:dnl|rem)\s)+"        # comment signs before a line
SPDX = (r"^\W*(?i:spdx-license-identifier)\s*:\s*(\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*(?:\s+(?i:and|or|with)\s+"
        r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*)*)(?:\s*[-*/#>]+)?\s*$")
PART = "\x1f"      # parts the passages of a statement


def with_statement(files: DataFrame, text_col: str, out: str = "statement") -> DataFrame:
    """``files`` plus the passages of a text column that speak of a licence; null if there are none.

    A text without such a line is not cut into lines.
    """
    text = F.col(f"`{text_col}`")
    lines = F.when(text.rlike(KEYWORDS), F.transform(F.split(F.regexp_replace(text, PART, " "), r"\r\n|\r|\n"),
                                                     lambda x: F.trim(F.regexp_replace(x, MARKERS, ""))))
    at = F.filter(F.transform("__lines", lambda x, i: F.when(x.rlike(KEYWORDS), i)), lambda i: i.isNotNull())
    k, n = F.col("__at"), F.size("__at")
    near = GAP + 1
    first = F.filter(k, lambda x, j: (j == 0) | (x - F.get(k, j - 1) > near))
    last = F.filter(k, lambda x, j: (j == n - 1) | (F.get(k, j + 1) - x > near))
    passages = F.zip_with("__first", "__last", lambda a, b: F.array_join(F.slice("__lines", a + 1, b - a + 1), "\n"))
    return (files.withColumn("__lines", lines).withColumn("__at", at).withColumn("__first", first).withColumn("__last", last)
            .withColumn(out, F.when(n > 0, F.array_join(passages, PART))).drop("__lines", "__at", "__first", "__last"))


def _terms(text: Column) -> Column:
    """Words and version numbers of a lower-cased text, without full stops at their ends."""
    parts = F.transform(F.split(text, TERM_SEPARATORS), lambda t: F.regexp_replace(t, r"^\.+|\.+$", ""))
    return F.array_remove(parts, "")


def template_table(spark: SparkSession) -> DataFrame:
    """(template, license, term, idf, w) with weights of length one per template."""
    texts = [*sorted(TEMPLATES.items()), *TEXTS]
    rows = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(texts)], "template int, license string, text string")
    tf = rows.select("template", "license", F.explode(_terms(ascii_lower(F.col("text")))).alias("term")) \
        .groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("term").agg(F.countDistinct("template").alias("df")) \
        .select("term", (F.log((F.lit(1.0) + len(texts)) / (1 + F.col("df"))) + 1).alias("idf"))
    weighted = tf.join(F.broadcast(idf), "term").withColumn("x", F.col("tf") * F.col("idf"))
    norm = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return stage(weighted.join(F.broadcast(norm), "template").select("template", "license", "term", "idf", (F.col("x") / F.col("norm")).alias("w")),
                 "license-templates")


def notices(statements: DataFrame) -> DataFrame:
    """(statement, notice) of distinct statements: whole passages, runs of paragraphs, lines."""
    passages = statements.select("statement", F.explode(F.split("statement", PART)).alias("passage"))
    cut = passages.withColumn("__parts", F.split("passage", r"\n(?:[ \t]*\n)+")) \
        .withColumn("__lines", F.filter(F.split("passage", r"\n"), lambda x: x.rlike(KEYWORDS)))
    parts, n = F.col("__parts"), F.size("__parts")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(RUN), n - i + 1)), lambda size: F.array_join(F.slice(parts, i, size), "\n"))))
    every = F.array_distinct(F.concat(F.array("passage"), runs, F.col("__lines")))
    return cut.select("statement", F.explode(every).alias("notice")).filter(F.col("notice").rlike(KEYWORDS))


def spdx(notice: Column) -> Column:
    """Licence that an SPDX tag names, null for other notices."""
    known = {k.lower(): k for k in [*TEMPLATES, *[k for k, _ in TEXTS]]}
    name = F.regexp_extract(notice, SPDX, 1)
    plain = F.lower(F.regexp_replace(name, r"(?i)(-only|-or-later|\+)$", ""))
    table = F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv])
    return F.when(name != "", F.coalesce(F.try_element_at(table, plain), name))


def score_statements(statements: DataFrame) -> DataFrame:
    """(statement, own_license, own_score) of distinct statements: the template of the largest cosine to one of its notices."""
    table = template_table(statements.sparkSession)                 # a fixed table of a few thousand rows
    unseen = F.log(F.lit(1.0 + len(TEMPLATES) + len(TEXTS))) + 1    # idf of a term in no template
    pairs = stage(notices(statements), "license-notices")
    distinct = pairs.select("notice").distinct().withColumn("tag", spdx(F.col("notice")))
    tagged = distinct.filter("tag is not null").select("notice", F.col("tag").alias("own_license"), F.lit(1.0).alias("own_score"))
    tf = distinct.filter("tag is null").select("notice", F.explode(_terms(ascii_lower(F.col("notice")))).alias("term")) \
        .groupBy("notice", "term").agg(F.count("*").alias("tf"))
    # the templates of a term in one row, so that a term met is one row until they are added up
    terms = table.groupBy("term").agg(F.first("idf").alias("idf"), F.collect_list(F.struct("template", "license", "w")).alias("held"))
    weighted = tf.join(F.broadcast(terms), "term", "left").select("notice", "held", (F.col("tf") * F.coalesce("idf", unseen)).alias("x"))
    norm = weighted.groupBy("notice").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighted.select("notice", "x", F.explode("held").alias("t")).groupBy("notice", F.col("t.template").alias("template"), F.col("t.license").alias("license")) \
        .agg(F.sum(F.col("x") * F.col("t.w")).alias("dot"))
    # the largest rounded score, and of equal ones the alphabetically first licence
    near = dots.join(norm, "notice").select("notice", "license", F.least(F.col("dot") / F.col("norm"), F.lit(1.0)).alias("score"))
    pick = lambda score, name: F.min(F.struct((-F.round(score, 9)).alias("r"), F.col(name).alias("own_license"), F.col(score).alias("own_score"))).alias("m")
    named = near.groupBy("notice").agg(pick("score", "license")).select("notice", "m.own_license", "m.own_score").unionByName(tagged)
    return pairs.join(named, "notice").groupBy("statement").agg(pick("own_score", "own_license")).select("statement", "m.own_license", "m.own_score")


def ancestors(path: Column) -> Column:
    """All directories above a path, nearest first; the root is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", is_license_file: Column | None = None,
         threshold: float = THRESHOLD, first_by: str | None = None) -> DataFrame:
    """``files`` plus own_license, own_score, license and license_dir.

    ``license`` is the file's own or the inherited one, ``license_dir`` the directory
    that it comes from (null if it is the file's own).  ``is_license_file`` marks the
    files that speak for their directory; by default those named LICENSE, LICENCE,
    COPYING or NOTICE, with any extension.  With ``first_by``, of these only the ones of
    the directory's least value of that column speak, among those with an own licence.
    """
    if is_license_file is None:
        is_license_file = F.element_at(F.split(F.col(path_col), "/"), -1).rlike(r"(?i)^(licen[cs]e|copying|notice)(\..*)?$")
    added = ("own_license", "own_score", "license", "license_dir")
    kept = [c for c in files.columns if c not in added]
    first = F.col(f"`{first_by}`") if first_by else F.lit(0)
    lean = with_statement(files.select(F.col(f"`{path_col}`").alias("__path"), is_license_file.alias("__speaks"), first.alias("__first_by"),
                                       F.col(f"`{text_col}`").alias("__text")), "__text").drop("__text")
    stated = stage(lean.filter("statement is not null"), "license-stated")
    scored = stage(score_statements(stated.select("statement").distinct())
                   .filter(F.col("own_score") >= threshold), "license-scores")
    speaking = (stated.filter("__speaks and __path is not null and __first_by is not null").join(scored, "statement")
                .select(F.array_join(F.slice(F.split("__path", "/"), 1, F.size(F.split("__path", "/")) - 1), "/").alias("dir"), "__first_by", "own_license"))
    joint = speaking.groupBy("dir", "__first_by").agg(F.array_join(F.array_sort(F.collect_set("own_license")), ",").alias("dir_license"))
    dirs = stage(joint.groupBy("dir").agg(F.min(F.struct("__first_by", "dir_license")).alias("m")).select("dir", F.col("m.dir_license").alias("dir_license")),
                 "license-dirs")
    # the nearest licensed directory of every directory that holds files, found once per directory
    homes = files.select(F.col(f"`{path_col}`").alias("__path")).filter("__path is not null") \
        .select(F.element_at(ancestors(F.col("__path")), 1).alias("home")).distinct()
    up = homes.select("home", F.explode(F.concat(F.array("home"), F.when(F.col("home") != "", ancestors(F.col("home")))
                                                 .otherwise(F.array().cast("array<string>")))).alias("dir"))
    nearest = (up.join(dirs, "dir").groupBy("home").agg(F.max(F.struct(F.length("dir").alias("n"), "dir", "dir_license")).alias("m"))
               .select("home", F.col("m.dir").alias("dir"), F.col("m.dir_license").alias("dir_license")))
    nearest = stage(nearest, "license-nearest")
    out = (with_statement(files.select(*[f"`{c}`" for c in kept], F.element_at(ancestors(F.col(f"`{path_col}`")), 1).alias("__home")), text_col, "__statement")
           .join(scored.withColumnRenamed("statement", "__statement"), "__statement", "left")
           .join(nearest.withColumnRenamed("home", "__home"), "__home", "left"))
    return out.select(*[f"`{c}`" for c in kept], "own_license", F.coalesce("own_score", F.lit(0.0)).alias("own_score"),
                      F.coalesce("own_license", "dir_license").alias("license"),
                      F.when(F.col("own_license").isNull(), F.col("dir")).alias("license_dir"))
