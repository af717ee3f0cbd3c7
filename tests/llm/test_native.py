"""Operators made of DataFrame functions against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shoplens.llm import decontaminate, fingerprint, license

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def item_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_hits(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for i in range(max(len(w) - n, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, hit, found = item_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (got := windows.get(tuple(w[i:i + size]))):
                    hit |= set(range(i, i + size))
                    found |= got
        out.append((key, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


def got_hits(docs, bench):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated)
                   for r in decontaminate.contaminated(docs, bench).collect()], key=str)


def test_decontamination_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert got_hits(docs, bench) == brute_hits([tuple(r) for r in docs.collect()], [tuple(r) for r in bench.collect()])


def test_decontamination_edges(spark):
    long = " ".join(f"w{i}" for i in range(14))
    docs = [(1, f"Pre {long.upper()}! post"), (2, None), (3, ""), (4, "Short item, here"), (4, "Short item, here"), (5, f"{long} {long}"),
            (None, "short ITEM"), (6, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (7, "ünï-códe 日本")]
    bench = [(1, long), (2, "short item"), (3, None), (4, "..."), (5, "SHORT-item"), (6, "日本")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert got_hits(d, b) == brute_hits(docs, bench)
    assert {r[0] for r in got_hits(d, b.limit(0)) if r[5]} == set() and got_hits(d.limit(0), b) == []
    assert sorted(str(r.doc_id) for r in decontaminate.drop_contaminated(d, b).collect()) == ["2", "3", "6"]
    bound = decontaminate.BROADCAST_WINDOWS
    decontaminate.BROADCAST_WINDOWS = 0          # the join without a broadcast
    try:
        assert got_hits(d, b) == brute_hits(docs, bench)
    finally:
        decontaminate.BROADCAST_WINDOWS = bound


def test_strip_takes_the_hit_words_out(spark):
    d = spark.createDataFrame([(1, "-- Keep Short item, here."), (2, "clean"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "short ITEM")], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.strip_contaminated(d, b).collect()}
    assert got == {1: "-- Keep here.", 2: "clean", 3: None}


@pytest.mark.parametrize("ranges", [20, 1])
def test_edited_texts(spark, ranges):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:60] + [(900, None), (901, "x"), (902, "日本語 テスト")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = {r.doc_id: r for r in fingerprint.edited_fingerprints(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    texts = {i: t or "" for i, t in docs}
    order = sorted(texts, reverse=True)
    assert len(got) == len(docs)
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[900].near_edited == 1.0 and list(got[900].sketch) == []


def test_sketches(spark):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(4000))
    df = spark.createDataFrame([(1, a), (2, a), (3, b), (4, f"{a} {b}"), (5, ""), (6, "Hi"), (6, "hi")], "doc_id long, text string")
    s = {r.doc_id: set(r.sketch) for r in fingerprint.fingerprints(df).collect()}
    assert s[1] == s[2] and not s[5] and len(s[6]) == 1
    assert abs(len(s[3]) - 3996 / 8) < 100 and s[1] <= s[4]                      # containment of a short text in a long one
    assert s[1] | s[3] <= s[4] and len(s[4] - s[1] - s[3]) <= 4                  # merging by union
    one = df.filter("doc_id = 4")
    assert fingerprint.edited_fingerprints(one).first().near_next == 1.0         # its own next
    assert fingerprint.edited_fingerprints(df.limit(0)).count() == 0


def test_license_scores_and_inheritance(spark):
    files = [("LICENSE", "Released under the MIT License."), ("a/b.py", "x = 1"), ("a/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
             ("a/c/d.py", "text\nThis work is licensed under the GNU General Public License, version 3.\nmore"), ("a/c/e/f.py", None),
             ("g/h.py", ""), (None, "Released under the MIT License."), ("g/h.py", ""), ("g/COPYING", "We ship all our copyright things with love and care")]
    df = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit("clash"))
    got = sorted([(r.path, r.own_license, r.license, r.license_dir) for r in license.scan(df).collect()], key=str)
    assert got == sorted([("LICENSE", "MIT", "MIT", None), ("a/b.py", None, "Apache-2.0", "a"), ("a/LICENSE.txt", "Apache-2.0", "Apache-2.0", None),
                          ("a/c/d.py", "GPL-3.0", "GPL-3.0", None), ("a/c/e/f.py", None, "Apache-2.0", "a"), ("g/h.py", None, "MIT", ""),
                          ("g/h.py", None, "MIT", ""), (None, "MIT", "MIT", None), ("g/COPYING", None, "MIT", "")], key=str)
    assert license.scan(df.limit(0)).count() == 0


def test_every_template_names_itself(spark):
    df = spark.createDataFrame([(k, t) for k, t in license.TEMPLATES.items()], "path string, text string")
    assert all(r.own_license == r.path and abs(r.own_score - 1) < 1e-9 for r in license.scan(df).collect())


APACHE = """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
MIT = """MIT License

Copyright (c) 2019 The Authors of Something

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Copyright (c) The Regents of the University of California.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""


def test_real_headers_and_licence_files(spark):
    code = "\n".join(f"value_{i} = call({i}, other)" for i in range(40))
    hashed = "\n".join(f"# {x}".rstrip() for x in APACHE.split("\n"))
    starred = "/*\n" + "\n".join(f" * {x}".rstrip() for x in GPL.split("\n")) + "\n */"
    mixed = f"{hashed}\n{code}\n# see the license of the copyright owners, redistribution of this warranty\n{code}\n# Copyright 2001 Someone Else Entirely"
    affero, older = GPL.replace("GNU General", "GNU Affero General"), GPL.replace("version 3", "version 2")
    cases = [("a/x.py", f"#!/bin/sh\n{hashed}\n{code}", "Apache-2.0"), ("b/x.c", f"{starred}\n{code}", "GPL-3.0"), ("c/COPYING", affero, "AGPL-3.0"),
             ("d/x.c", older, "GPL-2.0"), ("e/LICENSE", MIT, "MIT"), ("f/LICENSE", BSD, "BSD-3-Clause"), ("g/x.js", f"/* {MPL} */\n{code}", "MPL-2.0"),
             ("h/x.py", f"# SPDX-License-Identifier: MIT\n{code}", "MIT"), ("i/x.c", "/* SPDX-License-Identifier: gpl-2.0-or-later */", "GPL-2.0"),
             ("j/x.c", "// SPDX-License-Identifier: EUPL-1.2", "EUPL-1.2"), ("k/x.rs", "// SPDX-License-Identifier: MIT OR Apache-2.0", "MIT OR Apache-2.0"),
             ("l/x.py", mixed, "Apache-2.0"), ("m/x.md", f"{code}\n\n{MIT}\n\n{code}", "MIT"), ("n/x.py", code, None), ("e/y.py", code, "MIT")]
    got = {r.path: r for r in license.scan(spark.createDataFrame([c[:2] for c in cases], "path string, text string")).collect()}
    assert {p: got[p].license for p, _, _ in cases} == {p: want for p, _, want in cases}
    assert all(got[p].own_score > 0.85 for p, _, want in cases if want and p != "e/y.py") and got["e/y.py"].license_dir == "e"


def test_first_licensed_file_speaks_for_its_directory(spark):
    rows = [(3, "a/3", "Released under the MIT License."), (2, "a/2", "a copyright joke without any licence whatsoever to tell"),
            (5, "a/5", "SPDX-License-Identifier: ISC"), (9, "a/9", None)]
    df = spark.createDataFrame(rows, "k long, path string, text string")
    got = {r.k: (r.license, r.license_dir) for r in license.scan(df, is_license_file=F.lit(True), first_by="k").collect()}
    assert got == {2: ("MIT", "a"), 3: ("MIT", None), 5: ("ISC", None), 9: ("MIT", "a")}


def test_items_without_id_are_hits_as_in_the_sql(spark, tmp_path):
    import duckdb

    from shoplens.llm import queries

    docs = [(1, "one Secret Passage here"), (2, "clean"), (3, "secret passage and known item"), (4, None)]
    bench = [(None, "secret passage"), (None, "SECRET passage"), (7, "known item"), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        want = sorted(db.execute(queries.ORACLE_SQL["op10_decontaminate"]).fetchall())
    got = sorted(tuple(r) for r in queries.op10_decontaminate(spark, str(tmp_path)).collect())
    assert got == want and [r[2:4] + r[5:] for r in got] == [(2, 1, True), (0, 0, False), (4, 2, True), (0, 0, False)]
    found = decontaminate.contaminated(*[spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "benchmark")])
    assert {r.doc_id: r["items"] for r in found.collect()} == {1: [None], 2: [], 3: ["7", None], 4: []}


def test_shuffled_windows_carry_their_own_words_only(spark, monkeypatch):
    words = [f"w{i % 700}x{i // 700}" for i in range(1500)]
    docs = [(1, " ".join(words)), (2, " ".join(words[700:760])), (3, "short ITEM here")]
    bench = [(1, " ".join(words[40:55])), (2, "short item"), (3, " ".join(words[1400:1412]))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    sent, stage = [], decontaminate.stage

    def look(df, tag):
        nodes = [df._jdf.queryExecution().optimizedPlan()] if tag == "decontaminate-hits" else []
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Join":
                side = node.children().apply(0).output()
                sent.append({side.apply(i).name() for i in range(side.size())})
        return stage(df, tag)

    monkeypatch.setattr(decontaminate, "stage", look)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert got_hits(d, b) == brute_hits(docs, bench)
    assert sent and all(s == {"id", "tkey", "at", "h", "run"} for s in sent)


def test_windows_of_documents_are_cut_only_where_a_hash_meets(spark, monkeypatch):
    plans, stage = [], decontaminate.stage

    def look(df, tag):
        if tag == "decontaminate-hits":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stage(df, tag)

    monkeypatch.setattr(decontaminate, "stage", look)
    text = "one two three four five six seven eight nine ten eleven"
    d = spark.createDataFrame([(1, "x " + text), (2, "ten nine eight seven six five four three two one zero"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([("a", text), ("b", "three four")], "item_id string, text string")
    got = {r.doc_id: (list(r["items"]), r.n_hit) for r in decontaminate.contaminated(d, b).collect()}
    assert got == {1: (["a", "b"], 11), 2: ([], 0), 3: ([], 0)}
    joins = [line for line in plans[0].splitlines() if "HashJoin" in line]
    assert len(joins) == 2 and all(re.search(r"HashJoin \[h#\d+L\], \[h#\d+L\]", line) for line in joins)     # the hash alone is the key
