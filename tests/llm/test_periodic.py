"""Periodic runs against a plain search of every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every maximal stretch of every period, the smallest period of each."""
    runs, seen, n = [], set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                runs.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    keep = [True] * len(words)
    for s, n, q in runs:
        keep[s + q:s + n] = [False] * (n - q)
    return " ".join(w for w, k in zip(words, keep) if k)


def some_text(rng):
    n = int(rng.integers(0, 300))
    w = rng.integers(0, int(rng.choice([1, 2, 3, 40])), n)
    for _ in range(int(rng.integers(0, 4))):
        if n > 8:
            p, a = int(rng.integers(1, n // 4)), int(rng.integers(0, n))
            size = int(rng.integers(1, n - a + 1))
            w[a:a + size] = np.resize(w[a:a + p], size)
    return " ".join(f"w{x}" for x in w)


def test_z_function():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.integers(0, 2, int(rng.integers(0, 30))).tolist()
        z = periodic.z_function(s)
        for i in range(len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k
    assert periodic.primes_of(1) == [] and periodic.primes_of(12) == [2, 3] and periodic.primes_of(49) == [7] and periodic.primes_of(13) == [13]


def check(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    runs = [plain_runs(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    found = {}
    for r in periodic.periodic_runs(df).collect():
        found.setdefault(r.doc_id, []).append((r.run_start, r.run_length, r.run_period))
    assert [sorted(found.get(i, []), key=lambda r: (r[0], r[2])) for i in range(len(texts))] == runs
    whole = {r.doc_id: r for r in periodic.collapse_runs(df).collect()}
    short = {r.doc_id: r for r in periodic.collapse_runs(df, digest=True).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        best = min(runs[i], key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        for r in (whole[i], short[i]):
            assert (r.run_words, r.run_count, r.run_start, r.run_length, r.run_period) == (len(words), len(runs[i]), *best)
        assert whole[i].text == collapsed(words, runs[i])
        assert short[i].collapsed_sha256 == hashlib.sha256(whole[i].text.encode()).hexdigest()
        assert short[i].runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs[i]).encode()).hexdigest()


FIXED = ["", None, " \t ", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "x a b c a b c a b c a b c a b y", "a  b\ta\x0bb a\nb\ra b end",
         "a b " * 3 + "c " + "a b " * 5, "a a b " * 40, "a " * 700, "é é é é é é", " ".join(str(i % 150) for i in range(640))]


def test_equal_to_a_plain_search(spark):
    rng = np.random.default_rng(1)
    check(spark, FIXED + [some_text(rng) for _ in range(120)])


def test_small_tiles_and_tiles_as_rows(spark, monkeypatch):
    def tiles(n, k):
        size, step = 12 << k, 6 << k
        out = [(0, min(n, size))]
        while out[-1][1] < n:
            at = out[-1][0] + step
            out.append((at, min(n, at + size)))
        return out
    rng = np.random.default_rng(2)
    texts = FIXED + [some_text(rng) for _ in range(60)]
    parts = [np.array([hash(w) % 1000003 for w in (t or "").split()], np.int64) for t in texts]
    monkeypatch.setattr(periodic, "tiles", tiles)
    for words, found in zip(parts, periodic.fragments(parts)):      # stitched here as the shuffle does
        runs = {}
        for p, s, t in sorted(found):
            last = runs.setdefault(p, [])
            if last and s <= last[-1][1] - p:
                last[-1][1] = max(last[-1][1], t)
            else:
                last.append([s, t])
        got = sorted(((s, t - s, p) for p, of in runs.items() for s, t in of if t - s >= max(6, 4 * p)), key=lambda r: (r[0], r[2]))
        assert got == plain_runs(words.tolist())
    monkeypatch.setattr(periodic, "IN_PLACE", 20)
    check(spark, texts)


def test_repeated_rows_clashing_columns_and_empty_table(spark):
    rows = [(None, "a a a a a a", 1, "x"), (None, "a a a a a a", 1, "x"), (5, "a a a a a a", 2, None), (5, "b", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run_count int, sha string")
    got = periodic.collapse_runs(df)
    assert got.columns == ["doc_id", "text", "sha", "run_words", "run_count", "run_start", "run_length", "run_period"]
    assert sorted((str(r.doc_id), r.text, r.sha, r.run_count) for r in got.collect()) == [
        ("5", "a", None, 1), ("5", "b", None, 0), ("None", "a", "x", 1), ("None", "a", "x", 1)]
    assert periodic.collapse_runs(df.limit(0), digest=True).count() == 0 and periodic.periodic_runs(df.limit(0)).count() == 0
    assert periodic.collapse_runs(df.select("text")).count() == 4


def test_query_on_whole_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        words, h = re.findall(r"[^\x20\x09-\x0D]+", r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, o = plain_runs(words), got[r.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (o.n_runs, o.start, o.length, o.period) == (len(runs), *best)
        assert o.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert o.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_planting_of_odd_rows(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    texts = [None, "", " \n ", "\ta b  c d e f g\x0b"]
    df = spark.createDataFrame([*zip(ids, texts), (None, "x y")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in queries.with_planted_periods(df).collect()}
    assert got[ids[0]] is None and got[ids[1]] == "" and got[None] == "x y" and len(got[ids[3]].split()) == 7


if __name__ == "__main__":
    pytest.main([__file__])
