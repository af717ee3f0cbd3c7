"""Near duplicates and repeated strings against brute force."""

import hashlib
import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import minhash, suffix
from shoplens.llm.common import words
from shoplens.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def got_groups(df):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    return out


def test_near_duplicates_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert got_groups(df) == brute_groups([tuple(r) for r in df.collect()])


def test_near_duplicates_of_one_large_group_and_edges(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):                       # copies with edits: some linked, some only through others
        own = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            own[at] = f"x{k}_{at}"
        rows.append(" ".join(own))
    rows += ["", None, "   \n\t", "one two", "ONE  two", "one two three", " ".join(base), "é È é È é"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert got_groups(df) == brute_groups(list(enumerate(rows)))
    small = minhash.BLOCK_BYTES
    minhash.BLOCK_BYTES = 2048                # clusters then meet block against block
    try:
        assert got_groups(df) == brute_groups(list(enumerate(rows)))
    finally:
        minhash.BLOCK_BYTES = small


def test_near_duplicates_kept_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, None)],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3, False), (3, 3, True), (3, 3, True), (None, 3, None), (9, 9, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_optimal_densification_agrees_like_jaccard():
    rng = np.random.default_rng(0)
    share = []
    for _ in range(60):
        both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (30, 5, 5))
        share.append((minhash.signature(np.unique(np.r_[both, a])) == minhash.signature(np.unique(np.r_[both, b]))).mean())
    assert abs(np.mean(share) - 0.75) < 0.04
    assert len(set(minhash.signature(np.array([7], np.uint64)).tolist())) == 1


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (7, 3), (10, 11), (5, 5), (2, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in (1, 2, 3, 7)} == {1} and got[11] == 10 and got[5] == 5
    assert {got[x] for x in range(100, 141)} == {100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(rows, length):
    seen = {}
    for i, raw in enumerate(rows):
        for a in range(len(raw) - length + 1):
            seen.setdefault(raw[a:a + length], []).append((i, a))
    cover = [np.zeros(len(r), bool) for r in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                cover[i][a:a + length] = True
    out = []
    for raw, c in zip(rows, cover):
        kept = np.frombuffer(raw, np.uint8)[~c].tobytes()
        out.append((len(raw), int(c.sum()), int((np.diff(np.r_[0, c.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got_spans(spark, rows, length):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.repeat_bytes, r.repeat_removed, r.repeat_spans, r.repeat_sha256)
           for r in suffix.remove_repeats(df, digest=True, length=length).collect()}
    return [got[i] for i in range(len(rows))]


EDGE = ["", "x" * 150, "a" * 500, "ab" * 300, "Heat " * 100, None, "q" * 199 + "z", "é" * 100, "é" * 101] + \
    ["".join(chr(97 + (i * j * 7 + i) % 5) for i in range(260)) for j in range(4)] * 2


@pytest.mark.parametrize("length", [200, 23])
def test_repeated_strings_of_edge_texts(spark, length):
    assert got_spans(spark, EDGE, length) == brute_spans([(x or "").encode() for x in EDGE], length)


def test_repeated_strings_equal_brute_force_also_beyond_the_group_bound(spark):
    rows = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    want = brute_spans([x.encode() for x in rows], 200)
    assert got_spans(spark, rows, 200) == want
    bound = suffix.GROUP
    suffix.GROUP = 2
    try:
        assert got_spans(spark, rows, 200) == want
    finally:
        suffix.GROUP = bound


def test_remove_repeats_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "k" * 250, "x", 2), (2, "k" * 230 + "ü", "y", 3)], "doc_id long, text string, key string, rest int")
    got = sorted(suffix.remove_repeats(df).collect())
    assert [(r.doc_id, r.text, r.key, r.rest, r.repeat_spans) for r in got] == [(1, "", "x", 2, 1), (2, "ü", "y", 3, 1)]
    assert suffix.remove_repeats(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=120), min_size=1, max_size=6))
def test_windows_of_a_segment_by_transform(texts):
    """Every window that the transform calls repeated is, and no other (one anchor, place 0)."""
    parts = sorted({("#" * 8 + t).encode() for t in texts})
    runs = suffix.repeated_windows(parts, np.zeros(len(parts), np.int64), np.zeros(len(parts)), np.zeros(len(parts), bool), length=30)
    for i, part in enumerate(parts):
        got = {a for k in range(0, len(runs[i]), 2) for a in range(runs[i][k], runs[i][k + 1])}
        want = {a for a in range(len(part) - 29) if any(part[a:a + 30] == o[a:a + 30] for j, o in enumerate(parts) if j != i)}
        assert got == want


def test_links_between_labels_equal_every_pair():
    rng = np.random.default_rng(8)
    for _ in range(60):
        sets = [np.unique(rng.choice(40, int(rng.integers(1, 30)))).astype(np.uint64) for _ in range(25)]
        labels = [int(x) for x in rng.integers(0, 6, 25)]
        links = minhash._links_in(list(range(25)), labels, [s.tobytes() for s in sets], 75)

        def groups(pairs):
            top = {x: x for x in labels}

            def find(x):
                while top[x] != x:
                    x = top[x]
                return x
            for i, j in pairs:
                a, b = find(labels[i]), find(labels[j])
                top[max(a, b)] = min(a, b)
            return [find(x) for x in labels]

        def similar(i, j):
            both = len(np.intersect1d(sets[i], sets[j]))
            return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
        assert all(similar(i, j) and labels[i] != labels[j] for i, j in links) and len(links) < 6
        assert groups(links) == groups([p for p in itertools.combinations(range(25), 2) if similar(*p)])


def test_components_of_a_hub_with_many_edges(spark):
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(400, 460)] + [(399, 430), (900, 900), (800, 801), (801, 800)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(461)}, 900: 900, 800: 800, 801: 800}


def test_string_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("b", text), ("a", text + " end"), ("c", "other words of a text that stands alone here"), (None, text), ("d", None)]
    got = {r.id: (r.component, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "key string, text string"), "key")
           .selectExpr("key as id", "component_id as component", "kept").collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True), None: ("a", None), "d": ("d", True)}
