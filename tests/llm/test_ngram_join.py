import random
from collections import defaultdict

import numpy as np
import pytest

from larkspur.llm import ngram_join as nj
from larkspur.llm.components import components
from larkspur.llm.queries import QUERIES
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows, words


def grams(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent):
    """{id: {(size of a set, component)}} by comparing all pairs of distinct sets."""
    sets = defaultdict(list)
    for i, t in rows:
        sets[grams(t, n)].append(i)
    distinct = sorted((s for s in sets if s), key=lambda s: min(sets[s]))
    parent = list(range(len(distinct)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    for k, s in enumerate(distinct):
        for o in range(k):
            if 100 * len(s & distinct[o]) >= percent * len(s | distinct[o]):
                join(k, o)
    out = defaultdict(set)
    for k, s in enumerate(distinct):
        for i in sets[s]:
            out[i].add((len(s), min(sets[distinct[find(k)]])))
    for i in sets.get(frozenset(), []):
        out[i].add((0, i))
    return dict(out)


def found(df, n, percent):
    out = defaultdict(set)
    for r in nj.near_duplicates(df, nj.Threshold(n, percent)).collect():
        out[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    return dict(out)


def near_copies(seed):
    """Groups of copies with a few words changed, chains of them, short texts, and a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    shared = [word() for _ in range(30)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 8, 12, 30, 90, 200]))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                base = copy
            rows.append(copy + (shared if rng.random() < 0.3 else []))
    rng.shuffle(rows)
    return [(i * 3 + 1, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2), (2, 60, 3), (1, 100, 4)])
def test_against_all_pairs(spark, n, percent, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df, n, percent) == brute(rows, n, percent)


def test_query_against_all_pairs(spark):
    rows = [(d["doc_id"], d["text"]) for d in documents()]
    got = {r["doc_id"]: {(r["n_shingles"], r["component_id"])} for r in QUERIES["op9_ngram_jaccard_join"](spark, SF_DIR).collect()}
    assert got == brute(rows, 3, 90)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = found(odd_docs(spark), 3, 90)
    want = brute([r for r in rows if r[0] is not None], 3, 90)
    nulls = got.pop(None)
    assert nulls == {(1, None), (0, None)}
    assert got == want
    assert found(no_docs(spark), 3, 90) == {}


@pytest.mark.parametrize("words_, percent", [(3, 90), (5, 80), (5, 100), (2, 50)])
def test_sets_over_the_threshold_share_a_signature(words_, percent):
    t = nj.Threshold(words_, percent)
    rng = np.random.default_rng(7)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        differ = int(rng.integers(0, t.differing(len(one)) + 1))
        drop = int(rng.integers(0, min(differ, len(one) - 1) + 1))
        two = np.unique(np.concatenate([rng.permutation(one)[drop:], rng.integers(0, 2**64, differ - drop, dtype=np.uint64)]))
        both = len(np.intersect1d(one, two))
        if 100 * both >= percent * (len(one) + len(two) - both):
            (signs, needs), (others, wants) = nj.signatures(one, t), nj.signatures(two, t)
            for mine, need, theirs in ((signs, needs, others), (others, wants, signs)):
                shared = {int(k): np.isin(mine[need == k], theirs).sum() for k in np.unique(need)}
                assert any(n >= k & 0xFFFFFFFF for k, n in shared.items())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 499), (499, 500), (129, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(30)) and got[300] == 100 and got[500] == 499
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
