import itertools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur import session as session_module
from larkspur.llm import suffix_tree as st
from larkspur.llm.queries import QUERIES
from larkspur.llm.words import slices
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows, words

TEXTS = ["a b c a b d", "a b c", "b c a b c", "x y x y x y z", "", "a b c a b c a b c", "z z z z"] * 3


def brute(train, tests, cfg):
    """Scores by dictionaries of all runs of words, with the same smoothing and test."""
    runs = [Counter() for _ in range(cfg.depth + 1)]
    for t in train:
        seq = [*words(t), None]
        for k in range(cfg.depth + 1):
            runs[k].update(tuple(seq[i : i + k + 1]) for i in range(len(seq) - k))
    n, v = sum(runs[0].values()), len(runs[0])
    least = max(cfg.min_count, cfg.min_share * n)
    listed = [{r: c for r, c in x.items() if c >= least} for x in runs]
    d = cfg.discount

    def root(w):
        return (runs[0][w,] - d) / n if runs[0][w,] else d * v / n

    def rest(s):
        own = [c for r, c in listed[len(s)].items() if r[:-1] == s]
        return (runs[len(s) - 1][s] - sum(own) + d * len(own)) / runs[len(s) - 1][s]

    def p(w, s):
        if not s:
            return root(w)
        c = listed[len(s)].get((*s, w))
        low = rest(s) * p(w, s[1:])
        return low if c is None else (c - d) / runs[len(s) - 1][s] + low

    states = set()
    for k in range(1, cfg.depth + 1):
        for s in {r[:-1] for r in listed[k]}:
            own = {r[-1]: c for r, c in listed[k].items() if r[:-1] == s}
            total = runs[k - 1][s]
            gain = sum(c * math.log(p(w, s) / p(w, s[1:])) for w, c in own.items())
            gain += (total - sum(own.values())) * math.log(max(rest(s), 1e-300))
            if gain >= cfg.entry_cost * len(own) and gain >= cfg.min_divergence * total:
                states.update(s[i:] for i in range(len(s)))
    out = []
    for t in tests:
        seq, total = [*words(t), None], 0.0
        for i, w in enumerate(seq):
            context = next((c for k in range(cfg.depth, 0, -1) if i >= k and (c := tuple(seq[i - k : i])) in states), ())
            total += math.log10(p(w, context))
        out.append(total)
    return out, states


@pytest.mark.parametrize("depth, cost", [(1, 0.1), (2, 0.1), (3, 0.0), (2, 2.0)])
def test_scores_against_dictionaries(spark, depth, cost):
    cfg = st.Settings(depth=depth, min_count=2, min_share=0.0, entry_cost=cost)
    tests = [*TEXTS[:7], "a b unknown c a", "c c c a b", None]
    rows = [(i, t, True) for i, t in enumerate(TEXTS)] + [(100 + i, t, False) for i, t in enumerate(tests)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean").repartition(4)
    got = {r["doc_id"]: r for r in st.score(df, F.col("train"), settings=cfg).collect()}
    want, states = brute(TEXTS, tests, cfg)
    assert len(states) > 2 or cost == 2.0
    for i, w in enumerate(want):
        assert got[100 + i]["score"] == pytest.approx(w, rel=1e-9)


def test_distributions_sum_to_one(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tree, all_words = st.fit(df, st.Settings(entry_cost=0.0))
    vocabulary = sorted({w for t in TEXTS for w in words(t)})
    # two pads keep contexts in place; the sum runs over all words, the end and one unknown word
    for context in itertools.product(vocabulary, repeat=2):
        texts = [" ".join([*context, w]) for w in [*vocabulary, "unknown"]] + [" ".join(context)]
        total = 0.0
        for s in slices(pa.array(texts)):
            t = st.tokens_of(s)
            log_p, rare = st.score_tokens(t, tree)
            log_p = np.where(rare, log_p + tree.unseen(), log_p)
            total += float((10 ** log_p[t.first[:-1] + 2]).sum())
        assert total == pytest.approx(1.0, abs=1e-9)


def test_query_against_unigram_base(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op1_suffix_tree_scores"](spark, SF_DIR).collect()}
    docs = {d["doc_id"]: [*words(d["text"]), None] for d in documents()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, seq in docs.items() if i not in held for w in seq)
    n, v = sum(counts.values()), len(counts)
    for i, seq in docs.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i in held, len(seq), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in seq)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in seq), rel=1e-9)
    assert sum(rows[i]["score"] for i in held) > sum(rows[i]["base_score"] for i in held)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = st.score(docs, F.col("doc_id") < 8).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows) and by_id[None]["held_out"]
    untrained = st.score(docs, F.lit(False)).collect()
    assert {(r["score"], r["base_score"], r["n_known"], r["train_tokens"]) for r in untrained} == {(0.0, 0.0, 0, 0)}
    assert st.score(no_docs(spark), F.lit(True)).count() == 0


@pytest.mark.parametrize("depth, cost, share", [(1, 0.1, 0.1), (2, 0.1, 0.07), (3, 0.0, 0.1), (2, 0.1, 0.9), (2, 2.0, 0.05)])
def test_runs_that_are_not_sent_count_too(spark, depth, cost, share):
    assert st.Settings().min_share == 0
    cfg = st.Settings(depth=depth, entry_cost=cost, sent_share=share)
    tests = [*TEXTS[:7], "a b unknown c a", "c c c a b", None]
    rows = [(i, t, True) for i, t in enumerate(TEXTS)] + [(100 + i, t, False) for i, t in enumerate(tests)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean").repartition(4)
    got = {r["doc_id"]: r for r in st.score(df, F.col("train"), settings=cfg).collect()}
    whole = {r["doc_id"]: r for r in st.score(df, F.col("train"), settings=cfg._replace(sent_share=0.0)).collect()}
    want, _ = brute(TEXTS, tests, cfg)
    for i, w in enumerate(want):
        assert got[100 + i]["score"] == pytest.approx(w, rel=1e-9)
    for i, r in whole.items():
        assert (got[i]["n_known"], got[i]["n_tokens"]) == (r["n_known"], r["n_tokens"])
        assert got[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_open_words_are_not_written(spark, monkeypatch):
    """Of the folders that a query writes only that of its rows is left, and none has a row for each open word."""
    made = []

    def noted(session, df, label="cut"):
        out = write(session, df, label)
        made.append((label, out.folder, out.frame.count()))
        return out

    write = session_module.written
    monkeypatch.setattr(session_module, "written", noted)
    monkeypatch.setattr(st, "written", noted)
    df = spark.createDataFrame([(i, " ".join(TEXTS), True) for i in range(40)], "doc_id bigint, text string, train boolean").repartition(2)
    got = st.score(df, F.col("train"), settings=st.Settings(sent_share=0.9))
    assert got.count() == 40 and max(n for *_, n in made) < 40 * sum(len(t.split()) for t in TEXTS) / 4
    assert {label for label, folder, _ in made if os.path.exists(folder.removeprefix("file:"))} == {"scored"}
