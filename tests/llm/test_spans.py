import random

import numpy as np
import pytest

from strataloom.llm import spans as M

SCHEMA = "doc_id bigint, text string"


def brute(docs, span=M.SPAN):
    pairs, index, shared = set(), {}, {}
    for i, t in docs:
        for p in range(len(t or "") - span + 1):
            index.setdefault(t[p : p + span], set()).add(i)
    for s in index.values():
        pairs |= {(a, b) for a in s for b in s if a < b}
    for i, t in docs:
        covered = set()
        for p in range(len(t or "") - span + 1):
            if len(index[t[p : p + span]]) > 1:
                covered |= set(range(p, p + span))
        shared[i] = len(covered)
    return pairs, shared


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé日😀 ") for _ in range(r.randint(3, 9)))
    text = lambda n: "".join(word() for _ in range(n // 6 + 1))[:n]
    passages = [text(n) for n in (199, 200, 201, 260, 450, 900)]
    docs = [(i, text(r.randint(0, 500)) + r.choice(passages)[r.randint(0, 3) :] + text(r.randint(0, 300))) for i in range(60)]
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, None), (103, ""), (104, "-" * 1000), (105, "x" + "-" * 700), (106, "ab" * 300), (107, "ba" * 150), (108, passages[1]), (109, passages[0])]
    return docs


@pytest.mark.parametrize("seed", [1])
def test_pairs_and_shares_against_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("prefix", M.F.lit("extra")).withColumn("n", M.F.lit(1))
    pairs, shared = brute(docs)
    assert {tuple(r) for r in M.shared_pairs(df).collect()} == pairs
    got = {r["doc_id"]: (r["n_chars"], r["n_shared"]) for r in M.shared_share(df).collect()}
    assert got == {i: (None, None) if t is None else (len(t), shared[i]) for i, t in docs}


def test_a_prefix_of_many_suffixes_gives_the_same(spark, monkeypatch):
    docs = corpus(3)
    monkeypatch.setattr(M, "GROUP", 3)
    df = spark.createDataFrame(docs, SCHEMA)
    pairs, shared = brute(docs)
    small, whole = M.groups(df, M.copies(df))
    assert whole.count() > 0 and small.count() > 0
    assert {tuple(r) for r in M.shared_pairs(df).collect()} == pairs
    assert {r["doc_id"]: r["n_shared"] for r in M.shared_share(df).where("n_chars is not null").collect()} == {i: shared[i] for i, t in docs if t is not None}


@pytest.mark.parametrize("span", [401])
def test_other_lengths(spark, span):
    docs = corpus(5)
    df = spark.createDataFrame(docs, SCHEMA)
    pairs, shared = brute(docs, span)
    assert {tuple(r) for r in M.shared_pairs(df, span).collect()} == pairs
    assert {r["doc_id"]: r["n_shared"] for r in M.shared_share(df, span).where("n_chars is not null").collect()} == {i: shared[i] for i, t in docs if t is not None}


def test_classes_hold_every_pair(spark):
    docs = corpus(6)
    df = spark.createDataFrame(docs, SCHEMA)
    reps = {r["doc_id"]: r["rep"] for r in M.copies(df).collect()}
    of = {}
    for r in M.repeat_classes(df).collect():
        of.setdefault(r["repeat"], set()).add(r["doc_id"])
        assert r["n_copies"] == sum(v == r["doc_id"] for v in reps.values())
    linked = lambda a, b: reps[a] == reps[b] or any({reps[a], reps[b]} <= docs for docs in of.values())
    ids = sorted(reps)
    assert {(a, b) for a in ids for b in ids if a < b and linked(a, b)} == brute(docs)[0]


def test_every_window_keeps_an_anchor(monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 700)
    texts = [t or "" for _, t in corpus(4)]
    for t, (at, h) in zip(texts, M.anchors(texts)):
        for p in range(len(t) - M.SPAN + 1):
            assert any(p <= a <= p + M.SPAN - M.SPAN // 2 for a in at)
        codes = np.array([ord(c) for c in t], np.uint32)
        assert np.array_equal(M.gram_hashes(codes, M.SPAN // 2)[at], h)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert M.shared_pairs(none).count() == 0 and M.shared_share(none).count() == 0
