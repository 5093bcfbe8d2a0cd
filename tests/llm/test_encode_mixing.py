import base64
import math
import os
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.llm import encode as E
from strataloom.llm import mixing as X

VOCABULARY = f"{E.TOKENIZERS}/{E.VOCABULARY}"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="the tokenizers aren't here")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "\n\n  x", "Hello, world's <|endoftext|> end", "naïve 日本語 😀" * 20, "x" * 5000, "ab" * 4000, "\t\x00\r\n", "don't we'LL 12345   ", " " * 2000 + "a"]


def test_documents_against_the_library(spark, reference):
    docs = [*enumerate(TEXTS), (90, None), (91, TEXTS[3]), (91, TEXTS[3])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("ids", E.F.lit("other"))
    got = sorted((r["doc_id"], r["ids"]) for r in E.encode(df).collect())
    assert got == sorted((i, reference.encode_ordinary(t) if t else []) for i, t in docs)
    assert E.encode(df.limit(0)).count() == 0
    counts = {r["doc_id"]: r["n_tokens"] for r in E.encode(df, count_only=True).collect()}
    assert counts[90] == 0 and counts[3] == len(reference.encode_ordinary(TEXTS[3]))


@settings(max_examples=200, deadline=None)
@given(st.text(min_size=1, max_size=40))
def test_merges_against_the_library(text):
    ranks = E.load_ranks(VOCABULARY)
    enc = _library()
    for word in E._SPLIT.findall(text):
        raw = word.encode("utf-8", "replace")
        assert E.merge(raw, ranks) == E._heap_merge(raw, ranks) == enc.encode_ordinary(word if word.isprintable() else raw.decode("utf-8", "replace"))


@settings(max_examples=500, deadline=None)
@given(st.text(st.characters(max_codepoint=127), max_size=60))
def test_ascii_words_are_those_of_the_pattern(text):
    assert E.split(text) == E._SPLIT.findall(text) and "".join(E.split(text)) == text


def _library(cache=[]):  # noqa: B006
    if not cache:
        cache.append(tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=E.load_ranks(VOCABULARY), special_tokens={}))
    return cache[0]


def test_transducer_holds_its_words_and_no_others(tmp_path):
    r = random.Random(2)
    words = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 9))): [i, i * 7] for i in range(3000)}
    block = E.compile_lexicon(words)
    (tmp_path / "l").write_bytes(block)
    for lexicon in (E.Lexicon(block), E.Lexicon(str(tmp_path / "l"))):
        assert all(lexicon.get(w) == ids for w, ids in words.items())
        others = [bytes(r.choice(b"abcd") for _ in range(r.randint(0, 9))) for _ in range(3000)]
        assert all(lexicon.get(w) is None for w in others if w not in words)
    assert len(block) < 60 * len(words) and E.Lexicon(E.compile_lexicon({})).get(b"a") is None


def test_suffixes_are_shared():
    import struct

    states = lambda words: struct.unpack_from("<i", E.compile_lexicon({w: [1] for w in words}))[0]
    assert states([b"walking", b"talking", b"balking"]) == states([b"walking"])


def sources():
    return [X.Source("big", 1_000_000, 0.5, 1), X.Source("small", 10_000, 0.3, 4), X.Source("none", 0, 0.1, 9), X.Source("mid", 200_000, 0.1, 2)]


def test_plan_meets_the_targets_where_it_can():
    s = sources()
    budget, a = X.plan(s)
    assert a == 1.0 and sum(x.budget for x in s) == pytest.approx(budget) and s[2].budget == 0
    assert all(x.budget / budget == pytest.approx(x.target) and x.budget <= x.tokens * x.repeats * 1.0001 for x in s if x.tokens)


def test_plan_bends_to_the_repetition_limits():
    s = sources()
    budget, a = X.plan(s, budget=900_000)
    assert 0 < a < 1 and all(x.budget <= x.tokens * x.repeats + 1 for x in s)
    assert any(x.budget == pytest.approx(x.tokens * x.repeats, rel=1e-6) for x in s if x.tokens)


def test_plan_of_an_entropy():
    s = sources()
    goal = 0.9 * X.entropy([x.target / 0.9 for x in s if x.tokens])
    _, a = X.plan(s, budget=1000, wanted_entropy=goal)
    assert X.entropy([x.budget / 1000 for x in s]) == pytest.approx(goal, abs=1e-6)


def test_mix(spark):
    r = random.Random(6)
    docs = [(i, s, r.randint(1, 50)) for i, s in enumerate(["big"] * 3000 + ["small"] * 60 + ["mid"] * 500 + ["unlisted"] * 50 + [None] * 9)]
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 4), ("absent", 0.1, 9), ("mid", 0.1, 2)], "source string, target_share double, max_repeats bigint")
    got = X.mix(sizes, targets).collect()
    assert {r["source"] for r in got} == {"big", "small", "mid"} and len({(r["doc_id"], r["repeat_no"]) for r in got}) == len(got)
    total = sum(r["n_tokens"] for r in got)
    for name, share, cap in (("big", 0.5, 1), ("small", 0.3, 4), ("mid", 0.1, 2)):
        own = [r for r in got if r["source"] == name]
        assert sum(r["n_tokens"] for r in own) / total == pytest.approx(share / 0.9, abs=0.02) and max(r["repeat_no"] for r in own) <= cap
    assert sorted(map(tuple, got)) == sorted(map(tuple, X.mix(sizes.orderBy("n_tokens"), targets).collect()))
    assert X.mix(sizes.limit(0), targets).count() == 0 and X.mix(sizes, targets.limit(0)).count() == 0


def test_shares_report_every_source(spark):
    texts = [(i, f"word number {i} and more", s) for i, s in enumerate(["a"] * 80 + ["b"] * 5 + ["other"] * 3)] + [(900, None, "a"), (901, "", "b"), (902, "no source", None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, source string").withColumn("n_tokens", E.F.lit(1))
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("gone", 0.1, 2)], "source string, target_share double, max_repeats bigint")
    got = {r["source"]: r for r in X.shares(docs, targets).collect()}
    assert set(got) == {"a", "b", "other", "gone", None}
    assert got["b"]["most_repeats"] <= 3 and got["a"]["most_repeats"] == 1 and got["gone"]["mix_tokens"] == 0 and got["other"]["actual_share"] == 0
    assert math.isclose(sum(r["actual_share"] for r in got.values()), 1)
    assert got["a"]["actual_share"] == pytest.approx(2 / 3, abs=0.08)


def test_a_full_mix_bends_the_targets(spark):
    docs = spark.createDataFrame([(i, f"word number {i} and more", s) for i, s in enumerate(["a"] * 900 + ["b"] * 20 + ["other"] * 9)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 3)], "source string, target_share double, max_repeats bigint")
    got = X.full_mixture(docs, targets).collect()
    n = {s: sum(r["n_tokens"] for r in got if r["source"] == s) for s in "ab"}
    one = {s: sum(r["n_tokens"] for r in X.mixture(docs, targets).collect() if r["source"] == s) for s in "ab"}
    assert max(r["repeat_no"] for r in got if r["source"] == "b") == 3 and max(r["repeat_no"] for r in got if r["source"] == "a") == 1
    assert n["b"] / sum(n.values()) < 0.1 and one["b"] / sum(one.values()) == pytest.approx(0.4, abs=0.05) and sum(n.values()) > 5 * sum(one.values())


def test_mix_takes_an_entropy(spark):
    sizes = spark.createDataFrame([(i, s, 1) for i, s in enumerate(["a"] * 4000 + ["b"] * 1000)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 9), ("b", 0.5, 9)], "source string, target_share double, max_repeats bigint")
    got = X.mix(sizes, targets, budget=2000, wanted_entropy=0.6).groupBy("source").agg(E.F.sum("n_tokens")).collect()
    assert X.entropy([r[1] / 2000 for r in got]) == pytest.approx(0.6, abs=0.01)


def test_an_even_mix_is_temperature_alone(spark):
    n = {"a": 900, "b": 250, "c": 60}
    docs = spark.createDataFrame([(i, f"word number {i} and more", s) for i, s in enumerate(s for s, k in n.items() for _ in range(k))], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 9), ("b", 0.3, 9), ("c", 0.2, 9), ("gone", 0.0, 9)], "source string, target_share double, max_repeats bigint")
    have, got = ({s: sum(r["n_tokens"] for r in rows if r["source"] == s) for s in n} for rows in (X.sized(docs).collect(), X.even_mixture(docs, targets).collect()))
    shares = {s: got[s] / sum(got.values()) for s in n}
    assert X.entropy(list(shares.values())) == pytest.approx(X.entropy([0.5, 0.3, 0.2]), abs=0.005)
    power = [math.log(shares[s] / shares["c"]) / math.log(have[s] / have["c"]) for s in "ab"]
    assert power[0] == pytest.approx(power[1], abs=0.03) and 0 < power[0] < 1
