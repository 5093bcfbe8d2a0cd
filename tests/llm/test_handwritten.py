import random

import numpy as np
import pytest

from strataloom.llm import handwritten as M

NAMES = ["cursor", "pool_heap", "frameLock", "writer_emit", "tokenFlush", "arena_next", "delta", "region_map", "probe_span", "bucket"]


def statement(r, names):
    n = lambda: r.choice(names)
    return r.choice([
        lambda: ["if", "(", n(), "<", str(r.randint(0, 99)), ")", "{", "return", n(), ";", "}"], lambda: [n(), "=", n(), "(", n(), ",", n(), ")", ";"],
        lambda: ["while", "(", n(), ")", "{", n(), "--", ";", "}"], lambda: ["struct", n(), "*", n(), "=", "NULL", ";"], lambda: [n(), "->", n(), "=", n(), ";"],
    ])()


def body(r, names=NAMES, n=12):
    return [t for _ in range(n) for t in statement(r, names)]


def corpus(seed=1):
    """((repo, path, kind or None), tokens) of every kind, with decoys; and the upstream files."""
    r = random.Random(seed)
    upstream = [("lib", "1", f"lib{i}.c", body(r, [f"lib{i}_{n}" for n in NAMES], 15)) for i in range(3)]
    files = []
    for i in range(260):
        repo, ext = f"repo{i % 26}", r.choice(["c", "h", "java"])
        files += [((repo, f"src/m{i}/a{i}.{ext}", None), body(r)), ((repo, f"src/b{i}.{ext}", None), [r.choice(["/* do not edit the cursor while scanning */", "// generated ids start at 1", "/* Copyright the authors */"]), *body(r)])]
        if i % 5 == 0:
            case = [t for _ in range(12) for t in ("case", str(r.randint(0, 999)), ":", "return", hex(r.randint(0, 999)), ";")]
            files.append(((repo, f"src/g{i}.gen.{ext}", "generated"), case))
            files.append(((repo, f"src/h{i}.{ext}", "generated"), [f"/* Generated by tool{i} 1.{i} from x.tbl. Changes will be lost. */", *body(r)]))
            files.append(((repo, f"src/n{i}{r.choice(['.min', ''])}.{ext}", "minified"), body(r, list("abcdefg") + ["a1", "bq"])))
            files.append(((repo, f"src/d{i}.{ext}", "blob"), ["static", "int", "t", "[", "]", "=", "{", *[x for _ in range(60) for x in (hex(r.randint(0, 255)), ",")], "}", ";"]))
            files.append(((repo, f"src/t{i}.{ext}", None), ["static", "int", "t", "[", "]", "=", "{", *[x for _ in range(5) for x in (hex(r.randint(0, 255)), ",")], "}", ";", *body(r)]))
            copy = list(r.choice(upstream)[3])
            copy[r.randrange(len(copy))] = "patched"
            files.append(((repo, f"{r.choice(['third_party/x', 'src/own'])}/v{i}.{ext}", "vendored"), copy))
    return files, upstream


def kind_of(token):
    return "comment" if M.is_comment(token) else "literal" if token[:1].isdigit() or token[:1] == '"' else "keyword" if token in M._KEPT or token == "NULL" else "name" if token[:1].isalpha() else "operator"


@pytest.fixture(scope="module")
def tables(spark):
    files, upstream = corpus()
    rows = [(f[0], f[1], i, t, kind_of(t)) for f, ts in files for i, t in enumerate(ts)]
    random.Random(0).shuffle(rows)
    odd = [("r", "short.c", 0, "x", "name"), (None, "f.c", 1, "x", "name"), ("r", None, 1, "x", "name"), ("r", "f.c", None, "x", "name"), *[("r", "nulls.c", i, None, None) for i in range(30)], *[("r", "one.c", 0, t, "name") for t in "abc" * 10]]
    tokens = spark.createDataFrame(rows + rows[:500] + odd, "repo_name string, file_path string, token_index bigint, token_value string, token_type string").withColumn("block", M.F.lit("extra")).withColumn("kind", M.F.lit(1))
    up = spark.createDataFrame(upstream, "lib_name string, lib_version string, file_name string, token_values array<string>")
    return files, tokens, up


def test_held_out_quality(spark, tables):
    files, tokens, up = tables
    rows, models = M.classify(tokens, up)
    rows = rows.collect()
    got = {(r["repo_name"], r["file_path"]): (r["n_tokens"], r["kind"]) for r in rows}
    assert all(m.recall >= 0.9 and m.held for k, m in models.items() if k != "vendored")  # every vendored file here is a verbatim copy
    assert {r["source"] for r in rows if "/h" in r["file_path"] and r["kind"]} == {"comment"}  # plain code under a header
    assert "code" in {r["source"] for r in rows if "/g" in r["file_path"]} and all((r["source"] is None) == (r["kind"] is None) for r in rows)
    truth = {f[:2]: f[2] for f, ts in files}
    assert {k for k in got if k[0] != "r"} == set(truth) and set(got) - set(truth) == {("r", "nulls.c")}
    assert all(got[f[:2]][0] == len(ts) for f, ts in files)
    said, real = {k for k in truth if got[k][1]}, {k for k in truth if truth[k]}
    assert len(said & real) >= 0.97 * len(real) and len(said & real) >= 0.97 * len(said), [(k, truth[k], got[k]) for k in said ^ real][:9]
    assert sum(got[k][1] == truth[k] for k in real) >= 0.95 * len(real)


def test_classifier_on_unseen_rows():
    r = np.random.default_rng(3)
    rows = [(np.unique(r.integers(0, 50, 8) + (0 if y > 0 else 25)), y) for y in r.choice([1, -1], 600, p=[0.2, 0.8])]
    rows = [(at, np.ones(len(at)) / np.sqrt(len(at)), int(y)) for at, y in rows]
    m = M.fit(rows[:400], 80)
    reached = [sum(m.score(at, x) >= t for t in M.THRESHOLDS) for at, x, _ in rows[400:]]
    M.set_threshold(m, [(n, y > 0, 1) for n, (*_, y) in zip(reached, rows[400:])])
    assert m.precision > 0.85 and m.recall > 0.85 and m.held == sum(y > 0 for *_, y in rows[400:])
    M.set_threshold(m, [(3, False, 9)])
    assert (m.threshold, m.held) == (0.0, 0)


def test_empty_tables(spark, tables):
    _, tokens, up = tables
    assert M.classify(tokens.limit(0), up)[0].count() == 0
    assert M.not_handwritten(tokens.where("repo_name = 'repo1' and file_path like 'src/m%'"), up.limit(0)).count() == 0


def test_a_notice_is_read_wherever_it_stands(spark):
    schema = "repo_name string, file_path string, block bigint, values array<string>, types array<string>"
    known = M.upstream_shingles(spark.createDataFrame([], "lib_name string, lib_version string, file_name string, token_values array<string>"))
    rows = [("r", f"f{at}.c", b, ["// licence"] * 18 + ["x"] * at + ["// DO NOT EDIT"], ["name"] * (19 + at)) for at in (2, 400) for b in (0, 1)]
    got = M.facts_of(spark.createDataFrame(rows, schema), known).collect()
    assert len(got) == 4 and all("// DO NOT EDIT" in r["notes"] for r in got)


def test_shingles_find_copies_exactly(spark, tables):
    _, tokens, up = tables
    known = M.upstream_shingles(up)
    evidence = M.evidence_of(M.facts_of(M.blocks_of(tokens), known), known)
    got = {(r["repo_name"], r["file_path"]): r["contained"] for r in evidence.collect()}
    libs = [set(zip(*[u[3][k:] for k in range(M.SHINGLE)])) for u in up.collect()]
    for (repo, path, _), ts in tables[0][:200]:
        own = list(zip(*[ts[k:] for k in range(M.SHINGLE)]))
        assert got[repo, path] == pytest.approx(max(sum(g in lib for g in own) for lib in libs) / max(1, len(own)))
