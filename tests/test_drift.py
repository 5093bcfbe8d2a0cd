import json
from datetime import datetime

import pytest

from strataloom.operators import drift as D

CONTRACT = [(1, "repo_name", "string"), (2, "n", "bigint"), (3, "tags", "array<string>"), (4, "file_mask", "string")]
RAW = "record_id bigint, file_name string, line_no bigint, written_at timestamp, loaded_at timestamp, payload string"


@pytest.fixture(scope="module")
def contract(spark):
    return spark.createDataFrame(CONTRACT, "column_pos bigint, column_name string, column_type string")


def raw(spark, files):
    """files: name -> list of payloads, in the order they were written."""
    rows, k = [], 0
    for i, (name, payloads) in enumerate(files.items()):
        for j, p in enumerate(payloads):
            k += 1
            rows.append((k, name, j, datetime(2024, 1, 1 + i), None, p if p is None or isinstance(p, str) else json.dumps(p)))
    return spark.createDataFrame(rows, RAW)


FULL = {"repo_name": "a/b", "n": 1, "tags": ["x"], "file_mask": ".c"}


def test_every_kind_of_difference(spark, contract):
    old = [dict(FULL, n=i, repo_name=f"r{i}") for i in range(4)]
    new = [{("project" if k == "repo_name" else k): v for k, v in r.items()} | {"extra": i} for i, r in enumerate(old)]
    files = {
        "f-20240101-1.jsonl": old,
        "f-20240102-2.jsonl": new,
        "f-20240103-3.jsonl": [dict(r, n="7") for r in new] + [None, "no json", "[1]"],
        "f-20240104-4.jsonl": [{"repo_name": None, "tags": [], "n": None}],
        "g-20240105-5.jsonl": ["broken"],
    }
    got = {tuple(r) for r in D.differences(raw(spark, files), contract).collect()}
    assert got == {
        ("f-20240102-2.jsonl", "renamed", "repo_name", "project"), ("f-20240102-2.jsonl", "added", "extra", ""),
        ("f-20240103-3.jsonl", "renamed", "repo_name", "project"), ("f-20240103-3.jsonl", "added", "extra", ""), ("f-20240103-3.jsonl", "retyped", "n", ""),
        ("f-20240104-4.jsonl", "removed", "file_mask", ""),
        *(("g-20240105-5.jsonl", "removed", c, "") for _, c, _ in CONTRACT),
    }


def test_a_name_that_stands_beside_the_column_is_no_alias(spark, contract):
    files = {f"f-2024010{i}-{i}.jsonl": [dict(FULL, other="a/b")] for i in range(1, 4)} | {"f-20240104-4.jsonl": [{"n": 1, "tags": [], "file_mask": ".c", "other": "a/b"}]}
    got = {tuple(r) for r in D.differences(raw(spark, files), contract).where("kind <> 'added'").collect()}
    assert got == {("f-20240104-4.jsonl", "removed", "repo_name", "")}


def test_a_name_means_in_each_feed_what_its_values_say(spark, contract):
    files = {}
    for feed, column in (("f", "repo_name"), ("g", "file_mask")):
        full = [dict(FULL, repo_name=f"{feed}/{i}", file_mask=f".{feed}{i}") for i in range(6)]
        files[f"{feed}-20240101-1.jsonl"] = full
        files[f"{feed}-20240102-2.jsonl"] = [{("x" if k == column else k): v for k, v in r.items()} for r in full]
    got = {tuple(r) for r in D.differences(raw(spark, files), contract).collect()}
    assert got == {("f-20240102-2.jsonl", "renamed", "repo_name", "x"), ("g-20240102-2.jsonl", "renamed", "file_mask", "x")}


def test_order_repeats_and_late_rows_change_nothing(spark, contract):
    files = {"f-20240101-1.jsonl": [FULL], "f-20240102-2.jsonl": [dict(reversed(FULL.items()), more=1)]}
    rows = raw(spark, files)
    once = {tuple(r) for r in D.differences(rows, contract).collect()}
    assert once == {("f-20240102-2.jsonl", "added", "more", "")} == {tuple(r) for r in D.differences(rows.union(rows).orderBy("payload"), contract).collect()}


def test_consistent_table(spark, contract):
    files = {
        "f-20240101-1.jsonl": [FULL, dict(FULL, repo_name=["a", "b"], file_mask=["c", "h"], n=True)],
        "f-20240102-2.jsonl": [{"project": "a/b", "n": "12", "tags": "x;y", "file_mask": {"name": "m", "id": 3}}],
        "f-20240103-3.jsonl": [{"n": "many", "tags": ""}, "no json"],
    }
    got = {r["record_id"]: tuple(r)[1:] for r in D.consistent(raw(spark, files), contract, {"repo_name": D.ListForm("__"), "file_mask": D.ListForm("|", "(?i)\\.(", ")$")}).collect()}
    assert got == {1: ("a/b", 1, ["x"], ".c"), 2: ("a__b", 1, ["x"], "(?i)\\.(c|h)$"), 3: ("a/b", 12, ["x", "y"], "m"), 4: (None, None, [], None), 5: (None,) * 4}


def test_change_log(spark, contract):
    files = {f"f-2024010{i}-{i}.jsonl": [FULL if i != 2 else {k: v for k, v in FULL.items() if k != "tags"}] for i in range(1, 4)}
    got = {(r["file_name"][11], r["event"], r["column_name"]) for r in D.change_log(raw(spark, files), contract).collect()}
    assert got == {("2", "end", "tags"), ("3", "start", "tags")}


def test_empty_tables(spark, contract):
    none = raw(spark, {"f-20240101-1.jsonl": [FULL]}).limit(0)
    assert D.differences(none, contract).count() == 0 and D.consistent(none, contract).count() == 0 and D.change_log(none, contract).count() == 0
    assert D.consistent(none, contract).columns == ["record_id", *(c for _, c, _ in CONTRACT)]


def test_a_rename_with_another_type(spark, contract):
    old = [dict(FULL, n=100 + i) for i in range(5)]
    for value in (lambda n: str(n), lambda n: f"size {n}"):
        new = [{("count" if k == "n" else k): value(v) if k == "n" else v for k, v in r.items()} for r in old]
        got = {tuple(r) for r in D.differences(raw(spark, {"f-20240101-1.jsonl": old, "f-20240102-2.jsonl": new}), contract).collect()}
        assert got == {("f-20240102-2.jsonl", "renamed", "n", "count")}
