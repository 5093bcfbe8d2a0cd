import json
import os

import pytest
from pyspark.sql import functions as F

from strataloom import contracts
from strataloom.functions import mask, scalars
from strataloom.operators import enrich, footers, manifests, publishing, reports, retention
from strataloom.sources import files, sinks, steps

SHA = "b" * 40


def frame_of(tmp_path, salt, rows):
    """Writes a frame of (slug, host, included, category) with right u."""
    import hashlib

    u = lambda s: (int.from_bytes(hashlib.sha256(f"{salt}{s}".encode()).digest()[:8], "big") >> 11) / 2**53
    path = tmp_path / "frame.csv"
    path.write_text("slug,host,repo_url,head_oid,u,size_class,labels,included,category,stars\n" + "".join(f"{s},{h},https://x/{s},{SHA},{u(s)!r},M, lab ,{i},{c},9\n" for s, h, i, c in rows))
    return str(path), sorted((u(s), s) for s, _, i, _ in rows if i.strip().lower() in ("1", "true", "yes"))


def test_a_manifest_is_built_whole_or_not_at_all(spark, tmp_path):
    path, order = frame_of(tmp_path, "z:", [("a/b", "", "1", ""), ("c/d", "forge.example", " YES ", "own"), ("e/f", "", "no", ""), ("g/h/i", "forge.example", "true", "  ")])
    got = manifests.build(spark, path, "z:", str(tmp_path))
    assert (got["rows"], got["dropped"], got["written"]) == (3, 1, 3)
    lines = (tmp_path / "manifest.tsv").read_text().splitlines()
    name = {"a/b": "a__b", "c/d": "forge.example__c__d", "g/h/i": "forge.example__g__h__i"}
    assert lines[0].startswith("#") and got["frame_sha256"] in lines[0]
    assert [x.split("\t") for x in lines if x[0] != "#"] == [[name[s], f"https://x/{s}", {"a/b": "lab", "c/d": "own", "g/h/i": ""}[s], "", "M", SHA] for _, s in order]
    meta = json.loads((tmp_path / "project_meta.json").read_text())
    assert list(meta) == [name[s] for _, s in order] and meta["a__b"]["owner"] == "a" and meta["a__b"]["stars"] == "9" and list(meta["a__b"]) == contracts.PROVENANCE
    placed = [x.split("\t") for x in (tmp_path / "manifest.order.tsv").read_text().splitlines()]
    assert placed[0] == list(manifests.ORDER_FIELDS) and [(x[0], x[2], float(x[4])) for x in placed[1:]] == [(str(i), s, u) for i, (u, s) in enumerate(order, 1)]
    assert manifests.build(spark, path, "z:", str(tmp_path), limit=1)["written"] == 1
    with pytest.raises(ValueError):
        manifests.build(spark, path, "z:", str(tmp_path), limit=0)
    twice, _ = frame_of(tmp_path, "z:", [("a/b", "", "1", ""), ("A/B", "", "1", "")])
    with pytest.raises(files.InputError, match=":3: .* repeats line 2"):
        manifests.build(spark, twice, "z:", str(tmp_path))
    with pytest.raises(files.InputError, match="is not that"):
        manifests.build(spark, path, "other:", str(tmp_path))


def test_provenance_guard():
    assert manifests.check_provenance([], False) == "" == manifests.check_provenance(["stars"], False, publishes=False)
    assert "stars" in manifests.check_provenance(["stars"], True)
    for gaps, allowed in (([], True), (["stars"], False)):
        with pytest.raises(files.InputError):
            manifests.check_provenance(gaps, allowed)


def test_several_manifests(spark, tmp_path):
    (tmp_path / "1.tsv").write_text("\t \n# c\np\tu1\tk\t\tS\nq\tu2\tk\t\tXL\n")
    (tmp_path / "2.tsv").write_text(f"p\tu3\tk\t\tM\nr\tu4\tk\t\tM\t{SHA}\n")
    got, warned = manifests.entries(spark, [str(tmp_path / "1.tsv"), str(tmp_path / "2.tsv")])
    assert {(r["name"], r["url"], r["size_class"]) for r in got.collect()} == {("p", "u1", "S"), ("q", "u2", "XL"), ("r", "u4", "M")}
    assert len(warned) == 1 and ":1: p" in warned[0]
    (tmp_path / "3.tsv").write_text("only\tfour\tfields\there\n")
    with pytest.raises(files.InputError, match=":1: 5 or 6"):
        manifests.entries(spark, [str(tmp_path / "1.tsv"), str(tmp_path / "3.tsv")])


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for n, name in ((5000, "a.log"), (3, "b.log")):
        (tmp_path / name).write_text("".join(f"{i} line\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 5003 and all(r["line"] == f"{r['line_no']} line" for r in rows)


def tokens_of(spark, name, n=400):
    return spark.range(n).select(*[(F.col("id") if c == "token_index" else F.lit(name) if c == "repo_name" else F.sha2(F.col("id").cast("string"), 256) if c == "token_value" else F.lit(None)).cast(contracts.column_type(c)).alias(c) for c in contracts.COLUMNS])


@pytest.fixture
def workdirs(spark, tmp_path):
    """Three finished projects, one of them drifted, and one that only began."""
    root = tmp_path / "out"
    for name in ("a", "b", "odd"):
        (root / name).mkdir(parents=True)
        rows = tokens_of(spark, name)
        path = str(root / name / f"{name}-dataset.parquet")
        sinks.write_single_parquet(rows.drop("firm") if name == "odd" else rows, path, ["token_index"])
        sinks.write_stamp(str(root / name / f"{name}.validated"), 400, os.path.getsize(path))
    (root / "begun").mkdir()
    (root / "begun" / "log").write_text("x")
    entries = spark.createDataFrame([(n, f"u/{n}", "k", "S") for n in ("a", "b", "odd", "begun", "new")], "name string, url string, category string, size_class string")
    probes = spark.createDataFrame(publishing.probe(str(root), ["a", "b", "odd", "begun", "new"]), publishing.PROBE)
    return root, entries, probes


def test_join_by_join_is_a_rebuild(spark, workdirs, tmp_path):
    root, entries, probes = workdirs
    sinks.append_tsv(str(tmp_path / "metrics.tsv"), ["iso_start", "project", "class", "phase", "duration_s", "rc", "log"], ["2024-01-01T00:00:00+00:00", "a", "S", "pipeline", 3, 0, "l"])
    got = publishing.rebuild(spark, entries, probes, str(tmp_path / "all"), str(tmp_path / "metrics.tsv"), {"b": "asked to"})
    assert got["exit_code"] == publishing.OK and got["rows"] == 400 and [os.path.basename(p)[:3] for p in got["drifted"]] == ["odd"] and not got["unreadable"]
    assert spark.read.parquet(str(tmp_path / "all/phase_metrics")).count() == 1 and spark.table("tokens").count() == 400
    state = {r["name"]: r["state"] for r in spark.read.parquet(str(tmp_path / "all/projects")).collect()}
    assert state == {"a": "DONE", "b": "DONE", "odd": "DONE", "begun": "FAILED", "new": "QUEUED"}
    one = lambda n: publishing.join(spark, n, entries, probes, str(tmp_path / "one"), {"b": "asked to"})
    assert [one(n)[0] for n in ("a", "b", "a", "odd", "begun", "gone")] == [0, 0, 0, 1, 1, 2]
    rows = lambda where, table, *c: {tuple(r) for r in spark.read.parquet(str(tmp_path / where / table)).select(*c).collect()}
    assert rows("one", "joined", "name", "parquet_path") == rows("all", "joined", "name", "parquet_path") != set()
    assert rows("one", "projects", *contracts.CONTRACT.names[:0], "name", "state", "token_rows", "excluded_because") == {r for r in rows("all", "projects", "name", "state", "token_rows", "excluded_because") if r[0] in "ab"}
    (root / "a" / "a.validated").write_text("rows=many\n")
    probes = spark.createDataFrame(publishing.probe(str(root), ["a"]), publishing.PROBE)
    assert publishing.rebuild(spark, entries.where("name = 'a'"), probes, str(tmp_path / "bad"), str(tmp_path / "metrics.tsv"))["exit_code"] == publishing.FAILED


def test_gate_and_publishing(spark, workdirs, tmp_path):
    root, _, _ = workdirs
    good, odd, small = str(root / "a/a-dataset.parquet"), str(root / "odd/odd-dataset.parquet"), str(tmp_path / "small.parquet")
    spark.range(3).write.parquet(small)
    assert publishing.gate(spark, good, str(tmp_path / "s")) == "" and (tmp_path / "s").read_text().startswith("rows=400\n")
    assert publishing.gate(spark, odd, str(tmp_path / "t")).startswith("missing firm") and not (tmp_path / "t").exists()
    assert publishing.gate(spark, small).endswith(" bytes") and publishing.gate(spark, str(tmp_path / "none")) == "no file"
    assert publishing.publish(spark, odd, lambda: 0) == (False, "schema") and publishing.publish(spark, odd) == (True, "")
    assert publishing.publish(spark, good, lambda: 0, lambda p: []) == (False, "anonymize") and publishing.publish(spark, good, lambda: 1, lambda p: [p]) == (False, "join")
    assert publishing.publish(spark, good, lambda: 0, lambda p: [p]) == (True, "")


def test_footers_say_what_the_driver_says(spark, tmp_path):
    whole = tokens_of(spark, "a", 3)
    moved = whole.select(whole.columns[1], whole.columns[0], *whole.columns[2:])
    variants = {"whole": whole, "short": whole.drop("stars", "firm"), "more": whole.withColumn("zz", F.lit(1)), "retyped": whole.withColumn("token_index", F.col("token_index").cast("string")), "moved": moved}
    for name, df in variants.items():
        sinks.write_single_parquet(df, str(tmp_path / f"{name}.parquet"), ["token_value"])
    got = {}
    for r in footers.drift_rows(footers.footers(spark, [str(tmp_path / f"{n}.parquet") for n in variants])).collect():
        got.setdefault(os.path.basename(r["path"])[:-8], set()).add((r["kind"], r["column"], r["detail"]))
    assert got == {n: {tuple(d) for d in contracts.compare(df.schema)} for n, df in variants.items() if n != "whole"}


def test_run_rows(spark, tmp_path):
    ledger, log = str(tmp_path / "l.jsonl"), str(tmp_path / "runs.log")
    with steps.run(ledger, log, "r1", "census", {"workers": 2}, {"spark": "4"}) as outcomes:
        outcomes["done"] = 3
    with pytest.raises(KeyError), steps.run(ledger, log, "r2", "census", {}, {}):
        raise KeyError("x")
    rows = [json.loads(x) for x in open(ledger)]
    assert [(r["run_id"], r["step"], r.get("exit_code")) for r in rows] == [("r1", "run-start", None), ("r1", "run-end", 0), ("r2", "run-start", None), ("r2", "run-end", 1)]
    assert rows[1]["outcomes"] == {"done": 3} and "KeyError" in rows[3]["stop_reason"] and len(open(log).readlines()) == 5


def test_decisions(spark, tmp_path):
    assert [reports.deferral(n, 15) for n in (0, 1, 5, 9)] == [15, 30, 480, 600]
    assert reports.missing_flags("use --mask-widened or --jobs", ["--mask", "--jobs", "--html"]) == ["--mask", "--html"]
    df = spark.createDataFrame([("a.parquet",), (".git",), ("x.txt",), (None,)], "n string")
    assert [r[0] for r in df.select(retention.is_protected(F.col("n"))).collect()] == [True, True, False, False]
    assert reports.lines_of(df.where("n is not null"), {"n": 4}, ["n"]) == ["N", ".git", "a.parquet", "x.txt"]
    jobs = spark.createDataFrame([(1, 50.0), (2, 5.0), (3, None)], "pos int, not_before double")
    assert reports.next_due(jobs, 10).first()["pos"] == 2 and reports.next_due(jobs.where("pos = 1"), 10).count() == 0
    assert mask.mask_of(["a|b", "c.d", "h++"]) == "(?i)\\.(a\\|b|c\\.d|h\\+\\+)$"
    with pytest.raises(ValueError):
        mask.mask_of([])
    padded = spark.createDataFrame([("k",), ("\tK\u00a0",), ("j",), ("J",)], "domain string")
    with pytest.raises(enrich.Refused, match="repeats: k, j"):
        enrich.guard(padded.coalesce(1), "domain", "map")
    (tmp_path / "d.json").write_text('{"a": 1,\n "b": null}')
    assert files.json_documents(spark, str(tmp_path / "d.json"), "a int, b string").first()["a"] == 1
    import hashlib

    assert files.file_facts(spark, str(tmp_path / "d.json")).first()["sha256"] == hashlib.sha256((tmp_path / "d.json").read_bytes()).hexdigest()
    assert contracts.emit(contracts.CONTRACT).splitlines()[0] == '("repo_name", "string"),' and files.conf(spark, "none", "x") == "x"
    assert sinks.report(padded.limit(1)) == "domain\nk"
    assert [r[0] for r in spark.createDataFrame([(None,), (1.25,), (3.0,)], "x double").select(scalars.rounded(F.col("x"), "s")).collect()] == [None, "1", "3"]
