import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strataloom import contracts
from strataloom.functions import mask, scalars
from strataloom.operators import catalog, enrich, ledger, sampling
from strataloom.plans import corpus, problems
from strataloom.sources import files, sinks


@pytest.fixture(scope="module")
def duck(small_dir):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(small_dir):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{small_dir}/{f}')")
    return c


@pytest.mark.parametrize("name", [*corpus.ORACLE, *problems.ORACLE])
def test_query_against_sql(spark, duck, small_dir, name):
    df = ({**corpus.QUERIES, **problems.QUERIES})[name](spark, small_dir)
    sql = duck.sql(({**corpus.ORACLE, **problems.ORACLE})[name])
    columns = sorted(df.columns)
    assert sorted(sql.columns) == columns
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    ours = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    theirs = sorted((tuple(norm(dict(zip(sql.columns, r))[c]) for c in columns) for r in sql.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark, small_dir):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_contract_has_70_columns_in_order(spark, small_dir):
    assert len(contracts.COLUMNS) == 70 and len(contracts.UNATTRIBUTED) == 67
    assert contracts.compare(spark.read.parquet(f"{small_dir}/tokens.parquet").schema) == []


def test_all_drifts_are_reported(spark):
    short = contracts.CONTRACT.fields[:22]
    got = contracts.compare(type(contracts.CONTRACT)([*short, short[0].__class__("zz", short[0].dataType)]))
    assert [d.kind for d in got].count("missing") == 48 and got[-1][:2] == ("unexpected", "zz")
    swapped = type(contracts.CONTRACT)([contracts.CONTRACT.fields[1], contracts.CONTRACT.fields[0], *contracts.CONTRACT.fields[2:]])
    assert [d.kind for d in contracts.compare(swapped)] == ["order"]


def test_attribution_of_a_domain(spark):
    """One case for each rule of the two lookups: case of the key, no trimming, the company's own spelling kept, one hop only, blanks and nulls."""
    domains = spark.createDataFrame(
        [("wren.example", "Wren Works", "hand"), ("Lark.Example", "LARK", "list"), ("finch.example", "\tfinch gmbh ", "list"), ("7.example", "7", "hand"), ("gull.example", None, "hand"), ("tern.example", "Tern", None)],
        "domain string, company string, source string",
    )
    names = spark.createDataFrame([(" Lark ", "Lark Labs"), ("Lark Labs", "Second Hop"), ("finch gmbh", "Finch"), ("wren works", " "), ("TERN", "")], "firm_raw string, firm string")
    cases = {
        "WREN.example": ("Wren Works", " ", "hand"),  # a blank name that isn't empty is a name
        "lark.example": ("LARK", "Lark Labs", "list"), " lark.example": ("", "", ""), "7.example": ("7", "7", "hand"),
        "finch.example": ("\tfinch gmbh ", "\tfinch gmbh ", "list"),  # only spaces are trimmed for the name
        "gull.example": ("", "", "hand"), "tern.example": ("Tern", "Tern", ""), "owl.example": ("", "", ""), "": ("", "", ""), None: ("", "", ""),
    }
    tokens = spark.createDataFrame([(d, "old") for d in cases], "person_domain string, firm string")
    rows = enrich.attribute_firms(tokens, domains, names).collect()
    assert {r["person_domain"]: (r["firm_raw"], r["firm"], r["firm_source"]) for r in rows} == cases and len(rows) == len(cases)


def test_a_file_is_attributed_in_place_and_in_order(spark, tmp_path, small_dir):
    path = f"{tmp_path}/p.parquet"
    n = 500
    rows = spark.range(n).select(*[(F.col("id") if c == "token_index" else F.lit("intel.example" if c == "person_domain" else None)).cast(contracts.column_type(c)).alias(c) for c in contracts.UNATTRIBUTED])
    sinks.write_single_parquet(rows, path, ["token_index"])
    # the sink drops no contract column
    assert spark.read.parquet(path).columns == contracts.UNATTRIBUTED
    (tmp_path / "d.csv").write_text('domain,company,kind,source\nintel.example,"Intel, ""the"" firm",company,hand\n')
    (tmp_path / "c.csv").write_text("firm_raw,firm,decision,note\nx,y,keep,\n")
    assert enrich.attribute_file(spark, path, f"{tmp_path}/d.csv", f"{tmp_path}/c.csv") == n
    got = duckdb.sql(f"select token_index, firm from read_parquet('{path}')").fetchall()
    assert got == [(i, 'Intel, "the" firm') for i in range(n)] and contracts.compare(spark.read.parquet(path).schema) == []
    (tmp_path / "d.csv").write_text("domain,company,kind,source\na.b,A,,\n A.B ,B,,\n")
    with pytest.raises(enrich.Refused, match="a.b"):
        enrich.attribute_file(spark, path, f"{tmp_path}/d.csv", f"{tmp_path}/c.csv")
    assert duckdb.sql(f"select count(*) from read_parquet('{path}')").fetchall() == [(n,)]


def fold(rows):
    """An independent sequential fold of (line_no, project, run_id, attempt, step, status, state, failed_step)."""
    out, open_, closed = {}, {}, set()
    for _, p, run, attempt, step, status, state, failed_step in sorted(rows):
        if p is None:
            continue
        h = out.setdefault(p, ["", 0, 0, "", 0])
        if status == "started":
            open_[(p, run, attempt)] = step
        elif step == "project":
            closed.add((p, run, attempt))
            if state not in ("skipped", "deferred"):
                h[0], h[2] = state or "", h[2] + 1
                if state == "failed":
                    h[1], h[3] = h[1] + 1, failed_step or ""
    for key, step in open_.items():
        if key not in closed:
            h = out[key[0]]
            h[2], h[4], h[3] = h[2] + 1, h[4] + 1, f"{step} (interrupted)"
    return {p: tuple(h) for p, h in out.items()}


def test_ledger_against_a_sequential_fold(spark):
    r = random.Random(5)
    rows = []
    for i in range(3000):
        status = r.choice(["started", "ended", "done", None])
        step = r.choice(["clone", "pipeline", "project", "firm"])
        rows.append((i, r.choice([None, *"abcdefghij"]), r.choice([None, "r1", "r2", "r3"]), r.choice([None, 1, 2, 3, 4, 5]), step if status != "started" else r.choice(["clone", "pipeline"]), status, r.choice(["done", "failed", "skipped", "deferred"]), r.choice([None, "pipeline", "firm"])))
    df = spark.createDataFrame(rows, "line_no bigint, project string, run_id string, attempt bigint, step string, status string, state string, failed_step string")
    got = {r["project"]: (r["state"], r["failures"], r["attempts"], r["last_failed_step"], r["interrupted"]) for r in ledger.histories(df).collect()}
    assert got == fold(rows)
    assert ledger.histories(df.limit(0)).count() == 0


def test_plan_truth_table(spark):
    rows = [("a", "done", 0, 0), ("b", "done", 0, 0), ("c", "failed", 3, 0), ("d", "failed", 1, 1), ("e", "", 0, 3), ("f", "failed", 2, 0)]
    h = spark.createDataFrame(rows, "project string, state string, failures bigint, interrupted bigint")
    s = spark.createDataFrame([("a", True), ("b", False), ("f", True), ("new", True), ("newer", False)], "project string, stamped boolean")
    assert {tuple(r) for r in ledger.plan(h, s, 2).collect()} == {("a", "skip"), ("b", "run"), ("c", "give-up"), ("d", "run"), ("e", "give-up"), ("f", "post"), ("new", "post"), ("newer", "run")}


def test_u_is_known_and_any_prefix_is_in_order(spark):
    names = spark.createDataFrame([(f"o/r{i}",) for i in range(400)], "slug string")
    q = sampling.queue(names, "slug", "s:").orderBy("queue_pos").collect()
    assert [r["queue_pos"] for r in q] == list(range(1, 401)) and [r["u"] for r in q] == sorted(r["u"] for r in q)
    assert [r["slug"] for r in sampling.bottom_k(names, "slug", "s:", 7).collect()] == [r["slug"] for r in q[:7]]
    import hashlib

    expected = (int.from_bytes(hashlib.sha256(b"s:o/r1").digest()[:8], "big") >> 11) / 2**53
    assert {r["slug"]: r["u"] for r in q}["o/r1"] == expected


def test_scalars(spark):
    one = lambda *c: spark.range(1).select(*c).first()
    human = [one(scalars.human(F.lit(float(n))))[0] for n in (0, 1023, 1024, 1280, 1024**2 * 1.5, 1024**5 * 3)]
    assert human == ["0 B", "1023 B", "1.0 KiB", "1.2 KiB", "1.5 MiB", "3.0 PiB"]
    assert [one(scalars.size_to_bytes(F.lit(t)))[0] for t in ("3GB", "1.5 kib", "7B", "7", "80%", "x", "2t")] == [3 * 1024**3, 1536, 7, None, None, None, 2 * 1024**4]
    name = lambda h, s: one(scalars.project_name(F.lit(h), F.lit(s)))[0]
    assert [name("github.com", "a/b"), name("github.com", "b"), name("g.org", "b"), name("g.org", "/x/y/"), name("g.org", "a b"), name("g.org", "..")] == ["a__b", None, "g.org__b", "g.org__x__y", None, None]
    assert one(scalars.key_values(F.lit("rows=1\nx\nbytes=2=3\nrows=4")))[0] == {"rows": "4", "bytes": "2=3"}
    assert one(scalars.bar(F.lit(1.0), F.lit(4), 8))[0] == "##......" and one(scalars.percent(F.lit(0), F.lit(0)))[0] == 0
    assert [one(mask.selects(F.lit(p)))[0] for p in ("a.c", "A.H", "x/y.c++", "a.go", "c", "a.cs")] == [True, True, True, False, False, False]
    with pytest.raises(ValueError):
        mask.mask_of([])


def test_manifest_and_frame(spark, tmp_path):
    m = tmp_path / "m.tsv"
    sha = "a" * 40
    m.write_text(f"# note\n\np\tu\tk\t\tS\nq\tu\tk\tm\tL\t{sha}\n")
    assert [(r["line_no"], r["name"], r["file_filter"], r["commit"]) for r in files.manifest(spark, str(m)).orderBy("line_no").collect()] == [(3, "p", mask.UNIVERSAL, None), (4, "q", "m", sha)]
    assert files.manifest(spark, str(m), ["q"]).count() == 1
    for bad in ("a\tb\tc\td", "a\tu\tk\t\tXL", "a\tu\tk\t\tS\tbeef"):
        m.write_text(f"p\tu\tk\t\tS\n{bad}\n")
        with pytest.raises(files.InputError, match=":2: "):
            files.manifest(spark, str(m))
    import hashlib

    u = lambda s: (int.from_bytes(hashlib.sha256(f"s:{s}".encode()).digest()[:8], "big") >> 11) / 2**53
    f = tmp_path / "f.csv"
    head = "slug,host,repo_url,head_oid,u,size_class,labels,included\n"
    f.write_text(head + f"a/b,,http://x,{sha},{u('a/b')!r},S,lib,yes\nc/d,G.org,http://y,{sha},0.5,S,lib,no\n")
    kept, dropped = files.frame(spark, str(f), "s:")
    rows = kept.collect()
    assert dropped == 1
    assert [(r["name"], r["line_no"], r["category"]) for r in rows] == [("a__b", 2, "lib")]
    side = enrich.sidecar(kept, "frame:f", mask.UNIVERSAL, contracts.PROVENANCE).first()
    assert (side["owner"], side["repo"], side["file_mask"], side["clone_url"], side["stars"]) == ("a", "b", mask.UNIVERSAL, "http://x", "")
    for bad in (f"a/b,,http://x,{sha},0.25,S,lib,1", f"a/b,,http://x,BEEF,{u('a/b')!r},S,lib,1", f"b,,http://x,{sha},{u('b')!r},S,lib,1", f"a/b,,,{sha},{u('a/b')!r},S,lib,1", f"a/b,,x,{sha},{u('a/b')!r},XL,lib,1"):
        f.write_text(head + bad + "\n")
        with pytest.raises(files.InputError, match=":2: "):
            files.frame(spark, str(f), "s:")
    f.write_text("slug,host\n")
    with pytest.raises(files.InputError, match="repo_url"):
        files.frame(spark, str(f), "s:")


def test_logs(spark, tmp_path):
    log = f"{tmp_path}/ledger.jsonl"
    rows, torn = files.ledger(spark, log)
    assert rows.count() == 0 and torn.count() == 0
    sinks.append_rows(log, [{"project": "p", "step": "clone", "attempt": 1, "flags": {"a": 1}}])
    with open(log, "a") as f:
        f.write('\n{"project": "q", "st')
    sinks.append_rows(log, [{"project": "r", "manifest_row": {"name": "r"}}])
    rows, torn = files.ledger(spark, log)
    assert [(r["line_no"], r["project"], r["flags"]) for r in rows.orderBy("line_no").collect()] == [(1, "p", '{"a":1}'), (4, "r", None)]
    assert [r["line_no"] for r in torn.collect()] == [3]
    sinks.append_tsv(f"{tmp_path}/m.tsv", ["iso_start", "project", "class", "phase", "duration_s", "rc", "log"], ["2024-01-01T00:00:00+00:00", "p", "S", "pipeline", 3, 0, "l"])
    assert files.tsv(spark, f"{tmp_path}/m.tsv", files.METRICS).first()["duration_s"] == 3
    assert files.tsv(spark, f"{tmp_path}/absent.tsv", files.METRICS).count() == 0
    sinks.write_stamp(f"{tmp_path}/a.validated", 5, 7)
    (tmp_path / "b.validated").write_text("bytes=1\n")
    (tmp_path / "c.validated").write_text("rows=many\n")
    got = {os.path.basename(r["path"])[0]: (r["rows"], r["unreadable"]) for r in files.stamps(spark, f"{tmp_path}/*.validated").collect()}
    assert got == {"a": (5, False), "b": (0, False), "c": (None, True)}


def test_catalogue(spark, tmp_path):
    p = spark.createDataFrame([("a", "cat", "S", "DONE", "x", False, None), ("b", "cat", "M", "DONE", None, True, None), ("c", "cat", "S", "QUEUED", "y", False, None)], "name string, category string, size_class string, state string, parquet_path string, parquet_missing boolean, excluded_because string")
    assert [r["name"] for r in catalog.publishable(p).collect()] == ["a"]
    row = p.where("name = 'c'").withColumn("state", F.lit("DONE"))
    once = catalog.join_project(p, row)
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in catalog.join_project(once, row).collect()} and once.count() == 3
    assert sinks.replace_table(once, f"{tmp_path}/projects", "name").where("state = 'DONE'").count() == 3
    assert sinks.replace_table(p, f"{tmp_path}/projects", "name").where("state = 'DONE'").count() == 2
    with pytest.raises(ValueError, match="a"):
        sinks.assert_unique(p.union(p), "name")
    good, odd = f"{tmp_path}/good.parquet", f"{tmp_path}/odd.parquet"
    tokens = spark.createDataFrame([tuple("a" if c == "repo_name" else None for c in contracts.COLUMNS)], contracts.CONTRACT)
    sinks.write_single_parquet(tokens, good, ["token_index"])
    sinks.write_single_parquet(tokens.drop("firm"), odd, ["token_index"])
    (tmp_path / "bad.parquet").write_bytes(b"none")
    usable, drifted, unread = catalog.split_by_schema(spark, [good, odd, f"{tmp_path}/bad.parquet"])
    assert usable == [good] and [d.column for d in drifted[odd]] == ["firm"] and unread == [f"{tmp_path}/bad.parquet"]
    view = p.withColumn("parquet_path", F.when(F.col("name") == "a", good))
    assert catalog.create_view(spark, view)["usable"] == [good] and spark.table("tokens").columns[:3] == ["category", "size_class", "repo_name"] and spark.table("tokens").count() == 1
    catalog.create_view(spark, view.limit(0))
    assert spark.table("tokens").count() == 0
    assert [catalog.accepts(10_000, 1, []), catalog.accepts(10_001, 0, []), catalog.accepts(10_001, 1, [])] == ["10000 bytes", "no rows", ""]
