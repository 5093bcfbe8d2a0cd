"""Queries of building manifests, gating files, rebuilding the catalogue, reports and clean-up, and their SQL, over whole tables.

Operators that read text files get them from tables: the rows are written into the shared folder in the file's form and read by the
operator's own reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom import contracts
from strataloom.functions import mask, scalars
from strataloom.operators import closure, enrich, footers, ledger, manifests, publishing, reports, retention
from strataloom.plans.corpus import _CONTRACT, _HISTORY, RETRIES, SALT
from strataloom.runtime import scratch_path, table
from strataloom.sources import files

QUERIES, ORACLE = {}, {}
STATUS, AT = "frame:frame.csv@sha256:0123456789ab", "2024-01-01T00:00:00+00:00"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _line_no(c: str):
    return F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint")


def raw_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projects in the form of a selection frame: cells as strings, numbered lines; projects that aren't DONE are not included."""
    url = F.regexp_extract("url", "^https?://([^/]+)/(.*?)(\\.git)?$", 1).alias("host"), F.regexp_extract("url", "^https?://([^/]+)/(.*?)(\\.git)?$", 2).alias("slug")
    p = table(spark, sf_dir, "projects").select("name", "url", "category", "size_class", "state", *url)
    return p.select(
        _line_no("name").alias("line_no"), "slug", "host", F.col("url").alias("repo_url"), F.substring(F.sha2("name", 256), 1, 40).alias("head_oid"), scalars.u_of(F.col("slug"), SALT).cast("string").alias("u"),
        "size_class", F.concat(F.lit(" "), "category").alias("labels"), F.when(F.col("state") == "DONE", " Yes ").otherwise("no").alias("included"),
    )


_FRAME = """
    with p as (select cast('0x' || substr(sha256(name), 1, 8) as bigint) as line_no, name as project, url, category, size_class, state, substr(sha256(name), 1, 40) as commit,
                      regexp_extract(url, '^https?://([^/]+)/(.*?)(\\.git)?$', 1) as host, regexp_extract(url, '^https?://([^/]+)/(.*?)(\\.git)?$', 2) as slug from projects),
    frame as (select *, case when host = 'github.com' then replace(slug, '/', '__') else host || '__' || replace(slug, '/', '__') end as name,
                     (cast('0x' || substr(sha256('strata:' || slug), 1, 14) as bigint) >> 3) / 9007199254740992.0::double as u from p)"""


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.check_frame(raw_frame(spark, sf_dir), SALT).where("not dropped and violation is null")


@query(f"{_FRAME} select row_number() over (order by u, slug) as queue_pos, name, slug, commit, size_class, category, u from frame where state = 'DONE'")
def frame_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.work_queue(_kept(spark, sf_dir), SALT).select("queue_pos", "name", "slug", "commit", "size_class", "category", "u")


@query(f"{_FRAME} select row_number() over (order by u, slug) as queue_pos, name from frame where state = 'DONE' order by 1 limit 10")
def frame_queue_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.work_queue(_kept(spark, sf_dir), SALT, limit=10).select("queue_pos", "name")


@query("select count(*) filter (state = 'DONE') as kept, count(*) filter (state is distinct from 'DONE') as dropped from projects")
def frame_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = files.check_frame(raw_frame(spark, sf_dir), SALT)
    return checked.agg(F.count_if(~F.col("dropped")).alias("kept"), F.count_if("dropped").alias("dropped"))


@query("""
    select cast('0x' || substr(sha256(name), 1, 8) as bigint) as line_no, case cast('0x' || substr(sha256(name), 1, 8) as bigint) % 9
        when 0 then 'head_oid is no SHA' when 1 then 'u is no number' when 2 then 'u is outside [0, 1)' when 3 then 'u is not that of the slug and the salt'
        when 4 then 'the size class is none of S, M, L' when 5 then 'repo_url holds a tab or a newline' when 6 then 'repo_url is empty'
        when 7 then 'the category holds a tab or a newline' end as violation from projects""")
def frame_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("line_no") % 9
    broken = raw_frame(spark, sf_dir).drop("included").withColumns({
        "head_oid": F.when(k == 0, F.upper(F.concat(F.lit("a"), F.substring("head_oid", 2, 39)))).otherwise(F.col("head_oid")),
        "u": F.when(k == 1, "x").when(k == 2, "1.5").when(k == 3, F.when(F.col("u").cast("double") < 0.5, "0.75").otherwise("0.25")).otherwise(F.col("u")),
        "size_class": F.when(k == 4, "XL").otherwise(F.col("size_class")),
        "repo_url": F.when(k == 5, "https://a\tb").when(k == 6, "  ").otherwise(F.col("repo_url")),
        "labels": F.when(k == 7, "a\tb").otherwise(F.col("labels")),
    })
    return files.check_frame(broken, SALT).select("line_no", "violation")


@query(f"""
    {_FRAME}, twice as (select name, line_no from frame union all select upper(name), line_no + 1 from frame where size_class = 'S')
    select lower(name) as name_key, count(*) as n, min(line_no) as first_line, min(line_no) + 1 as second_line from twice group by 1 having count(*) > 1""")
def frame_repeated_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.check_frame(raw_frame(spark, sf_dir), SALT).select("name", "line_no", "size_class")
    again = rows.where("size_class = 'S'").select(F.upper("name").alias("name"), (F.col("line_no") + 1).alias("line_no"))
    return manifests.repeated_projects(rows.select("name", "line_no").union(again))


@query(f"""
    {_FRAME} select row_number() over (order by u, slug) as queue_pos, name || chr(9) || url || chr(9) || category || chr(9) || chr(9) || size_class || chr(9) || commit as line
    from frame where state = 'DONE'""")
def manifest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.manifest_text(manifests.work_queue(_kept(spark, sf_dir), SALT))


@query(f"""
    {_FRAME} select name, url as clone_url, '{STATUS}' as provenance_status, size_class, category as manifest_category, '{mask.UNIVERSAL}' as file_mask,
        coalesce(nullif(regexp_extract(slug, '^(.*)/[^/]*$', 1), ''), host) as owner, regexp_extract(slug, '([^/]*)$', 1) as repo, '' as stars from frame where state = 'DONE'""")
def frame_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = manifests.provenance_status("frame.csv", "0123456789abcdef")
    side = enrich.sidecar(_kept(spark, sf_dir), status, mask.UNIVERSAL, contracts.PROVENANCE)
    return side.select("name", "clone_url", "provenance_status", "size_class", "manifest_category", "file_mask", "owner", "repo", "stars")


@query(" union all ".join(f"select '{f}' as field, count(*) as n_blank, count(*) as n_rows from tokens having count(*) filter (coalesce(trim({f}), '') <> '') = 0" for f in contracts.PROVENANCE))
def provenance_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.provenance_gaps(table(spark, sf_dir, "tokens"))


@query("""
    select name, url, category, size_class from (
        select line_no, manifest_row['name'] as name, manifest_row['url'] as url, coalesce(manifest_row['category'], '') as category, manifest_row['size_class'] as size_class
        from ledger where manifest_row is not null)
    qualify row_number() over (partition by name order by line_no % 2, line_no) = 1""")
def manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lambda k: F.coalesce(F.try_element_at("manifest_row", F.lit(k)), F.lit(""))
    line = F.concat_ws("\t", *[m(k) for k in ("name", "url", "category", "file_filter", "size_class")]).alias("value")
    rows, paths = table(spark, sf_dir, "ledger").where("manifest_row is not null").select("line_no", line), []
    for half in (0, 1):
        paths.append(scratch_path(spark, "manifest"))
        rows.where(F.col("line_no") % 2 == half).coalesce(1).sortWithinPartitions("line_no").select("value").write.text(paths[-1])
    return manifests.entries(spark, paths)[0]


@query(f"{_FRAME} select name, host, commit, u, size_class, category from frame where state = 'DONE'")
def frame_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "frame")
    raw_frame(spark, sf_dir).drop("line_no").coalesce(1).write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(path)
    return files.frame(spark, path, SALT)[0].select("name", "host", "commit", "u", "size_class", "category")


@query("select domain, coalesce(company, '') as company, coalesce(kind, '') as kind, coalesce(source, '') as source from domain_map")
def lookup_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    keep = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quoteAll": True}
    table(spark, sf_dir, "domain_map").write.options(header=True, **keep).csv(path)
    return files.lookup(spark, path).select("domain", *[F.coalesce(c, F.lit("")).alias(c) for c in ("company", "kind", "source")])


@query("select count(*) as n_rows, cast(sum(n) as bigint) as n_numbered, min(least) as least from (select 1 as n, 0::bigint as least from tokens)")
def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.numbered_parquet(spark, f"{sf_dir}/tokens.parquet")
    by = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), (F.max("_row") + 1).alias("_m"), F.min("_row").alias("_l"))
    return by.agg(F.sum("_n").alias("n_rows"), F.sum("_m").alias("n_numbered"), F.min("_l").alias("least"))


@query("select project, step as phase, cast(floor(duration_s) as bigint) as duration_s, exit_code as rc from ledger where project is not null")
def phase_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    rows = table(spark, sf_dir, "ledger").where("project is not null")
    fields = [F.col("start_utc").alias("iso_start"), "project", F.lit("S").alias("class"), F.col("step").alias("phase"), F.floor("duration_s").alias("duration_s"), F.col("exit_code").alias("rc"), F.lit("log").alias("log")]
    rows.select(*fields).write.option("sep", "\t").option("header", True).csv(path)
    return publishing.phase_metrics(spark, path).select("project", "phase", "duration_s", "rc")


@query("select row_number() over (order by line_no) as line_no, run_id, project, attempt, step, status, state, failed_step, exit_code, duration_s, manifest_row['name'] as named from ledger")
def ledger_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ledger")
    rows = table(spark, sf_dir, "ledger")
    rows.coalesce(1).sortWithinPartitions("line_no").select(F.to_json(F.struct(*[c for c in rows.columns if c != "line_no"])).alias("value")).write.text(path)
    read, _ = files.ledger(spark, path)
    return read.select("line_no", "run_id", "project", "attempt", "step", "status", "state", "failed_step", "exit_code", "duration_s", F.try_element_at("manifest_row", F.lit("name")).alias("named"))


@query("""
    select name, url, category, size_class, state, case when state = 'DONE' then token_rows end as token_rows, case when state = 'DONE' then parquet_path end as parquet_path,
           state = 'DONE' and token_rows is null as rows_unreadable, state = 'DONE' and parquet_path is null as parquet_missing, case when name = 'none' then 'x' end as excluded_because
    from (select *, case when state in ('DONE', 'RUNNING', 'FAILED') then state else 'QUEUED' end as state from projects)""".replace("select *, case", "select * exclude (state), case"))
def catalogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "projects")
    stamp = F.when(F.col("state") == "DONE", F.concat(F.lit("rows="), F.coalesce(F.col("token_rows").cast("string"), F.lit("many")), F.lit("\nbytes=7\n")))
    probes = p.select("name", stamp.alias("stamp"), (F.col("state") == "RUNNING").alias("locked"), F.col("state").isin("RUNNING", "FAILED", "DONE").alias("touched"), F.col("parquet_path").alias("parquet"))
    return publishing.project_rows(p.select("name", "url", "category", "size_class"), probes, {"none": "x"})


@query(f"""
    select name, parquet_path, '{AT}' as joined_utc from projects
    where state = 'DONE' and parquet_path is not null and not coalesce(parquet_missing, false) and excluded_because is null""")
def joined_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishing.joined_rows(table(spark, sf_dir, "projects"), at=AT)


@query("""
    select 'tokens' as form, 'attributed' as verdict union all select 'unattributed tokens', 'unattributed'
    union all select 'lineitem', 'missing repo_name: string' from (select 1 from (describe lineitem) where column_name = 'repo_name' having count(*) = 0)""")
def firm_input_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "tokens").schema
    forms = {"tokens": tokens, "unattributed tokens": type(tokens)(tokens.fields[:-3]), "lineitem": table(spark, sf_dir, "lineitem").schema}
    return spark.createDataFrame([(n, enrich.input_form(s)) for n, s in forms.items()], "form string, verdict string")


@query("""
    with k as (select regexp_replace(lower(coalesce(domain, '')), '^\\s+|\\s+$', '', 'g') as key, row_number() over () as line from domain_map),
    second as (select key, line from (select key, line, row_number() over (partition by key order by line) as r from k) where r = 2)
    select 'domain_map' as name, 'domain repeats: ' || (select string_agg(key, ', ' order by line) from (select * from second order by line limit 5)) as refusal
    union all select 'firm_list', ''""")
def lookup_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    def refusal(name: str, column: str) -> str:
        try:
            enrich.guard(table(spark, sf_dir, name), column, name)
        except enrich.Refused as e:
            return str(e).removeprefix(f"{name}: ")
        return ""

    return spark.createDataFrame([("domain_map", refusal("domain_map", "domain")), ("firm_list", refusal("firm_list", "firm"))], "name string, refusal string")


_DRIFTS = f"""
    with want(name, type) as (values {_CONTRACT}), t(name) as (values ('tokens'), ('lineitem'), ('documents')),
    have as (select 'tokens' as t, column_name as name, column_type as type from (describe tokens) union all select 'lineitem', column_name, column_type from (describe lineitem)
             union all select 'documents', column_name, column_type from (describe documents)),
    drifts as (select t.name as "table", case when h.name is null then 'missing' else 'type' end as kind, w.name as "column" from t cross join want w left join have h on h.t = t.name and h.name = w.name
                   where h.name is null or h.type <> w.type
               union all select h.t, 'unexpected', h.name from have h where h.name not in (select name from want))"""


def _footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [p for t in ("tokens", "lineitem", "documents") for p in table(spark, sf_dir, t).inputFiles()]
    return footers.footers(spark, paths)


def _table_of(path):
    return F.regexp_extract(path, "/(\\w+)\\.parquet(/[^/]*)?$", 1).alias("table")


@query(f"{_DRIFTS} select distinct t.name as \"table\", case when d.\"table\" is null then 'usable' else 'drifted' end as verdict, (select count(*) from drifts x where x.\"table\" = t.name) as n_drifts from t left join drifts d on d.\"table\" = t.name")
def footer_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.sorted_out(_footers(spark, sf_dir)).select(_table_of("path"), "verdict", "n_drifts").distinct()


@query(f'{_DRIFTS} select "table", kind, "column" from drifts')
def footer_drifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.drift_rows(_footers(spark, sf_dir)).select(_table_of("path"), "kind", "column").distinct()


@query(f"{_DRIFTS} select t.name as \"table\", not exists (select 1 from drifts d where d.\"table\" = t.name) as accepted from t where t.name <> 'documents'")
def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t, publishing.gate(spark, f"{sf_dir}/{t}.parquet") == "") for t in ("tokens", "lineitem")], "table string, accepted boolean")


@query("""
    with l as (select project, concat_ws(' ', arg_max(step, line_no), arg_max(status, line_no)) as last from ledger where project is not null group by 1)
    select name, size_class, state, coalesce(last, '—') as last_activity from projects left join l on name = project""")
def project_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status(table(spark, sf_dir, "projects"), ledger.last_activity(table(spark, sf_dir, "ledger")))


@query("""
    select done, total, cast(floor(done * 100 / total) as bigint) as percent, repeat('#', full_) || repeat('.', 20 - full_) as bar, failed from (
        select count(*) filter (state = 'DONE') as done, count(*) as total, count(*) filter (state = 'FAILED') as failed,
               cast(round_even(count(*) filter (state = 'DONE') * 20.0::double / count(*), 0) as integer) as full_ from projects)""")
def project_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.progress(table(spark, sf_dir, "projects"))


@query("""
    select name, 'excluded' as flag, excluded_because as detail from projects where excluded_because is not null
    union all select name, 'parquet missing', '' from projects where parquet_missing union all select name, 'rows unreadable', '' from projects where rows_unreadable""")
def project_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.flags(table(spark, sf_dir, "projects"))


@query("select line_no, step, status from ledger where project = (select min(project) from ledger)")
def project_ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ledger")
    return reports.of_project(rows, rows.agg(F.min("project")).first()[0]).select("line_no", "step", "status")


@query("""
    select run_id, count(*) filter (state = 'skipped') as skipped, count(*) filter (state = 'done') as done, count(*) filter (state = 'failed') as failed
    from ledger where step = 'project' and status is distinct from 'started' group by run_id""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counters(table(spark, sf_dir, "ledger"))


@query("select count(*) filter (coalesce(trim(pinned_sha), '') = '') as n_unpinned, count(*) as n_rows from ledger")
def unpinned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unpinned(table(spark, sf_dir, "ledger"), "pinned_sha")


@query(f"""
    {_HISTORY}, stamped as (select name as project, state = 'DONE' as stamped from projects)
    select coalesce(h.project, s.project) as project, case when h.state = 'done' and coalesce(stamped, false) then 'skip'
           when coalesce(failures, 0) + coalesce(interrupted, 0) > {RETRIES} then 'give-up' when coalesce(stamped, false) then 'post' else 'run' end as decision,
           coalesce(attempts, 0) + 1 as attempt, coalesce(failures + interrupted, 0) as failures
    from histories h full join stamped s on h.project = s.project""")
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "projects").select(F.col("name").alias("project"), (F.col("state") == "DONE").alias("stamped"))
    return reports.work(ledger.histories(table(spark, sf_dir, "ledger")), stamped, RETRIES)


@query("select name, cast('0x' || substr(sha256(name), 1, 8) as bigint) as pos from projects where coalesce(token_rows, 0) <= 100 order by 2 limit 1")
def next_due_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "projects").select("name", _line_no("name").alias("pos"), F.col("token_rows").cast("double").alias("not_before"))
    return reports.next_due(jobs, 100.0).select("name", "pos")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as the entries of work directories, one project a repository."""
    ends = F.when(F.col("doc_id") % 97 == 0, ".parquet").otherwise(".txt")
    subtree = F.when(F.col("doc_id") % 3 == 0, "memo").when(F.col("doc_id") % 3 == 1, "html").otherwise("src")
    return table(spark, sf_dir, "documents").where("repo_name is not null").select(F.col("repo_name").alias("project"), subtree.alias("subtree"), F.concat(F.col("doc_id").cast("string"), ends).alias("name"), F.col("n_chars").alias("bytes"))


_SWEEP = """
    with e as (select repo_name as project, doc_id % 3 < 2 as free, doc_id % 97 = 0 as kept, coalesce(n_chars, 0) as bytes from documents where repo_name is not null),
    s as (select project, count(*) as n_entries, cast(sum(bytes) as bigint) as bytes, cast(coalesce(sum(bytes) filter (free), 0) as bigint) as free, count(*) filter (free and kept) as violations from e group by 1),
    swept as (select project, n_entries, bytes, violations, case when p.state is distinct from 'DONE' then 'kept' when violations > 0 then 'refused' else 'swept' end as verdict, free
              from s left join projects p on p.name = project)"""


@query(f"{_SWEEP} select project, n_entries, bytes, case when verdict = 'swept' then free else 0 end as freed, violations, verdict from swept")
def sweep_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.sweep(_entries(spark, sf_dir), table(spark, sf_dir, "projects"))


@query(f"{_SWEEP} select verdict, count(*) as n_projects, cast(sum(bytes) as bigint) as bytes, cast(sum(case when verdict = 'swept' then free else 0 end) as bigint) as freed from swept group by verdict")
def sweep_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.totals(sweep_report(spark, sf_dir))


@query("select repo_name as project, count(*) as n from documents where repo_name is not null and doc_id % 5 <> 0 group by 1")
def removable_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = _entries(spark, sf_dir)
    keepers = entries.where(F.regexp_extract("name", "^\\d+", 0).cast("bigint") % 5 == 0)
    return retention.removable(entries, keepers).groupBy("project").agg(F.count(F.lit(1)).alias("n"))


@query("""
    select line_no, coalesce(regexp_matches(flags, '(^|[^\\w-])workers($|[^\\w-])'), false) as workers, coalesce(regexp_matches(flags, '(^|[^\\w-])work($|[^\\w-])'), false) as work
    from ledger""")
def whole_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ledger").select("line_no", scalars.whole_flag(F.col("flags"), "workers").alias("workers"), scalars.whole_flag(F.col("flags"), "work").alias("work"))


@query("""
    select line_no, cast(cast(round_even(duration_s, 0) as bigint) as varchar) as s, printf('%.3f', round_even(duration_s, 3)) as ms, printf('%.1f', round_even(duration_s / 60, 1)) as mins
    from ledger""")
def rounded_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("duration_s")
    return table(spark, sf_dir, "ledger").select("line_no", scalars.rounded(d, "s").alias("s"), scalars.rounded(d, "ms").alias("ms"), scalars.rounded(d, "min").alias("mins"))


@query("select distinct original_commit_sha, array_to_string(list_slice(footer_signed_off_by, 1, 2), '; ') as signers from tokens where footer_signed_off_by is not null")
def first_signers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "tokens").where("footer_signed_off_by is not null")
    return rows.select("original_commit_sha", scalars.first_few(F.col("footer_signed_off_by"), 2).alias("signers")).distinct()


@query("select distinct file_path, file_path <> '' and not contains(file_path, '/') and not contains(file_path, '..') as safe from tokens where file_path is not null")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "tokens").where("file_path is not null").select("file_path").distinct()
    return paths.withColumn("safe", scalars.safe_name(F.col("file_path")))


@query("""
    with recursive p as (select distinct doc_id as child, doc_id // 8 as parent from documents where doc_id >= 8), d(id) as (
        select child from p where parent = 3 union select p.child from p join d on p.parent = d.id) select id from d""")
def descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("doc_id >= 8").select(F.col("doc_id").alias("child"), F.floor(F.col("doc_id") / 8).alias("parent"))
    return closure.descendants(docs, spark.createDataFrame([(3,)], "id bigint"))
