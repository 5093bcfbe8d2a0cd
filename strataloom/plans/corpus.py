"""Queries of the corpus pipeline's own operators and their SQL, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom import contracts
from strataloom.functions import mask, scalars
from strataloom.operators import catalog, enrich, ledger, reports, sampling
from strataloom.runtime import table
from strataloom.sources import files, sinks

SALT, SAMPLE, NEWEST, RETRIES = "strata:", 50, 20, 2
QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _names(t: DataFrame) -> DataFrame:
    return enrich.first_of_key(t.where("firm_raw is not null"), "firm_raw", "firm_raw", "firm")


_DOMAINS = "select * from domain_map where domain is not null qualify row_number() over (partition by lower(domain) order by domain, company nulls last, source nulls last) = 1"
_U = "(cast('0x' || substr(sha256('strata:' || name), 1, 14) as bigint) >> 3) / 9007199254740992.0::double"
_HISTORY = """
    with r as (select * from ledger where project is not null),
    final as (select * from r where step = 'project' and status is distinct from 'started'),
    counted as (select * from final where state is null or state not in ('skipped', 'deferred')),
    folded as (select project, arg_max(state, line_no) as state, count(*) filter (state = 'failed') as failures, count(*) as attempts,
                      arg_max(coalesce(failed_step, ''), line_no) filter (state = 'failed') as failed_step from counted group by project),
    started as (select project, run_id, attempt, min(line_no) as first_line, arg_max(step, line_no) as step from r where status = 'started' group by all),
    cut as (select * from started s where not exists (select 1 from final f where f.project = s.project and f.run_id is not distinct from s.run_id
                                                      and f.attempt is not distinct from s.attempt)),
    lost as (select project, count(*) as n, arg_max(step, first_line) as step from cut group by project),
    histories as (
        select p.project, coalesce(f.state, '') as state, coalesce(f.failures, 0) as failures, coalesce(f.attempts, 0) + coalesce(l.n, 0) as attempts,
               coalesce(l.step || ' (interrupted)', f.failed_step, '') as last_failed_step, coalesce(l.n, 0) as interrupted
        from (select distinct project from r) p left join folded f using (project) left join lost l using (project))"""


@query(f"""
    with d as ({_DOMAINS}), c as (select * from firm_canonical where firm_raw is not null
         qualify row_number() over (partition by lower(firm_raw) order by firm_raw, firm nulls last) = 1)
    select t.repo_name, t.file_path, t.token_index, coalesce(d.company, '') as firm_raw, coalesce(nullif(c.firm, ''), d.company, '') as firm,
           coalesce(d.source, '') as firm_source
    from tokens t left join d on lower(d.domain) = lower(t.person_domain) left join c on lower(trim(c.firm_raw)) = lower(trim(d.company))""")
def firm_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = enrich.first_of_key(table(spark, sf_dir, "domain_map").where("domain is not null"), "domain", "domain", "company", "source")
    out = enrich.attribute_firms(table(spark, sf_dir, "tokens"), domains, _names(table(spark, sf_dir, "firm_canonical")))
    return out.select("repo_name", "file_path", "token_index", "firm_raw", "firm", "firm_source")


@query("select coalesce(lower(trim(domain)), '') as key, count(*) as n from domain_map group by 1 having count(*) > 1")
def lookup_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.repeated_keys(table(spark, sf_dir, "domain_map"), "domain").select("key", "n")


@query("""
    select key, n, line_no as second_line from (
        select coalesce(lower(trim(project)), '') as key, line_no, row_number() over w as r, count(*) over (partition by coalesce(lower(trim(project)), '')) as n
        from ledger window w as (partition by coalesce(lower(trim(project)), '') order by line_no)) where r = 2""")
def repeated_key_second_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.repeated_keys(table(spark, sf_dir, "ledger"), "project", "line_no")


@query("select lower(domain) as name_key, count(*) as n from domain_map where domain is not null group by 1 having count(*) > 1")
def names_repeated_but_for_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.repeated_names(table(spark, sf_dir, "domain_map"), "domain")


@query("""
    select p.category, p.size_class, t.size_class as size_class_1, t.repo_name, t.file_path, t.token_index, t.token_value
    from tokens t join projects p on t.repo_name = p.name""")
def corpus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = catalog.corpus_view(table(spark, sf_dir, "tokens"), table(spark, sf_dir, "projects"))
    return view.select("category", "size_class", "size_class_1", "repo_name", "file_path", "token_index", "token_value")


@query("select count(*) as n_rows from tokens t join projects p on t.repo_name = p.name")
def corpus_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.corpus_view(table(spark, sf_dir, "tokens"), table(spark, sf_dir, "projects")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("select count(*) as n_rows from tokens")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tokens").agg(F.count(F.lit(1)).alias("n_rows"))


_CONTRACT = ", ".join(f"('{n}', '{ {'bigint': 'BIGINT', 'string': 'VARCHAR', 'array<string>': 'VARCHAR[]'}[t]}')" for n, t in contracts.as_rows(contracts.CONTRACT))


@query(f"""
    with want(name, type) as (values {_CONTRACT}), have as (select column_name as name, column_type as type from (describe lineitem))
    select case when h.name is null then 'missing' when w.name is null then 'unexpected' else 'type' end as kind, coalesce(w.name, h.name) as "column"
    from want w full join have h using (name) where h.name is null or w.name is null or h.type <> w.type""")
def schema_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    drifts = contracts.compare(table(spark, sf_dir, "lineitem").schema)
    return contracts.drift_table(spark, drifts).select("kind", "column")


@query(f"""
    with want(name, type) as (values {_CONTRACT}), have as (select column_name as name, column_type as type from (describe tokens))
    select count(*) as n_drifts from want w full join have h using (name) where h.name is null or w.name is null or h.type <> w.type""")
def token_contract_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    drifts = contracts.compare(table(spark, sf_dir, "tokens").schema)
    return contracts.drift_table(spark, drifts).agg(F.count(F.lit(1)).alias("n_drifts"))


@query(f"{_HISTORY} select * from histories")
def ledger_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.histories(table(spark, sf_dir, "ledger"))


@query(f"{_HISTORY} select project, run_id, attempt, first_line, step from cut")
def interrupted_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.interrupted_attempts(table(spark, sf_dir, "ledger"))


@query("""
    select line_no, project, run_id, attempt, step, status from ledger where status is distinct from 'started'
    union all
    select line_no, project, run_id, attempt, step, 'interrupted' from ledger s where status = 'started' and not exists (
        select 1 from ledger e where e.status is distinct from 'started' and e.project is not distinct from s.project and e.run_id is not distinct from s.run_id
               and e.attempt is not distinct from s.attempt and e.step is not distinct from s.step)""")
def ledger_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.audit(table(spark, sf_dir, "ledger")).select("line_no", "project", "run_id", "attempt", "step", "status")


@query(f"""
    {_HISTORY}, stamped as (select name as project, state = 'DONE' as stamped from projects)
    select coalesce(h.project, s.project) as project, case when h.state = 'done' and coalesce(stamped, false) then 'skip'
           when coalesce(failures, 0) + coalesce(interrupted, 0) > {RETRIES} then 'give-up' when coalesce(stamped, false) then 'post' else 'run' end as decision
    from histories h full join stamped s on h.project = s.project""")
def scheduler_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "projects").select(F.col("name").alias("project"), (F.col("state") == "DONE").alias("stamped"))
    return ledger.plan(ledger.histories(table(spark, sf_dir, "ledger")), stamped, RETRIES)


@query("select project, arg_max(step, line_no) as step, arg_max(status, line_no) as status, max(line_no) as line_no from ledger where project is not null group by project")
def last_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.last_activity(table(spark, sf_dir, "ledger"))


@query("select state, count(*) as n from ledger where step = 'project' and status is distinct from 'started' group by state")
def outcome_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.outcomes(table(spark, sf_dir, "ledger"))


_FINISHED = "select line_no, project, run_id, attempt, duration_s from ledger where step = 'pipeline' and exit_code = 0 and status is distinct from 'started'"


@query(_FINISHED)
def finished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.finished_runs(table(spark, sf_dir, "ledger")).select("line_no", "project", "run_id", "attempt", "duration_s")


@query(f"{_FINISHED} order by line_no desc limit {NEWEST}")
def newest_finished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.newest(finished_runs(spark, sf_dir), NEWEST)


@query("select step, max(duration_s) as max_duration_s, max(queue_pos) as max_queue_pos, min(duration_s) as min_duration_s, count(*) as samples from ledger group by step")
def phase_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.peaks(table(spark, sf_dir, "ledger"), "step", ["duration_s", "queue_pos"], ["duration_s"])


@query("""
    with g as (select event_id, event_id - lag(event_id, 1, 0) over w as span, k - lag(k, 1, 0) over w as busy
               from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events) window w as (partition by user_id order by event_id))
    select event_id, case when span > 0 then round_even(100.0::double * busy / span, 1) else 0.0 end as busy_percent from g""")
def sample_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint"))
    return ledger.deltas(events, ["user_id"], ["event_id"], "k", "event_id").select("event_id", "busy_percent")


@query("select state, count(*) as n from projects group by state")
def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.state_counts(table(spark, sf_dir, "projects"))


@query("""
    select size_class, count(*) filter (state = 'DONE') as done, count(*) as total, cast(floor(count(*) filter (state = 'DONE') * 100 / count(*)) as bigint) as percent
    from projects group by size_class""")
def class_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.class_breakdown(table(spark, sf_dir, "projects"))


@query("select name, parquet_path from projects where state = 'DONE' and parquet_path is not null and not coalesce(parquet_missing, false) and excluded_because is null")
def publishable_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.publishable(table(spark, sf_dir, "projects")).select("name", "parquet_path")


@query("""
    select count(*) filter (parquet_missing) as missing, count(*) filter (rows_unreadable) as unreadable, count(*) filter (excluded_because is not null) as excluded,
           count(*) filter (parquet_path is null) as without_path from projects""")
def catalogue_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.flag_counts(table(spark, sf_dir, "projects"))


@query("""
    select name, token_rows as said, coalesce(n, 0) as found, case when coalesce(n, 0) = 0 then 'no rows' when token_rows is null then 'unstamped'
           when token_rows <> n then 'stale' else 'ok' end as verdict
    from projects left join (select repo_name, count(*) as n from tokens group by 1) on name = repo_name""")
def stamped_row_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.row_checks(table(spark, sf_dir, "tokens"), table(spark, sf_dir, "projects"))


@query(f"select name, {_U} as u, row_number() over (order by {_U}, name) as queue_pos from projects")
def u_queue_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.queue(table(spark, sf_dir, "projects").select("name"), "name", SALT).select("name", "u", "queue_pos")


@query(f"select name, {_U} as u from projects order by 2, 1 limit {SAMPLE}")
def u_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bottom_k(table(spark, sf_dir, "projects").select("name"), "name", SALT, SAMPLE)


@query("""
    select project, line_no, run_id, pinned_sha from ledger where project is not null qualify row_number() over (partition by project order by line_no) = 1""")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.first_wins(table(spark, sf_dir, "ledger"), "project", "line_no").select("project", "line_no", "run_id", "pinned_sha")


@query("""
    select line_no, case when pinned_sha is not null and not regexp_full_match(pinned_sha, '[0-9a-f]{40}') then 'the pinned commit is no SHA'
                         when coalesce(manifest_row['size_class'], '') not in ('S', 'M', 'L') then 'the size class is none of S, M, L' end as violation
    from ledger where manifest_row is not null""")
def manifest_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lambda k: F.coalesce(F.try_element_at("manifest_row", F.lit(k)), F.lit(""))
    line = F.concat_ws("\t", *[m(k) for k in ("name", "url", "category", "file_filter", "size_class")], F.col("pinned_sha"))  # null: no sixth field
    rows = table(spark, sf_dir, "ledger").where("manifest_row is not null").select(F.lit("ledger").alias("path"), "line_no", line.alias("line"))
    return files.manifest_fields(rows).select("line_no", "violation")


@query(f"select distinct repo_name, file_path, regexp_matches(file_path, '{mask.UNIVERSAL}') as selected from tokens where file_path is not null")
def mask_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "tokens").where("file_path is not null").select("repo_name", "file_path").distinct()
    return files.withColumn("selected", mask.selects(F.col("file_path")))


@query("""
    with p as (select name, url, regexp_extract(url, '^https?://([^/]+)/', 1) as host, regexp_extract(url, '^https?://[^/]+/(.*?)(\\.git)?$', 1) as slug from projects)
    select name, case when host = 'github.com' then replace(slug, '/', '__') else host || '__' || replace(slug, '/', '__') end as project_name,
           regexp_extract(slug, '^(.*)/[^/]*$', 1) as owner, regexp_extract(slug, '([^/]*)$', 1) as repo, regexp_replace(url, '\\.git$', '') || '/commit/' as commits
    from p""")
def project_names_from_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "projects").select("name", "url", F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("host"), F.regexp_extract("url", "^https?://[^/]+/(.*?)(\\.git)?$", 1).alias("slug"))
    return p.select("name", scalars.project_name(F.col("host"), F.col("slug")).alias("project_name"), scalars.owner_of(F.col("slug"), F.col("host")).alias("owner"), scalars.repo_of(F.col("slug")).alias("repo"), scalars.commit_url(F.col("url")).alias("commits"))


@query("select doc_id, sha256(text) as digest from documents")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


_STEP = "n_chars * 1000.0::double"


@query(f"""
    select doc_id, case when x < 1024 then cast(cast(round_even(x, 0) as bigint) as varchar) || ' B'
        when x / 1024 < 1024 then printf('%.1f KiB', round_even(x / 1024, 1)) else printf('%.1f MiB', round_even(x / 1024 / 1024, 1)) end as size
    from (select doc_id, {_STEP} as x from documents)""")
def human_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", scalars.human(F.col("n_chars") * 1000.0).alias("size"))


@query("select p_partkey, cast(p_size as bigint) * 1048576 as bytes from part")
def parsed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, " MiB").otherwise("m"))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.size_to_bytes(text).alias("bytes"))


@query("""
    select name, case when token_rows is null then 0 when token_rows % 5 = 0 then null else token_rows end as rows, length(name) as bytes, coalesce(token_rows % 5 = 0, false) as unreadable
    from projects""")
def key_value_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.concat(F.lit("rows="), F.when(F.col("token_rows") % 5 == 0, "many").otherwise(F.concat(F.lit(" "), F.col("token_rows").cast("string"))))
    text = F.concat_ws("\n", rows, F.concat(F.lit("bytes="), F.length("name").cast("string")), F.lit("no pair"))
    return table(spark, sf_dir, "projects").select("name", files.stamp_facts(text).alias("_s")).select("name", "_s.*")


@query("select line_no, cast(json_extract_string(flags, '$.workers') as bigint) as workers, json_extract_string(flags, '$.skip_html') as skip_html from ledger")
def ledger_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ledger").select("line_no", F.get_json_object("flags", "$.workers").try_cast("bigint").alias("workers"), F.get_json_object("flags", "$.skip_html").alias("skip_html"))


@query("select doc_id, strftime(created_at at time zone 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' as created from documents")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", scalars.iso_seconds(F.col("created_at")).alias("created"))


@query("""
    with n as (select repo_name as name, count(*) as rows from tokens group by 1)
    select p.name, p.token_rows from projects p anti join n on p.name = n.name union all select n.name, n.rows from n join (select distinct name from projects) using (name)""")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects = table(spark, sf_dir, "projects").select("name", "token_rows")
    found = table(spark, sf_dir, "tokens").groupBy(F.col("repo_name").alias("name")).agg(F.count(F.lit(1)).alias("token_rows"))
    return sinks.upsert(projects, found.join(projects.select("name").distinct(), "name", "left_semi"), "name")


@query("""
    select distinct project from ledger where project is not null and project not in
        (select name from projects where state = 'DONE' and parquet_path is not null and not coalesce(parquet_missing, false) and excluded_because is null)""")
def projects_without_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = catalog.publishable(table(spark, sf_dir, "projects")).select(F.col("name").alias("project"))
    return table(spark, sf_dir, "ledger").where("project is not null").select("project").distinct().join(done, "project", "left_anti")


@query("select repo_name, 2 * count(*) as n, max(token_index) as most from tokens group by repo_name")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/tokens.parquet"
    return files.token_files(spark, [path, path]).groupBy("repo_name").agg(F.count(F.lit(1)).alias("n"), F.max("token_index").alias("most"))


_FIELDS = [f for f in contracts.PROVENANCE if f != "file_mask"]


@query("select repo_name, " + ", ".join(f"coalesce(max(nullif(trim({f}), '')), '') as {f}" for f in _FIELDS) + ", coalesce(max(nullif(trim(file_mask), '')), '" + mask.UNIVERSAL + "') as file_mask from tokens group by repo_name")
def project_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.provenance_by_project(table(spark, sf_dir, "tokens"), contracts.PROVENANCE, {"file_mask": mask.UNIVERSAL})


@query("""
    select size_class, repeat('#', full_) || repeat('.', 20 - full_) as bar from (
        select size_class, cast(round_even(count(*) filter (state = 'DONE') * 20.0::double / count(*), 0) as integer) as full_ from projects group by size_class)""")
def progress_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = catalog.class_breakdown(table(spark, sf_dir, "projects"))
    return counts.select("size_class", scalars.bar(F.col("done").cast("double"), F.col("total")).alias("bar"))
