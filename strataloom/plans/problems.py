"""Queries of the general training-data problems (p1, p2, p5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.operators import drift, hotkeys, timestamps
from strataloom.runtime import table

#: How this corpus writes owner and repository, and the extensions of a mask, as one string.
LIST_FORMS = {"repo_name": drift.ListForm("__"), "file_mask": drift.ListForm("|", "(?i)\\.(", ")$")}
KEYS = ["repo_name", "person_domain", "file_path"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, clocks, abbrevs = (table(spark, sf_dir, n) for n in ("tokens", "repo_clocks", "zone_abbrevs"))
    return timestamps.commit_instants(tokens, clocks, abbrevs, timestamps.dictionary_path(spark, abbrevs))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.differences(table(spark, sf_dir, "raw_records"), table(spark, sf_dir, "contract_columns"))


def p2_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.change_log(table(spark, sf_dir, "raw_records"), table(spark, sf_dir, "contract_columns"))


def p2_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.consistent(table(spark, sf_dir, "raw_records"), table(spark, sf_dir, "contract_columns"), LIST_FORMS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotkeys.heavy_keys(table(spark, sf_dir, "tokens"), KEYS).select("key_field", "key_value")


def p5_key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotkeys.key_profile(table(spark, sf_dir, "tokens"), KEYS, "is_structural", "original_commit_sha")


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_change_log, p2_table, p5_found, p5_key_profile)}

_STACKED = " union all ".join(f"select '{k}' as key_field, {k} as key_value, is_structural, original_commit_sha from tokens" for k in KEYS)
_KIND = """case json_type(v) when 'VARCHAR' then 'string' when 'UBIGINT' then 'bigint' when 'BIGINT' then 'bigint' when 'DOUBLE' then 'decimal'
        when 'ARRAY' then case when len(list_filter(from_json(v, '["json"]'), lambda x: json_type(x) not in ('VARCHAR', 'NULL'))) = 0 then 'array<string>' else 'array' end
        else lower(json_type(v)) end"""
ORACLE = {
    "p2_change_log": f"""
        with j as (select file_name, payload from raw_records where file_name is not null and json_valid(payload) and json_type(payload) = 'OBJECT'),
        cells as (select file_name, k as column_name, json_extract(payload, '$."' || k || '"') as v from (select file_name, payload, unnest(json_keys(payload)) as k from j)),
        footer as (select distinct file_name, column_name, {_KIND} as json_type from cells where json_type(v) <> 'NULL'),
        files as (select file_name, coalesce(nullif(regexp_extract(file_name, '^(.*?)-\\d{{8}}-[^-]*$', 1), ''), file_name) as feed, min(written_at) as written from raw_records where file_name is not null group by all),
        placed as (select file_name, feed, row_number() over (partition by feed order by written nulls first, file_name) as pos, count(*) over (partition by feed) as last from files),
        seen as (select *, pos - lag(pos, 1, -1) over w as gap, lead(pos) over w as next from placed join footer using (file_name) window w as (partition by feed, column_name, json_type order by pos)),
        events as (select feed, pos as shown, 'start' as event, column_name, json_type from seen where gap <> 1 and pos > 1
                   union all select feed, pos + 1, 'end', column_name, json_type from seen where next is distinct from pos + 1 and pos < last)
        select e.feed, p.file_name, e.event, e.column_name, e.json_type from events e join placed p on p.feed = e.feed and p.pos = e.shown""",
    "p5_found": f"""
        select key_field, key_value from ({_STACKED}) group by key_field, key_value
        having regexp_matches(key_value, '\\S') and count(*) * 25 >= (select count(*) from tokens)""",
    "p5_key_profile": f"""
        select key_field, key_value, count(*) as n_rows, count(*) filter (is_structural <> 0) as n_flagged,
               count(distinct original_commit_sha) as n_members
        from ({_STACKED}) group by key_field, key_value""",
}
