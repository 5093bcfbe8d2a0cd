"""Queries of the problems tagged llm and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import encode, firms, handwritten, mixing, mojibake, names, spans
from strataloom.runtime import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(table(spark, sf_dir, "tokens"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_sources(spark, sf_dir).select("repo_name", "file_path")


def p4_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handwritten.not_handwritten(table(spark, sf_dir, "tokens"), table(spark, sf_dir, "upstream_files"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return firms.canonical_firms(*[table(spark, sf_dir, n) for n in ("firm_canonical", "tokens", "domain_map", "firm_list")])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restore_tokens(table(spark, sf_dir, "tokens"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.full_mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.even_mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_pairs(table(spark, sf_dir, "documents"))


def p10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.repeat_classes(table(spark, sf_dir, "documents"))


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p4_found, p4_sources, p6_found, p7_found, p8_ids, p9_mix, p9_full, p9_even, p9_shares, p10_found, p10_repeats, p10_shared)}

_WINDOWS = f"""
    with d as (select distinct doc_id, text from documents where length(text) >= {spans.SPAN} and doc_id is not null),
    w as (select doc_id, i, substr(text, i, {spans.SPAN}) as run from d, unnest(range(1, length(text) - {spans.SPAN - 2})) as t(i))"""
#: Every run of a span's length of every document; for the small tables that the comparison with SQL is made on.
ORACLE: dict[str, str] = {
    "p10_found": f"""{_WINDOWS}, one as (select distinct doc_id, run from w)
        select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from one a join one b on a.run = b.run and a.doc_id < b.doc_id""",
    "p10_shared": f"""{_WINDOWS}, shared as (select run from w group by run having min(doc_id) < max(doc_id)),
        starts as (select doc_id, i, lead(i) over (partition by doc_id order by i) as next from w where run in (select run from shared)),
        covered as (select doc_id, cast(sum(least({spans.SPAN}, coalesce(next - i, {spans.SPAN}))) as bigint) as n from starts group by 1)
        select doc_id, length(text) as n_chars, case when text is not null then coalesce(n, 0) end as n_shared from documents left join covered using (doc_id)""",
}
