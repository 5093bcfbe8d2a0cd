"""Per-key results where a few keys hold most rows (problem 5).

Every result here is algebraic: a scan task folds its rows into a hash table of key states (Spark's partial aggregation, which
falls back to sorting and spills when the table outgrows its memory), and only those compact states are shuffled. A key that
holds a third of all rows therefore arrives as at most one state a task, not as its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.runtime import materialise

#: Fixed value: a key is heavy from 1/25 of all rows on.
HEAVY_ONE_IN = 25


def unpivot_keys(df: DataFrame, fields: list[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """(key_field, key_value, carried columns): one row per input row and field, in one scan. Null keys stay."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("key_field"), F.col(f"`{f}`").cast("string").alias("key_value")) for f in fields]))
    carried = [c.alias(n) for n, c in (carry or {}).items()]
    return df.select(pairs.alias("_key"), *carried).select("_key.key_field", "_key.key_value", *(carry or {}))


def key_counts(df: DataFrame, fields: list[str]) -> DataFrame:
    """(key_field, key_value, n_rows) of every value of every field, null and blank ones too."""
    return unpivot_keys(df, fields).groupBy("key_field", "key_value").agg(F.count(F.lit(1)).alias("n_rows"))


def heavy_keys(df: DataFrame, fields: list[str], one_in: int = HEAVY_ONE_IN) -> DataFrame:
    """(key_field, key_value, n_rows, n_all) of the values, neither null nor blank, that hold at least 1/one_in of all rows.

    Repeated rows count. A value is taken as stored: ' a' and 'a' are two keys. An empty table has no heavy key; ties all
    come out. The counts are written, so that the totals come from them and the table is scanned once.
    """
    counts = materialise(key_counts(df, fields), "key-counts")
    total = counts.groupBy(F.col("key_field").alias("_field")).agg(F.sum("n_rows").alias("n_all"))
    heavy = counts.join(F.broadcast(total), counts["key_field"] == total["_field"]).drop("_field")  # one row per field
    return heavy.where((F.trim("key_value") != "") & F.col("key_value").rlike("\\S") & (F.col("n_rows") * one_in >= F.col("n_all")))


def key_profile(df: DataFrame, fields: list[str], flag: str, member: str) -> DataFrame:
    """(key_field, key_value, n_rows, n_flagged, n_members): rows, rows with ``flag`` <> 0 and distinct non-null ``member`` by key.

    The distinct count goes by (key, member) first, so the members of a heavy key spread over all tasks; the second step only
    adds up one state per key and task. Null keys form one group per field; a null flag isn't flagged.
    """
    rows = unpivot_keys(df, fields, {"_flag": F.col(f"`{flag}`"), "_member": F.col(f"`{member}`")})
    by_member = rows.groupBy("key_field", "key_value", "_member").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_flag") != 0).alias("_f"))
    return by_member.groupBy("key_field", "key_value").agg(
        F.sum("_n").alias("n_rows"), F.sum("_f").alias("n_flagged"), F.count("_member").alias("n_members")
    )
