"""Schemas that drift between files (problem 2).

A catalogue of column lifespans: the keys and JSON types of every file's records are its footer, presence is followed through
the files of one feed with ``lag`` and islands, and the starts and endings are logged. An alias table links, feed by feed and for all feeds
together, a name outside the contract to the contract column whose lifespans end where its own start; that the two are never in one file and hold
the same values, whatever their JSON type, confirms it. The casts of the consistent table are generated from that table.

The payloads are parsed once, to hashes of their values; all the rest works on these.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.runtime import materialise

#: Shares an alias needs: of its files without the contract column, of its values known of that column, of its starts in the
#: file where that column is missing for the first time.
MIN_APART, MIN_VALUES, MIN_HANDOVER = 0.9, 0.3, 0.5
#: Where few values are known, shares of shapes (values with letters and digits replaced) and of starts that stand in for them.
#: A name of another type than the column's needs SURE_HANDOVER of its starts to be the only one in a file that lacks only that column.
MIN_SHAPES, SURE_HANDOVER = 0.9, 0.9

FEED = "^(.*?)-\\d{8}-[^-]*$"

def feed_of(file_name: Column) -> Column:
    """The part of a file name before its date; the whole name if it has none."""
    return F.when(file_name.rlike(FEED), F.regexp_extract(file_name, FEED, 1)).otherwise(file_name)


def json_type(schema: Column) -> Column:
    """Contract type name of a variant's schema text; 'void' for null, other types lower-cased without their inner types."""
    return (
        F.when(schema == "VOID", "void")
        .when(schema == "STRING", "string")
        .when(schema == "BIGINT", "bigint")
        .when(schema.isin("ARRAY<STRING>", "ARRAY<VOID>"), "array<string>")
        .otherwise(F.lower(F.regexp_extract(schema, "^[A-Z]+", 0)))
    )


def explode_fields(raw: DataFrame) -> DataFrame:
    """(file_name, column_name, json_type, value): one row per record and key; a payload that is no JSON object gives none."""
    v = raw.where("file_name is not null").selectExpr("file_name", "try_parse_json(payload) as _v").where("schema_of_variant(_v) like 'OBJECT%'")
    sql = "select file_name, key as column_name, schema_of_variant(value) as _schema, to_json(value) as value from {v}, lateral variant_explode(_v)"
    got = raw.sparkSession.sql(sql, v=v)
    return got.select("file_name", "column_name", json_type(F.col("_schema")).alias("json_type"), "value")


def cells_of(raw: DataFrame) -> DataFrame:
    """(file_name, column_name, json_type, value_hash, shape_hash, n): how often a file's column holds a value, and the value's shape.

    Values are told by their text whatever their JSON type; a shape is a text with its letters and digits replaced.
    """
    text = F.regexp_replace("value", '^"|"$', "")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "\\p{Lu}+", "A"), "\\p{Ll}+", "a"), "\\p{Nd}+", "9")
    cells = explode_fields(raw).select("file_name", "column_name", "json_type", F.xxhash64(text).alias("value_hash"), F.xxhash64(shape).alias("shape_hash"))
    return cells.groupBy("file_name", "column_name", "json_type", "value_hash", "shape_hash").agg(F.count(F.lit(1)).alias("n"))


def footers(cells: DataFrame) -> DataFrame:
    """(file_name, column_name, json_type, n): how often a file's column holds a type."""
    return cells.groupBy("file_name", "column_name", "json_type").agg(F.sum("n").alias("n"))


def file_order(raw: DataFrame) -> DataFrame:
    """(file_name, feed, file_pos): the files in the order they were written, by feed; null times come first."""
    files = raw.where("file_name is not null").groupBy("file_name").agg(F.min("written_at").alias("_at")).withColumn("feed", feed_of(F.col("file_name")))
    return files.withColumn("file_pos", F.row_number().over(Window.partitionBy("feed").orderBy("_at", "file_name"))).drop("_at")


def lifespans(order: DataFrame, footer: DataFrame) -> DataFrame:
    """(feed, column_name, json_type, starts_pos, ends_pos, n_files, at_end): the runs of consecutive files of a feed that have the column with the type.

    at_end: the run lasts to the feed's last file, so no ending was seen.
    """
    seen = order.join(footer.select("file_name", "column_name", "json_type").distinct(), "file_name")
    by = Window.partitionBy("feed", "column_name", "json_type").orderBy("file_pos")
    starts = F.when(F.col("file_pos") - F.lag("file_pos", 1, -1).over(by) == 1, 0).otherwise(1)
    runs = seen.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(by))
    last = order.groupBy("feed").agg(F.max("file_pos").alias("_last"))
    spans = runs.groupBy("feed", "column_name", "json_type", "_run").agg(F.min("file_pos").alias("starts_pos"), F.max("file_pos").alias("ends_pos"), F.count(F.lit(1)).alias("n_files"))
    return spans.join(last, "feed").withColumn("at_end", F.col("ends_pos") == F.col("_last")).drop("_run", "_last")


#: The one type that ``lifespans`` follows where only a column's presence counts.
ANY_TYPE = "any"


def handovers(spans: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feed, new_name, n_begins) and (feed, new_name, column_name, n_handed, n_alone) of ``spans``, lifespans of columns of ANY_TYPE.

    A lifespan of a name outside the contract begins unless it begins with its feed. It is handed over by the contract columns
    whose lifespans end in the file before, alone if nothing else begins or ends there.
    """
    begins = spans.where("starts_pos > 1").join(names, spans["column_name"] == names["_c"], "left_anti").select("feed", F.col("column_name").alias("new_name"), F.col("starts_pos").alias("_at"))
    ends = spans.where("not at_end").join(names, spans["column_name"] == names["_c"], "left_semi").select("feed", "column_name", (F.col("ends_pos") + 1).alias("_at"))
    alone = begins.groupBy("feed", "_at").agg(F.count(F.lit(1)).alias("_b")).join(ends.groupBy("feed", "_at").agg(F.count(F.lit(1)).alias("_e")), ["feed", "_at"])
    alone = alone.select("feed", "_at", ((F.col("_b") == 1) & (F.col("_e") == 1)).cast("int").alias("_alone"))
    handed = begins.join(ends, ["feed", "_at"]).join(alone, ["feed", "_at"]).groupBy("feed", "new_name", "column_name").agg(F.count(F.lit(1)).alias("n_handed"), F.sum("_alone").alias("n_alone"))
    return begins.groupBy("feed", "new_name").agg(F.count(F.lit(1)).alias("n_begins")), handed


#: The feed of evidence from all feeds together.
EVERY_FEED = "*"


def aliases(order: DataFrame, footer: DataFrame, spans: DataFrame, cells: DataFrame, contract: DataFrame) -> DataFrame:
    """(feed, new_name, column_name, apart, known, alike, handover): names outside the contract that hold a contract column's content in a feed.

    The evidence is a feed's own, and that of all under EVERY_FEED; the known values of a contract column are always
    those of all feeds. A feed has few lifespans, so there the known values must confirm what they say; shapes and types alone may
    only over all feeds. Of several contract columns that a name could stand for, the one with the most known values wins, then
    the least name.
    """
    names = contract.select(F.col("column_name").alias("_c"), "column_type").where("_c is not null").distinct()
    only = names.select("_c").distinct()
    new, key = ["feed", "new_name"], ["feed", "new_name", "column_name"]
    n_begins, handed = handovers(spans, only)
    scope = F.explode(F.array("feed", F.lit(EVERY_FEED))).alias("feed")
    order = order.select("file_name", scope)
    n_begins = n_begins.select(scope, "new_name", "n_begins").groupBy(*new).agg(F.sum("n_begins").alias("n_begins"))
    handed = handed.select(scope, "new_name", "column_name", "n_handed", "n_alone").groupBy(*key).agg(F.sum("n_handed").alias("n_handed"), F.sum("n_alone").alias("n_alone"))
    cols = order.join(footer.select("file_name", "column_name").distinct(), "file_name").select("feed", "file_name", "column_name")
    outside = lambda df: df.join(only, df["column_name"] == only["_c"], "left_anti").withColumnRenamed("column_name", "new_name")
    inside = lambda df: df.join(only, df["column_name"] == only["_c"], "left_semi")
    strange = outside(cols)
    n_files = strange.groupBy(*new).agg(F.count(F.lit(1)).alias("n_files"))
    together = strange.join(inside(cols), ["feed", "file_name"]).groupBy(*key).agg(F.count(F.lit(1)).alias("n_together"))
    held = cells.where("json_type <> 'void'").join(order.select("file_name", "feed"), "file_name")

    def common(what: str, n_all: str, n_common: str) -> tuple[DataFrame, DataFrame]:
        mine = outside(held.select("feed", "column_name", what).distinct())
        theirs = inside(held.select("column_name", what).distinct())
        return mine.groupBy(*new).agg(F.count(F.lit(1)).alias(n_all)), mine.join(theirs, what).groupBy(*key).agg(F.count(F.lit(1)).alias(n_common))

    n_values, shared = common("value_hash", "n_values", "n_shared")
    n_shapes, alike = common("shape_hash", "n_shapes", "n_alike")
    types = outside(held.select("feed", "column_name", "json_type").distinct()).groupBy(*new).agg(F.collect_set("json_type").alias("_types"))
    wanted = names.select(F.col("_c").alias("column_name"), "column_type").groupBy("column_name").agg(F.collect_set("column_type").alias("_wanted"))
    both = alike.select(*key).union(handed.select(*key)).distinct()
    for df, by in ((n_files, new), (n_values, new), (n_shapes, new), (types, new), (wanted, ["column_name"])):
        both = both.join(df, by)
    for df, by in ((alike, key), (shared, key), (together, key), (n_begins, new), (handed, key)):
        both = both.join(df, by, "left")
    # Retyped: the name never holds the column's contract type.
    retyped = ~F.arrays_overlap("_types", "_wanted") & (F.col("n_begins") > 0) & (F.coalesce("n_alone", F.lit(0)) >= SURE_HANDOVER * F.col("n_begins"))
    scored = both.select(
        *key, (1 - F.coalesce("n_together", F.lit(0)) / F.col("n_files")).alias("apart"), (F.coalesce("n_shared", F.lit(0)) / F.col("n_values")).alias("known"),
        (F.coalesce("n_alike", F.lit(0)) / F.col("n_shapes")).alias("alike"), F.when(F.col("n_begins") > 0, F.coalesce("n_handed", F.lit(0)) / F.col("n_begins")).alias("handover"), retyped.alias("_retyped"),
    )
    by_values = (F.col("known") >= MIN_VALUES) & (F.coalesce("handover", F.lit(1.0)) >= MIN_HANDOVER)
    by_shapes = (F.col("alike") >= MIN_SHAPES) & (F.col("handover") >= SURE_HANDOVER)
    sure = F.when(F.col("feed") == EVERY_FEED, F.coalesce("_retyped", F.lit(False)) | by_values | by_shapes).otherwise(by_values & F.col("handover").isNotNull())
    scored = scored.where((F.col("apart") >= MIN_APART) & sure)
    best = Window.partitionBy(*new).orderBy(F.col("known").desc(), F.col("handover").desc(), "column_name")
    return scored.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank", "_retyped")


def catalogue(raw: DataFrame, contract: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The file order, the footers, the alias table and the renames (file_name, column_name, new_name) of ``raw``."""
    cells = materialise(cells_of(raw), "cells")
    footer = materialise(footers(cells), "footers")
    order = materialise(file_order(raw), "file-order")
    spans = materialise(lifespans(order, footer.select("file_name", "column_name", F.lit(ANY_TYPE).alias("json_type")).distinct()), "lifespans")
    alias = materialise(aliases(order, footer, spans, cells, contract), "aliases")
    return order, footer, alias, materialise(renames(order, footer, alias), "renames")


def renames(order: DataFrame, footer: DataFrame, alias: DataFrame) -> DataFrame:
    """(file_name, column_name, new_name): by file, the contract columns it lacks whose alias it has.

    Of its feed's own evidence and that of all feeds, the one with more known values says what a name stands for, the latter
    among equals; of two names for one column the one with more known values, then the lesser name.
    """
    cols = footer.select("file_name", "column_name").distinct()
    there = cols.withColumnRenamed("column_name", "new_name").join(order.select("file_name", "feed"), "file_name")
    got = there.join(alias, ["feed", "new_name"]).unionByName(there.withColumn("feed", F.lit(EVERY_FEED)).join(alias, ["feed", "new_name"]))
    meant = Window.partitionBy("file_name", "new_name").orderBy(F.col("known").desc(), "feed")
    got = got.withColumn("_rank", F.row_number().over(meant)).where("_rank = 1").drop("_rank")
    free = got.join(cols, ["file_name", "column_name"], "left_anti")
    best = Window.partitionBy("file_name", "column_name").orderBy(F.col("known").desc(), "new_name")
    return free.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").select("file_name", "column_name", "new_name")


def differences(raw: DataFrame, contract: DataFrame) -> DataFrame:
    """(file_name, kind, column_name, new_name): every difference of each file from the contract.

    'renamed': the column's content stands under new_name; 'removed': the column is absent and not renamed; 'added': a column
    outside the contract that isn't the new name of one; 'retyped': a non-null value has another JSON type than the contract's.
    Repeated and late records change nothing. A file none of whose payloads is a JSON object lacks every column. Records
    without file name belong to no file and are left out; a repeated contract column counts once.
    """
    order, footer, _, renamed = catalogue(raw, contract)
    names = contract.select("column_name", "column_type").where("column_name is not null").distinct()
    cols = footer.select("file_name", "column_name").distinct()
    wanted = sorted(r[0] for r in names.select("column_name").distinct().collect())  # a schema, not data
    expected = order.select("file_name", F.explode(F.array(*[F.lit(c) for c in wanted])).alias("column_name"))
    removed = expected.join(cols, ["file_name", "column_name"], "left_anti").join(renamed, ["file_name", "column_name"], "left_anti")
    added = cols.join(names, "column_name", "left_anti").join(renamed.select("file_name", F.col("new_name").alias("column_name")), ["file_name", "column_name"], "left_anti")
    retyped = footer.join(names, "column_name").where((F.col("json_type") != "void") & (F.col("json_type") != F.col("column_type"))).select("file_name", "column_name").distinct()
    parts = [renamed.select("file_name", F.lit("renamed").alias("kind"), "column_name", "new_name")]
    parts += [x.select("file_name", F.lit(kind).alias("kind"), "column_name", F.lit("").alias("new_name")) for kind, x in (("removed", removed), ("added", added), ("retyped", retyped))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def change_log(raw: DataFrame, contract: DataFrame) -> DataFrame:
    """(feed, file_name, event, column_name, json_type): every start and ending of a column's type within a feed, with the file in which it shows.

    A run that begins with the feed or lasts to its end has no such event.
    """
    order, footer, _, _ = catalogue(raw, contract)
    spans = lifespans(order, footer.where("json_type <> 'void'"))
    starts = spans.where("starts_pos > 1").select("feed", F.col("starts_pos").alias("file_pos"), F.lit("start").alias("event"), "column_name", "json_type")
    ends = spans.where("not at_end").select("feed", (F.col("ends_pos") + 1).alias("file_pos"), F.lit("end").alias("event"), "column_name", "json_type")
    return starts.unionByName(ends).join(order, ["feed", "file_pos"]).select("feed", "file_name", "event", "column_name", "json_type")


class ListForm(NamedTuple):
    """How the parts of a list make one string, where a file holds a list in place of a string."""

    join: str = ";"
    prefix: str = ""
    suffix: str = ""


def _cast(wanted: str, form: ListForm, kind: Column, value: Column) -> Column:
    """``value`` (JSON text of type ``kind``) as the contract's type; null where it can't be."""
    text = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    if wanted == "bigint":
        return F.when(kind == "boolean", F.when(text == "true", 1).otherwise(0)).otherwise(text.try_cast("bigint"))
    items = F.from_json(value, "array<string>")
    if wanted == "array<string>":
        return F.when(kind == "array<string>", items).when(kind == "string", F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ";")))
    joined = F.concat(F.lit(form.prefix), F.array_join(items, form.join), F.lit(form.suffix))
    return F.when(kind.startswith("array"), joined).when(kind == "object", F.coalesce(F.get_json_object(value, "$.name"), value)).otherwise(text)


def consistent(raw: DataFrame, contract: DataFrame, list_forms: dict[str, ListForm] | None = None) -> DataFrame:
    """One row per record_id with the contract's columns in contract order: renamed columns under their contract name, other types cast.

    Repeated records come out once. A column that a record lacks, a null, or a value without a cast to the contract's type is
    null; a payload that is no JSON object gives a row of nulls. ``list_forms`` says by column how a list makes a string, where ';'
    between its parts isn't it. ``contract`` must have few columns: it is the schema.
    """
    _, _, _, renamed = catalogue(raw, contract)
    forms = list_forms or {}
    schema = [(r[0], r[1]) for r in contract.orderBy("column_pos").select("column_name", "column_type").collect()]  # a schema, not data
    own = F.when(F.col("record_id").isNull(), F.xxhash64("file_name", "line_no", "payload"))  # rows without an id stay apart
    one = raw.groupBy("record_id", own.alias("_own")).agg(F.min(F.struct("file_name", "payload")).alias("_r")).select("record_id", "_r.*")
    maps = renamed.groupBy(F.col("file_name").alias("_file")).agg(F.map_from_entries(F.collect_list(F.struct("column_name", "new_name"))).alias("_names"))  # a schema a file
    rows = one.join(maps, one["file_name"] == maps["_file"], "left").withColumn("_s", F.expr("try_parse_json(payload)"))
    rows = rows.withColumn("_types", F.expr("transform_values(cast(_s as map<string,variant>), (k, x) -> schema_of_variant(x))")).withColumn("_json", F.expr("transform_values(cast(_s as map<string,variant>), (k, x) -> to_json(x))"))
    out = []
    for name, wanted in schema:
        key = F.coalesce(F.try_element_at("_names", F.lit(name)), F.lit(name))
        kind = json_type(F.try_element_at("_types", key))
        out.append(_cast(wanted, forms.get(name, ListForm()), kind, F.try_element_at("_json", key)).alias(name))
    return rows.select("record_id", *out)
