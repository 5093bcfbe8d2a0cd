"""Mixed timestamp forms and zones, normalised to one UTC instant (problem 1).

Distinct-value dictionary: the raw strings are reduced to distinct (source, text, zone) entries with a map-side combine, each is
parsed exactly once with built-in expressions, the parsed entries are appended to a stored dictionary, and the instants are
joined back to the rows. A later call with the same dictionary parses only what it has not seen.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.runtime import scratch_path, shared_dir, spread

DAY = 86_400_000_000

# English month names as commits write them.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_MON = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
_DOW = "(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\\s+)?"
_CLOCK = "(\\d{1,2}):(\\d{2})(?::(\\d{2})(?:[.,](\\d+))?)?"
_MERIDIEM = "(?:\\s*([AP]M)\\b)?"
_ZONE = "\\s*(Z|[+-]\\d{2}(?::?\\d{2})?|[A-Za-z]{1,5}|[A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+)?(?:\\[[^\\]]*\\])?"

#: Every accepted form: a regular expression and the group numbers of year, month, day, hour, minute, second, fraction,
#: AM/PM and zone (0: the form has no such part).
FORMS: dict[str, tuple[str, tuple[int, ...]]] = {
    "iso": (f"(?i)^(\\d{{4}})-(\\d{{1,2}})-(\\d{{1,2}})(?:[T\\s]\\s*{_CLOCK}{_MERIDIEM}{_ZONE})?$", (1, 2, 3, 4, 5, 6, 7, 8, 9)),
    "slash": (f"(?i)^(\\d{{4}})/(\\d{{1,2}})/(\\d{{1,2}})(?:[T\\s]\\s*{_CLOCK}{_MERIDIEM}{_ZONE})?$", (1, 2, 3, 4, 5, 6, 7, 8, 9)),
    "dotted": (f"(?i)^(\\d{{1,2}})\\.(\\d{{1,2}})\\.(\\d{{4}})(?:[T\\s]\\s*{_CLOCK}{_MERIDIEM}{_ZONE})?$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "basic": (f"(?i)^(\\d{{4}})(\\d{{2}})(\\d{{2}})T(\\d{{2}})(\\d{{2}})(?:(\\d{{2}})(?:[.,](\\d+))?)?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "git": (f"(?i)^{_DOW}{_MON}\\s+(\\d{{1,2}})\\s+{_CLOCK}\\s+(\\d{{4}}){_ZONE}$", (7, 1, 2, 3, 4, 5, 6, 0, 8)),
    "mail": (f"(?i)^{_DOW}(\\d{{1,2}})\\s+{_MON}\\s+(\\d{{4}})\\s+{_CLOCK}{_MERIDIEM}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "us": (f"(?i)^{_DOW}{_MON}\\s+(\\d{{1,2}}),\\s*(\\d{{4}}),?\\s+{_CLOCK}{_MERIDIEM}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
}
#: Unix time: seconds, milliseconds, microseconds or nanoseconds by the number of digits, with or without '@' and an offset.
EPOCH = "^@?(-?\\d{9,10}|\\d{13}|\\d{16}|\\d{19})(?:\\s+[+-]\\d{4})?$"
CANONICAL = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}\\.\\d{6}Z$"

INVALID, SKIPPED, AMBIGUOUS = "invalid", "skipped", "ambiguous"



def _number(c: Column, default: int) -> Column:
    return F.when(c == "", F.lit(default)).otherwise(c.try_cast("bigint"))


def _month(c: Column) -> Column:
    by_name = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i).cast("bigint"))])
    return F.coalesce(c.try_cast("bigint"), F.try_element_at(by_name, F.lower(F.substring(c, 1, 3))))


PARTS = ("year", "month", "day", "hour", "minute", "second", "fraction", "meridiem", "zone")


def _fields(text: Column) -> Column:
    """The PARTS of ``text`` by the first form it has, as an array of texts; null if it has none.

    One match and one rewrite a form, not one an extracted part: the generated code stays small enough to be compiled.
    """
    out = F.lit(None)
    for pattern, groups in reversed(FORMS.values()):
        out = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, ";".join(f"${g}" if g else "" for g in groups))).otherwise(out)
    return F.split(out, ";", -1)


def _offset_micros(zone: Column, meant: Column) -> Column:
    """Micros east of UTC of a 'Z', a numeric offset or an abbreviation that means ``meant`` minutes; null for anything else."""
    numeric = "^([+-])(\\d{2}):?(\\d{2})?$"
    sign = F.when(F.regexp_extract(zone, numeric, 1) == "-", -1).otherwise(1)
    minutes = _number(F.regexp_extract(zone, numeric, 2), 0) * 60 + _number(F.regexp_extract(zone, numeric, 3), 0)
    return F.when(F.upper(zone) == "Z", F.lit(0).cast("bigint")).when(zone.rlike(numeric), sign * minutes).otherwise(meant) * 60_000_000


def _shift(micros: Column, zone: Column) -> Column:
    """The wall-clock micros in ``zone`` of an instant."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(micros), zone))


def instant_text(micros: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SS.ffffffZ of an instant, whatever the session's time zone."""
    day, rest = F.floor(micros / DAY).cast("int"), F.pmod(micros, F.lit(DAY).cast("bigint"))

    def digits(unit: int, modulus: int, width: int) -> Column:
        return F.lpad((F.floor(rest / unit) % modulus).cast("bigint").cast("string"), width, "0")

    hms = F.concat_ws(":", digits(3_600_000_000, 24, 2), digits(60_000_000, 60, 2), digits(1_000_000, 60, 2))
    return F.concat(F.date_from_unix_date(day).cast("string"), F.lit("T"), hms, F.lit("."), digits(1, 1_000_000, 6), F.lit("Z"))


def parse(pairs: DataFrame, abbrevs: DataFrame) -> DataFrame:
    """Columns utc_micros and utc_text for rows of (text, zone).

    utc_text is the instant as YYYY-MM-DDTHH:MM:SS.ffffffZ, or 'invalid' (the text is no date and time, its parts don't
    exist, or it names no zone and ``zone`` is null or unknown), 'skipped' or 'ambiguous' (a wall-clock time that its zone's
    clock jumped over or showed twice). A numeric offset wins over any other zone in the text; an abbreviation means what
    ``abbrevs`` (abbrev, offset_minutes) says, the least offset if it is listed twice; a text without zone is wall-clock time
    of ``zone``. Missing parts are zero, digits past microseconds are cut. A null text gives null.
    """
    spark = pairs.sparkSession
    meant = abbrevs.groupBy(F.upper(F.trim("abbrev")).alias("_abbrev")).agg(F.min(F.col("offset_minutes").cast("bigint")).alias("_minutes")).where("_abbrev is not null")
    # from_utc_timestamp fails on a name it doesn't know, so a name counts only if the zone database has it (some 600 names).
    names = F.broadcast(spark.createDataFrame([(z.lower(), z) for z in zone_names()], "_lower string, _zone string"))
    df = pairs.withColumn("_t", F.regexp_replace("text", "^\\s+|\\s+$", "")).withColumn("_f", _fields(F.col("_t")))
    text = {k: F.col("_f")[i] for i, k in enumerate(PARTS)}
    micros = F.rpad(F.substring(text["fraction"], 1, 6), 6, "0").try_cast("bigint")
    whole = {k: _number(text[k], 0) for k in ("hour", "minute", "second")} | {k: text[k].try_cast("bigint") for k in ("year", "day")}
    df = df.select("*", *[c.alias(f"_{k}") for k, c in (whole | {"month": _month(text["month"]), "micros": micros, "meridiem": F.upper(text["meridiem"]), "said": text["zone"]}).items()])
    p = {k: F.col(f"_{k}") for k in ("year", "month", "day", "hour", "minute", "second", "micros", "meridiem")} | {"zone": F.col("_said")}
    hour = F.when(p["meridiem"] == "", p["hour"]).otherwise(F.when(p["hour"].between(1, 12), p["hour"] % 12 + F.when(p["meridiem"] == "PM", 12).otherwise(0)))
    date = F.expr("try_make_timestamp_ntz(cast(_year as int), cast(_month as int), cast(_day as int), 0, 0, cast(0 as decimal(16,6)))").cast("date")
    ok = hour.between(0, 23) & p["minute"].between(0, 59) & p["second"].between(0, 59)
    wall = F.when(ok, F.unix_date(date).cast("bigint") * DAY + ((hour * 60 + p["minute"]) * 60 + p["second"]) * 1_000_000 + p["micros"])
    df = df.withColumns({"_wall": wall, "_upper": F.upper(p["zone"]), "_name": F.lower(F.when(p["zone"] == "", F.col("zone")).otherwise(p["zone"]))})
    df = df.join(meant, F.col("_upper") == F.col("_abbrev"), "left").join(names, F.col("_name") == F.col("_lower"), "left")
    df = df.withColumn("_off", _offset_micros(p["zone"], F.col("_minutes")))
    # Each side of a change of the clock gives a candidate; the wall-clock time is real if it maps back to itself.
    w, z, a, b = (F.col(c) for c in ("_wall", "_zone", "_a", "_b"))
    df = df.withColumns({n: w - (_shift(w + d, z) - (w + d)) for n, d in (("_a", -DAY), ("_b", DAY))})
    a_ok, b_ok = _shift(a, z) == w, _shift(b, z) == w
    df = df.withColumn("_seen", F.when(a_ok & b_ok & (a != b), F.lit(2)).when(a_ok | b_ok, 1).otherwise(0))
    digits = F.regexp_extract("_t", EPOCH, 1)
    n, size = digits.try_cast("bigint"), F.length(F.regexp_replace(digits, "-", ""))
    unix = F.when(size <= 10, n * 1_000_000).when(size == 13, n * 1_000).when(size == 16, n).when(size == 19, F.floor(n / 1000).cast("bigint"))
    local = F.when(F.col("_off").isNotNull(), w - F.col("_off")).when(F.col("_seen") == 1, F.when(a_ok, a).otherwise(b))
    df = df.withColumn("utc_micros", F.when(digits != "", unix).otherwise(local))
    why = F.when(w.isNull() | z.isNull(), INVALID).when(F.col("_seen") == 2, AMBIGUOUS).otherwise(SKIPPED)
    out = F.when(F.col("text").isNotNull(), F.coalesce(instant_text(F.col("utc_micros")), why))
    return df.select(*pairs.columns, "utc_micros", out.alias("utc_text"))


def zone_names() -> list[str]:
    """The region names of the zone database, UTC and GMT."""
    return sorted({z for z in available_timezones() if "/" in z and not z.startswith(("posix/", "right/"))} | {"UTC", "GMT"})


class TimestampDictionary:
    """A stored dictionary (source, text, zone) -> (utc_micros, utc_text), grown by what it has not seen.

    An entry depends on nothing but its key and the abbreviations, so a dictionary serves any data that these are meant for. Two
    learners at once may both append an entry; it is read once.
    """

    KEY = ("source", "text", "zone")

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "timestamps")

    def entries(self) -> DataFrame | None:
        """The dictionary, each entry once; None before anything was learned."""
        try:
            return self.spark.read.parquet(self.path).groupBy(*self.KEY).agg(F.first("utc_micros").alias("utc_micros"), F.first("utc_text").alias("utc_text"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def learn(self, found: DataFrame, abbrevs: DataFrame) -> DataFrame:
        """Parse and append the distinct entries of ``found`` (source, text, zone) that the dictionary lacks; return the whole dictionary."""
        new = found.select(*self.KEY).where("text is not null").distinct()
        if (old := self.entries()) is not None:
            same = [new[c].eqNullSafe(old[c]) for c in self.KEY]
            new = new.join(old.select(*self.KEY), same[0] & same[1] & same[2], "left_anti")
        parse(spread(new), abbrevs).write.mode("append").option("compression", "zstd").parquet(self.path)
        return self.entries()


def dictionary_path(spark, abbrevs: DataFrame) -> str:
    """Where the dictionary for these abbreviations lies in the shared folder, for every session that uses it."""
    meant = abbrevs.select(F.sum(F.xxhash64(F.upper(F.trim("abbrev")), F.col("offset_minutes").cast("bigint")).cast("decimal(38,0)"))).first()[0]
    return f"{shared_dir(spark)}/strataloom/timestamp-dictionary/{int(meant or 0) % (1 << 64):016x}"


def normalise(rows: DataFrame, fields: list[str], clocks: DataFrame, abbrevs: DataFrame, source: str = "repo_name", path: str | None = None) -> DataFrame:
    """``rows`` with <field>_utc for each of ``fields``: the instant's text, or 'skipped', 'ambiguous' or 'invalid'.

    ``clocks`` (repo_name, tz_name) has one row per source at most; a repeated source keeps its least tz_name. A null field
    gives null, a blank one 'invalid', a source without clock makes its zoneless texts 'invalid'. Repeated rows stay; other
    columns pass through, also those named text or zone.
    """
    spark = rows.sparkSession
    clock = clocks.groupBy(F.col("repo_name").alias("_source")).agg(F.min("tz_name").alias("_clock")).where("_source is not null")
    rows = rows.join(clock, rows[source] == clock["_source"], "left").drop("_source")
    found = rows.select(F.col(f"`{source}`").alias("source"), F.explode(F.array(*[F.col(f"`{f}`") for f in fields])).alias("text"), F.col("_clock").alias("zone"))
    entries = TimestampDictionary(spark, path).learn(found, abbrevs)
    for f in fields:
        d = entries.select(F.col("source").alias("_source"), F.col("text").alias("_text"), F.col("zone").alias("_zone"), F.col("utc_text").alias(f"{f}_utc"))
        rows = rows.join(d, rows[source].eqNullSafe(d["_source"]) & (rows[f] == d["_text"]) & rows["_clock"].eqNullSafe(d["_zone"]), "left").drop("_source", "_text", "_zone")
    return rows.drop("_clock")


def commit_instants(tokens: DataFrame, clocks: DataFrame, abbrevs: DataFrame, path: str | None = None) -> DataFrame:
    """(original_commit_sha, field, utc_text): one row per commit and date field whose text isn't null, '' or canonical already."""
    fields = ["author_date", "committer_date"]
    commits = tokens.select("repo_name", "original_commit_sha", *fields).distinct()
    stacked = commits.select("repo_name", "original_commit_sha", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("x")).select("repo_name", "original_commit_sha", "x.field", F.col("x.text").alias("text"))
    todo = stacked.where((F.col("text") != "") & ~F.col("text").rlike(CANONICAL)).where("original_commit_sha is not null")
    return normalise(todo, ["text"], clocks, abbrevs, path=path).select("original_commit_sha", "field", F.col("text_utc").alias("utc_text")).distinct()
