"""Scalar functions as native Spark expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SHA = "^[0-9a-f]{40}$"
TRUE_WORDS = ("1", "true", "yes")
HOME = "github.com"
UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")


def blank_to(c: Column, default: Column | str) -> Column:
    """``c``, or ``default`` where it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), default if isinstance(default, Column) else F.lit(default))


def strip(c: Column) -> Column:
    """``c`` without white space of any kind around it."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def u_of(slug: Column, salt: str) -> Column:
    """The first 53 bits of sha256(salt + slug) as a fraction of 2**53: a permanent random number in [0, 1)."""
    head = F.conv(F.substring(F.sha2(F.concat(F.lit(salt), slug), 256), 1, 14), 16, 10).cast("bigint")
    return F.shiftright(head, 3) / F.lit(float(2**53))


def is_sha(c: Column) -> Column:
    return c.rlike(SHA)


def included(c: Column) -> Column:
    """Whether a cell says yes; null says no."""
    return F.coalesce(F.lower(strip(c)).isin(*TRUE_WORDS), F.lit(False))


def slug_parts(slug: Column) -> Column:
    return F.filter(F.split(slug, "/"), lambda x: x != "")


def project_name(host: Column, slug: Column) -> Column:
    """owner__repo at home, host__owner__repo elsewhere; null where that is no plain directory name or the slug is too short."""
    parts, away = slug_parts(slug), host != HOME
    name = F.array_join(F.when(away, F.concat(F.array(host), parts)).otherwise(parts), "__")
    enough = F.size(parts) >= F.when(away, 1).otherwise(2)
    return F.when(enough & name.rlike("^[A-Za-z0-9._-]+$") & ~name.contains(".."), name)


def owner_of(slug: Column, host: Column) -> Column:
    """What stands before the last slash, or the host."""
    return blank_to(F.regexp_extract(slug, "^(.*)/[^/]*$", 1), host)


def repo_of(slug: Column) -> Column:
    return F.substring_index(slug, "/", -1)


def commit_url(url: Column) -> Column:
    """The address under which a repository's commits stand."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, "\\.git$", ""), "/+$", ""), F.lit("/commit/"))


def size_to_bytes(text: Column) -> Column:
    """Bytes of a size like '3GB' or '1.5 KiB' (units of 1024); null for anything else, percentages included."""
    pattern = "^(\\d+(?:\\.\\d+)?) ?([KMGT]?)(I?B)?$"
    t = F.upper(F.trim(text))
    unit, tail = F.regexp_extract(t, pattern, 2), F.regexp_extract(t, pattern, 3)
    power = F.instr(F.lit("KMGT"), unit)
    valid = t.rlike(pattern) & ((unit != "") | (tail == "B"))
    return F.when(valid, F.floor(F.regexp_extract(t, pattern, 1).try_cast("double") * F.pow(F.lit(1024.0), F.when(unit == "", 0).otherwise(power))).cast("bigint"))


def human(n: Column) -> Column:
    """Bytes for a reader: '17 B', '1.2 KiB'. Ties round to even."""
    x = n.cast("double")
    scaled = [x / float(1024**i) for i in range(len(UNITS))]
    text = [F.format_string(f"%.0f {UNITS[0]}", F.bround(x, 0))] + [F.format_string(f"%.1f {u}", F.bround(s, 1)) for s, u in zip(scaled[1:], UNITS[1:])]
    return F.when(x.isNotNull(), reduce(lambda rest, i: F.when(scaled[i] < 1024, text[i]).otherwise(rest), range(len(UNITS) - 2, -1, -1), text[-1]))


def iso_seconds(ts: Column) -> Column:
    """A timestamp as ISO text in seconds with its offset; UTC in a session that runs in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def percent(done: Column, total: Column) -> Column:
    """Whole percent, 0 of nothing."""
    return F.when(total > 0, F.floor(done * 100 / total)).otherwise(0).cast("bigint")


def bar(done: Column, total: Column, width: int = 20) -> Column:
    """A progress bar of ``width`` characters."""
    full = F.when(total > 0, F.bround(done * width / total, 0)).otherwise(0).cast("int")
    return F.concat(F.repeat(F.lit("#"), full), F.repeat(F.lit("."), F.lit(width) - full))


def key_values(text: Column) -> Column:
    """A map of the 'key=value' lines of a text; of a repeated key the last."""
    lines = F.filter(F.split(text, "\r?\n"), lambda x: x.contains("="))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_extract(x, "^[^=]*=(.*)$", 1).alias("value")))
    return F.aggregate(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["key"]), F.create_map(p["key"], p["value"])))


def no_field_breaks(c: Column) -> Column:
    """Whether a value can stand in one field of a tab-separated line."""
    return ~F.coalesce(c.rlike("[\\t\\r\\n]"), F.lit(False))


def safe_name(c: Column) -> Column:
    """Whether a name is one path component that stays where it is put."""
    return F.coalesce((c != "") & ~c.contains("/") & ~c.contains(".."), F.lit(False))


def whole_flag(text: Column, flag: str) -> Column:
    """Whether a text names ``flag`` whole: '--mask' isn't in '--mask-widened'."""
    return F.coalesce(text.rlike("(?<![\\w-])" + re.escape(flag) + "(?![\\w-])"), F.lit(False))


def first_few(items: Column, n: int, sep: str = "; ") -> Column:
    """The first ``n`` of an array of messages as one text."""
    return F.array_join(F.slice(items, 1, n), sep)


def rounded(seconds: Column, unit: str) -> Column:
    """A duration as logs write it: 's' whole seconds, 'ms' seconds with three decimals, 'min' minutes with one; ties to even."""
    forms = {"s": F.bround(seconds, 0).cast("bigint").cast("string"), "ms": F.format_string("%.3f", F.bround(seconds, 3)), "min": F.format_string("%.1f", F.bround(seconds / 60, 1))}
    return F.when(seconds.isNotNull(), forms[unit])
