"""Writers: one file put in place atomically, stamps, append-only logs, tables replaced or upserted by key."""

from __future__ import annotations

import fcntl
import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(path: str, text: str) -> None:
    """A whole text file, put in place by a rename."""
    target = Path(path)
    part = target.with_name(f".{target.name}.part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, target)


def write_single_parquet(df: DataFrame, path: str, order: list[str]) -> None:
    """``df`` in the given order as one ZSTD file at ``path``. What stands there stays untouched until the new file is whole.

    One task writes the file: for one project's data, many projects go in parallel.
    """
    target = Path(path)
    part = target.with_name(f".{target.name}.part")
    shutil.rmtree(part, ignore_errors=True)
    try:
        df.repartition(1).sortWithinPartitions(*order).drop(*[c for c in order if c.startswith("_")]).write.option("compression", "zstd").parquet(str(part))
        (written,) = part.glob("part-*.parquet")
        os.replace(written, target)
    finally:
        shutil.rmtree(part, ignore_errors=True)


def write_stamp(path: str, rows: int, size: int) -> None:
    write_text(path, f"rows={rows}\nbytes={size}\n")


def append_rows(path: str, rows: list[dict]) -> None:
    """Appends JSON lines to a ledger under a lock; a torn last line is ended first, and the rows are on disk when this returns."""
    with open(path, "a+b") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        if f.seek(0, os.SEEK_END):
            f.seek(-1, os.SEEK_END)
            if f.read(1) != b"\n":
                f.write(b"\n")
        f.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode())
        f.flush()
        os.fsync(f.fileno())


def append_tsv(path: str, header: list[str], row: list) -> None:
    """Appends one tab-separated row, with the header on the first write."""
    new = not os.path.exists(path)
    with open(path, "a", encoding="utf-8") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        f.write(("\t".join(header) + "\n" if new else "") + "\t".join(map(str, row)) + "\n")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(old.columns).unionByName(new)


def assert_unique(df: DataFrame, key: str) -> None:
    """Raises ValueError with up to three repeated keys."""
    repeated = [r[0] for r in df.groupBy(key).count().where("count > 1").orderBy(key).limit(3).collect()]
    if repeated:
        raise ValueError(f"{key} repeats: {', '.join(map(str, repeated))}")


def replace_table(df: DataFrame, path: str, key: str | None = None) -> DataFrame:
    """Create or replace a stored table: written whole beside, then swapped in."""
    if key:
        assert_unique(df, key)
    part, old = f"{path}.part", f"{path}.old"
    shutil.rmtree(part, ignore_errors=True)
    df.write.mode("overwrite").option("compression", "zstd").parquet(part)
    shutil.rmtree(old, ignore_errors=True)
    if os.path.exists(path):
        os.replace(path, old)
    os.replace(part, path)
    shutil.rmtree(old, ignore_errors=True)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def report(df: DataFrame, limit: int = 20) -> str:
    """A small table as text for a console: the first rows by all columns."""
    rows = df.orderBy(*[F.col(f"`{c}`") for c in df.columns]).limit(limit).collect()
    return "\n".join("\t".join("" if v is None else str(v) for v in r) for r in [df.columns, *rows])
