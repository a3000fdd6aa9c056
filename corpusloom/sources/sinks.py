"""Results as files: JSON lines with nulls kept, ledgers and caches as Parquet, side pages copied."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .signals import read_or_empty


def as_json(*columns: str) -> Column:
    """A JSON object of the columns: nulls are kept, letters stay as they are."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str, order: list[str] | None = None, files: int | None = None) -> None:
    """One JSON object a line. With ``order`` the files' names follow it, over range partitions."""
    columns = df.columns
    placed = df if order is None else (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    placed.select(as_json(*columns).alias("value")).write.mode("overwrite").text(path)


def add_rows(df: DataFrame, path: str, key: str) -> DataFrame:
    """Appends rows whose key the table at ``path`` does not have, the first of each key; gives back what was added.

    An unreadable table counts as empty, so that a lost ledger is begun anew.
    """
    spark = df.sparkSession
    have = read_or_empty(spark, path, df.schema)
    fresh = df.dropDuplicates([key]).join(have.select(key), key, "left_anti").select(*df.columns)
    from corpusloom.runtime import persisted

    fresh = persisted(fresh, "added")
    fresh.write.mode("append").parquet(path)
    return fresh


def copy_pages(names: list[str], source: str, target: str) -> list[str]:
    """Copies the side pages that exist; gives back their names."""
    Path(target).mkdir(parents=True, exist_ok=True)
    found = [n for n in names if (Path(source) / n).is_file()]
    for n in found:
        shutil.copy(Path(source) / n, Path(target) / n)
    return found
