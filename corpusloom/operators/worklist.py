"""Selecting what to scrape, caps, ledgers, paging and rate plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import domain_of, is_article_url, parse_signal_date
from corpusloom.runtime import persisted


def running_before(df: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the earlier rows of the group, by ``order`` (unique within it).

    Rows are range-partitioned by group and order and written, so that a group of any size is spread; each part sums by
    itself and starts from the total of the parts before it, which is one row for each part of a group.
    """
    part = df.withColumn("_v", value).repartitionByRange(group, *order).withColumn("_p", F.spark_partition_id())
    part = persisted(part, "ordered")
    totals = part.groupBy("_p", F.col(group).alias("_g")).agg(F.sum("_v").alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(F.col("_p").alias("_q"), "_g", before.alias("_o"))
    local = F.coalesce(F.sum("_v").over(Window.partitionBy("_p", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = part.withColumn(name, local).join(totals, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn(name, F.col(name) + F.col("_o")).drop("_v", "_p", "_q", "_g", "_o")


def select_worklist(corpus: DataFrame, need: str, now: str, days: int | None = None, run: str | None = None, limit: int | None = 40, url: str = "url", date: str = "pub_date") -> DataFrame:
    """Article urls of a need: core first, then forward-looking, then the newest; undated ones after all dates from 1970.

    ``now`` is a date; with ``days`` only records dated within so many days of it stay. The limit is below any fetch.
    """
    dated = corpus.withColumn("_day", parse_signal_date(F.col(date)))
    found = dated.where((F.col("need") == need) & is_article_url(F.col(url)))
    if run is not None:
        found = found.where(F.array_contains("_runs", run))
    if days is not None:
        found = found.where(F.col("_day") >= F.date_sub(F.lit(now).cast("date"), days))
    ranked = found.orderBy(
        F.when(F.col("tier") == "core", 0).otherwise(1),
        F.when(F.col("forward_looking"), 0).otherwise(1),
        F.coalesce(-F.unix_date("_day"), F.lit(0)),
        "ord",
    )
    return (ranked if limit is None else ranked.limit(limit)).drop("_day")


def first_of(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key by ``order`` (unique): a minimum and a semi join, no group is gathered."""
    first = df.where(key.isNotNull()).groupBy(key.alias("_k")).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi")


def not_in_ledger(worklist: DataFrame, ledger: DataFrame, url: str = "url", force: bool = False) -> DataFrame:
    """Rows whose url the ledger does not have; all of them with ``force``."""
    return worklist if force else worklist.join(ledger.select(url).distinct(), url, "left_anti")


def cap_per_group(df: DataFrame, group: list[str], order: list, cap: int) -> DataFrame:
    """The first ``cap`` rows of each group and the group's true size ``n_found``; a cap of 0 keeps all.

    A rank with a limit is cut to ``cap`` rows a group in every task before the shuffle, so no group is gathered.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_found"))
    if cap > 0:
        df = df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= cap).drop("_r")
    return df.join(sizes, group)


def cumulative_stop(df: DataFrame, group: str, count: str, order: list, target: int) -> DataFrame:
    """Rows up to the one whose running sum first reaches the target, within each group; a target of 0 keeps all."""
    if target <= 0:
        return df
    return running_before(df, group, order, F.col(count), "_c").where(F.col("_c") < target).drop("_c")


def numbered(df: DataFrame, group: str, order: str, per_sheet: int = 12, columns: int = 3) -> DataFrame:
    """``idx`` from 1 within a group, and the sheet, slot, column and row it stands on."""
    at = running_before(df, group, [order], F.lit(1), "idx").withColumn("idx", F.col("idx") + 1)
    at = at.withColumn("sheet", (F.floor((F.col("idx") - 1) / per_sheet) + 1).cast("int")).withColumn("slot", ((F.col("idx") - 1) % per_sheet).cast("int"))
    return at.withColumn("grid_col", F.col("slot") % columns).withColumn("grid_row", F.floor(F.col("slot") / columns).cast("int"))


def rate_schedule(df: DataFrame, url: str, order: str, seconds: int = 2) -> DataFrame:
    """Seconds after the start at which each url's turn comes, ``seconds`` apart within a domain."""
    placed = running_before(df.withColumn("domain", domain_of(F.col(url))), "domain", [order], F.lit(1), "start_s")
    return placed.withColumn("start_s", F.col("start_s") * seconds)


def freshness(date: Column, now: str) -> Column:
    """Routing by age: under 45 days reuse, up to 90 judgement, beyond that reharvest; undated is unknown."""
    age = F.datediff(F.lit(now).cast("date"), date)
    return F.when(age.isNull(), "unknown").when(age < 45, "reuse").when(age <= 90, "judgement").otherwise("reharvest")
