"""The accepted corpus: ordered merge of runs, history, statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import norm_title, norm_url, or_else


def titles_agree(a: str, b: str) -> bool:
    """Normalised titles of one article: equal, one begins the other (the empty one begins all), or words contained."""
    if a.startswith(b) or b.startswith(a):
        return True
    x, y = set(a.split()), set(b.split())
    return x <= y or y <= x


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Slots of records that come sorted by group and order. Only the open group's representatives are held."""
    group, titles = None, []
    for pdf in frames:
        slots = []
        for g, t in zip(pdf["grp"], pdf["t"], strict=True):
            if g != group:
                group, titles = g, []
            slot = next((i for i, r in enumerate(titles) if titles_agree(r, t)), len(titles))
            if slot == len(titles):
                titles.append(t)
            else:
                titles[slot] = t
            slots.append(slot)
        yield pd.DataFrame({"k": pdf["k"], "grp": pdf["grp"], "slot": slots})


def merge_slots(signals: DataFrame, key: str = "row_id") -> DataFrame:
    """(k, grp, slot): which article each record goes to, scanning each url's records in order of run and arrival.

    The fold depends on the order and on what it has replaced, so a url's records pass through one task, as a sorted
    stream of (order, title); memory holds one url's articles. All fields are put together afterwards by aggregation.
    """
    grp = or_else(norm_url(F.col("url")), F.coalesce("id", F.lit("")))
    narrow = signals.select(F.col(key).alias("k"), grp.alias("grp"), norm_title(F.col("title")).alias("t"), F.coalesce("run_date", F.lit("")).alias("r"), F.coalesce("file_name", F.lit("")).alias("f"))
    ordered = narrow.repartition("grp").sortWithinPartitions("grp", "r", "f", "k").select("k", "grp", "t")
    return ordered.mapInPandas(_fold, "k long, grp string, slot long")


def merge_corpus(signals: DataFrame, key: str = "row_id") -> DataFrame:
    """One row for each article: the newest record's fields (nulls too), category and tier of the newest that has one,
    the sorted set of runs and the first run. ``ord`` numbers follow (first run, source, first record).

    Records without url group by id; blank titles agree with any title of their url; repeated records merge.
    """
    slots = merge_slots(signals, key).withColumnRenamed("k", key)
    when = F.struct(F.coalesce("run_date", F.lit("")), F.coalesce("file_name", F.lit("")), key)
    fields = [c for c in signals.columns if c not in ("category", "tier", "run_date", "file_name")]
    merged = (
        signals.join(slots, key)
        .groupBy("grp", "slot")
        .agg(
            F.max_by(F.struct(*[F.col(c) for c in fields]), when).alias("_new"),
            *[F.max_by(F.nullif(c, F.lit("")), F.when(F.nullif(c, F.lit("")).isNotNull(), when)).alias(c) for c in ("category", "tier")],
            F.array_sort(F.collect_set(F.coalesce("run_date", F.lit("")))).alias("_runs"),
            F.min(F.coalesce("run_date", F.lit(""))).alias("_first_seen"),
            F.min(key).alias("_first_key"),
            F.count(F.lit(1)).alias("n_records"),
        )
    )
    return merged.select("_new.*", "category", "tier", "_runs", "_first_seen", "_first_key", "n_records")


def need_history(signals: DataFrame) -> DataFrame:
    """(run, need, n): counts before merging; a missing need is "unsettled"."""
    return signals.groupBy(F.coalesce("run_date", F.lit("")).alias("run"), or_else(F.col("need"), F.lit("unsettled")).alias("need")).agg(F.count(F.lit(1)).alias("n"))


def shares(counted: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """Adds ``share``: n over the sum of n of the same ``by``."""
    total = counted.groupBy(*by).agg(F.sum(n).alias("_t")) if by else counted.agg(F.sum(n).alias("_t"))
    joined = counted.join(total, by) if by else counted.crossJoin(F.broadcast(total))  # one row
    return joined.withColumn("share", F.col(n) / F.col("_t")).drop("_t")
