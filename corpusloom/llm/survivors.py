"""The best representative of each group of duplicate records, field by field.

Fields are unpivoted to long rows (group, field, normalised value). Each usable value of a record is a vote, worth
the trust in the record's source times a recency decay, and votes are summed by value; ``max_by`` takes the winner of each
field and the winners are pivoted back. All steps are sums, maxima and ``max_by``, which combine before the
shuffle, so a group may hold any share of the rows.

With ``half_life_days`` the decay is ``0.5 ** (age / half_life_days)``, age counted from the latest run of the table. With
``half_life_days=None`` the decay is steep: votes are ranked within their group and field from the latest (run, key) on, and
each rank weighs so much less than the one before that it outweighs all later ranks together, whatever the trusts. Votes of one
value and run are summed first, so what is ranked is bounded by the runs and the usable values, not by the group.
p1_found is stated by the latest record, which is the winner of these votes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import broadcast_if_small, persisted


def normalised(column: Column) -> Column:
    """Lower case, without white space at the ends."""
    return F.lower(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""))


def trust_of(df: DataFrame, source: str, usable: dict[str, list[str]]) -> DataFrame:
    """(source, weight): the share of a source's fields that are usable, between 0.1 and 1, as its trust."""
    good = reduce(lambda a, b: a + b, [F.coalesce(normalised(F.col(f)).isin(values), F.lit(False)).cast("int") for f, values in usable.items()])
    share = F.sum(good) / (F.count(F.lit(1)) * len(usable))
    return df.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.greatest(F.lit(0.1), share).alias("weight"))


def survivors(
    df: DataFrame,
    group: str,
    key: str,
    order: str,
    usable: dict[str, DataFrame | list[str]],
    source: str | None = None,
    trust: DataFrame | None = None,
    half_life_days: float | None = None,
) -> DataFrame:
    """One row for each group of two or more records: ``first_<key>``, ``best_<key>`` and the winner of each field.

    ``order`` is the run date (a string; null comes first), ``key`` breaks ties. ``usable`` gives each field's usable
    values, as a list or a one-column table; both are compared after normalising. The best record has the most usable
    fields, then the latest run, then the largest key. A field without usable value is the empty string. ``trust`` has
    (source, weight), weights above 0; sources not in it, and null ones, weigh 1. Repeated rows count as records of their
    own. Equal votes go to the value of the latest record.
    """
    base = df
    for name, values in usable.items():
        value = normalised(F.col(name))
        if isinstance(values, list):
            base = base.withColumn(f"_{name}", F.when(value.isin(values), value))
        else:
            good = values.select(normalised(F.col(values.columns[0])).alias(f"_v_{name}")).where(F.col(f"_v_{name}").isNotNull()).distinct()
            base = base.join(good, value == F.col(f"_v_{name}"), "left").withColumnRenamed(f"_v_{name}", f"_{name}")
    fields = list(usable)
    weight = F.lit(1.0)
    if trust is not None:
        base = base.join(trust.select(F.col("source").alias("_trusted"), F.col("weight").alias("_weight")), F.col(source) == F.col("_trusted"), "left")
        weight = F.coalesce("_weight", F.lit(1.0))
    when = F.coalesce(F.col(order), F.lit(""))
    place = F.struct(when.alias("o"), F.col(key).alias("k"))
    filled = reduce(lambda a, b: a + b, [F.col(f"_{f}").isNotNull().cast("int") for f in fields])
    groups = base.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(key).alias(f"first_{key}"),
        F.max(F.struct(filled.alias("c"), when.alias("o"), F.col(key).alias("k"))).alias("_best"),
    )
    groups = persisted(groups.where("_n > 1").select(group, f"first_{key}", F.col("_best.k").alias(f"best_{key}")), "survivor-groups")
    # lone records have no say in any group
    base = base.join(broadcast_if_small(groups.select(group)), group, "left_semi")

    votes = base.select(group, key, when.alias("_o"), weight.alias("_w"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}").alias("value")) for f in fields])).alias("_f"))
    votes = votes.where("_f.value is not null").select(group, key, "_o", "_w", "_f.*")
    by_run = votes.groupBy(group, "field", "value", "_o").agg(F.sum("_w").alias("_w"), F.max(key).alias("_k"))
    if half_life_days is None:
        whole = Window.partitionBy(group, "field")
        step = 4 * F.sum("_w").over(whole) / F.min("_w").over(whole)
        rank = F.row_number().over(whole.orderBy(F.desc("_o"), F.desc("_k")))
        voted = by_run.withColumn("vote", F.col("_w") * F.pow(step, -rank.cast("double")))
    else:
        last = df.agg(F.max(F.try_to_timestamp(F.col(order), F.lit("yyyy-MM-dd"))).alias("_last"))
        dated = by_run.crossJoin(F.broadcast(last))  # one row
        age = F.datediff("_last", F.try_to_timestamp(F.col("_o"), F.lit("yyyy-MM-dd")))
        decay = F.pow(F.lit(0.5), F.coalesce(age, F.lit(100 * half_life_days)) / F.lit(float(half_life_days)))
        voted = dated.withColumn("vote", F.col("_w") * decay)
    tally = voted.groupBy(group, "field", "value").agg(F.sum("vote").alias("vote"), F.max(F.struct(F.col("_o").alias("o"), F.col("_k").alias("k"))).alias("latest"))
    rank = F.struct(F.round(F.log2("vote"), 9).alias("vote"), "latest") if half_life_days is not None else F.struct("vote", "latest")
    won = tally.groupBy(group).pivot("field", fields).agg(F.max_by("value", rank))
    return groups.join(won, group, "left").select(group, f"first_{key}", f"best_{key}", *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields])
