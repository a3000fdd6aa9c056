"""Distinctive terms: positive pointwise mutual information of term and record.

``ppmi(t, r) = max(0, log2( p(t, r) / (p(t) * p_a(r)) ))`` with ``p(t, r) = n(t, r) / n``,
``p(t) = n(t) / n`` and the record (context) share smoothed, ``p_a(r) = n(r)^a / sum n(r')^a``.
Everything is group-bys and equi-joins: the joint counts are made once, the marginals come
from them with map-side partial aggregation, and only pairs that can still qualify are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import persisted

#: A term is a maximal run of these characters, at least MIN_TERM long.
MIN_TERM = 3
TERM = rf"[a-z0-9]{{{MIN_TERM},}}"
#: Exponent that smooths the context counts.
ALPHA = 0.75


def record_text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def joint_counts(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, term, tf) and the record total ``n_r``; null texts count as empty, records without terms give no row."""
    terms = df.select(F.col(key), F.regexp_extract_all(record_text(*columns), F.lit(f"({TERM})"), F.lit(1)).alias("_terms"))
    return (
        terms.select(key, F.size("_terms").alias("n_r"), F.explode("_terms").alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("n_r").cast("long").alias("n_r"))
    )


def _bounded(joint: DataFrame, min_tf: int, min_df: int, max_df: int | None) -> DataFrame:
    """The pairs of the joint counts that reach the bounds, with the term's marginals ``df`` and ``n_t``."""
    by_term = joint.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n_t"))
    if min_df > 1:
        by_term = by_term.where(F.col("df") >= min_df)
    if max_df is not None:
        by_term = by_term.where(F.col("df") <= max_df)
    return joint.where(F.col("tf") >= min_tf).join(by_term, "term")


def ppmi(df: DataFrame, key: str, columns: list[str], min_tf: int = 1, min_df: int = 1, max_df: int | None = None, alpha: float = ALPHA) -> DataFrame:
    """Score each (record, term): columns ``key, term, tf, df, ppmi``.

    Counts and marginals cover the whole table; ``min_tf``, ``min_df`` and ``max_df`` only say which scored
    pairs come out. ``key`` must be unique; repeated keys would be scored as one record. Null or empty texts
    give no rows; an empty table gives an empty result.
    """
    joint = persisted(joint_counts(df, key, *columns), "distinctive-joint")
    sizes = joint.groupBy(key).agg(F.first("n_r").cast("double").alias("n_r"))
    total = sizes.agg(F.sum("n_r").alias("n"), F.sum(F.pow("n_r", F.lit(alpha))).alias("z"))
    score = F.log2((F.col("tf") / F.col("n")) / ((F.col("n_t") / F.col("n")) * (F.pow(F.col("n_r").cast("double"), F.lit(alpha)) / F.col("z"))))
    return (
        _bounded(joint, min_tf, min_df, max_df)
        .crossJoin(F.broadcast(total))  # one row of totals
        .select(key, "term", "tf", "df", F.greatest(score, F.lit(0.0)).alias("ppmi"))
    )
