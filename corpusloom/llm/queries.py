"""Queries of this subpackage, and SQL for those that SQL can state."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import persisted, shared_dir, table

from . import articles, boilerplate, clusters, distinctive, history, leakage, quality, residue, survivors, tokenizing


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = table(spark, sf_dir, "tagged_signals")
    return signals.select("row_id", "source", "category", "tier", "run_date").join(articles.article_labels(signals), "row_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = {"category": table(spark, sf_dir, "sources").select("category"), "tier": ["core", "extended"]}
    best = survivors.survivors(_records(spark, sf_dir), "class", "row_id", "run_date", usable, source="source")
    return best.select("first_row_id", "best_row_id", "category", "tier")


def p1_voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners by votes that halve in 90 days and trust a source by its share of usable tiers."""
    usable = {"category": table(spark, sf_dir, "sources").select("category"), "tier": ["core", "extended"]}
    trust = survivors.trust_of(table(spark, sf_dir, "tagged_signals"), "source", {"tier": ["core", "extended"]})
    best = survivors.survivors(_records(spark, sf_dir), "class", "row_id", "run_date", usable, source="source", trust=trust, half_life_days=90.0)
    return best.select("first_row_id", "best_row_id", "category", "tier")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.furniture(table(spark, sf_dir, "articles"), table(spark, sf_dir, "article_images"))


def p2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article's text without its furniture."""
    return boilerplate.main_text(table(spark, sf_dir, "articles"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(table(spark, sf_dir, "corpus"))


def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster's size and three most typical records."""
    return clusters.described(table(spark, sf_dir, "corpus"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "articles"))


def p4_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier's threshold, and its precision and recall on hosts it was not trained on."""
    return residue.validation(table(spark, sf_dir, "articles"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest files as batches against the history of all files before them."""
    return history.newest_last(history.History(spark, _folder(spark, "history")), table(spark, sf_dir, "tagged_signals"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored terms within the bounds. The query is stated by counts alone: every pair is scored, and a score of nought keeps its row."""
    corpus = table(spark, sf_dir, "corpus")
    scored = distinctive.ppmi(corpus, "ord", ["title", "summary"], min_tf=3, min_df=2, max_df=8)
    # no column of the result needs the score, so without being written it would not be made
    return persisted(scored, "distinctive-scores").select("ord", "term")


def p6_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (record, term) of the corpus with its score."""
    corpus = table(spark, sf_dir, "corpus")
    return distinctive.ppmi(corpus, "ord", ["title", "summary"]).withColumn("ppmi", F.round("ppmi", 6))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizing.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = quality.text_types(table(spark, sf_dir, "documents"))
    return typed.where(F.col("prose") < 0.5).select("doc_id")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and posterior types of every document."""
    return quality.text_types(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_voted": p1_voted,
    "p2_found": p2_found,
    "p2_main_text": p2_main_text,
    "p3_found": p3_found,
    "p3_clusters": p3_clusters,
    "p4_found": p4_found,
    "p4_validation": p4_validation,
    "p7_found": p7_found,
    "p6_found": p6_found,
    "p6_scores": p6_scores,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}

_TERMS = """terms AS (
  SELECT ord, unnest(regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(summary, '')), '[a-z0-9]{3,}')) AS term FROM corpus
), joint AS (SELECT ord, term, count(*) AS tf FROM terms GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df, sum(tf) AS n_t FROM joint GROUP BY term),
sizes AS (SELECT ord, sum(tf) AS n_r FROM joint GROUP BY ord),
total AS (SELECT sum(n_r) AS n, sum(pow(n_r, 0.75)) AS z FROM sizes)"""

SQL: dict[str, str] = {
    "p6_found": f"WITH {_TERMS} SELECT ord, term FROM joint JOIN dfs USING (term) WHERE tf >= 3 AND df BETWEEN 2 AND 8",
    "p6_scores": f"""WITH {_TERMS}
SELECT ord, term, tf, df, round(greatest(log2((tf / n) / ((n_t / n) * (pow(n_r, 0.75) / z))), 0), 6) AS ppmi
FROM joint JOIN dfs USING (term) JOIN sizes USING (ord) CROSS JOIN total""",
}
