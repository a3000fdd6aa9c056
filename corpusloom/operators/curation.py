"""Around the corpus: curated codes and their history, digests, scrape batches, result clusters, display."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import or_else
from corpusloom.runtime import broadcast_if_small, persisted
from corpusloom.sources import signals as S
from corpusloom.sources.sinks import add_rows

from . import pages as G
from . import planes as P
from . import search as R
from . import worklist as W


def with_default(df: DataFrame, side: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """A left join with a curated table; where it has no row, its columns take their defaults."""
    joined = df.join(broadcast_if_small(side), key, "left")
    return joined.select(*df.columns, *[F.coalesce(c, F.lit(defaults[c])).alias(c) if defaults.get(c) is not None else F.col(c) for c in side.columns if c != key])


def code_changes(states: DataFrame, code: str, run: str, status: str) -> DataFrame:
    """What each run does to a code: propose it, move its status, or append evidence; and retire it after its last run.

    ``states`` has one row a code and run. History is only appended to: every run of a code gives a row; extension.
    """
    w = Window.partitionBy(code).orderBy(run)  # one row a run
    last = states.agg(F.max(run).alias("_last"))
    seen = states.withColumn("before", F.lag(status).over(w)).withColumn("_i", F.row_number().over(w)).withColumn("next_run", F.lead(run).over(w))
    change = F.when(F.col("_i") == 1, "propose").when(~F.col(status).eqNullSafe(F.col("before")), "move").otherwise("append")
    retired = F.col("next_run").isNull() & (F.col(run) < F.col("_last"))
    return seen.crossJoin(F.broadcast(last)).select(code, run, change.alias("change"), "before", F.col(status).alias("status"), retired.alias("retired"))  # one row


def shortened(text: Column, width: int = 220) -> Column:
    """White space made single, cut at a word's end to ``width`` characters with " [...]" for what is left out."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    room = width - len(" [...]")
    head = F.regexp_extract(F.substring(flat, 1, room + 1), r"(?s)^(.*) ", 1)
    whole = F.when(F.substring(flat, room + 1, 1) == " ", F.substring(flat, 1, room)).otherwise(head)
    return F.when(F.length(flat) <= width, flat).when(whole == "", F.lit("[...]")).otherwise(F.concat(whole, F.lit(" [...]")))


def run_badge(runs: Column) -> Column:
    """Months and days of the runs, joined by "+"."""
    return F.array_join(F.transform(runs, lambda r: F.substring(r, 6, 1_000)), "+")


def digest(corpus: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` records of the latest run to tell about: core, then forward-looking, then the latest dates; extension."""
    last = corpus.agg(F.max("_first_seen").alias("_last"))
    found = corpus.crossJoin(F.broadcast(last)).where("_first_seen = _last").drop("_last")  # one row
    return found.orderBy(F.when(F.col("tier") == "core", 0).otherwise(1), F.when(F.col("forward_looking"), 0).otherwise(1), F.desc_nulls_last("pub_date"), "ord").limit(n)


def topic_shares(corpus: DataFrame, topic: Column) -> DataFrame:
    """(need, n, share) within the records of a topic: shares are of the topic, not of the corpus; extension."""
    n = corpus.where(topic).groupBy(or_else(F.col("need"), F.lit("unsettled")).alias("need")).agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_t")))).select("need", "n", (F.col("n") / F.col("_t")).alias("share"))  # one row


def tagging_gate(corpus: DataFrame) -> Column:
    """Where a record is pooled: its substrate if the fit is high or medium, else unsettled; extension."""
    return F.when(F.lower("fit_confidence").isin("high", "medium"), or_else(F.col("recommended_substrate"), F.lit("unsettled"))).otherwise("unsettled")


def statline(codes: DataFrame) -> DataFrame:
    """One row: codes, needs that have one, evidence and its sources. ``codes`` has need, code, evidence (an array)."""
    flat = codes.select("need", "code", F.explode_outer("evidence").alias("source"))
    return flat.agg(F.count_distinct("need", "code").alias("codes"), F.count_distinct("need").alias("needs"), F.count("source").alias("evidence"), F.count_distinct("source").alias("sources"))


def harvested(sources: DataFrame, ask: Callable[[str, str], tuple[str, int, int]], columns: tuple[str, str] = ("name", "base_url")) -> DataFrame:
    """(source, answer, tokens_in, tokens_out) of an injected model's answers, one question a source.

    A source whose question fails has a null answer and costs nothing.
    """
    import pandas as pd

    def batches(frames):
        for pdf in frames:
            rows = []
            for name, url in zip(pdf[columns[0]], pdf[columns[1]], strict=True):
                try:
                    rows.append((name, *ask(name, url)))
                except Exception:  # noqa: BLE001  one source must not end the harvest
                    rows.append((name, None, 0, 0))
            yield pd.DataFrame(rows, columns=["source", "answer", "tokens_in", "tokens_out"])

    return sources.select(*columns).mapInPandas(batches, "source string, answer string, tokens_in long, tokens_out long")


def token_usage(answers: DataFrame) -> DataFrame:
    return answers.agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.count_if(F.col("answer").isNull()).alias("failed"))


def manifest_upsert(manifest: DataFrame, images: DataFrame, name: str, order: str) -> DataFrame:
    """The manifest with one row for each new file name, the first by ``order``; rows it has stay as they are."""
    fresh = W.first_of(images.join(manifest.select(name), name, "left_anti"), F.col(name), order)
    return manifest.select(*images.columns).union(fresh.select(*images.columns))


def scrape_batch(worklist: DataFrame, ledger: str | None, fetch: Callable[[str], tuple[int, str, str]], cap: int = 15, target: int = 0, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(articles, images) of a worklist (ord, url): each url once, not those in the ledger, fetched, parsed, capped, stopped.

    The first of equal urls by ``ord`` is scraped. A page keeps its first ``cap`` images and its true count; pages after the
    one at which the kept images reach ``target`` are left out and stay out of the ledger; 0 turns either off. Failed
    fetches are articles with method "failed". The ledger is a folder of (url, method, images); null keeps none.
    """
    spark = worklist.sparkSession
    once = W.first_of(worklist.where("url is not null").select("ord", "url"), F.col("url"), "ord")
    if ledger is not None and not force:
        once = W.not_in_ledger(once, S.read_or_empty(spark, ledger, S.LEDGER))
    once = persisted(once, "scrape-list")
    got = persisted(S.fetched(once, fetch), "scrape-pages")
    ok = got.where("status < 400 and body is not null")
    articles, images = G.extract(ok.withColumn("html", F.col("body")))
    images = persisted(images, "scrape-images")
    counts = images.groupBy("url").agg(F.count(F.lit(1)).alias("images_found"))
    told = articles.join(counts, "url", "left").withColumn("images_found", F.coalesce("images_found", F.lit(0)))
    walled = G.looks_paywalled(F.col("page_text"), F.col("text"))
    told = once.join(told, "url", "left").withColumn("images_found", F.when(F.col("title").isNull() | walled, 0).otherwise(F.col("images_found")))
    told = told.withColumn("fetch_method", F.when(F.col("title").isNull() | walled, "failed").otherwise("static"))
    told = told.withColumn("images_kept", F.least("images_found", F.lit(cap)) if cap else F.col("images_found")).withColumn("_all", F.lit(0))
    told = persisted(W.cumulative_stop(told, "_all", "images_kept", ["ord"], target).drop("_all", "page_text"), "scrape-articles")
    if ledger is not None:
        add_rows(told.select("url", F.col("fetch_method").alias("method"), F.col("images_found").cast("long").alias("images")), ledger, "url")
    kept = images.join(told.where("fetch_method = 'static'").select("url", "ord"), "url")
    return told, kept.where(F.col("seq") < cap) if cap else kept


def result_clusters(corpus: DataFrame, query: str, limit: int = 200, terms: int = 3) -> DataFrame:
    """(cluster, n, central, keywords): the best matches of a query grouped by their vectors; extension.

    Matches without a usable vector are in no cluster. Clusters are the plane's k-means over all matches together; the
    central member is the best-ranked one, keywords tell a cluster from the other matches.
    """
    from corpusloom.functions import vectors as V

    found = R.search(corpus, query, limit).withColumn("v", V.decode_bytes(F.col("vec"))).where(F.size("v") == 128)
    found = persisted(found.select(F.lit("all").alias("need"), "ord", "title", "summary", "score", F.size("_runs").alias("runs"), "v"), "matches")
    placed = persisted(P.cluster_by_need(found, rollup=False), "match-clusters")
    docs = found.drop("need").join(placed, "ord")
    named = P.labels(docs, ["need", "cluster"], P.STOP, terms)
    rank = F.struct((-F.round("score", 9)).alias("s"), (-F.col("runs")).alias("r"), "ord")
    return docs.groupBy("need", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min_by("ord", rank).alias("central")).join(named, ["need", "cluster"]).select("cluster", "n", "central", F.col("label").alias("keywords"))
