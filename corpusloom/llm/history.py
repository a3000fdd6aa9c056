"""New batches against all history, through the hash forest.

The history is a folder of runs, one a batch: the forest of titles (``hashforest``), ``nodes`` (the different keys of the
accepted records, with the record first accepted of their article), ``titles`` (their words, once) and ``merged`` (articles that a later batch showed to be one).
A batch is located by prefix range in the forest and by its pages, slugs, ids and words in the nodes; only the batch and
the nodes it reaches are labelled. Older runs are joined, never aggregated or written again; ``merge_runs`` makes one of many.

Whether a title is general (two publishers carry it) is judged by all that is known when its batch comes. A batch may hold
many files: labelling all at once is the first load of an empty history, and that is what p7_found does.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.operators.graph import connected_components
from corpusloom.runtime import broadcast_if_small, delete, persisted, scratch, together

from . import articles, hashforest


def repeats(signals: DataFrame) -> DataFrame:
    """(accepted_row_id, row_id): each record with an earlier one of its article, and the first of them, without a history.

    The article's first record comes from one aggregation that combines before the shuffle. Null and blank keys are
    handled as in ``articles.article_labels``; an empty table gives no rows.
    """
    labels = articles.article_labels(signals)
    first = labels.groupBy("class").agg(F.min("row_id").alias("accepted_row_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return labels.join(first, "class").where("row_id > accepted_row_id").select("accepted_row_id", "row_id")


_KEYS = ["id", "page", "slug", "root", "title", "untitled"]
_NODE = [*_KEYS, "publisher", "words"]


class History:
    """Accepted articles in the folder ``path``: ``forest/…``, and ``nodes``, ``titles`` and ``merged`` by ``run=N``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.forest = hashforest.HashForest(spark, f"{self.path}/forest")

    def _read(self, part: str, before: int) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}").where(F.col("run") < before).drop("run")
        except AnalysisException:
            return None

    def nodes(self, before: int) -> DataFrame | None:
        """The nodes of the runs before one, each with its article's first record as it is known by then."""
        found, merged = self._read("nodes", before), self._read("merged", before)
        if found is None or merged is None or merged.isEmpty():
            return found
        now = connected_components(merged.select(F.col("old").alias("a"), F.col("new").alias("b"))).select(F.col("node").alias("accepted"), "component")
        return found.join(broadcast_if_small(now), "accepted", "left").withColumn("accepted", F.coalesce("component", "accepted")).drop("component")

    def accept(self, batch: DataFrame, run: int) -> DataFrame:
        """Label a batch, persist it as run ``run`` and give (accepted_row_id, row_id) of the records that repeat one.

        Row ids are above all accepted ones, run numbers too. Records repeat earlier ones of the history or of the batch.
        Where the batch joins articles of the history, ``joined`` tells (old, new) first records. An empty batch changes
        nothing; null and blank keys are handled as in ``articles.article_labels``. What else was written on the way is deleted.
        """
        with scratch(self.spark):
            return self._accepted(batch, run)

    def _accepted(self, batch: DataFrame, run: int) -> DataFrame:
        keys = articles.keyed(batch)
        old = self.nodes(run) if run else None
        if old is None:
            told = articles.titles_of(keys)
            fresh = told[2]
            # general titles are never compared: the forest of a first load does without them
            labels = articles.labels_of(keys, lambda: self.forest.add(told[0], "publisher", "words", "title", run), told, tuple(_KEYS))
            placed = labels.select("row_id", F.col("class").alias("component"), F.lit(None).cast("long").alias("accepted"), *_KEYS)
        else:
            fresh = keys.where("title is not null").select("title", "publisher", "words").distinct()
            fresh = persisted(fresh.join(self._read("titles", run).select("title"), "title", "left_anti"), "fresh-titles")
            located = persisted(self.forest.add(fresh, "publisher", "words", "title", run), "located")
            reached = persisted(self._reached(keys, old, located, run), "reached")
            both = keys.select("row_id", *_NODE).union(reached.select("row_id", *_NODE))
            labels = persisted(articles.labels_of(persisted(both, "batch-keys"), located, keep=tuple(_KEYS)), "batch-labels")
            told = labels.join(reached.select("row_id", "accepted"), "row_id", "left")
            # nodes of one article stay together
            seats = connected_components(told.where("accepted is not null").select(F.col("class").alias("a"), F.xxhash64(F.lit("accepted"), "accepted").alias("b")))
            placed = told.join(seats, F.col("class") == F.col("node"), "left").select("row_id", F.coalesce("component", "class").alias("component"), "accepted", *_KEYS)
        placed = persisted(placed, f"placed-{run}")
        # a record that is alone in its component is its article's first and repeats none
        first = placed.groupBy("component").agg(F.min(F.coalesce("accepted", "row_id")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        first = broadcast_if_small(persisted(first, "firsts"))
        settled = persisted(placed.join(first, "component").select("row_id", "accepted", "first", *_KEYS), "settled")
        joined = settled.where("accepted <> first").select(F.col("accepted").alias("old"), F.col("first").alias("new")).distinct()
        new = "accepted is null and row_id is not null"
        mine = settled.where(new)
        kept = mine.groupBy(*_KEYS, F.col("first").alias("accepted")).agg(F.min("row_id").alias("row_id"))
        alone = placed.where(new).join(first, "component", "left_anti").select(*_KEYS, F.col("row_id").alias("accepted"), "row_id")
        return together(
            lambda: joined.write.mode("overwrite").parquet(f"{self.path}/merged/run={run}"),
            lambda: kept.union(alone).write.mode("overwrite").parquet(f"{self.path}/nodes/run={run}"),
            lambda: fresh.write.mode("overwrite").parquet(f"{self.path}/titles/run={run}"),
            lambda: persisted(mine.where("row_id > first").select(F.col("first").alias("accepted_row_id"), "row_id"), "repeats", keep=True),
        )[-1]

    def joined(self, run: int) -> DataFrame:
        """(old, new): first records of articles that the run showed to be one."""
        return self.spark.read.schema("old long, new long").parquet(f"{self.path}/merged/run={run}")

    def _reached(self, keys: DataFrame, old: DataFrame, located: DataFrame, run: int) -> DataFrame:
        """The history's nodes that share a page, a slug, an id or words with the batch, or a located title; and their titles' namesakes."""
        titles = self._read("titles", run)
        found = None
        by = ("page", "slug", "id", "title")
        wanted = keys.select(F.explode(F.array(*[F.struct(F.lit(c).alias("by"), F.col(c).alias("_key")) for c in by])).alias("_")).select("_.*")
        near = located.select(F.lit("title"), F.explode(F.array("a", "b")))
        wanted = persisted(wanted.union(near).where("_key is not null").distinct(), "wanted-keys")
        counts = {r["by"]: r["n"] for r in wanted.groupBy("by").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a column
        for c in by:
            side = wanted.where(F.col("by") == c).select("_key", F.lit(True).alias("_" + c))
            side = F.broadcast(side) if counts.get(c, 0) <= runtime.BROADCAST_ROWS else side
            found = (old if found is None else found).join(side, F.col(c) == F.col("_key"), "left").drop("_key")
        found = persisted(found.where("_page or _slug or _id or _title").select("row_id", "accepted", *_KEYS), "reached-keys")
        words = titles.join(broadcast_if_small(found.select("title").where("title is not null").distinct()), "title", "left_semi").select("words")
        words = persisted(keys.select("words").union(words).where("words <> ''").distinct(), "reached-words")
        names = persisted(titles.join(broadcast_if_small(words), "words", "left_semi").select(F.col("title").alias("_t"), "publisher", "words"), "reached-titles")
        # what was found by a title's key is among the titles of these words
        named = old.join(broadcast_if_small(names), F.col("title") == F.col("_t")).select("row_id", "accepted", *_KEYS, "publisher", "words")
        untitled = found.where("title is null").select("row_id", "accepted", *_KEYS, F.lit(None).cast("string").alias("publisher"), F.lit("").alias("words"))
        return named.union(untitled)

    def merge_runs(self, into: str, runs: int) -> History:
        """The history of the runs before ``runs`` as one run 0 at ``into``: articles joined, forest merged. The old folder stays."""
        merged = History(self.spark, into)
        nodes = self.nodes(runs)
        if nodes is not None:

            def forest():
                with scratch(self.spark):
                    self.forest.merge(f"{merged.path}/forest")

            together(
                forest,
                lambda: nodes.write.mode("overwrite").parquet(f"{merged.path}/nodes/run=0"),
                lambda: self._read("titles", runs).write.mode("overwrite").parquet(f"{merged.path}/titles/run=0"),
                lambda: self.spark.createDataFrame([], "old long, new long").write.mode("overwrite").parquet(f"{merged.path}/merged/run=0"),
            )
        return merged

    def forget(self) -> None:
        """Delete the runs, once they are merged elsewhere; which articles each run joined stays."""
        for part in ("forest", "nodes", "titles"):
            delete(self.spark, f"{self.path}/{part}")


def by_files(history: History, signals: DataFrame, file: str = "file_name") -> tuple[DataFrame, list[dict]]:
    """Accept the files one by one, in the order of their first records: the repeats as all files show them, and figures of each batch."""
    files = [r[0] for r in signals.groupBy(file).agg(F.min("row_id").alias("first")).orderBy("first").select(file).collect()]  # a row a file
    found, figures = None, []
    for run, name in enumerate(files):
        batch = signals.where(F.col(file).eqNullSafe(F.lit(name)))
        part = history.accept(batch, run)
        old = history.nodes(run) if run else None
        figures.append({"file": name, "records": batch.count(), "repeats": part.count(), "articles_joined": history.joined(run).count(), "nodes_in_history": 0 if old is None else old.count()})
        found = part if found is None else found.union(part)
    if found is None:
        return history.spark.createDataFrame([], "accepted_row_id long, row_id long"), figures
    return _as_joined(found, history._read("merged", len(files))), figures


def _as_joined(found: DataFrame, merged: DataFrame | None) -> DataFrame:
    """The batches' repeats with the articles that (old, new) first records showed to be one."""
    if merged is None or merged.isEmpty():
        return found
    now = persisted(connected_components(merged.select(F.col("old").alias("a"), F.col("new").alias("b"))).select("node", "component"), "articles-joined")
    # the first record of an article that turned out to be another's repeats it too
    moved = now.where("node <> component").select(F.col("component").alias("accepted_row_id"), F.col("node").alias("row_id"))
    told = found.join(broadcast_if_small(now), F.col("accepted_row_id") == F.col("node"), "left").select(F.coalesce("component", "accepted_row_id").alias("accepted_row_id"), "row_id")
    return told.union(moved).distinct()


def newest_last(history: History, signals: DataFrame, file: str = "file_name") -> DataFrame:
    """The repeats where the two newest files come as batches to the history of all files before them.

    The older files are the first load of the empty history. The next file is located in that run; then both runs are
    merged, the merged ones deleted, and the newest file is located in what came of it. Loads end where the first record of a file is, so row ids
    only grow; of two files the second is a batch, one file is one load.
    """
    firsts = sorted(r["first"] for r in signals.groupBy(file).agg(F.min("row_id").alias("first")).where("first is not null").collect())  # a row a file
    borders = firsts[1:][-2:]
    rid, found, merged, run = F.col("row_id"), None, [], 0
    for i in range(len(borders) + 1):
        load = signals
        if i:
            load = load.where(rid >= borders[i - 1])
        if i < len(borders):
            load = load.where((rid < borders[i]) if i else (rid < borders[i]) | rid.isNull())
        if run > 1:
            old, history = history, history.merge_runs(f"{history.path}/one-run", run)
            old.forget()
            run = 1
        part = history.accept(load, run)
        merged.append(history.joined(run))
        found, run = part if found is None else found.union(part), run + 1
    for part in merged[1:]:
        merged[0] = merged[0].union(part)
    return _as_joined(found, merged[0])
