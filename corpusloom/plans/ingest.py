"""Scans, merges, history, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import corpus as C
from corpusloom.operators import schema_drift, worklist
from corpusloom.runtime import table
from corpusloom.sources import signals as S

from .registry import query, s_list, s_norm_title, s_norm_url, s_strip


def signals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tagged_signals")


_RUNS = "runs AS (SELECT file_name, run_date, row_number() OVER (ORDER BY run_date, file_name) AS run_ord FROM (SELECT DISTINCT file_name, coalesce(run_date, '') AS run_date FROM tagged_signals))"


@query(f"WITH {_RUNS} SELECT t.row_id, r.run_ord, t.seq FROM tagged_signals t JOIN runs r ON t.file_name = r.file_name AND coalesce(t.run_date, '') = r.run_date")
def scan_runs(spark, sf):
    """Every record with the place of its run."""
    t = signals(spark, sf).select("row_id", "seq", "file_name", F.coalesce("run_date", F.lit("")).alias("run_date"))
    return t.join(S.run_order(signals(spark, sf)), ["file_name", "run_date"]).select("row_id", F.col("run_ord").cast("long").alias("run_ord"), "seq")


@query("SELECT file_name, count(*) AS n FROM tagged_signals GROUP BY file_name")
def run_counts(spark, sf):
    return signals(spark, sf).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT name, category FROM sources WHERE coalesce(fetchable, true) AND NOT coalesce(semiotic_only, false)")
def harvestable_sources(spark, sf):
    return table(spark, sf, "sources").where(F.coalesce("fetchable", F.lit(True)) & ~F.coalesce("semiotic_only", F.lit(False))).select("name", "category")


@query("SELECT name, category, base_url FROM sources WHERE NOT coalesce(semiotic_only, false)")
def field_guide_sources(spark, sf):
    return table(spark, sf, "sources").where(~F.coalesce("semiotic_only", F.lit(False))).select("name", "category", "base_url")


@query("SELECT name FROM sources WHERE NOT coalesce(fetchable, true)")
def skipped_unfetchable(spark, sf):
    return table(spark, sf, "sources").where(~F.coalesce("fetchable", F.lit(True))).select("name")


@query("SELECT DISTINCT source AS wanted FROM tagged_signals WHERE source IS NOT NULL AND source NOT IN (SELECT name FROM sources WHERE coalesce(fetchable, true))")
def subset_missing(spark, sf):
    """Wanted names (those of the records) that no fetchable source has."""
    wanted = signals(spark, sf).select(F.col("source").alias("wanted")).where("wanted is not null").distinct()
    able = table(spark, sf, "sources").where(F.coalesce("fetchable", F.lit(True))).select(F.col("name").alias("wanted"))
    return wanted.join(able, "wanted", "left_anti")


@query("SELECT s.name, s.category, count(t.row_id) AS kept FROM sources s LEFT JOIN tagged_signals t ON t.source = s.name GROUP BY ALL")
def per_source_counts(spark, sf):
    """Records by source, with the sources that have none; counted before the join."""
    n = signals(spark, sf).where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("kept"))
    s = table(spark, sf, "sources").select("name", "category")
    return s.join(n, s["name"] == n["source"], "left").select("name", "category", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"))


@query("SELECT s.name, count(t.row_id) AS kept FROM sources s LEFT JOIN tagged_signals t ON t.source = s.name WHERE coalesce(s.fetchable, true) AND NOT coalesce(s.semiotic_only, false) GROUP BY s.name HAVING count(t.row_id) < 8")
def below_target(spark, sf):
    """Harvestable sources with fewer than eight records."""
    able = harvestable_sources(spark, sf).select("name")
    return per_source_counts(spark, sf).join(able, "name", "left_semi").where("kept < 8").select("name", "kept")


@query(f"SELECT min(row_id) AS row_id, {s_strip('url')} AS url FROM tagged_signals WHERE {s_strip('url')} <> '' GROUP BY ALL")
def dedup_first(spark, sf):
    """The first record of each trimmed url; blank urls are dropped."""
    t = signals(spark, sf).select("row_id", X.strip(F.col("url")).alias("url")).where("url <> ''")
    return worklist.first_of(t, F.col("url"), "row_id")


@query(f"SELECT row_id, {s_norm_url()} AS u FROM tagged_signals")
def norm_url(spark, sf):
    return signals(spark, sf).select("row_id", X.norm_url(F.col("url")).alias("u"))


@query(f"SELECT row_id, {s_norm_title()} AS t FROM tagged_signals")
def norm_title(spark, sf):
    return signals(spark, sf).select("row_id", X.norm_title(F.col("title")).alias("t"))


@query("SELECT row_id, regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM tagged_signals")
def slugify(spark, sf):
    return signals(spark, sf).select("row_id", X.slugify(F.col("source")).alias("slug"))


_SLUG = "regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(
    f"SELECT row_id, left({_SLUG}, 32) || '_' || CASE WHEN coalesce(pub_date, '') IN ('', 'undated') THEN 'undated' ELSE left(regexp_replace(pub_date, '[^0-9]', '_', 'g'), 10) END || '_' || printf('%03d', seq) AS new_id FROM tagged_signals WHERE source IS NOT NULL"
)
def make_id(spark, sf):
    """Ids from source, date and place in the file."""
    return signals(spark, sf).where("source is not null").select("row_id", X.make_id(F.col("source"), F.col("pub_date"), F.col("seq")).alias("new_id"))


@query("SELECT coalesce(run_date, '') AS run, coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n FROM tagged_signals GROUP BY ALL")
def need_history(spark, sf):
    return C.need_history(signals(spark, sf))


_HISTORY = "h AS (SELECT coalesce(run_date, '') AS run, coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n FROM tagged_signals GROUP BY ALL), s AS (SELECT run, need, n, n / sum(n) OVER (PARTITION BY run) AS share FROM h)"


@query(f"WITH {_HISTORY} SELECT run, need, round(share, 6) AS share FROM s")
def need_share_by_run(spark, sf):
    return C.shares(C.need_history(signals(spark, sf)), ["run"]).select("run", "need", F.round("share", 6).alias("share"))


@query(f"WITH {_HISTORY} SELECT need, n, round(share, 6) AS share, share > 0.2 AS over FROM (SELECT need, n, n / sum(n) OVER () AS share FROM (SELECT need, sum(n)::BIGINT AS n FROM h GROUP BY need))")
def need_balance(spark, sf):
    """Shares of the needs over all runs, with those above a fifth marked."""
    total = C.need_history(signals(spark, sf)).groupBy("need").agg(F.sum("n").alias("n"))
    return C.shares(total, []).select("need", "n", F.round("share", 6).alias("share"), (F.col("share") > 0.2).alias("over"))


@query(f"WITH {_HISTORY} SELECT run, need, round(share - lag(share) OVER (PARTITION BY need ORDER BY run), 6) AS drift FROM s")
def need_drift(spark, sf):
    """Change of each need's share against its run before; extension."""
    w = Window.partitionBy("need").orderBy("run")  # one row a run
    return C.shares(C.need_history(signals(spark, sf)), ["run"]).select("run", "need", F.round(F.col("share") - F.lag("share").over(w), 6).alias("drift"))


@query(f"WITH {_HISTORY} SELECT run, need, round(share, 6) AS share FROM s WHERE (SELECT count(DISTINCT run) FROM h) >= 3")
def pulse_series(spark, sf):
    """Shares over time, only once there are three runs."""
    s = C.shares(C.need_history(signals(spark, sf)), ["run"])
    gate = s.agg(F.count_distinct("run").alias("_runs"))
    return s.crossJoin(F.broadcast(gate)).where("_runs >= 3").select("run", "need", F.round("share", 6).alias("share"))  # one row


@query("SELECT row_id FROM tagged_signals WHERE run_date IS NOT NULL AND file_name IS NOT NULL UNION SELECT row_id FROM tagged_signals WHERE run_date IS NULL")
def union_runs(spark, sf):
    """Runs put together again: dated ones, then the undated."""
    t = signals(spark, sf)
    return t.where("run_date is not null and file_name is not null").select("row_id").unionByName(t.where("run_date is null").select("row_id")).distinct()


@query("SELECT DISTINCT source FROM tagged_signals WHERE source IS NOT NULL EXCEPT SELECT name FROM sources")
def except_subset(spark, sf):
    return signals(spark, sf).select("source").where("source is not null").distinct().join(table(spark, sf, "sources").select(F.col("name").alias("source")), "source", "left_anti")


_FOLD = f"""n AS (SELECT row_id, coalesce(nullif({s_norm_url()}, ''), coalesce(id, '')) AS grp, {s_norm_title()} AS t, coalesce(run_date, '') AS r, coalesce(file_name, '') AS f FROM tagged_signals),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY r, f, row_id) AS i FROM n),
fold AS (SELECT grp, i, row_id, [t] AS titles, 1::BIGINT AS slot FROM o WHERE i = 1
  UNION ALL SELECT grp, i, row_id, CASE WHEN s IS NULL THEN list_append(titles, t) ELSE list_transform(titles, lambda x, j: CASE WHEN j = s THEN t ELSE x END) END, coalesce(s, len(titles) + 1) FROM
  (SELECT o.grp, o.i, o.row_id, o.t, p.titles, list_filter(range(1, len(p.titles) + 1), lambda j: starts_with(p.titles[j], o.t) OR starts_with(o.t, p.titles[j]) OR list_has_all(string_split(p.titles[j], ' '), string_split(o.t, ' ')) OR list_has_all(string_split(o.t, ' '), string_split(p.titles[j], ' ')))[1] AS s
   FROM fold p JOIN o ON o.grp = p.grp AND o.i = p.i + 1)),
m AS (SELECT fold.grp, slot, i, t.* FROM fold JOIN tagged_signals t USING (row_id))"""


@query(
    f"""WITH RECURSIVE {_FOLD} SELECT arg_max(row_id, i) AS row_id, arg_max(ROW(id), i)[1] AS id, arg_max(ROW(source), i)[1] AS source, arg_max(category, i) FILTER (WHERE category <> '') AS category, arg_max(ROW(title), i)[1] AS title, arg_max(ROW(url), i)[1] AS url, arg_max(ROW(pub_date), i)[1] AS date,
arg_max(ROW(summary), i)[1] AS summary, arg_max(ROW(forward_looking), i)[1] AS forward_looking, arg_max(tier, i) FILTER (WHERE tier <> '') AS tier, arg_max(ROW(need), i)[1] AS need, list_sort(list_distinct(list(coalesce(run_date, '')))) AS _runs, min(coalesce(run_date, '')) AS _first_seen, min(row_id) AS _first_key, count(*) AS n_records FROM m GROUP BY grp, slot"""
)
def corpus_merge(spark, sf):
    """The ordered fuzzy merge of all runs: each step depends on what the one before replaced."""
    t = signals(spark, sf).withColumnRenamed("pub_date", "date")
    merged = C.merge_corpus(t)
    keep = ["row_id", "id", "source", "category", "title", "url", "date", "summary", "forward_looking", "tier", "need", "_runs", "_first_seen", "_first_key", "n_records"]
    return merged.select(*keep)


_EXACT = f"""g AS (SELECT *, coalesce(nullif({s_norm_url()}, ''), coalesce(id, '')) AS grp, {s_norm_title()} AS t, row_number() OVER (PARTITION BY coalesce(nullif({s_norm_url()}, ''), coalesce(id, '')), {s_norm_title()} ORDER BY coalesce(run_date, '') DESC, coalesce(file_name, '') DESC, row_id DESC) AS age FROM tagged_signals)"""


@query(
    f"""WITH {_EXACT}, c AS (SELECT grp, t, category FROM g WHERE category <> '' QUALIFY row_number() OVER (PARTITION BY grp, t ORDER BY age) = 1), r AS (SELECT grp, t, tier FROM g WHERE tier <> '' QUALIFY row_number() OVER (PARTITION BY grp, t ORDER BY age) = 1),
a AS (SELECT grp, t, count(*) AS n, count(DISTINCT coalesce(run_date, '')) AS runs, min(coalesce(run_date, '')) AS first_seen FROM g GROUP BY ALL)
SELECT g.row_id, a.n, a.runs, a.first_seen, c.category, r.tier, g.summary FROM g JOIN a USING (grp, t) LEFT JOIN c USING (grp, t) LEFT JOIN r USING (grp, t) WHERE g.age = 1"""
)
def corpus_merge_exact(spark, sf):
    """The merge where equal normalised titles are the same: aggregates that combine before the shuffle."""
    t = signals(spark, sf).withColumn("grp", X.or_else(X.norm_url(F.col("url")), F.coalesce("id", F.lit("")))).withColumn("t", X.norm_title(F.col("title")))
    when = F.struct(F.coalesce("run_date", F.lit("")), F.coalesce("file_name", F.lit("")), "row_id")
    run = F.coalesce("run_date", F.lit(""))
    last = {c: F.max_by(F.nullif(c, F.lit("")), F.when(F.nullif(c, F.lit("")).isNotNull(), when)).alias(c) for c in ("category", "tier")}
    a = t.groupBy("grp", "t").agg(F.max_by(F.struct("row_id", "summary"), when).alias("_n"), F.count(F.lit(1)).alias("n"), F.size(F.collect_set(run)).cast("long").alias("runs"), F.min(run).alias("first_seen"), *last.values())
    return a.select("_n.row_id", "n", "runs", "first_seen", "category", "tier", "_n.summary")


@query(
    f"""WITH {_EXACT}, a AS (SELECT grp, t, min(coalesce(run_date, '')) AS first_seen, max(CASE WHEN age = 1 THEN coalesce(source, '') END) AS source, min(row_id) AS first_row FROM g GROUP BY ALL)
SELECT first_row, row_number() OVER (ORDER BY first_seen, source, first_row) AS ord FROM a"""
)
def corpus_order(spark, sf):
    """The corpus' order: first run, source, first arrival. Numbered over range partitions, not in one task."""
    t = signals(spark, sf).withColumn("grp", X.or_else(X.norm_url(F.col("url")), F.coalesce("id", F.lit("")))).withColumn("t", X.norm_title(F.col("title")))
    run = F.coalesce("run_date", F.lit(""))
    when = F.struct(run, F.coalesce("file_name", F.lit("")), "row_id")
    a = t.groupBy("grp", "t").agg(F.min(run).alias("first_seen"), F.max_by(F.coalesce("source", F.lit("")), when).alias("source"), F.min("row_id").alias("first_row"))
    part = a.repartitionByRange("first_seen", "source", "first_row").withColumn("_p", F.spark_partition_id())
    from corpusloom.runtime import cut

    placed = cut(part)
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = placed.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy("first_seen", "source", "first_row")))
    return within.join(F.broadcast(sizes.select("_p", "_before")), "_p").select("first_row", (F.col("_before") + F.col("_i")).alias("ord"))  # one row a partition


@query("SELECT count(*) AS n, count(*) FILTER (WHERE len(_runs) > 1) AS several_runs, count(*) FILTER (WHERE forward_looking) AS forward, max(_first_seen) AS newest FROM corpus")
def corpus_stats(spark, sf):
    c = table(spark, sf, "corpus")
    return c.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("_runs") > 1).alias("several_runs"), F.count_if("forward_looking").alias("forward"), F.max("_first_seen").alias("newest"))


@query("SELECT ord, id, source, category, title, url, pub_date, summary, forward_looking, tier, need, _runs, _first_seen, nullif(vec, '') AS vec FROM corpus")
def site_projection(spark, sf):
    """The columns that a site shows; an empty vector is left out."""
    return table(spark, sf, "corpus").select("ord", "id", "source", "category", "title", "url", "pub_date", "summary", "forward_looking", "tier", "need", "_runs", "_first_seen", F.nullif("vec", F.lit("")).alias("vec"))


@query("SELECT c.ord, s.category AS source_category, s.base_url FROM corpus c LEFT JOIN sources s ON s.name = c.source")
def provenance_join(spark, sf):
    """Each record with its source's facts, or nulls; the side is broadcast only if it is small."""
    from corpusloom.runtime import broadcast_if_small

    s = broadcast_if_small(table(spark, sf, "sources").select("name", F.col("category").alias("source_category"), "base_url"))
    c = table(spark, sf, "corpus")
    return c.join(s, c["source"] == s["name"], "left").select("ord", "source_category", "base_url")


@query("SELECT category, coalesce(fetchable, true) AS fetchable, count(*) AS n FROM sources GROUP BY ALL")
def provenance_counts(spark, sf):
    """Sources by category and access; extension."""
    return table(spark, sf, "sources").groupBy("category", F.coalesce("fetchable", F.lit(True)).alias("fetchable")).agg(F.count(F.lit(1)).alias("n"))


#: Needs and their colours: fixed values.
NEED_COLOURS = {"Naming the Machine": "#d671a8", "Settling Accounts": "#a884d6", "Self-Authorship": "#5b86d6", "Certified Human": "#d9a84e", "Kinship": "#3f9d96", "Appetite": "#e0654a", "Ballast": "#7fb069", "unsettled": "#8f9092"}
NO_COLOUR = "#8f9092"


@query(f"SELECT ord, coalesce(m.colour, '{NO_COLOUR}') AS colour FROM corpus c LEFT JOIN (VALUES {', '.join(f'({s_list([k, v])})' for k, v in NEED_COLOURS.items())}) m(need, colour) ON m.need = coalesce(nullif(c.need, ''), 'unsettled')")
def need_meta_join(spark, sf):
    """The need's colour, grey for an unknown one."""
    meta = spark.createDataFrame(list(NEED_COLOURS.items()), "need string, colour string")
    c = table(spark, sf, "corpus").select("ord", X.or_else(F.col("need"), F.lit("unsettled")).alias("need"))
    return c.join(F.broadcast(meta), "need", "left").select("ord", F.coalesce("colour", F.lit(NO_COLOUR)).alias("colour"))  # eight rows


_LUMINANCE = "((0.299 * ('0x' || substr(colour, 2, 2))::INT + 0.587 * ('0x' || substr(colour, 4, 2))::INT + 0.114 * ('0x' || substr(colour, 6, 2))::INT) / 255)"


@query(f"SELECT need, round({_LUMINANCE}, 6) AS luminance, {_LUMINANCE} > 0.62 AS light FROM (VALUES {', '.join(f'({s_list([k, v])})' for k, v in NEED_COLOURS.items())}) m(need, colour)")
def luminance(spark, sf):
    value = X.luminance(F.col("colour"))
    return spark.createDataFrame(list(NEED_COLOURS.items()), "need string, colour string").select("need", F.round(value, 6).alias("luminance"), (value > 0.62).alias("light"))


@query("SELECT id, arg_max(row_id, row_id) AS row_id, arg_max(need, row_id) AS need FROM tagged_signals WHERE need IS NOT NULL GROUP BY id")
def codes_latest(spark, sf):
    """The later record overwrites the earlier of the same key."""
    return S.latest_by_key(signals(spark, sf).where("need is not null").select("id", "row_id", "need"), "id", ["row_id"])


@query("SELECT arg_max(file_name, ingested_at::VARCHAR || file_name) AS file_name FROM tagged_signals WHERE ingested_at IS NOT NULL")
def newest_file(spark, sf):
    return signals(spark, sf).where("ingested_at is not null").agg(F.max_by("file_name", F.struct("ingested_at", "file_name")).alias("file_name"))


@query("SELECT row_id FROM tagged_signals WHERE ingested_at < TIMESTAMP '2026-07-17' - INTERVAL 180 DAY")
def retention_filter(spark, sf):
    """What is older than 180 days at a given day."""
    return signals(spark, sf).where(F.col("ingested_at") < F.lit("2026-07-17").cast("timestamp_ntz") - F.expr("INTERVAL 180 DAYS")).select("row_id")


@query("SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) AS i FROM tagged_signals) WHERE i % 7 = 0")
def systematic_sample(spark, sf):
    """Every seventh record of the order of arrival, which is numbered without gaps."""
    return signals(spark, sf).where("row_id % 7 = 0").select("row_id") if _dense(spark, sf) else _ranked(spark, sf)


def _dense(spark, sf) -> bool:
    r = signals(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.max("row_id").alias("hi"), F.min("row_id").alias("lo")).first()
    return r.n == 0 or (r.lo == 1 and r.hi == r.n)


def _ranked(spark, sf) -> DataFrame:
    from corpusloom.runtime import cut

    placed = cut(signals(spark, sf).select("row_id").repartitionByRange("row_id").withColumn("_p", F.spark_partition_id()))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    i = F.row_number().over(Window.partitionBy("_p").orderBy("row_id"))
    return placed.withColumn("_i", i).join(F.broadcast(sizes.select("_p", "_before")), "_p").where("(_before + _i) % 7 = 0").select("row_id")  # one row a partition


@query("SELECT coalesce(nullif(fit_confidence, ''), 'none') AS grade, count(*) AS n, round(count(*) / (SELECT count(*) FROM tagged_signals), 6) AS share FROM tagged_signals GROUP BY ALL")
def grade_coverage(spark, sf):
    """Shares of the grades; extension."""
    n = signals(spark, sf).groupBy(X.or_else(F.col("fit_confidence"), F.lit("none")).alias("grade")).agg(F.count(F.lit(1)).alias("n"))
    return C.shares(n, []).withColumn("share", F.round("share", 6))


@query()
def p5_found(spark, sf):
    """Each change of a file against the one before it in its feed."""
    return schema_drift.changes(table(spark, sf, "raw_records"))


@query()
def p5_consistent(spark, sf):
    """All raw records in one table under consistent names."""
    return schema_drift.consistent_table(table(spark, sf, "raw_records"))
