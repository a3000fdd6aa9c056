"""Curated tables, code history, digests, scraping, embedding, sinks: queries and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import vectors as V
from corpusloom.operators import curation as K
from corpusloom.operators import embedding as E
from corpusloom.operators import planes as P
from corpusloom.runtime import shared_dir, table
from corpusloom.sources import signals as S
from corpusloom.sources import sinks

from .registry import query, s_list

#: Curated side tables of the examples; every operator takes another one.
CODES = {"Home Craft": ("hand-made", "emergent"), "Grief Ritual": ("open mourning", "dominant")}
AXES = {"Home Craft": ("private", "public"), "Memory Archive": ("kept", "lost")}
NOTES = {"2026-07-17": "first run with tiers", "2026-06-22": "late sources added"}


def _values(rows) -> str:
    return ", ".join("(" + s_list(r) + ")" for r in rows)


def _needs(spark, sf):
    return table(spark, sf, "corpus").groupBy(X.or_else(F.col("need"), F.lit("unsettled")).alias("need")).agg(F.count(F.lit(1)).alias("n"))


_NEEDS = "n AS (SELECT coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n FROM corpus GROUP BY ALL)"


@query(f"WITH {_NEEDS} SELECT need, n, code, status FROM n LEFT JOIN (VALUES {_values((k, *v) for k, v in CODES.items())}) c(need, code, status) USING (need)")
def need_code_join(spark, sf):
    """Needs with their curated code; null where there is none."""
    codes = spark.createDataFrame([(k, *v) for k, v in CODES.items()], "need string, code string, status string")
    return K.with_default(_needs(spark, sf), codes, "need", {})


@query(f"WITH {_NEEDS} SELECT need, n, coalesce(low, '') AS low, coalesce(high, '') AS high FROM n LEFT JOIN (VALUES {_values((k, *v) for k, v in AXES.items())}) c(need, low, high) USING (need)")
def need_axes_join(spark, sf):
    """Needs with the poles of their axis; blank where there are none."""
    axes = spark.createDataFrame([(k, *v) for k, v in AXES.items()], "need string, low string, high string")
    return K.with_default(_needs(spark, sf), axes, "need", {"low": "", "high": ""})


@query(f"WITH r AS (SELECT coalesce(run_date, '') AS run, count(*) AS n FROM tagged_signals GROUP BY ALL) SELECT run, n, coalesce(note, '') AS note FROM r LEFT JOIN (VALUES {_values(NOTES.items())}) c(run, note) USING (run)")
def run_note_join(spark, sf):
    """Runs with their note; blank where there is none."""
    runs = table(spark, sf, "tagged_signals").groupBy(F.coalesce("run_date", F.lit("")).alias("run")).agg(F.count(F.lit(1)).alias("n"))
    return K.with_default(runs, spark.createDataFrame(list(NOTES.items()), "run string, note string"), "run", {"note": ""})


@query("SELECT sum(length(name)) AS tokens_in, sum(length(base_url)) FILTER (WHERE coalesce(fetchable, true)) AS tokens_out, count(*) FILTER (WHERE NOT coalesce(fetchable, true) OR base_url IS NULL) AS failed FROM (SELECT CASE WHEN coalesce(fetchable, true) AND base_url IS NOT NULL THEN name END AS name, base_url, fetchable FROM sources)")
def token_usage(spark, sf):
    """Tokens of a harvest through an injected model, which here answers with the address and fails on unfetchable sources."""
    sources = table(spark, sf, "sources").select("name", F.when(F.coalesce("fetchable", F.lit(True)), F.col("base_url")).alias("base_url"))

    def ask(name, url):
        return url, len(name), len(url)  # fails without an address

    return K.token_usage(K.harvested(sources, ask))


@query("WITH c AS (SELECT DISTINCT need, category, source FROM corpus WHERE need IS NOT NULL AND category IS NOT NULL) SELECT (SELECT count(*) FROM (SELECT DISTINCT need, category FROM c)) AS codes, count(DISTINCT need) AS needs, count(source) AS evidence, count(DISTINCT source) AS sources FROM c")
def codes_statline(spark, sf):
    """Codes (categories of a need), needs, pieces of evidence and their sources."""
    c = table(spark, sf, "corpus").where("need is not null and category is not null")
    codes = c.groupBy("need", F.col("category").alias("code")).agg(F.collect_set("source").alias("evidence"))  # at most as many as there are sources
    return K.statline(codes)


_STATES = "s AS (SELECT source AS code, run_date AS run, max(lower(trim(tier))) AS status FROM tagged_signals WHERE source IS NOT NULL AND run_date IS NOT NULL GROUP BY ALL)"


@query(
    f"WITH {_STATES} SELECT code, run, CASE WHEN row_number() OVER w = 1 THEN 'propose' WHEN status IS DISTINCT FROM lag(status) OVER w THEN 'move' ELSE 'append' END AS change, lag(status) OVER w AS before, status, "
    "lead(run) OVER w IS NULL AND run < (SELECT max(run) FROM s) AS retired FROM s WINDOW w AS (PARTITION BY code ORDER BY run)"
)
def code_changes(spark, sf):
    """What each run does to the status of a code (here: a source's highest tier); extension."""
    t = table(spark, sf, "tagged_signals").where("source is not null and run_date is not null")
    states = t.groupBy(F.col("source").alias("code"), F.col("run_date").alias("run")).agg(F.max(F.lower(F.trim("tier"))).alias("status"))
    return K.code_changes(states, "code", "run", "status")


_FLAT = r"trim(regexp_replace(coalesce(summary, ''), '[\s\p{Z}]+', ' ', 'g'))"


@query(
    f"SELECT ord, array_to_string(list_transform(_runs, lambda r: substr(r, 6)), '+') AS runs, CASE WHEN length(t) <= 220 THEN t WHEN substr(t, 215, 1) = ' ' THEN left(t, 214) || ' [...]' WHEN contains(left(t, 215), ' ') THEN regexp_extract(left(t, 215), '(?s)^(.*) ', 1) || ' [...]' ELSE '[...]' END AS shown, coalesce(category, '—') AS category FROM (SELECT *, {_FLAT} AS t FROM corpus)"
)
def display_rows(spark, sf):
    """What a list of hits shows: runs by month and day, the summary cut at a word, a dash for no category."""
    c = table(spark, sf, "corpus")
    return c.select("ord", K.run_badge(F.col("_runs")).alias("runs"), K.shortened(F.col("summary")).alias("shown"), F.coalesce("category", F.lit("—")).alias("category"))


@query("""SELECT ord, to_json({'ord': ord, 'title': title, 'need': need, 'forward_looking': forward_looking, '_runs': _runs}) AS line FROM corpus""")
def json_lines(spark, sf):
    """Records as JSON: nulls kept, letters as they are."""
    return table(spark, sf, "corpus").select("ord", sinks.as_json("ord", "title", "need", "forward_looking", "_runs").alias("line"))


@query("SELECT ord, id, title, vec FROM corpus")
def json_sink(spark, sf):
    """The corpus written as JSON files in order, and read again."""
    path = f"{shared_dir(spark).rstrip('/')}/json-{uuid.uuid4().hex}"
    sinks.write_json(table(spark, sf, "corpus").select("ord", "id", "title", "vec"), path, ["ord"])
    return spark.read.schema("ord long, id string, title string, vec string").json(path)


@query(r"SELECT regexp_replace(url, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS url, 'N' AS need FROM articles WHERE starts_with(regexp_replace(url, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), 'http') AND article_id % 7 <> 0")
def urls_file_scan(spark, sf):
    """Urls of a text file with blank and commented lines."""
    a = table(spark, sf, "articles").where("url is not null")
    path = f"{shared_dir(spark).rstrip('/')}/urls-{uuid.uuid4().hex}"
    a.select(F.explode(F.array(F.lit(""), F.concat(F.when(F.col("article_id") % 7 == 0, "# ").otherwise("  "), "url", F.lit(" ")))).alias("value")).write.text(path)
    return S.scan_url_list(spark, path, "N")


def _source_file(spark, sf) -> str:
    """The sources as one YAML file in the shared folder."""
    t = table(spark, sf, "sources")
    quoted = lambda c: F.when(F.col(c).isNull(), "null").otherwise(F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"'), F.lit('"')))
    flag = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    lines = [F.concat(F.lit("  - name: "), quoted("name"))]
    lines += [F.concat(F.lit(f"    {c}: "), quoted(c)) for c in ("category", "base_url", "recent_url", "exhibitions_url", "note")]
    lines += [F.concat(F.lit(f"    {c}: "), flag(c)) for c in ("fetchable", "semiotic_only", "recent_url_uncertain")]
    path = f"{shared_dir(spark).rstrip('/')}/sources-{uuid.uuid4().hex}"
    entries = t.orderBy("name").agg(F.array_join(F.collect_list(F.concat_ws("\n", *lines)), "\n").alias("e"))  # a curated list
    entries.select(F.concat(F.lit("range_days: 90\ncategories:\n  art: x\nsources:\n"), "e", F.lit("\nother: 1\n")).alias("value")).coalesce(1).write.text(path)
    return path


@query("SELECT * FROM sources")
def scan_sources(spark, sf):
    """The source list through its YAML file."""
    return S.scan_sources(spark, _source_file(spark, sf))


@query("SELECT name, category, base_url FROM sources WHERE NOT coalesce(semiotic_only, false)")
def field_guide_lines(spark, sf):
    """The field guide's sources through the line reader."""
    return S.scan_field_guide(spark, _source_file(spark, sf))


@query("SELECT name, image_id, article_id FROM (SELECT left(sha1(image_url), 16) AS name, image_id, article_id, row_number() OVER (PARTITION BY left(sha1(image_url), 16) ORDER BY article_id % 2, image_id) AS r FROM article_images WHERE image_url IS NOT NULL) WHERE r = 1")
def manifest_upsert(spark, sf):
    """Images of even articles are in the manifest; those of the others are added unless their file name is there."""
    i = table(spark, sf, "article_images").where("image_url is not null").select(F.left(F.sha1("image_url"), F.lit(16)).alias("name"), "image_id", "article_id")
    from corpusloom.operators.worklist import first_of

    even = first_of(i.where("article_id % 2 = 0"), F.col("name"), "image_id")
    return K.manifest_upsert(even, i.where("article_id % 2 = 1"), "name", "image_id")


@query(
    """WITH w AS (SELECT min(article_id) AS ord, url FROM articles WHERE url IS NOT NULL GROUP BY url), l AS (SELECT DISTINCT url FROM articles WHERE article_id % 10 = 0 AND url IS NOT NULL),
n AS (SELECT article_id AS ord, count(*) AS found FROM article_images GROUP BY ALL), c AS (SELECT ord, url, coalesce(found, 0) AS images_found, least(coalesce(found, 0), 3) AS images_kept FROM w LEFT JOIN n USING (ord) WHERE url NOT IN (SELECT url FROM l)),
s AS (SELECT *, sum(images_kept) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) - images_kept AS before FROM c) SELECT ord, url, images_found, images_kept, 'static' AS fetch_method FROM s WHERE before < 100"""
)
def scrape_batch(spark, sf):
    """A batch of pages that are built from the tables: once each, without the ledger's, three images a page, until there are 100."""
    a = table(spark, sf, "articles").where("url is not null")
    ledger = f"{shared_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    a.where("article_id % 10 = 0").select("url", F.lit("static").alias("method"), F.lit(0).cast("long").alias("images")).distinct().write.parquet(ledger)
    n = table(spark, sf, "article_images").groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    # the page's number and its images travel in the url, as the fetcher is a plain function
    told = a.groupBy("url").agg(F.min("article_id").alias("article_id")).join(n, "article_id", "left")
    work = told.select(F.col("article_id").alias("ord"), F.concat("url", F.lit("#pictures="), F.coalesce("n", F.lit(0)).cast("string")).alias("url"))
    held = spark.read.parquet(ledger)
    work = work.join(held.select("url"), F.substring_index(work["url"], "#pictures=", 1) == held["url"], "left_anti")

    def fetch(url):
        count = int(url.rpartition("#pictures=")[2])
        body = "<title>T</title><article><p>" + "A page of the tables. " * 30 + "</p>" + "".join(f'<img src="/p{i}.jpg">' for i in range(count)) + "</article>"
        return 200, "text/html", body

    articles, _ = K.scrape_batch(work, None, fetch, cap=3, target=100)
    return articles.select("ord", F.substring_index("url", "#pictures=", 1).alias("url"), "images_found", "images_kept", "fetch_method")


@query("SELECT ord FROM corpus WHERE _first_seen = (SELECT max(_first_seen) FROM corpus) ORDER BY CASE WHEN tier = 'core' THEN 0 ELSE 1 END, CASE WHEN forward_looking THEN 0 ELSE 1 END, pub_date DESC NULLS LAST, ord LIMIT 5")
def monthly_digest(spark, sf):
    """Five records of the latest run to tell about; extension."""
    return K.digest(table(spark, sf, "corpus")).select("ord")


@query("WITH n AS (SELECT coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n FROM corpus WHERE contains(lower(coalesce(title, '') || ' ' || coalesce(summary, '')), 'garden') GROUP BY ALL) SELECT need, n, round(n / (SELECT sum(n) FROM n), 6) AS share FROM n")
def topic_shares(spark, sf):
    """Shares of the needs within the records about a topic; extension."""
    text = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit(""))))
    return K.topic_shares(table(spark, sf, "corpus"), F.contains(text, F.lit("garden"))).withColumn("share", F.round("share", 6))


@query("SELECT CASE WHEN lower(fit_confidence) IN ('high', 'medium') THEN coalesce(nullif(recommended_substrate, ''), 'unsettled') ELSE 'unsettled' END AS pool, count(*) AS n FROM corpus GROUP BY ALL")
def tagging_gate(spark, sf):
    """Records by the pool that their fit puts them in; extension."""
    return table(spark, sf, "corpus").groupBy(K.tagging_gate(None).alias("pool")).agg(F.count(F.lit(1)).alias("n"))


_GROUPS = "g AS (SELECT coalesce(nullif(need, ''), 'unsettled') AS need, ord % 4 AS cluster, avg(ord % 97) AS x, avg(ord % 89) AS y, count(*) AS n FROM corpus GROUP BY ALL)"


@query(
    f"""WITH {_GROUPS}, m AS (SELECT need, avg(x) AS mx, avg(y) AS my, max(least(30, 9 + 3 * sqrt(n))) AS top FROM g GROUP BY need),
s AS (SELECT need, max(abs(x - mx)) AS sx, max(abs(y - my)) AS sy FROM g JOIN m USING (need) GROUP BY need)
SELECT need, cluster, round(290 + (x - mx) * (212 - top - 10) / CASE WHEN sx = 0 THEN 1 ELSE sx END, 3) AS px, round(216 - (y - my) * (168 - top - 22) / CASE WHEN sy = 0 THEN 1 ELSE sy END, 3) AS py, round(least(30, 9 + 3 * sqrt(n)), 3) AS r FROM g JOIN m USING (need) JOIN s USING (need)"""
)
def plane_geometry(spark, sf):
    """Where groups stand on their need's picture, each axis scaled by itself; the groups are made of the ids."""
    c = table(spark, sf, "corpus").groupBy(X.or_else(F.col("need"), F.lit("unsettled")).alias("need"), (F.col("ord") % 4).alias("cluster"))
    groups = c.agg(F.avg(F.col("ord") % 97).alias("x"), F.avg(F.col("ord") % 89).alias("y"), F.count(F.lit(1)).alias("n")).withColumn("label", F.lit("l"))
    placed = P.geometry(groups)
    return placed.select("need", "cluster", *[F.round(k, 3).alias(k) for k in ("px", "py", "r")])


@query()
def range_pictures(spark, sf):
    """One SVG for each need with a plane."""
    from .planes import semantic_range

    found = semantic_range(spark, sf)
    return P.pictures(found, AXES and {k: (v, ("", "")) for k, v in AXES.items()})


@query()
def embed_corpus(spark, sf):
    """Vectors of the corpus by a deterministic encoder: hash, cache, encode, axes, quantise."""
    cache = f"{shared_dir(spark).rstrip('/')}/embeddings-{uuid.uuid4().hex}"
    made, _ = E.embedded(table(spark, sf, "corpus"), cache, E.hash_encoder(32), dims=16)
    return made


@query()
def result_clusters(spark, sf):
    """The matches of a query grouped by their vectors; extension."""
    return K.result_clusters(table(spark, sf, "corpus"), "garden memory archive")


@query(
    "SELECT vec_id, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::DOUBLE / 0.03, 0)))::INT) AS q FROM embeddings"
)
def vector_text_roundtrip(spark, sf):
    """Quantised vectors through their base64 form."""
    e = table(spark, sf, "embeddings").select("vec_id", V.encode_bytes(V.quantize(F.col("embedding"), F.lit(0.03))).alias("t"))
    return e.select("vec_id", V.decode_bytes(F.col("t")).alias("q"))


