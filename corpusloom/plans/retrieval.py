"""Search, browsing, worklists, dates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import search as R
from corpusloom.operators import worklist as W
from corpusloom.runtime import persisted, table

from .registry import query, s_date, s_list, s_path, s_strip, s_words

QUERY = "home craft memory grief body"
NOW = "2026-07-17"
NEED = "Certified Human"


def corpus(spark, sf):
    return table(spark, sf, "corpus")


def _terms_sql(text: str) -> str:
    return ", ".join(f"({s_list([t])}, {w}, {s_list([p])})" for t, w, p in R.expand(X.query_terms(text), R.SYNONYMS))


def _match_sql(w: str = "word", t: str = "term") -> str:
    ok = lambda a, b: f"(length({a}) - length({b}) <= 2 OR substr({a}, length({b}) + 1) IN ({s_list(X.ENDINGS)}))"
    return (
        f"({w} = {t} OR ({t} NOT IN ({s_list(X.SHORT_TERMS)}) AND CASE WHEN length({t}) >= 4 AND starts_with({w}, {t}) THEN {ok(w, t)} "
        f"WHEN length({w}) >= 4 AND starts_with({t}, {w}) THEN {ok(t, w)} ELSE false END))"
    )


_FIELD_WORDS = " UNION ALL ".join(f"SELECT ord, {w} AS fw, unnest({s_words(f)}) AS word FROM corpus" for f, w in R.WEIGHTS.items())
_RUNS = "runs AS (SELECT list_sort(list(DISTINCT r)) AS runs FROM (SELECT unnest(_runs) AS r FROM corpus))"
_BOOSTS = """(1 + 0.5 * (parents - 1)) * CASE WHEN tier = 'core' THEN 1.2 ELSE 1.0 END * CASE WHEN len(_runs) > 1 THEN 1.1 ELSE 1.0 END
 * pow(0.92, CASE WHEN coalesce(list_position(runs, coalesce(_first_seen, '')), 0) = 0 THEN 0 ELSE len(runs) - list_position(runs, coalesce(_first_seen, '')) END)"""
_SCORED = f"""w AS ({_FIELD_WORDS}), t(term, tw, parent) AS (VALUES {_terms_sql(QUERY)}), {_RUNS},
hits AS (SELECT ord, sum(fw * tw) AS total, count(DISTINCT parent) AS parents FROM w JOIN t ON {_match_sql()} GROUP BY ord),
scored AS (SELECT c.*, total * {_BOOSTS} AS score FROM hits JOIN corpus c USING (ord) CROSS JOIN runs)"""


@query(f"WITH {_SCORED} SELECT ord, round(score, 6) AS score FROM scored WHERE score > 0")
def search_score(spark, sf):
    """The score of every record that the query matches."""
    return R.scored(corpus(spark, sf), QUERY).where("score > 0").select("ord", F.round("score", 6).alias("score"))


@query(f"WITH {_SCORED} SELECT ord, round(score, 6) AS score FROM (SELECT *, round(score, 9) AS s FROM scored WHERE score > 0) ORDER BY s DESC, len(_runs) DESC, ord LIMIT 25")
def search_topk(spark, sf):
    """The flagship: the 25 best records for a free-text query."""
    return R.search(corpus(spark, sf), QUERY).select("ord", F.round("score", 6).alias("score"))


@query(f"WITH {_SCORED} SELECT ord, round(score, 6) AS score FROM (SELECT *, round(score, 9) AS s FROM scored WHERE score > 0 AND lower(coalesce(nullif(need, ''), 'unsettled')) NOT IN ('kinship', 'unsettled')) ORDER BY s DESC, len(_runs) DESC, ord LIMIT 25")
def search_exclude(spark, sf):
    return R.search(corpus(spark, sf), QUERY, exclude=["Kinship", "Unsettled"]).select("ord", F.round("score", 6).alias("score"))


_MANY = ["home craft", "memory archive", "body fashion", "grief ritual"]


@query(
    f"""WITH w AS ({_FIELD_WORDS}), t(query, term, tw, parent) AS (VALUES {", ".join(f"({s_list([q, t])}, {w}, {s_list([p])})" for q in _MANY for t, w, p in R.expand(X.query_terms(q), R.SYNONYMS))}), {_RUNS},
hits AS (SELECT query, ord, sum(fw * tw) AS total, count(DISTINCT parent) AS parents FROM w JOIN t ON {_match_sql()} GROUP BY query, ord)
SELECT query, ord, round(total * {_BOOSTS}, 6) AS score FROM hits JOIN corpus c USING (ord) CROSS JOIN runs"""
)
def search_bulk(spark, sf):
    """Several queries at once, by the blocked join of words and terms."""
    rows = [(q, t, w, p) for q in _MANY for t, w, p in R.expand(X.query_terms(q), R.SYNONYMS)]
    return R.search_many(corpus(spark, sf), spark.createDataFrame(rows, "query string, term string, weight double, parent string")).select("query", "ord", F.round("score", 6).alias("score"))


@query(f"SELECT * FROM (VALUES {_terms_sql(QUERY)}) t(term, weight, parent)")
def query_expand(spark, sf):
    typed = spark.createDataFrame([(t,) for t in X.query_terms(QUERY)], "parent string")
    synonyms = spark.createDataFrame([(k, v) for k, v in R.SYNONYMS.items()], "parent string, synonyms array<string>")
    more = typed.join(F.broadcast(synonyms), "parent").select(F.explode("synonyms").alias("term"), F.lit(0.5).alias("weight"), "parent")  # the curated map
    return typed.select(F.col("parent").alias("term"), F.lit(1.0).alias("weight"), "parent").union(more)


_LEXICAL = f"""{_SCORED}, tok AS (SELECT DISTINCT ord, unnest(list_filter({s_words("coalesce(title, '') || ' ' || coalesce(summary, '')")}, lambda x: length(x) >= 3 AND x NOT IN ({s_list(X.ROLLUP_STOP)}))) AS term FROM corpus),
df AS (SELECT term, count(*) AS df FROM tok GROUP BY term), n AS (SELECT count(*) AS n FROM corpus),
m AS (SELECT ord FROM scored WHERE score > 0), mt AS (SELECT term, count(*) AS mdf FROM tok JOIN m USING (ord) GROUP BY term),
wt AS (SELECT term, ln((n + 1) / (df + 1)) * mdf / (SELECT count(*) FROM m) AS weight FROM mt JOIN df USING (term) CROSS JOIN n),
o AS (SELECT ord, sum(weight) AS overlap FROM tok JOIN wt USING (term) WHERE ord NOT IN (SELECT ord FROM m) GROUP BY ord)"""


@query(f"WITH {_LEXICAL} SELECT ord, round(pow(overlap / (SELECT max(overlap) FROM o), 2), 6) AS nearness FROM o WHERE pow(overlap / (SELECT max(overlap) FROM o), 2) > 0.25")
def lexical_neighbours(spark, sf):
    """Records near the matched ones by their words: idf weights of the matches' words, squared share of the nearest; extension."""
    c = corpus(spark, sf)
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))
    tok = persisted(c.select("ord", F.explode(F.array_distinct(X.label_words(text, X.ROLLUP_STOP))).alias("term")), "neighbour-words")
    matched = persisted(R.scored(c, QUERY).where("score > 0").select("ord"), "neighbour-matches")
    df = tok.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    sizes = c.agg(F.count(F.lit(1)).alias("n")).crossJoin(matched.agg(F.count(F.lit(1)).alias("m")))  # one row each
    weight = tok.join(matched, "ord", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("mdf")).join(df, "term").crossJoin(F.broadcast(sizes))
    weight = weight.select("term", (F.ln((F.col("n") + 1) / (F.col("df") + 1)) * F.col("mdf") / F.col("m")).alias("weight"))
    overlap = tok.join(matched, "ord", "left_anti").join(weight, "term").groupBy("ord").agg(F.sum("weight").alias("overlap"))
    top = overlap.agg(F.max("overlap").alias("_top"))
    near = F.pow(F.col("overlap") / F.col("_top"), F.lit(2.0))
    return overlap.crossJoin(F.broadcast(top)).where(near > 0.25).select("ord", F.round(near, 6).alias("nearness"))


@query("SELECT coalesce(nullif(category, ''), 'untagged') AS category, count(*) AS n FROM corpus GROUP BY ALL")
def browse_category(spark, sf):
    return R.browse(corpus(spark, sf), "category", "untagged")


@query("SELECT coalesce(nullif(need, ''), 'untagged') AS need, count(*) AS n FROM corpus GROUP BY ALL")
def browse_need(spark, sf):
    return R.browse(corpus(spark, sf), "need", "untagged")


@query("SELECT recommended_substrate, count(*) AS n FROM corpus GROUP BY ALL")
def browse_substrate(spark, sf):
    """Null is a value."""
    return R.browse(corpus(spark, sf), "recommended_substrate", None)


@query(f"SELECT row_id, {s_date()} AS day FROM tagged_signals")
def parse_signal_date(spark, sf):
    return table(spark, sf, "tagged_signals").select("row_id", X.parse_signal_date(F.col("pub_date")).alias("day"))


_AGE = f"date_diff('day', {s_date()}, DATE '{NOW}')"


@query(f"SELECT row_id, CASE WHEN {s_date()} IS NULL THEN 'unknown' WHEN {_AGE} < 45 THEN 'reuse' WHEN {_AGE} <= 90 THEN 'judgement' ELSE 'reharvest' END AS route FROM tagged_signals")
def freshness_bucket(spark, sf):
    return table(spark, sf, "tagged_signals").select("row_id", W.freshness(X.parse_signal_date(F.col("pub_date")), NOW).alias("route"))


_IS_ARTICLE = f"regexp_replace({s_path(s_strip(chr(99) + 'oalesce(url, ' + chr(39) * 2 + ')'))}, '/', '', 'g') <> ''"


@query(f"SELECT row_id FROM tagged_signals WHERE {_IS_ARTICLE}")
def article_url_filter(spark, sf):
    return table(spark, sf, "tagged_signals").where(X.is_article_url(F.col("url"))).select("row_id")


@query(
    f"SELECT ord FROM corpus WHERE need = '{NEED}' AND {_IS_ARTICLE} AND {s_date()} >= DATE '{NOW}' - INTERVAL 400 DAY "
    f"ORDER BY CASE WHEN tier = 'core' THEN 0 ELSE 1 END, CASE WHEN forward_looking THEN 0 ELSE 1 END, coalesce(-date_diff('day', DATE '1970-01-01', {s_date()}), 0), ord LIMIT 40"
)
def select_worklist(spark, sf):
    return W.select_worklist(corpus(spark, sf), NEED, NOW, days=400).select("ord")


@query("SELECT t.row_id FROM tagged_signals t WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM articles a WHERE a.url = t.url)")
def ledger_anti(spark, sf):
    """Records whose url has not been scraped."""
    t = table(spark, sf, "tagged_signals").where("url is not null")
    return W.not_in_ledger(t, table(spark, sf, "articles")).select("row_id")


@query("SELECT i.image_id FROM article_images i WHERE image_url IS NOT NULL AND image_id IN (SELECT min(image_id) FROM article_images WHERE image_url IS NOT NULL GROUP BY image_url)")
def download_worklist(spark, sf):
    """One download for each image url: the first writer stays."""
    return W.first_of(table(spark, sf, "article_images").where("image_url is not null").select("image_id", "image_url"), F.col("image_url"), "image_id").select("image_id")


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY image_id) AS r, count(*) OVER (PARTITION BY article_id) AS n_found FROM article_images) SELECT article_id, image_id, n_found FROM r WHERE r <= 15")
def cap_per_group(spark, sf):
    """At most 15 images of an article, with how many there were."""
    return W.cap_per_group(table(spark, sf, "article_images").select("article_id", "image_id"), ["article_id"], ["image_id"], 15).select("article_id", "image_id", "n_found")


@query(
    """WITH c AS (SELECT a.site, a.article_id, count(i.image_id) AS n FROM articles a LEFT JOIN article_images i USING (article_id) GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY site ORDER BY article_id ROWS UNBOUNDED PRECEDING) AS c FROM c) SELECT site, article_id, n FROM s WHERE c - n < 20"""
)
def cumulative_stop(spark, sf):
    """Articles of a site until 20 images are reached."""
    n = table(spark, sf, "article_images").groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    a = table(spark, sf, "articles").select("site", "article_id").join(n, "article_id", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    return W.cumulative_stop(a, "site", "n", ["article_id"], 20).select("site", "article_id", "n")


@query("WITH r AS (SELECT article_id, image_id, row_number() OVER (PARTITION BY article_id ORDER BY image_id) AS idx FROM article_images) SELECT article_id, image_id, idx, (idx - 1) // 12 + 1 AS sheet, (idx - 1) % 12 AS slot, (idx - 1) % 12 % 3 AS grid_col, (idx - 1) % 12 // 3 AS grid_row FROM r")
def sheet_paging(spark, sf):
    return W.numbered(table(spark, sf, "article_images").select("article_id", "image_id"), "article_id", "image_id")


@query("WITH r AS (SELECT image_id, alt, article_id, (row_number() OVER (PARTITION BY article_id ORDER BY image_id) - 1) // 12 + 1 AS sheet FROM article_images) SELECT r.image_id, r.sheet, a.url, a.title, r.alt FROM r JOIN articles a USING (article_id)")
def sidecar_lookup(spark, sf):
    """The article behind each numbered image."""
    n = W.numbered(table(spark, sf, "article_images").select("article_id", "image_id", "alt"), "article_id", "image_id")
    return n.join(table(spark, sf, "articles").select("article_id", "url", "title"), "article_id").select("image_id", "sheet", "url", "title", "alt")


@query(r"WITH d AS (SELECT article_id, url, regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\.', '') AS domain FROM articles) SELECT article_id, domain, 2 * (row_number() OVER (PARTITION BY domain ORDER BY article_id) - 1) AS start_s FROM d")
def rate_schedule(spark, sf):
    return W.rate_schedule(table(spark, sf, "articles").select("article_id", "url"), "url", "article_id").select("article_id", "domain", "start_s")


@query("SELECT ord FROM corpus WHERE _first_seen = (SELECT max(_first_seen) FROM corpus) ORDER BY pub_date DESC NULLS LAST, ord LIMIT 8")
def freshest_default(spark, sf):
    """Without a query: the eight freshest records of the latest run; extension."""
    c = corpus(spark, sf)
    last = c.agg(F.max("_first_seen").alias("_last"))
    return c.crossJoin(F.broadcast(last)).where("_first_seen = _last").orderBy(F.desc_nulls_last("pub_date"), "ord").limit(8).select("ord")  # one row


@query("WITH c AS (SELECT source, category, need, row_number() OVER (PARTITION BY need, source ORDER BY ord) AS r, ord FROM corpus WHERE need IS NOT NULL AND source IS NOT NULL) SELECT need, source, ord FROM c WHERE r <= 3")
def per_source_cap(spark, sf):
    """At most three records of a source for each need."""
    c = corpus(spark, sf).where("need is not null and source is not null").select("need", "source", "ord")
    return W.cap_per_group(c, ["need", "source"], ["ord"], 3).select("need", "source", "ord")


@query("SELECT need, source, greatest(count(*) - 3, 0) AS capped FROM corpus WHERE need IS NOT NULL AND source IS NOT NULL GROUP BY ALL")
def per_source_overflow(spark, sf):
    n = corpus(spark, sf).where("need is not null and source is not null").groupBy("need", "source").agg(F.count(F.lit(1)).alias("n"))
    return n.select("need", "source", F.greatest(F.col("n") - 3, F.lit(0)).alias("capped"))


@query("SELECT need, count(DISTINCT source) AS sources, count(DISTINCT category) AS categories, count(DISTINCT source) >= 4 AND count(DISTINCT category) >= 2 AS enough FROM corpus WHERE need IS NOT NULL GROUP BY need")
def code_coverage_gate(spark, sf):
    """Whether evidence comes from four sources and two categories."""
    sides = corpus(spark, sf).where("need is not null").groupBy("need").agg(F.count_distinct("source").alias("sources"), F.count_distinct("category").alias("categories"))
    return sides.withColumn("enough", (F.col("sources") >= 4) & (F.col("categories") >= 2))


@query("WITH h AS (SELECT source, coalesce(run_date, '') AS run, max(tier) AS status FROM tagged_signals WHERE source IS NOT NULL AND tier IS NOT NULL GROUP BY ALL) SELECT source, run, status, lag(status) OVER (PARTITION BY source ORDER BY run) AS before, status IS DISTINCT FROM lag(status) OVER (PARTITION BY source ORDER BY run) AS moved FROM h")
def status_velocity(spark, sf):
    """A status against the run before it."""
    h = table(spark, sf, "tagged_signals").where("source is not null and tier is not null").groupBy("source", F.coalesce("run_date", F.lit("")).alias("run")).agg(F.max("tier").alias("status"))
    before = F.lag("status").over(Window.partitionBy("source").orderBy("run"))  # one row a run
    return h.select("source", "run", "status", before.alias("before"), (~F.col("status").eqNullSafe(before)).alias("moved"))


@query("WITH p AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age FROM events) SELECT user_id, event_id, before IS NOT NULL AND value IS DISTINCT FROM before AS changed FROM p WHERE age <= 6")
def changed_chip(spark, sf):
    """The last six pulls of each indicator, and whether they changed."""
    e = table(spark, sf, "events")
    # the seven newest of a user: cut in every task before the shuffle, so no user is gathered
    age = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))
    newest = e.select("user_id", "event_id", "ts", "value").withColumn("age", age).where("age <= 7")
    p = newest.withColumn("before", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return p.where("age <= 6").select("user_id", "event_id", (F.col("before").isNotNull() & ~F.col("value").eqNullSafe(F.col("before"))).alias("changed"))


@query("SELECT count(*) AS articles, count(*) FILTER (WHERE coalesce(a.text, '') <> '') AS ok, (SELECT count(*) FROM article_images) AS images, count(*) FILTER (WHERE fetch_method = 'failed') AS failed FROM articles a")
def scrape_summary(spark, sf):
    a = table(spark, sf, "articles").agg(F.count(F.lit(1)).alias("articles"), F.count_if(F.coalesce("text", F.lit("")) != "").alias("ok"), F.count_if(F.col("fetch_method") == "failed").alias("failed"))
    return a.crossJoin(table(spark, sf, "article_images").agg(F.count(F.lit(1)).alias("images"))).select("articles", "ok", "images", "failed")  # one row each


@query("SELECT * FROM (SELECT need, category, count(*) AS n FROM corpus WHERE need IS NOT NULL AND category IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY need ORDER BY n DESC, category) = 1")
def dominant_category(spark, sf):
    """The leading category of each need; extension."""
    n = corpus(spark, sf).where("need is not null and category is not null").groupBy("need", "category").agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy("need").agg(F.min(F.struct((-F.col("n")).alias("m"), "category")).alias("t"))
    return top.select("need", "t.category", (-F.col("t.m")).alias("n"))
