"""Pages and images: filters, decisions, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import pages as G
from corpusloom.runtime import table

from .registry import query, s_list, s_path, s_strip

_HOST = "regexp_extract(lower(image_url), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1)"
_JUNK = (
    f"CASE WHEN ends_with({s_path('lower(image_url)')}, '.svg') THEN 'svg' WHEN starts_with(lower(image_url), 'data:') THEN 'data-uri' "
    + " ".join(f"WHEN ends_with({_HOST}, {s_list([h])}) THEN 'ad-domain'" for h in G.AD_HOSTS)
    + " "
    + " ".join(f"WHEN contains(lower(image_url), {s_list([h])}) THEN {s_list(['junk-hint:' + h])}" for h in G.JUNK_HINTS)
    + " WHEN (image_id % 500 < 200) THEN 'too-small' END"
)


@query(f"SELECT image_id, {_JUNK} AS reason FROM article_images")
def junk_reason(spark, sf):
    """Why an image is furniture; the declared width is made of its id, as the table has none."""
    i = table(spark, sf, "article_images")
    width = F.concat((F.col("image_id") % 500).cast("string"), F.lit("px"))
    return i.select("image_id", G.junk_reason(F.col("image_url"), width, F.lit(None).cast("string")).alias("reason"))


@query(f"SELECT article_id, length(coalesce(text, '')) < 400 AND ({' OR '.join(f'contains(lower(text), {s_list([h])})' for h in G.PAYWALL_HINTS)}) IS TRUE AS walled FROM articles")
def paywall_flag(spark, sf):
    return table(spark, sf, "articles").select("article_id", G.looks_paywalled(F.col("text"), F.col("text")).alias("walled"))


@query("SELECT article_id, length(coalesce(text, '')) < 200 OR coalesce(n, 0) = 0 AS fallback FROM articles LEFT JOIN (SELECT article_id, count(*) AS n FROM article_images GROUP BY ALL) USING (article_id)")
def needs_fallback(spark, sf):
    n = table(spark, sf, "article_images").groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "articles").join(n, "article_id", "left").select("article_id", G.needs_browser(F.col("text"), F.col("n")).alias("fallback"))


_STATUS = "[200, 404, 500, 403, 301, 200, 503, 429][1 + article_id % 8]"
_TYPE = "['text/html; charset=utf-8', 'application/xml', 'image/jpeg'][1 + article_id % 3]"


@query(
    f"WITH a AS (SELECT article_id, {_STATUS} AS status, {_TYPE} AS ctype, 1 + article_id % 3 AS attempt FROM articles) SELECT article_id, CASE WHEN status IN (401, 402, 403, 404, 410, 451) THEN 'give-up' "
    "WHEN status >= 400 THEN CASE WHEN attempt < 3 THEN 'retry:' || (attempt * 2) ELSE 'give-up' END WHEN NOT (contains(ctype, 'html') OR contains(ctype, 'xml')) THEN 'not-html' ELSE 'parse' END AS decision FROM a"
)
def fetch_decision(spark, sf):
    """What follows a response; statuses are made of the ids."""
    a = table(spark, sf, "articles").select("article_id")
    pick = lambda values, n: F.get(F.array(*[F.lit(v) for v in values]), (F.col("article_id") % n).cast("int"))
    status, ctype = pick([200, 404, 500, 403, 301, 200, 503, 429], 8), pick(["text/html; charset=utf-8", "application/xml", "image/jpeg"], 3)
    return a.select("article_id", G.fetch_decision(status, ctype, 1 + F.col("article_id") % 3).alias("decision"))


@query(
    "SELECT article_id, CASE WHEN a AND b THEN 'failed' WHEN a AND c THEN 'static' WHEN d AND e THEN 'failed' WHEN d AND f THEN 'playwright' WHEN a AND g THEN 'static' ELSE 'failed' END AS outcome FROM "
    "(SELECT article_id, article_id % 2 = 0 AS a, article_id % 5 = 0 AS b, article_id % 3 = 0 AS c, article_id % 7 <> 0 AS d, article_id % 11 = 0 AS e, article_id % 4 <> 1 AS f, article_id % 13 <> 0 AS g FROM articles)"
)
def scrape_outcome(spark, sf):
    i = F.col("article_id")
    out = G.scrape_outcome(i % 2 == 0, i % 5 == 0, i % 3 == 0, i % 7 != 0, i % 11 == 0, i % 4 != 1, i % 13 != 0)
    return table(spark, sf, "articles").select("article_id", out.alias("outcome"))


_ENDING = f"regexp_extract(lower({s_path('image_url')}), '(\\.(?:jpg|jpeg|png|webp|gif|avif))$', 1)"


@query(f"SELECT image_id, left(sha1(image_url), 16) || coalesce(nullif({_ENDING}, ''), '.img') AS name FROM article_images WHERE image_url IS NOT NULL")
def cache_filename(spark, sf):
    return table(spark, sf, "article_images").where("image_url is not null").select("image_id", X.cache_filename(F.col("image_url")).alias("name"))


_DIMENSION = "['640', '640px', '100%', '', 'auto', ' 12.5px '][1 + image_id % 6]"


@query(f"SELECT image_id, CASE WHEN regexp_matches(v, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') THEN try_cast(v AS DOUBLE) END AS pixels FROM (SELECT image_id, trim(replace(trim({_DIMENSION}), 'px', '')) AS v FROM article_images)")
def parse_dimension(spark, sf):
    value = F.get(F.array(*[F.lit(v) for v in ("640", "640px", "100%", "", "auto", " 12.5px ")]), (F.col("image_id") % 6).cast("int"))
    return table(spark, sf, "article_images").select("image_id", X.parse_dimension(value).alias("pixels"))


_ESCAPED = "replace(replace(replace(replace(replace(caption, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"


@query(f"SELECT image_id, {_ESCAPED} AS escaped FROM article_images")
def html_escape(spark, sf):
    return table(spark, sf, "article_images").select("image_id", X.html_escape(F.col("caption")).alias("escaped"))


@query("SELECT article_id, left(text, 1500) AS excerpt FROM articles")
def text_excerpt(spark, sf):
    return table(spark, sf, "articles").select("article_id", X.excerpt(F.col("text"), G.EXCERPT).alias("excerpt"))


_SETS = "['a.jpg 1x, b.jpg 2x', 'a.jpg 900w, b.jpg 1x', 'c.jpg', 'd.jpg 300w, e.jpg 1200w, f.jpg 1200w', '', 'g.jpg zz, h.jpg 5w'][1 + image_id % 6]"
_PARTS = r"""unnest(string_split(s, ',')) AS p, generate_subscripts(string_split(s, ','), 1) AS i"""


@query(
    f"""WITH p AS (SELECT image_id, {_PARTS} FROM (SELECT image_id, {_SETS} AS s FROM article_images)), q AS (SELECT image_id, i, string_split(trim(p), ' ') AS w FROM p WHERE trim(p) <> ''),
r AS (SELECT image_id, i, w[1] AS u, CASE WHEN regexp_matches(coalesce(w[2], ''), '^\\d+w$') THEN regexp_extract(w[2], '\\d+')::DOUBLE WHEN regexp_matches(coalesce(w[2], ''), '^\\d+x$') THEN regexp_extract(w[2], '\\d+')::DOUBLE * 1000 ELSE 0 END AS n FROM q)
SELECT a.image_id, best AS picked FROM article_images a LEFT JOIN (SELECT image_id, u AS best FROM r QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n DESC, i) = 1) USING (image_id)"""
)
def srcset_pick(spark, sf):
    """The sharpest of a srcset; the sets are made of the ids."""
    sets = ("a.jpg 1x, b.jpg 2x", "a.jpg 900w, b.jpg 1x", "c.jpg", "d.jpg 300w, e.jpg 1200w, f.jpg 1200w", "", "g.jpg zz, h.jpg 5w")
    value = F.get(F.array(*[F.lit(v) for v in sets]), (F.col("image_id") % 6).cast("int"))
    return table(spark, sf, "article_images").select("image_id", G.srcset_pick(value).alias("picked"))


@query("SELECT record_id, nullif(regexp_extract(payload, '(?s)(\\{.*\\})', 1), '') AS object FROM (SELECT record_id, '```json\n' || payload || '\n```' AS payload FROM raw_records)")
def json_salvage(spark, sf):
    """The object in an answer that stands in a code fence."""
    fenced = F.concat(F.lit("```json\n"), F.col("payload"), F.lit("\n```"))
    return table(spark, sf, "raw_records").select("record_id", F.nullif(X.json_payload(fenced), F.lit("")).alias("object"))


@query("SELECT a.image_id, b.image_id AS twin FROM (SELECT image_id, article_id, split_part(image_url, '?', 1) AS u FROM article_images) a JOIN (SELECT min(image_id) AS image_id, article_id, split_part(image_url, '?', 1) AS u FROM article_images GROUP BY ALL) b USING (article_id, u) WHERE a.image_id > b.image_id")
def variant_overlap(spark, sf):
    """Images of a page that are a variant (the url without query) of an earlier one."""
    i = table(spark, sf, "article_images").select("image_id", "article_id", F.substring_index("image_url", "?", 1).alias("u"))
    first = i.groupBy("article_id", "u").agg(F.min("image_id").alias("twin"))
    return i.join(first, ["article_id", "u"]).where("image_id > twin").select("image_id", "twin")


_TIDY = r"trim(regexp_replace(coalesce({0}, ''), '[\s\p{{Z}}]+', ' ', 'g'))"


@query(
    f"""WITH p AS (SELECT article_id, image_id, image_url AS u, {_TIDY.format("alt")} AS alt, {_TIDY.format("caption")} AS caption, {_TIDY.format("context")} AS said FROM article_images WHERE image_url <> '' AND {_JUNK.replace("(image_id % 500 < 200)", "FALSE")} IS NULL),
i AS (SELECT article_id, image_id, 0 AS again, u AS image_url, alt, caption, said, CASE WHEN image_id % 4 < 2 THEN [u, u || '?w=400'] ELSE [u] END AS forms FROM p
  UNION ALL SELECT article_id, image_id, 1, u || '?w=400', '', '', '', [u || '?w=400'] FROM p WHERE image_id % 5 = 0),
c AS (SELECT *, coalesce(last_value(CASE WHEN length(said) > 30 THEN left(said, 200) END IGNORE NULLS) OVER (PARTITION BY article_id ORDER BY image_id, again ROWS UNBOUNDED PRECEDING), '') AS context FROM i),
f AS (SELECT article_id, image_id, again, unnest(forms) AS form FROM i),
late AS (SELECT DISTINCT x.article_id, x.image_id, x.again FROM f x JOIN f y ON x.article_id = y.article_id AND x.form = y.form AND (y.image_id, y.again) < (x.image_id, x.again))
SELECT article_id, row_number() OVER (PARTITION BY article_id ORDER BY image_id, again)::INT - 1 AS seq, image_url, alt, caption, context FROM c JOIN (SELECT article_id FROM articles WHERE url IS NOT NULL) USING (article_id) ANTI JOIN late USING (article_id, image_id, again)"""
)
def extract_images(spark, sf):
    """Images out of HTML pages that are built from the tables: in pictures, sets of sizes, late loading, and once more in small."""
    quoted = lambda c: X.html_escape(F.coalesce(F.col(c), F.lit("")))
    u, alt, caption = quoted("image_url"), quoted("alt"), quoted("caption")
    small = F.concat(u, F.lit("?w=400"))
    put = lambda text, *cols: F.format_string(text, *cols)
    kind = F.col("image_id") % 4
    shown = (
        F.when(kind == 0, put('<figure><picture><source srcset="%s 400w, %s 1600w"><img src="%s" alt="%s"></picture><figcaption>%s</figcaption></figure>', small, u, small, alt, caption))
        .when(kind == 1, put('<div><img srcset="%s 1x, %s 2x" src="%s" alt="%s"><div class="wp-caption-text">%s</div></div>', small, u, small, alt, caption))
        .when(kind == 2, put('<div><img data-src="%s" alt="%s" title="%s"></div>', u, alt, caption))
        .otherwise(put('<figure><img src="%s" alt="%s"><figcaption>%s</figcaption></figure>', u, alt, caption))
    )
    again = F.when(F.col("image_id") % 5 == 0, put('<div><img src="%s"></div>', small)).otherwise("")
    part = F.concat(put("<p>%s</p>", quoted("context")), shown, again)
    i = table(spark, sf, "article_images").where("image_url <> ''").groupBy("article_id")
    i = i.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("image_id", part.alias("part")))), lambda s: s["part"]), "").alias("shown"))  # one page is one document
    html = F.concat(F.lit("<html><nav><img src='/n.jpg'></nav><article><h1>"), quoted("title"), F.lit("</h1>"), "shown", F.lit("</article><footer><img src='/f.jpg'></footer></html>"))
    pages = table(spark, sf, "articles").where("url is not null").join(i, "article_id").select("article_id", "url", html.alias("html"))
    return G.extract(pages, key="article_id")[1].drop("url")


@query(
    f"SELECT article_id, url, {_TIDY.format('title')} AS title, coalesce(pub_date, '')[1:10] AS date, trim(coalesce(author, '')) AS author, "
    f"list_filter(list_transform(string_split(array_to_string(tags, ','), ','), lambda t: trim(t)), lambda t: t <> '') AS tags, left({_TIDY.format('text')}, 1500) AS text FROM articles WHERE url IS NOT NULL"
)
def page_fields(spark, sf):
    """Title, date, author, tags and excerpt out of HTML pages that are built from the tables."""
    quoted = lambda c: X.html_escape(F.coalesce(c, F.lit("")))
    meta = lambda name, c: F.concat(F.lit(f'<meta name="{name}" content="'), quoted(c), F.lit('">'))
    head = F.concat(F.lit("<html><head><title>"), quoted(F.col("title")), F.lit("</title>"), meta("author", F.col("author")), meta("article:published_time", F.col("pub_date")), meta("keywords", F.array_join("tags", ",")), F.lit("</head>"))
    html = F.concat(head, F.lit("<article><p>"), quoted(F.col("text")), F.lit("</p></article></html>"))
    pages = table(spark, sf, "articles").where("url is not null").select("article_id", "url", html.alias("html"))
    return G.extract(pages, key="article_id")[0].drop("page_text")


@query("WITH l AS (SELECT article_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM articles) SELECT article_id, line AS context FROM l WHERE length(line) > 30 QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY i DESC) = 1")
def element_context(spark, sf):
    """The last line of more than 30 characters of each page."""
    lines = table(spark, sf, "articles").select("article_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).where(F.length("line") > 30)
    return lines.groupBy("article_id").agg(F.max_by("line", "i").alias("context"))


@query("WITH l AS (SELECT article_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM articles), h AS (SELECT *, last_value(CASE WHEN length(line) BETWEEN 1 AND 30 THEN line END IGNORE NULLS) OVER (PARTITION BY article_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS head FROM l) SELECT article_id, head, count(*) AS n FROM h WHERE length(line) > 30 GROUP BY ALL")
def header_ffill_count(spark, sf):
    """Long lines under each short one, the short line filled forward; extension."""
    from pyspark.sql import Window

    lines = table(spark, sf, "articles").select("article_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    head = F.last(F.when(F.length("line").between(1, 30), F.col("line")), ignorenulls=True).over(Window.partitionBy("article_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))  # a page's lines
    return lines.withColumn("head", head).where(F.length("line") > 30).groupBy("article_id", "head").agg(F.count(F.lit(1)).alias("n"))
