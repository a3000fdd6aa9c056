"""Vectors, terms, labels, clusters and planes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import vectors as V
from corpusloom.operators import planes as P
from corpusloom.runtime import broadcast_if_small, cut, persisted, table

from .registry import query, s_list, s_strip, s_words


def corpus(spark, sf):
    return table(spark, sf, "corpus")


def embeddings(spark, sf):
    return table(spark, sf, "embeddings")


_TEXT = s_strip(f"{s_strip(chr(99) + 'oalesce(title, ' + chr(39) * 2 + ')')} || ' . ' || {s_strip(chr(99) + 'oalesce(summary, ' + chr(39) * 2 + ')')}")


@query(f"SELECT ord, sha1({_TEXT}) AS h FROM corpus")
def embed_text_hash(spark, sf):
    return corpus(spark, sf).select("ord", F.sha1(X.embed_text(F.col("title"), F.col("summary"))).alias("h"))


_HASHES = f"a AS (SELECT sha1({_TEXT}) AS h FROM corpus), b AS (SELECT DISTINCT sha1({_TEXT}) AS h FROM tagged_signals)"


@query(f"WITH {_HASHES} SELECT DISTINCT h FROM b WHERE h NOT IN (SELECT h FROM a)")
def embed_missing(spark, sf):
    """Texts of the runs that the cache (the corpus' texts) does not have, once each."""
    text = X.embed_text(F.col("title"), F.col("summary"))
    cache = corpus(spark, sf).select(F.sha1(text).alias("h"))
    return table(spark, sf, "tagged_signals").select(F.sha1(text).alias("h")).distinct().join(cache, "h", "left_anti")


@query(f"SELECT DISTINCT sha1({_TEXT}) AS h FROM corpus WHERE sha1({_TEXT}) IN (SELECT sha1({_TEXT}) FROM corpus WHERE vec <> '')")
def embed_have(spark, sf):
    """Texts of the corpus that the cache (the rows with a vector) has, once each."""
    c = corpus(spark, sf).select(F.sha1(X.embed_text(F.col("title"), F.col("summary"))).alias("h"), "vec")
    return c.select("h").distinct().join(c.where("vec <> ''").select("h"), "h", "left_semi")


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS length FROM embeddings")
def vector_norm(spark, sf):
    return embeddings(spark, sf).select("vec_id", F.round(V.norm(F.col("embedding")), 6).alias("length"))


@query("WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS l FROM embeddings) SELECT vec_id, round(embedding[1]::DOUBLE / CASE WHEN l = 0 THEN 1 ELSE l END, 6) AS first, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / CASE WHEN l = 0 THEN 1 ELSE l END, 6) AS total FROM n")
def l2_normalize(spark, sf):
    e = embeddings(spark, sf).select("vec_id", V.l2_normalize(F.col("embedding")).alias("u"))
    return e.select("vec_id", F.round(F.col("u")[0], 6).alias("first"), F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


_DOT = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"
_LEN = "sqrt(list_sum(list_transform({0}.embedding, lambda x: x::DOUBLE * x::DOUBLE)))"


@query(f"SELECT a.vec_id, round({_DOT} / ({_LEN.format('a')} * {_LEN.format('b')}), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark, sf):
    """Each vector against the next one."""
    a = embeddings(spark, sf).select("vec_id", F.col("embedding").alias("x"))
    b = embeddings(spark, sf).select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    return a.join(b, "vec_id").select("vec_id", F.round(V.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))


@query("SELECT round(max(abs(x)) / 127, 9) AS scale FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings)")
def quant_scale(spark, sf):
    top = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    return embeddings(spark, sf).agg(F.round(F.max(top) / 127, 9).alias("scale"))


@query("SELECT vec_id, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::DOUBLE / 0.03, 0)))::INT) AS q FROM embeddings")
def quantize_int8(spark, sf):
    return embeddings(spark, sf).select("vec_id", V.quantize(F.col("embedding"), F.lit(0.03)).alias("q"))


_BLOB = "try(from_base64(nullif(vec, '')))"
_BYTES = "list_transform(range(octet_length({0})), lambda i: (('0x' || substr(hex({0}), 2 * i::INT + 1, 2))::INT + 128) % 256 - 128)"


@query(f"SELECT ord, CASE WHEN octet_length(b) > 0 THEN {_BYTES.format('b')} END AS v, CASE WHEN octet_length(b) > 0 THEN to_base64(b) = vec END AS same FROM (SELECT ord, vec, {_BLOB} AS b FROM corpus)")
def decode_vec(spark, sf):
    """The signed bytes of each record's vector, and the string they give again."""
    v = V.decode_bytes(F.col("vec"))
    return corpus(spark, sf).select("ord", v.alias("v"), (V.encode_bytes(v) == F.col("vec")).alias("same"))


def _bag(stop):
    return f"list_filter({s_words(chr(99) + 'oalesce(title, ' + chr(39) * 2 + ') || ' + chr(39) + ' ' + chr(39) + ' || coalesce(summary, ' + chr(39) * 2 + ')')}, lambda x: length(x) >= 3 AND x NOT IN ({s_list(stop)}))"


_TOK = f"tok AS (SELECT DISTINCT ord, coalesce(nullif(need, ''), 'unsettled') AS need, coalesce(vec, '') <> '' AS has, unnest({_bag(X.ROLLUP_STOP)}) AS term FROM corpus), ptok AS (SELECT DISTINCT ord, coalesce(nullif(need, ''), 'unsettled') AS need, unnest({_bag(X.PLANE_STOP)}) AS term FROM corpus WHERE coalesce(vec, '') <> '')"


def _docs(spark, sf):
    return corpus(spark, sf).select("ord", X.or_else(F.col("need"), F.lit("unsettled")).alias("need"), "title", "summary", F.nullif("vec", F.lit("")).alias("vec"))


def _words(docs, stop):
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))
    return docs.select("ord", "need", F.explode(F.array_distinct(X.label_words(text, stop))).alias("term"))


@query(f"WITH {_TOK} SELECT term, count(*) AS df FROM tok GROUP BY term")
def doc_freq(spark, sf):
    return _words(_docs(spark, sf), X.ROLLUP_STOP).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


@query(f"WITH {_TOK} SELECT need, term, count(*) AS df FROM ptok GROUP BY ALL")
def doc_freq_by_need(spark, sf):
    return _words(_docs(spark, sf).where("vec is not null"), X.PLANE_STOP).groupBy("need", "term").agg(F.count(F.lit(1)).alias("df"))


@query(f"WITH {_TOK} SELECT need, term, count(*) AS tf FROM tok GROUP BY ALL HAVING count(*) > 1")
def cluster_tf(spark, sf):
    """Member documents of each group (the need) that hold a term, where there are several."""
    return _words(_docs(spark, sf), X.ROLLUP_STOP).groupBy("need", "term").agg(F.count(F.lit(1)).alias("tf")).where("tf > 1")


_TFIDF = f"{_TOK}, d AS (SELECT term, count(*) AS df FROM tok GROUP BY term), f AS (SELECT need, term, count(*) AS tf FROM tok GROUP BY ALL), s AS (SELECT need, term, tf, tf * (ln(((SELECT count(*) FROM corpus) + 1) / (df + 1)) + 1) AS score FROM f JOIN d USING (term))"


@query(f"WITH {_TFIDF} SELECT need, term, round(score, 6) AS score FROM s")
def tfidf(spark, sf):
    docs = _docs(spark, sf)
    words = _words(docs, X.ROLLUP_STOP)
    df = words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    tf = words.groupBy("need", "term").agg(F.count(F.lit(1)).alias("tf")).join(df, "term").crossJoin(F.broadcast(n))  # one row
    return tf.select("need", "term", F.round(F.col("tf") * (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1), 6).alias("score"))


@query(f"WITH {_TFIDF}, r AS (SELECT *, row_number() OVER (PARTITION BY need ORDER BY round(score, 9) DESC, tf DESC, term DESC) AS i FROM s) SELECT need, string_agg(term, ' · ' ORDER BY i) AS label FROM r WHERE i <= 3 GROUP BY need")
def cluster_labels(spark, sf):
    """The three terms that tell each group (the need) from the whole."""
    return P.labels(_docs(spark, sf), ["need"], X.ROLLUP_STOP, 3)


@query("WITH c AS (SELECT coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n, min(ord) AS first FROM corpus GROUP BY ALL) SELECT need, n, round(100.0 * n / (SELECT count(*) FROM corpus), 4) AS pct, row_number() OVER (ORDER BY n DESC, first) AS place FROM c")
def need_rollup(spark, sf):
    """Count, share and place of each need; ties by first appearance."""
    from pyspark.sql import Window

    c = _docs(spark, sf).groupBy("need").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    total = c.agg(F.sum("n").alias("t"))
    placed = F.row_number().over(Window.orderBy(F.desc("n"), "first"))  # one row a need
    return c.crossJoin(F.broadcast(total)).select("need", "n", F.round(F.lit(100.0) * F.col("n") / F.col("t"), 4).alias("pct"), placed.cast("long").alias("place"))


@query("SELECT need, n, CASE WHEN n < 8 THEN 0 WHEN n <= 15 THEN 2 WHEN n <= 30 THEN 3 WHEN n <= 60 THEN 4 ELSE 5 END AS k FROM (SELECT coalesce(nullif(need, ''), 'unsettled') AS need, count(*) AS n FROM corpus WHERE coalesce(vec, '') <> '' GROUP BY ALL)")
def k_for(spark, sf):
    c = _docs(spark, sf).where("vec is not null").groupBy("need").agg(F.count(F.lit(1)).alias("n"))
    return c.select("need", "n", X.k_for(F.col("n")).alias("k"))


_CENTRE = """x AS (SELECT label, vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings), c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY ALL),
s AS (SELECT x.label, vec_id, sum(v * m) AS dot FROM x JOIN c USING (label, i) GROUP BY ALL)"""


@query(f"WITH {_CENTRE} SELECT label, vec_id, round(dot, 6) AS dot FROM s QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(dot, 9) DESC, vec_id) <= 6")
def central_items(spark, sf):
    """The six vectors of each label nearest to its centre."""
    from pyspark.sql import Window

    e = embeddings(spark, sf)
    long = e.select("label", "vec_id", F.posexplode("embedding").alias("i", "v"))
    centre = long.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m")).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))  # one entry a dimension
    near = e.join(broadcast_if_small(centre, 10_000), "label").select("label", "vec_id", V.dot(F.col("embedding"), F.transform("c", lambda s: s["m"])).alias("dot"))
    best = near
    for part in (["label", "_s"], ["label"]):  # salted first, so that no label is sorted by one task
        best = best.withColumn("_s", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
        best = best.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy(F.desc(F.round("dot", 9)), "vec_id"))).where("_r <= 6")
    return best.select("label", "vec_id", F.round("dot", 6).alias("dot"))


@query("WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) SELECT label, i - 1 AS i, round(avg(v), 6) AS m, count(*) AS n FROM x GROUP BY ALL")
def centroid_mean(spark, sf):
    long = embeddings(spark, sf).select("label", F.posexplode("embedding").alias("i", "v"))
    return long.groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("m"), F.count(F.lit(1)).alias("n"))


def _vectors(spark, sf):
    docs = _docs(spark, sf).withColumn("v", V.decode_bytes(F.col("vec")))
    return docs.where(F.size("v") == 128)


_UNIT = f"""u AS (SELECT ord, need, list_transform(v, lambda x: x / CASE WHEN l = 0 THEN 1 ELSE l END) AS u FROM (SELECT ord, need, v, sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x))) AS l FROM
(SELECT ord, coalesce(nullif(need, ''), 'unsettled') AS need, {_BYTES.format("b")} AS v FROM (SELECT ord, need, {_BLOB} AS b FROM corpus) WHERE octet_length(b) = 128)))"""
_NEAR = "round(list_dot_product(u.u, {0}.u), 11)"


@query(
    f"""WITH {_UNIT}, a AS (SELECT need, arg_min(u, ord) AS u FROM u GROUP BY need),
b AS (SELECT u.need, arg_min(u.u, ROW({_NEAR.format("a")}, ord)) AS u FROM u JOIN a USING (need) GROUP BY u.need),
c AS (SELECT u.need, arg_min(u.u, ROW(greatest({_NEAR.format("a")}, {_NEAR.format("b")}), ord)) AS u FROM u JOIN a USING (need) JOIN b USING (need) GROUP BY u.need),
s AS (SELECT u.need, ord, {_NEAR.format("a")} AS x, {_NEAR.format("b")} AS y, {_NEAR.format("c")} AS z FROM u JOIN a USING (need) JOIN b USING (need) JOIN c USING (need))
SELECT need, ord, CASE WHEN x >= y AND x >= z THEN 0 WHEN y >= z THEN 1 ELSE 2 END AS cluster FROM s"""
)
def kmeans_init_assign(spark, sf):
    """The rollup's seeds, farthest first, and each record's place under them: the first step of its k-means."""
    return P.cluster_by_need(_vectors(spark, sf), rounds=1)


@query(
    f"""WITH {_UNIT.replace("list_transform(v, lambda x: x / CASE WHEN l = 0 THEN 1 ELSE l END)", "v")}, x AS (SELECT need, ord, generate_subscripts(u, 1) AS i, unnest(u)::DOUBLE AS x FROM u)
SELECT need, count(*) AS n, round(sum(m), 4) AS mean, round(sum(w), 4) AS variance FROM (SELECT need, i, avg(x) AS m, var_pop(x) AS w, count(*) AS n FROM x GROUP BY ALL HAVING count(*) > 1) GROUP BY need"""
)
def plane_moments(spark, sf):
    """Of each need's plane: dimensions, sum of the means and whole variance, from the summed products that give its axes."""
    m = P.moments(persisted(_vectors(spark, sf).select("need", "ord", F.col("v").cast("array<double>").alias("v")), "plane-rows"), 128).where("n > 1")
    mean = F.col("total") / F.col("n")
    return m.groupBy("need").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(mean), 4).alias("mean"), F.round(F.sum(F.get("products", F.col("i")) / F.col("n") - mean * mean), 4).alias("variance"))


@query()
def kmeans_rollup(spark, sf):
    """Three clusters a need, by the rollup's k-means."""
    return P.cluster_by_need(_vectors(spark, sf))


@query()
def kmeans_range(spark, sf):
    """Clusters of a need's plane, by the plane's k-means."""
    return P.cluster_by_need(_vectors(spark, sf), rollup=False)


@query()
def pca_2d(spark, sf):
    """Each record's place on its need's plane; signs are fixed by the largest loading."""
    made = P.plane_of_need(_vectors(spark, sf))
    return made.select("need", "ord", *[F.round(c, 6).alias(c) for c in ("x", "y", "share_x", "share_y")])


@query()
def pca_poles(spark, sf):
    """The seven lowest and highest records of each axis, in needs as they are stated."""
    from pyspark.sql import Window

    at = pca_2d(spark, sf)
    long = at.select("need", "ord", F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("at")) for a in ("x", "y")])).alias("s")).select("need", "ord", "s.*")
    low, high = (F.row_number().over(Window.partitionBy("need", "axis").orderBy(o, "ord")) for o in (F.asc("at"), F.desc("at")))
    return long.withColumn("low", low).withColumn("high", high).where("low <= 7 or high <= 7").select("need", "axis", "ord", "at", (F.col("low") <= 7).alias("is_low"))


@query()
def geo_rollup(spark, sf):
    """Each need's clusters with size and label."""
    docs = _docs(spark, sf)
    placed = persisted(P.cluster_by_need(_vectors(spark, sf)), "rollup")
    member = docs.join(placed.select("ord", "cluster"), "ord", "left")
    named = P.labels(member, ["need", "cluster"], X.ROLLUP_STOP, 3)
    sizes = placed.groupBy("need", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))
    return sizes.join(named, ["need", "cluster"])


@query()
def semantic_range(spark, sf):
    """The clusters of each need on its plane: centre, size, label."""
    v = _vectors(spark, sf)
    placed = cut(P.cluster_by_need(v, rollup=False))
    at = P.plane_of_need(v)
    named = P.labels(v.join(placed.select("ord", "cluster"), "ord", "left"), ["need", "cluster"], X.PLANE_STOP, 2, within="need")
    centre = at.join(placed.select("ord", "cluster"), "ord").groupBy("need", "cluster").agg(F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y"), F.count(F.lit(1)).alias("n"))
    return centre.join(named, ["need", "cluster"])
