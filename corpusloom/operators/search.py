"""Free-text retrieval over the corpus: expansion, weighted scores, ranking, browsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import or_else, query_terms, word_match, words
from corpusloom.runtime import broadcast_if_small

#: Weights of the fields: fixed values.
WEIGHTS = {"title": 3.0, "summary": 2.0, "novelty_note": 2.0, "cross_substrate_notes": 1.0, "category": 2.0, "source": 1.0, "recommended_substrate": 1.0, "need": 1.0}
#: The curated synonyms; every search takes another map as a parameter: fixed values.
SYNONYMS = {
    "ai": ["artificial", "intelligence", "algorithm", "algorithmic", "chatbot", "llm", "machine"],
    "beauty": ["aesthetic", "cosmetic", "skincare", "grooming", "makeup"],
    "wellness": ["health", "wellbeing", "therapy", "healing", "mindfulness"],
    "sport": ["athlete", "athletic", "fitness", "running", "gym", "training"],
    "money": ["wealth", "financial", "economic", "income", "class", "capitalism"],
    "masculinity": ["men", "male", "manhood", "masculine"],
    "men": ["masculinity", "male", "manhood"],
    "femininity": ["women", "female", "womanhood", "feminine", "girlhood"],
    "women": ["femininity", "female", "womanhood"],
    "intimacy": ["closeness", "tenderness", "romance", "desire", "eroticism"],
    "community": ["belonging", "collective", "gathering", "communal"],
    "nostalgia": ["retro", "vintage", "longing", "memory", "archival"],
    "luxury": ["premium", "opulence", "wealth", "aspirational"],
    "food": ["culinary", "eating", "restaurant", "cooking", "cuisine", "dining"],
    "fashion": ["clothing", "apparel", "garment", "style", "dress"],
    "internet": ["online", "digital", "platform", "virality", "meme"],
    "work": ["labor", "labour", "career", "workplace", "job", "hustle"],
    "identity": ["selfhood", "persona", "self"],
    "ritual": ["ceremony", "practice", "tradition", "rite"],
    "authenticity": ["authentic", "sincerity", "genuine"],
    "queer": ["lgbtq", "gay", "lesbian", "trans", "drag"],
    "aging": ["age", "aged", "older", "elder", "elderly", "longevity"],
    "craft": ["handmade", "artisan", "craftsmanship", "maker"],
    "celebrity": ["fame", "stardom", "influencer", "parasocial"],
    "music": ["song", "album", "pop", "sound", "sonic"],
    "film": ["cinema", "movie", "documentary", "director"],
    "home": ["domestic", "interior", "household", "dwelling"],
    "body": ["embodied", "physical", "flesh", "corporeal"],
    "death": ["grief", "mourning", "mortality", "funeral"],
    "grief": ["death", "mourning", "loss"],
    "technology": ["digital", "device", "software", "tech"],
    "spirituality": ["religion", "sacred", "faith", "mysticism", "astrology"],
    "status": ["prestige", "taste", "distinction", "aspiration"],
    "loneliness": ["isolation", "alone", "solitude", "disconnection"],
    "slowness": ["slow", "leisure", "rest", "idleness"],
}
SYNONYM_WEIGHT, BREADTH, CORE, SEVERAL_RUNS, AGEING = 0.5, 0.5, 1.2, 1.1, 0.92


def expand(terms: list[str], synonyms: dict[str, list[str]]) -> list[tuple[str, float, str]]:
    """(term, weight, typed term): typed terms weigh 1, their synonyms half; duplicates stay."""
    return [x for t in terms for x in [(t, 1.0, t), *((s, SYNONYM_WEIGHT, t) for s in synonyms.get(t, []))]]


def runs_of(corpus: DataFrame) -> DataFrame:
    """One row with the sorted array of all runs."""
    return corpus.select(F.explode("_runs").alias("r")).agg(F.array_sort(F.collect_set("r")).alias("runs"))


def recency(runs: Column) -> Column:
    """The factor by age of the first run; a first run that is none of the runs costs nothing."""
    n = F.size(runs)
    at = F.array_position(runs, F.coalesce("_first_seen", F.lit("")))
    age = F.when(at == 0, 0).otherwise(n - at)
    return F.when(n == 0, F.lit(1.0)).otherwise(F.pow(F.lit(AGEING), age.cast("double")))


def boosts(parents: Column, runs: Column) -> Column:
    """What multiplies the weighted sum: breadth, tier, several runs, recency."""
    return (
        (1 + BREADTH * (parents - 1))
        * F.when(F.col("tier") == "core", CORE).otherwise(1.0)
        * F.when(F.size("_runs") > 1, SEVERAL_RUNS).otherwise(1.0)
        * recency(runs)
    )


def _field_words(corpus: DataFrame) -> DataFrame:
    """(ord, field_weight, word): every word of the weighted fields, from one scan."""
    weighted = [F.transform(words(F.col(f)), _weigh(w)) for f, w in WEIGHTS.items()]
    exploded = corpus.select("ord", F.explode(F.flatten(F.array(*weighted))).alias("_t"))
    return exploded.select("ord", F.col("_t.field_weight").alias("field_weight"), F.col("_t.word").alias("word"))


def _weigh(weight: float):
    return lambda word: F.struct(F.lit(weight).alias("field_weight"), word.alias("word"))


def _block(c: str) -> Column:
    """Words that match without being equal share their first four letters; shorter ones match only themselves."""
    return F.substring(c, 1, 4)


def search_many(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, ord, score) for a table of (query, term, weight, parent), by a blocked join of words and terms.

    An equi-join on the first four letters finds every match; nothing but matches is shuffled where the terms are few
    enough to be broadcast, which is counted first.
    """
    wanted = broadcast_if_small(queries.withColumn("block", _block("term")))
    hit = _field_words(corpus).withColumn("block", _block("word")).join(wanted, "block").where(word_match(F.col("word"), F.col("term")))
    sums = hit.groupBy("query", "ord").agg(F.sum(F.col("field_weight") * F.col("weight")).alias("total"), F.count_distinct("parent").alias("parents"))
    rows = corpus.select("ord", "tier", "_runs", "_first_seen").crossJoin(F.broadcast(runs_of(corpus)))  # one row
    return sums.join(rows, "ord").select("query", "ord", (F.col("total") * boosts(F.col("parents"), F.col("runs"))).alias("score"))


def scored(corpus: DataFrame, query: str, synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    """The corpus with ``score``; rows that match nothing have 0. Typed duplicates add to the score, not to the breadth."""
    wanted = expand(query_terms(query), SYNONYMS if synonyms is None else synonyms)
    if not wanted:
        return corpus.withColumn("score", F.lit(0.0))
    terms = corpus.sparkSession.createDataFrame([("", *w) for w in wanted], "query string, term string, weight double, parent string")
    found = search_many(corpus, terms).select("ord", F.col("score").alias("_score"))
    return corpus.join(found, "ord", "left").withColumn("score", F.coalesce("_score", F.lit(0.0))).drop("_score")


def search(corpus: DataFrame, query: str, limit: int = 25, exclude: list[str] | None = None, synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    """The best ``limit`` rows by score (to nine places), then number of runs, then order. Excluded needs never change the ranking."""
    found = scored(corpus, query, synonyms).where("score > 0")
    if exclude:
        found = found.where(~F.lower(or_else(F.col("need"), F.lit("unsettled"))).isin([e.lower() for e in exclude]))
    return found.orderBy(F.desc(F.round("score", 9)), F.desc(F.size("_runs")), "ord").limit(limit)


def browse(corpus: DataFrame, column: str, default: str | None) -> DataFrame:
    """(value, n) of a column; without a default, null is a value."""
    value = F.col(column) if default is None else or_else(F.col(column), F.lit(default))
    return corpus.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n"))
