"""Scans and connectors: run files, source lists, url lists, ledgers, injected fetchers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import or_else, strip

#: The fields of an accepted record: fixed values, in the order of the output.
FIELDS = ["id", "source", "category", "title", "url", "date", "summary", "forward_looking", "recommended_substrate", "fit_confidence", "cross_substrate_notes", "novelty_note", "tier", "need"]

SIGNAL = T.StructType([T.StructField(f, T.BooleanType() if f == "forward_looking" else T.StringType()) for f in FIELDS])
RUN = T.StructType([T.StructField("tagging_date", T.StringType()), T.StructField("signals", T.ArrayType(SIGNAL))])
SOURCE = T.StructType(
    [T.StructField(f, T.StringType()) for f in ("name", "category", "base_url", "recent_url", "exhibitions_url", "note")]
    + [T.StructField(f, T.BooleanType()) for f in ("fetchable", "semiotic_only", "recent_url_uncertain")]
)

LEDGER = T.StructType([T.StructField("url", T.StringType()), T.StructField("method", T.StringType()), T.StructField("images", T.LongType())])


def scan_runs(spark: SparkSession, pattern: str) -> DataFrame:
    """Records of run files: (file_name, run_date, seq, fields). A run without date takes its file's name."""
    files = spark.read.schema(RUN).json(pattern, multiLine=True).withColumn("file_name", F.col("_metadata.file_name"))
    dated = files.withColumn("run_date", or_else(F.col("tagging_date"), F.regexp_replace("file_name", r"\.json$", "")))
    return dated.select("file_name", "run_date", F.posexplode("signals").alias("seq", "s")).select("file_name", "run_date", F.col("seq").cast("long").alias("seq"), "s.*")


def run_order(signals: DataFrame) -> DataFrame:
    """(file_name, run_date, run_ord): runs in order of date, then file name; as many rows as there are files."""
    runs = signals.select("file_name", F.coalesce("run_date", F.lit("")).alias("run_date")).distinct()
    return runs.withColumn("run_ord", F.row_number().over(Window.orderBy("run_date", "file_name")))


def scan_sources(spark: SparkSession, path: str) -> DataFrame:
    """The ``sources`` list of a YAML file, on any file system Spark reads; keys that are left out are null."""
    import yaml

    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one curated file
    listed = (yaml.safe_load(text) or {}).get("sources") or []
    return spark.createDataFrame([tuple(s.get(f) for f in SOURCE.names) for s in listed], SOURCE)


def scan_field_guide(spark: SparkSession, path: str) -> DataFrame:
    """(name, category, base_url) of a source list, read line by line without a YAML parser; semiotic-only ones are left out.

    The list begins after the line ``sources:`` and ends before the next line that is neither indented, blank nor a comment.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("i", "line"))  # one curated file
    ends = ~F.col("line").rlike(r"^\s|^#|^$|^-")
    order = Window.orderBy("i")
    marked = lines.withColumn("section", F.last(F.when(ends, F.trim("line")), ignorenulls=True).over(order)).where("section = 'sources:'")
    marked = marked.withColumn("n", F.count_if(F.col("line").rlike(r"^\s*-?\s*name:")).over(order))
    pair = F.regexp_extract("line", r"^\s*-?\s*(\w+):\s*[\"']?(.*?)[\"']?\s*$", 1), F.regexp_extract("line", r"^\s*-?\s*(\w+):\s*[\"']?(.*?)[\"']?\s*$", 2)
    told = marked.where("n > 0").select("n", pair[0].alias("k"), pair[1].alias("v")).groupBy("n").pivot("k", ["name", "category", "base_url", "semiotic_only"]).agg(F.first("v"))
    return told.where("coalesce(semiotic_only, 'false') <> 'true'").select("name", "category", F.nullif("base_url", F.lit("null")).alias("base_url"))


def scan_codes(spark: SparkSession, pattern: str) -> DataFrame:
    """(need, codes, file_name) of code files: of the files of a need the last by name; those without need or codes do not count."""
    schema = "need string, codes array<struct<id:string,status:string,confidence:string>>, _broken string"
    read = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(pattern, multiLine=True).withColumn("file_name", F.col("_metadata.file_name"))
    good = read.where("need <> '' and size(codes) > 0").drop("_broken")
    return latest_by_key(good, "need", ["file_name"])


def scan_url_list(spark: SparkSession, path: str, need: str) -> DataFrame:
    """(url, need) of a text file: lines that begin with http, without blanks and comments."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return lines.where(F.startswith("url", F.lit("http"))).select("url", F.lit(need).alias("need"))


def latest_by_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """The last row of each key, without collecting groups: a max over the ordering and the row."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(key, "_r.*")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A state table, or an empty one where it cannot be read."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def fetched(urls: DataFrame, fetch: Callable[[str], tuple[int, str, str]], partitions: int = 8) -> DataFrame:
    """(url, status, content_type, body) through an injected fetcher, a domain's urls in one partition."""
    from corpusloom.functions.text import domain_of

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame([(u, *fetch(u)) for u in pdf["url"]], columns=["url", "status", "content_type", "body"])

    return urls.select("url").repartition(partitions, domain_of(F.col("url"))).mapInPandas(batches, "url string, status int, content_type string, body string")


def encoded(texts: DataFrame, encode: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """(h, v) of (h, text) rows through an injected encoder, in batches."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame({"h": pdf["h"], "v": [list(map(float, v)) for v in encode(pdf["text"].tolist())]})

    return texts.select("h", "text").mapInPandas(batches, "h string, v array<float>")
