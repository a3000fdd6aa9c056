"""From texts to short vectors: cache, injected encoder, principal axes, quantisation."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vectors as V
from corpusloom.functions.text import embed_text
from corpusloom.runtime import persisted
from corpusloom.sources.signals import encoded
from corpusloom.sources.sinks import add_rows

from .planes import axes_of, moments

Encoder = Callable[[list[str]], list[list[float]]]


def hash_encoder(dimensions: int = 32) -> Encoder:
    """A deterministic encoder for tests: signed hashed words."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dimensions))
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % dimensions] += 1 if h >> 40 & 1 else -1
        return out.tolist()

    return encode


def embedded(signals: DataFrame, cache: str, encode: Encoder | None, dims: int = 128, key: str = "ord") -> tuple[DataFrame, dict]:
    """(key, vec) of each record and what describes the vectors; each different text is encoded once, ever.

    Texts are known by their hash; those the cache lacks are encoded and appended to it. Without an encoder the cached
    ones alone get a vector. Cached vectors are made unit vectors, centred, put on the first ``dims`` axes and quantised in
    steps of the largest value over 127. Records with equal texts share a vector; with nothing cached there are none.
    """
    texts = signals.select(F.col(key), embed_text(F.col("title"), F.col("summary")).alias("text")).withColumn("h", F.sha1("text"))
    have = _cached(texts, cache)
    if encode is not None:
        wanted = texts.select("h", "text").dropDuplicates(["h"])
        wanted = wanted if have is None else wanted.join(have.select("h"), "h", "left_anti")
        add_rows(encoded(wanted, encode).select("h", "v"), cache, "h")
        have = _cached(texts, cache)
    if have is None:
        return texts.select(key, F.lit(None).cast("string").alias("vec")).limit(0), {}
    rows = persisted(texts.join(have, "h").select(F.lit("all").alias("need"), F.col(key).alias("ord"), V.l2_normalize(F.col("v")).alias("v")), "embedded")
    first = rows.select(F.size("v").alias("n")).first()
    if first is None:
        return texts.select(key, F.lit(None).cast("string").alias("vec")).limit(0), {}
    summed = moments(rows, first.n).orderBy("i").collect()  # one row a dimension
    n, mean = summed[0].n, np.array([r.total for r in summed]) / summed[0].n
    axes, shares = axes_of(np.array([r.products for r in summed]) / n - np.outer(mean, mean), min(dims, n, first.n))

    def project(frames):
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame({"k": pdf["ord"], "p": list((np.stack(pdf["v"].to_numpy()) - mean) @ axes.T)})

    placed = persisted(rows.mapInPandas(project, "k long, p array<double>"), "projected")
    top = placed.agg(F.max(F.array_max(F.transform("p", F.abs))).alias("m")).first().m
    scale = top / 127 if top else 1.0
    vec = V.encode_bytes(V.quantize(F.col("p"), F.lit(scale)))
    about = {"count": n, "raw_dim": first.n, "dim": len(axes), "scale": scale, "share": float(shares.sum()), "mean_b64": float_blob(mean), "components_b64": float_blob(axes)}
    return placed.select(F.col("k").alias(key), vec.alias("vec")), about


def _cached(texts: DataFrame, cache: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return texts.sparkSession.read.parquet(cache).select("h", "v").dropDuplicates(["h"])
    except AnalysisException:
        return None


def float_blob(values: np.ndarray) -> str:
    """Base64 of the float32 bytes."""
    import base64

    return base64.b64encode(np.asarray(values, np.float32).tobytes()).decode("ascii")


def backfilled(corpus: DataFrame, cache: str, encode: Encoder, dims: int = 128) -> tuple[DataFrame, dict]:
    """The corpus with all its vectors made anew; an encoder is required."""
    if encode is None:
        raise ValueError("an encoder is required")
    made, about = embedded(corpus, cache, encode, dims)
    return corpus.drop("vec").join(made, "ord", "left"), about


