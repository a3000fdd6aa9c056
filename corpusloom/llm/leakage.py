"""Evaluation texts inside training texts: winnowed fingerprints, joined and extended.

Words are compared without case, accents, punctuation, markup and marks. Both sides are fingerprinted by
winnowing: of every ``WINDOW`` successive k-gram hashes the smallest is kept, so any shared run of
``K + WINDOW - 1`` words shares a fingerprint. A passage of ``SPAN`` words with at most ``MISSES`` words
replaced holds an unbroken run of at least ``ceil((SPAN - MISSES) / (MISSES + 1))`` words; K and WINDOW
are chosen so that this run is guaranteed to be hit. Each hit fixes a diagonal (document position minus item
position), and the diagonal is extended: it counts if some SPAN successive words differ in at most MISSES.

The test items are the stated query set: they go to the workers in blocks of at most ``BLOCK_WORDS`` words,
so what is broadcast has a fixed bound, and the training texts are read block by block without a shuffle.
"""

from __future__ import annotations

import html
import re
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN, MISSES = 20, 2
RUN = -(-(SPAN - MISSES) // (MISSES + 1))  # 6 words stay unbroken
K = 5
WINDOW = RUN - K + 1
BLOCK_WORDS = 500_000

#: Tags, entities, and short marks in brackets: [sic], (1), {a}, [link](target).
_MARKUP = re.compile(r"<[^<>]{0,200}>|&(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[A-Za-z]{2,31});|\]\([^()\s]{1,300}\)|\[[^\[\]\n]{1,30}\]|\((?:sic|[^\W_]{1,2}|\d{1,4})\)|\{[^{}\s]{1,6}\}")
_BREAK = re.compile("(?<=\\w)[\u00ad\u200b\u200c\u200d\u2060\ufeff]+(?=\\w)|(?<=[^\\W\\d_])[-\u2010\u2011\u00ac]\\n\\s*(?=[^\\W\\d_])|[\u00ad\u200b\u200c\u200d\u2060\ufeff]")
_BROKEN = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]|[-\u2010\u2011\u00ac]\n")
_WORD = re.compile(r"[^\W_]+")
_LETTERS = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("ł", "l"), ("đ", "d"), ("ı", "i")]
_ACCENT = re.compile("[\u0300-\u036f]+")


def _markup(m: re.Match) -> str:
    return html.unescape(m.group()) if m.group()[0] == "&" else " "


def words(text: str | None) -> list[str]:
    """The compared words of a text; null and empty texts have none."""
    if not text:
        return []
    if "<" in text or "&" in text or "[" in text or "(" in text or "{" in text:
        text = _MARKUP.sub(_markup, text)
    if _BROKEN.search(text):
        text = _BREAK.sub("", text)
    if not text.isascii():
        text = _ACCENT.sub("", unicodedata.normalize("NFKD", text)).lower()
        for a, b in _LETTERS:
            if a in text:
                text = text.replace(a, b)
    return _WORD.findall(text.lower())


_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(ids: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of every k successive word numbers."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = (h ^ (ids[i : i + n].astype(np.uint64) + np.uint64(1))) * _MIX
            h ^= h >> np.uint64(29)
    return h


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the smallest hash (the rightmost of equals) of every window."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    w = min(window, n)
    best, at = hashes[: n - w + 1].copy(), np.arange(n - w + 1)
    for i in range(1, w):
        h = hashes[i : i + len(best)]
        smaller = h <= best
        best[smaller] = h[smaller]
        at[smaller] = np.arange(i, i + len(best))[smaller]
    return at[np.concatenate([[True], at[1:] != at[:-1]])]  # never falls: equals go to the right


def passage(a: np.ndarray, b: np.ndarray, diagonal: int, span: int, misses: int) -> bool:
    """Whether span successive words of b and a (shifted by the diagonal) differ in at most so many places."""
    lo, hi = max(0, -diagonal), min(len(b), len(a) - diagonal)
    if hi - lo < span:
        return False
    wrong = np.concatenate([[0], np.cumsum(a[lo + diagonal : hi + diagonal] != b[lo:hi])])
    return bool(((wrong[span:] - wrong[:-span]) <= misses).any())


class ItemIndex:
    """The fingerprints of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.number: dict[str, int] = {}
        for _, ws in items:
            for w in ws:
                self.number.setdefault(w, len(self.number) + 1)
        self.items = [(i, np.array([self.number[w] for w in ws], np.int64)) for i, ws in items]
        rows = []
        for n, (_, ids) in enumerate(self.items):
            h = gram_hashes(ids)
            rows += [(h[p], n, p) for p in winnow(h)]
        rows.sort()
        self.hash = np.array([r[0] for r in rows], np.uint64)
        self.owner = [int(r[1]) for r in rows]
        self.place = [int(r[2]) for r in rows]

    def find(self, texts: list[str | None], span: int = SPAN, misses: int = MISSES) -> list[tuple[int, int]]:
        """(place of the text, item) for the texts of a batch, which are laid end to end.

        Words of no item are all number 0 and match nothing, so no gram reaches across a gap of zeros.
        """
        known, flat, ends = self.number.get, [], [0]
        for text in texts:
            ws = words(text)
            if len(ws) >= span:
                flat += map(known, ws, repeat(0))
                flat += (0,) * K
            ends.append(len(flat))
        if not len(self.hash) or not flat:
            return []
        ids, ends = np.array(flat, np.int64), np.array(ends)
        h = gram_hashes(ids)
        at = winnow(h)
        own = h[at]
        lo = np.searchsorted(self.hash, own, "left")
        hit = (self.hash[np.minimum(lo, len(self.hash) - 1)] == own) & (ids[at] > 0)
        at, lo = at[hit], lo[hit]
        hi = np.searchsorted(self.hash, h[at], "right")
        row = np.searchsorted(ends, at, "right") - 1
        found: set[tuple[int, int]] = set()
        tried: set[tuple[int, int, int]] = set()
        for r, p, a, b in zip(row.tolist(), at.tolist(), lo.tolist(), hi.tolist(), strict=True):
            for j in range(a, b):
                n, d = self.owner[j], p - self.place[j]
                if (r, n) in found or (r, n, d) in tried:
                    continue
                tried.add((r, n, d))
                if passage(ids[ends[r] : ends[r + 1]], self.items[n][1], d - ends[r], span, misses):
                    found.add((r, n))
        return [(r, self.items[n][0]) for r, n in sorted(found)]


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", span: int = SPAN, misses: int = MISSES) -> DataFrame:
    """(doc_id, item_id) for each document that holds a passage of an item.

    Items of fewer than ``span`` words, and null, empty or blank texts on either side, match nothing. Repeated
    documents each come out. Extra columns on either side are dropped first. An empty side gives an empty result.
    """
    if span < SPAN or misses > MISSES:
        raise ValueError(f"fingerprints guarantee passages of {SPAN} words or more with at most {MISSES} replaced")
    spark = docs.sparkSession
    schema = f"`{doc_id}` bigint, `{item_id}` bigint"
    read = docs.select(F.col(doc_id).cast("long"), F.col(text)).where(F.length(text) >= span)

    def scan(block: list[tuple[int, list[str]]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)  # at most BLOCK_WORDS words and one item

        def batches(it):
            index = ItemIndex(shared.value)
            for batch in it:
                key = batch.column(0).to_pylist()
                rows = [(key[r], i) for r, i in index.find(batch.column(1).to_pylist(), span, misses)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=[doc_id, item_id])

        return read.mapInArrow(batches, schema)

    found, block, size = spark.createDataFrame([], schema), [], 0
    for row in items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where(F.length("t") > 0).toLocalIterator():
        ws = words(row.t)
        if len(ws) >= span:
            block.append((row.i, ws))
            size += len(ws)
        if size >= BLOCK_WORDS:
            found, block, size = found.union(scan(block)), [], 0
    return found.union(scan(block)) if block else found
