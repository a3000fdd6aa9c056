"""Which records of the tagged runs are the same article.

A record has a page (its url without scheme, port, decoration and tracking), a publisher (its source, else its
host) and a title. Titles are compared as words without case, accents, markup, doubled letters, and without the
publisher's name at their ends. A title that the same words carry at two or more publishers is general ("In
brief"): it names no subject and links nothing by itself.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from urllib.parse import parse_qsl, unquote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from corpusloom import runtime
from corpusloom.operators.graph import connected_components
from corpusloom.runtime import broadcast_if_small, persisted, together

from . import hashforest

_TRACKING = re.compile(r"^(?:utm_.*|ref|ref_src|source|share|amp|fbclid|gclid|mc_[a-z]+|campaign|cmp|igshid|s|from|output|print)$")
_HOST_PREFIX = re.compile(r"^(?:www\d?|m|mobile|amp)\.(?=[^.]+\.)")
_TAIL = re.compile(r"(?:/(?:index|default)\.(?:html?|php|aspx?)|\.(?:html?|php|aspx?)|/amp|/)+$")
_SLASHES = re.compile(r"/{2,}")
#: Most urls: host and path of plain lower-case letters, which need no parsing.
_PLAIN = re.compile(r"https?://([a-z0-9-]+(?:\.[a-z0-9-]+)+)(/(?!(?:amp|mobile)/)[a-z0-9_-]+(?:/[a-z0-9_-]+)*)(?<!/amp)")
_ALNUM = re.compile(r"[^\W_]+")
_TAG = re.compile(r"<[^<>]{0,100}>")
_REPEAT = re.compile(r"(.)\1+")
#: The words that "&" stands for; they are not compared.
_AND = frozenset(("and", "et", "und", "y"))
_YEAR = re.compile(r"^(?:19|20)\d\d$")
_ACCENT = re.compile("[̀-ͯ]+")


#: Values that recur in many records (sources, words) are worked out once while so many others come.
RECUR = 1 << 16


def plain(text: str) -> str:
    if text.isascii():
        return text.lower()
    return _ACCENT.sub("", unicodedata.normalize("NFKD", text)).lower()


@lru_cache(RECUR)
def _host(name: str) -> str:
    return _HOST_PREFIX.sub("", name)


def page_of(url: str | None) -> tuple[str | None, str | None]:
    """(page, host) of a url: null where it is blank or no url; the page is ``host`` alone for a root."""
    if not url:
        return None, None
    if m := _PLAIN.fullmatch(url):
        host = _host(m[1])
        return host + m[2], host
    if not url.strip():
        return None, None
    text = "".join(url.split())
    if "://" not in text:
        text = "http://" + text.lstrip("/")
    try:
        parts = urlsplit(text)
        host = _host((parts.hostname or "").rstrip("."))
    except ValueError:
        return None, None
    if not host or "." not in host:
        return None, None
    path = unquote(parts.path).lower()
    if "//" in path:
        path = _SLASHES.sub("/", path)
    if path.startswith(("/amp/", "/mobile/")):
        path = path[path.index("/", 1) :]
    path = _TAIL.sub("", path)
    query = sorted((k.lower(), v) for k, v in parse_qsl(parts.query) if not _TRACKING.match(k.lower())) if parts.query else None
    return host + path + ("?" + "&".join(f"{k}={v}" for k, v in query) if query else ""), host


@lru_cache(RECUR)
def publisher_of(source: str | None, host: str | None) -> str | None:
    """Letters and digits of the source, or of the host without its last label."""
    name = "".join(_ALNUM.findall(plain(source))) if source else ""
    return name or (("".join(_ALNUM.findall(host.rpartition(".")[0]))) if host else None) or None


@lru_cache(RECUR)
def _name_words(source: str) -> list[str]:
    return [w for w in _ALNUM.findall(plain(source)) if w not in _AND]


@lru_cache(RECUR)
def _single(word: str) -> str:
    return word if word.isdigit() else _REPEAT.sub(r"\1", word)


def title_words(title: str | None, source: str | None = None) -> list[str]:
    """The compared words of a title: entities and tags resolved, doubled letters single, publisher's name cut off."""
    if not title:
        return []
    text = html.unescape(title)
    text = plain((_TAG.sub(" ", text) if "<" in text else text).replace("ß", "ss"))
    words = [w for w in _ALNUM.findall(text) if w not in _AND]
    own = _name_words(source) if source else []
    if own and len(words) > len(own):
        if words[-len(own) :] == own:
            words = words[: -len(own)]
        elif words[: len(own)] == own:
            words = words[len(own) :]
    return [_single(w) for w in words]


def _near(a: str, b: str) -> bool:
    """Whether two words differ by one slip: a letter more, less, other, or two swapped."""
    if min(len(a), len(b)) < 3 or abs(len(a) - len(b)) > 1 or a.isdigit() or b.isdigit():
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (len(x) > 1 and x[:2] == y[1::-1] and x[2:] == y[2:])


def same_title(a: list[str], b: list[str], lenient: bool = False) -> bool:
    """Whether two titles are the same apart from editing.

    Numbers other than years must agree. Words may be misspelt by one slip; two words may be put in; a subtitle
    may follow. ``lenient`` (the records share a page) also lets two words be replaced if half of them agree.
    """
    if not a or not b:
        return False
    if [w for w in a if w.isdigit() and not _YEAR.match(w)] != [w for w in b if w.isdigit() and not _YEAR.match(w)]:
        return False
    if len(a) > len(b):
        a, b = b, a
    rest = list(b)
    odd = []
    for w in a:
        if w in rest:
            rest.remove(w)
        else:
            odd.append(w)
    slips = 0
    for w in list(odd):
        match = next((r for r in rest if _near(w, r)), None)
        if match is not None:
            odd.remove(w)
            rest.remove(match)
            slips += 1
    if slips > (1 if len(a) <= hashforest.SHORT else 2) or (slips and len(a) - len(odd) - slips < 1):
        return False
    if odd:
        return lenient and len(odd) <= 2 and len(rest) <= 3 and 2 * (len(a) - len(odd)) >= len(a)
    if len(rest) <= 2:
        return len(a) >= 2 or not rest
    begins = sum(x == y or _near(x, y) for x, y in zip(a, b[: len(a)], strict=True)) == len(a)
    ends = sum(x == y or _near(x, y) for x, y in zip(a, b[-len(a) :], strict=True)) == len(a)
    return (len(a) >= 3 or (len(a) == 2 and max(map(len, a)) >= 6)) and (begins or ends or lenient)


_KEYS = "row_id long, id string, page string, slug string, publisher string, words string, root boolean"


def record_keys(signals: DataFrame) -> DataFrame:
    """The compared keys of each record. Blank titles have no words, blank urls no page."""

    def batches(frames):
        for b in frames:
            found = []
            for source, title, url in zip(*[b.column(c).to_pylist() for c in ("source", "title", "url")], strict=True):
                page, host = page_of(url)
                slug = page.rpartition("/")[2] if page and "/" in page and "?" not in page else None
                found.append((page, f"{host}/{slug}" if slug else None, publisher_of(source, host), " ".join(title_words(title, source)), page is not None and page == host))
            kinds = [*[pa.string()] * 4, pa.bool_()]
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("row_id"), b.column("id"), *columns], [c.split()[0] for c in _KEYS.split(", ")])

    typed = [F.col(c).cast("string").alias(c) for c in ("id", "source", "title", "url")]
    return signals.select(F.col("row_id").cast("long").alias("row_id"), *typed).mapInArrow(batches, _KEYS)


@F.pandas_udf(BooleanType())
def _same(a: pd.Series, b: pd.Series, loose: pd.Series) -> pd.Series:
    return pd.Series([same_title(x.split(), y.split(), z) for x, y, z in zip(a, b, loose, strict=True)], dtype=bool)


#: Of pages with more different titles than this, titles are looked up by their rarest words, not all compared,
PAGE_TITLES = 50
#: unless all these pages have no more pairs of titles than this: they cost less than a forest.
CROWDED_PAIRS = 100_000


def _hashed(kind: str, *columns: str) -> Column:
    """A 64-bit key of the columns; null where one is null."""
    present = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        present = present & F.col(c).isNotNull()
    return F.when(present, F.xxhash64(F.lit(kind), *columns))


def keyed(signals: DataFrame) -> DataFrame:
    """The records' keys, hashed: strings are replaced by 64-bit keys before anything is shuffled, but for the titles' words."""
    blank = (F.col("words") == "") | F.col("publisher").isNull()
    keys = record_keys(signals).withColumn("title", F.when(~blank, _hashed("title", "publisher", "words")))
    hashed = [_hashed(c, c).alias(c) for c in ("id", "page", "slug")]
    return persisted(keys.select("row_id", *hashed, "root", "title", (F.col("words") == "").alias("untitled"), "publisher", "words"), "article-keys")


def article_labels(signals: DataFrame) -> DataFrame:
    """(row_id, class): records of the same article have the same class.

    Exact copies and records with the same words are one class by their key, before any join; classes are linked
    where a hash forest finds titles of a publisher that are the same apart from editing, where a page carries such titles
    loosely, and where a record without url has the id of another. Only links between different classes enter the
    connected components, so a group of a third of all rows is one node there.
    """
    return labels_of(keyed(signals))


def titles_of(keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(title, publisher, words) of the titles that name a subject, the general ones (as ``_general``), and all titles."""
    titles = persisted(keys.where("title is not null").select("title", "publisher", "words").distinct(), "article-titles")
    many = titles.groupBy(F.xxhash64("words").alias("_w")).agg(F.count(F.lit(1)).alias("_p")).where("_p > 1").select("_w")
    many = broadcast_if_small(persisted(many, "article-general"))
    subjects = persisted(titles.join(many, F.xxhash64("words") == F.col("_w"), "left_anti"), "article-subjects")
    general = broadcast_if_small(titles.join(many, F.xxhash64("words") == F.col("_w"), "left_semi").select(F.col("title").alias("_general")))
    return subjects, general, titles


def labels_of(keys: DataFrame, located: DataFrame | Callable[[], DataFrame] | None = None, told: tuple[DataFrame, DataFrame, DataFrame] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``article_labels`` of ``keyed`` records; ``located`` are the pairs of titles to compare, or what gives them, by default those of a new forest.

    ``told`` is ``titles_of`` the records where it is known; columns of the keys to ``keep`` follow the labels.
    """
    subjects, general, _ = told or titles_of(keys)
    texts = subjects.select("title", "words")

    further = [c for c in keep if c not in ("id", "page", "slug", "root", "untitled")]
    kept = [c for c in keep if c not in ("id", "page")]

    def carried() -> tuple[DataFrame, DataFrame, DataFrame]:
        """The records with the titles that name something, the pages' titles, and the pages that have several."""
        marked = persisted(
            keys.join(general, F.col("title") == F.col("_general"), "left").select("row_id", "id", "page", "slug", "root", "untitled", F.when(F.col("_general").isNull(), F.col("title")).alias("named"), *further), "article-marked"
        )
        per_page = persisted(marked.where("page is not null and not root and named is not null").groupBy("page", "named").agg(F.first("slug").alias("slug")), "article-pages")
        return marked, per_page, persisted(per_page.groupBy("page").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "article-shared")

    if located is None:
        located = lambda: hashforest.near_pairs(subjects, "publisher", "words", "title")
    located, (marked, per_page, shared) = together(located, carried) if callable(located) else (located, carried())
    crowded = shared.where(F.col("n") > PAGE_TITLES)
    n = crowded.agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0] or 0
    beside = per_page.join(shared if n <= CROWDED_PAIRS else shared.where(F.col("n") <= PAGE_TITLES), "page").select("page", "named")
    loose = beside.select("page", F.col("named").alias("a")).join(beside.select("page", F.col("named").alias("b")), "page").where("a < b").select("a", "b")
    if n > CROWDED_PAIRS:
        entries = broadcast_if_small(per_page.join(broadcast_if_small(crowded), "page").select("page", "named"))
        entries = texts.join(entries, F.col("named") == F.col("title")).select("page", "named", "words")
        loose = loose.union(hashforest.near_pairs(persisted(entries, "article-crowded"), "page", "words", "named", lenient=True))

    # both kinds of pairs get their words, and are compared, together
    pairs = persisted(located.select("a", "b", F.lit(False).alias("loose")).union(loose.distinct().select("a", "b", F.lit(True))), "article-pairs")
    sent = F.broadcast if pairs.limit(runtime.BROADCAST_ROWS + 1).count() <= runtime.BROADCAST_ROWS else lambda df: df
    one = texts.select(F.col("title").alias("a"), F.col("words").alias("words_a"))
    two = texts.select(F.col("title").alias("b"), F.col("words").alias("words_b"))
    pairs = sent(sent(pairs).join(one, "a")).join(two, "b")  # of each title there is one row
    linked = persisted(connected_components(pairs.where(_same("words_a", "words_b", "loose")).select("a", "b")), "article-links")
    linked = broadcast_if_small(linked)

    # records without a title of their own belong to their page's only article, else to the page itself
    lone = marked.where("named is null")
    settled = per_page.join(linked, F.col("named") == F.col("node"), "left").select("page", "slug", F.coalesce("component", "named").alias("c"))
    by_page = settled.join(lone.select("page").distinct(), "page", "left_semi").groupBy("page").agg(F.min("c").alias("page_class"), F.max("c").alias("_most")).where("page_class = _most").drop("_most")
    by_slug = settled.join(lone.where("untitled").select("slug").distinct(), "slug", "left_semi").groupBy("slug").agg(F.min("c").alias("slug_class"), F.max("c").alias("_most")).where("slug_class = _most").drop("_most")
    named = marked.where("named is not null").join(linked, F.col("named") == F.col("node"), "left").select("row_id", "id", "page", F.coalesce("component", "named").alias("class"), *kept)
    row_key = F.xxhash64(F.lit("row"), F.col("row_id"))
    placed = F.when(F.col("untitled"), F.coalesce("page_class", "slug_class", "page")).otherwise(F.col("page"))
    untitled = lone.join(by_page, "page", "left").join(by_slug, "slug", "left").select("row_id", "id", "page", F.when(F.col("page").isNull() | F.col("root"), row_key).otherwise(placed).alias("class"), *kept)
    labelled = persisted(named.union(untitled), "article-classes")

    # a record without url has the id of a record of the article
    bare = labelled.where("page is null and id is not null").select("id", F.col("class").alias("a")).distinct()
    others = labelled.where("page is not null").join(bare.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("class").alias("b"))
    among = bare.groupBy("id").agg(F.min("a").alias("b"))
    through = broadcast_if_small(persisted(connected_components(bare.join(others.union(among), "id").select("a", "b")), "article-through"))
    return labelled.join(through, F.col("class") == F.col("node"), "left").select("row_id", F.coalesce("component", "class").alias("class"), *keep)
