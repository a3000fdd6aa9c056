"""Articles and images out of HTML pages, and the decisions around fetching them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import parse_dimension, url_path

#: Parts of image urls that mark page furniture: fixed values.
JUNK_HINTS = ["logo", "icon", "favicon", "sprite", "avatar", "gravatar", "tracking", "pixel", "spacer", "blank.", "placeholder", "1x1", "badge", "button", "/ads/", "/ad/", "advert", "emoji", "loading.gif", "spinner"]
#: Hosts that serve only advertising or measurement: fixed values.
AD_HOSTS = ["doubleclick.net", "googlesyndication.com", "google-analytics.com", "googletagmanager.com", "facebook.com", "facebook.net", "amazon-adsystem.com", "scorecardresearch.com", "quantserve.com", "adnxs.com", "criteo.com", "outbrain.com", "taboola.com", "chartbeat.com", "parsely.com", "bat.bing.com"]
#: Phrases of paywalls and challenges: fixed values.
PAYWALL_HINTS = ["subscribe to continue", "subscribe to read", "subscription required", "sign in to continue", "log in to continue", "create a free account", "already a subscriber", "this article is for subscribers", "become a member to read", "unlock this article", "meter has expired", "enable javascript and cookies to continue", "verify you are human", "checking your browser"]
#: Status codes after which a fetch is not tried again: fixed values.
NO_RETRY = (401, 402, 403, 404, 410, 451)
LEAST_TEXT, PAYWALL_TEXT, LEAST_SIDE, EXCERPT, SNIPPET, TRIES = 200, 400, 200, 1500, 200, 3


def junk_reason(url: Column, width: Column, height: Column) -> Column:
    """Why an image is furniture, the first reason that holds; null for a keeper. Ad hosts match as plain suffixes."""
    low = F.lower(url)
    host = F.regexp_extract(low, r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    reason = F.when(F.endswith(url_path(low), F.lit(".svg")), "svg").when(F.startswith(low, F.lit("data:")), "data-uri")
    for h in AD_HOSTS:
        reason = reason.when(F.endswith(host, F.lit(h)), "ad-domain")
    for h in JUNK_HINTS:
        reason = reason.when(F.contains(low, F.lit(h)), f"junk-hint:{h}")
    return reason.when((parse_dimension(width) < LEAST_SIDE) | (parse_dimension(height) < LEAST_SIDE), "too-small")


def looks_paywalled(page_text: Column, text: Column) -> Column:
    """Little article text, and a phrase of a paywall or challenge on the page."""
    low = F.lower(F.coalesce(page_text, F.lit("")))
    return (F.length(F.coalesce(text, F.lit(""))) < PAYWALL_TEXT) & F.exists(F.array(*[F.lit(h) for h in PAYWALL_HINTS]), lambda h: F.contains(low, h))


def needs_browser(text: Column, images: Column) -> Column:
    """Whether a static fetch gave too little: short text or no images."""
    return (F.length(F.coalesce(text, F.lit(""))) < LEAST_TEXT) | (F.coalesce(images, F.lit(0)) == 0)


def fetch_decision(status: Column, content_type: Column, attempt: Column) -> Column:
    """What follows a static response: give up, retry (with the wait in seconds), skip a type, or parse."""
    html = F.contains(F.lower(content_type), F.lit("html")) | F.contains(F.lower(content_type), F.lit("xml"))
    again = F.when(attempt < TRIES, F.concat(F.lit("retry:"), (attempt * 2).cast("string"))).otherwise("give-up")
    return F.when(status.isin(*NO_RETRY), "give-up").when(status.isNull() | (status >= 400), again).when(~F.coalesce(html, F.lit(True)), "not-html").otherwise("parse")


def scrape_outcome(static_ok: Column, static_wall: Column, static_enough: Column, browser_ok: Column, browser_wall: Column, browser_any: Column, static_crumbs: Column) -> Column:
    """How a page was got: static, playwright or failed."""
    return (
        F.when(static_ok & static_wall, "failed")
        .when(static_ok & static_enough, "static")
        .when(browser_ok & browser_wall, "failed")
        .when(browser_ok & browser_any, "playwright")
        .when(static_ok & static_crumbs, "static")
        .otherwise("failed")
    )


def pick_from_srcset(value: str | None) -> str | None:
    """The largest candidate: widths count as they are, densities a thousandfold; the first of equals."""
    best, top = None, -1.0
    for part in (value or "").split(","):
        words = part.split()
        if not words:
            continue
        size = 0.0
        if len(words) > 1 and words[1][-1:].lower() in ("w", "x"):
            try:
                size = float(words[1][:-1]) * (1000 if words[1][-1].lower() == "x" else 1)
            except ValueError:
                size = 0.0
        if size > top:
            best, top = words[0], size
    return best


def srcset_pick(value: Column) -> Column:
    """pick_from_srcset without UDF: a maximum over the candidates, the first of equals."""
    parts = F.filter(F.transform(F.split(value, ","), lambda p: F.split(F.trim(p), r"\s+")), lambda p: F.get(p, F.lit(0)) != "")

    def size(p: Column) -> Column:
        d = F.lower(F.coalesce(F.get(p, F.lit(1)), F.lit("")))
        n = F.regexp_extract(d, r"^(\d+\.?\d*)[wx]$", 1).try_cast("double")
        return F.coalesce(F.when(F.endswith(d, F.lit("x")), n * 1000).otherwise(n), F.lit(0.0))

    ranked = F.transform(parts, lambda p, i: F.struct(size(p).alias("s"), (-i).alias("i"), F.get(p, F.lit(0)).alias("u")))
    return F.array_max(ranked)["u"]


_SKIP = {"nav", "header", "footer", "aside"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CAPTION = re.compile(r"caption|credit|cutline|wp-caption-text|image-desc", re.IGNORECASE)
#: Attributes that hold an image's address, the ones of late loading last.
_ADDRESSES = ("src", "data-src", "data-lazy-src", "data-original")


class _Node:
    __slots__ = ("attrs", "children", "order", "parent", "tag", "text")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None, order: int):
        self.tag, self.attrs, self.parent, self.order = tag, attrs, parent, order
        self.children: list[_Node] = []
        self.text: list[tuple[int, str]] = []

    def all(self) -> Iterator[_Node]:
        yield self
        for c in self.children:
            yield from c.all()

    def content(self) -> str:
        pieces = sorted(p for n in self.all() if n.tag not in ("script", "style") for p in n.text)
        return " ".join(" ".join(p for _, p in pieces).split())

    def inside(self, tags: set[str]) -> bool:
        at: _Node | None = self
        while at is not None:
            if at.tag in tags:
                return True
            at = at.parent
        return False


class _Tree(HTMLParser):
    """A forgiving tree: an end tag closes up to its start, a stray one is dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None, 0)
        self.count = 0

    def handle_starttag(self, tag, attrs):
        self.count += 1
        if tag == "p" and self.at.tag == "p":
            self.at = self.at.parent
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at, self.count)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        at = self.at
        while at.parent is not None and at.tag != tag:
            at = at.parent
        if at.parent is not None:
            self.at = at.parent

    def handle_data(self, data):
        self.count += 1
        if data.strip():
            self.at.text.append((self.count, data))


def parse(html: str | None) -> _Node:
    tree = _Tree()
    tree.feed(html or "")
    return tree.root


def _caption(img: _Node) -> str:
    at: _Node | None = img
    while at is not None and at.tag != "figure":
        at = at.parent
    if at is not None:
        found = next((n for n in at.all() if n.tag == "figcaption"), None)
        if found is not None:
            return found.content()
    for anchor in (img, img.parent):
        if anchor is None or anchor.parent is None:
            continue
        siblings = anchor.parent.children
        for s in siblings[siblings.index(anchor) + 1 :][:3]:
            if _CAPTION.search(s.attrs.get("class", "")):
                return s.content()
    return img.attrs.get("title", "").strip()


def _up(node: _Node, tag: str) -> _Node | None:
    """The nearest ancestor of a tag."""
    at = node.parent
    while at is not None and at.tag != tag:
        at = at.parent
    return at


def addresses(img: _Node) -> tuple[str | None, list[str]]:
    """(best, all): the address an image is kept under, and every one it can be reached by.

    Sets of sizes come first, those of a surrounding picture before the image's own; the largest of the first set is the
    best. Without sets it is the first plain address.
    """
    around = _up(img, "picture")
    holders = ([n for n in around.all() if n.tag == "source"] if around is not None else []) + [img]
    sets = [v for n in holders if (v := n.attrs.get("srcset") or n.attrs.get("data-srcset"))]
    plain = [v for k in _ADDRESSES if (v := img.attrs.get(k))]
    best = next((u for v in sets if (u := pick_from_srcset(v))), None) or next(iter(plain), None)
    return best, [w[0] for v in sets for part in v.split(",") if (w := part.split())] + plain


def images_of(html: str | None, base: str) -> list[dict]:
    """The meaningful images of a page in document order: url, alt, caption, context.

    Images in navigation, header, footer and asides are left out, as is furniture by the rules of junk_reason. An image
    any of whose addresses an earlier one of the page has is the same picture and left out. Broken pages give what can be read.
    """
    nodes = [n for n in parse(html).all() if not n.inside(_SKIP)]
    out: list[dict] = []
    seen: set[str] = set()
    context = ""
    for n in nodes:
        if n.tag == "p" and len(said := n.content()) > 30:
            context = said[:SNIPPET]
        if n.tag != "img":
            continue
        best, every = addresses(n)
        if not best or best.strip().startswith("data:"):
            continue
        url = urljoin(base, best.strip())
        if _junk(url, n.attrs.get("width"), n.attrs.get("height")):
            continue
        known = {url} | {urljoin(base, v.strip()) for v in every if not v.strip().startswith("data:")}
        if known.isdisjoint(seen):
            out.append({"url": url, "alt": n.attrs.get("alt", "").strip(), "caption": _caption(n), "context": context})
            seen |= known
    return out


def _junk(url: str, width: str | None, height: str | None) -> bool:
    low = url.lower()
    host = urlparse(low).netloc

    def small(v: str | None) -> bool:
        try:
            return v is not None and float(v.strip().lower().replace("px", "")) < LEAST_SIDE
        except ValueError:
            return False

    return urlparse(low).path.endswith(".svg") or any(host.endswith(h) for h in AD_HOSTS) or any(h in low for h in JUNK_HINTS) or small(width) or small(height)


def article_fields(html: str | None) -> dict:
    """Title, date, author, tags and the excerpt of a page's text; blank where the page has none."""
    root = parse(html)
    nodes = list(root.all())
    metas = {(n.attrs.get("property") or n.attrs.get("name") or "").lower(): n.attrs.get("content", "").strip() for n in nodes if n.tag == "meta"}

    def first(tag: str) -> str:
        return next((n.content() for n in nodes if n.tag == tag), "")

    main = next((n for n in nodes if n.tag == "article"), None) or next((n for n in nodes if n.tag == "main"), root)
    body = "\n".join(t for n in main.all() if n.tag == "p" and not n.inside(_SKIP) and (t := n.content()))
    time = next((n.attrs.get("datetime", "") for n in nodes if n.tag == "time"), "")
    return {
        "title": metas.get("og:title") or first("h1") or first("title"),
        "date": metas.get("article:published_time", "")[:10] or time[:10],
        "author": metas.get("author", ""),
        "tags": [t.strip() for t in (metas.get("keywords") or metas.get("article:tag") or "").split(",") if t.strip()],
        "text": body[:EXCERPT],
        "page_text": root.content(),
    }


def extract(pages: DataFrame, url: str = "url", html: str = "html", key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles, images) of pages: the fields by url, and the images with their place ``seq``; ``key`` (a long) stays with both."""
    also = [key] if key else []
    head = f"{key} long, " if key else ""

    def rows_of(pdf: pd.DataFrame) -> Iterator[tuple]:
        return zip(pdf[url], pdf[html], *[pdf[k] for k in also], strict=True)

    def fields(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame([{**dict(zip(also, k, strict=True)), "url": u, **article_fields(h)} for u, h, *k in rows_of(pdf)], columns=[*also, "url", "title", "date", "author", "tags", "text", "page_text"])

    def pictures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(*k, u, i, x["url"], x["alt"], x["caption"], x["context"]) for u, h, *k in rows_of(pdf) for i, x in enumerate(images_of(h, u))]
            yield pd.DataFrame(rows, columns=[*also, "url", "seq", "image_url", "alt", "caption", "context"])

    read = pages.select(*also, url, html)
    return (
        read.mapInPandas(fields, head + "url string, title string, date string, author string, tags array<string>, text string, page_text string"),
        read.mapInPandas(pictures, head + "url string, seq int, image_url string, alt string, caption string, context string"),
    )
