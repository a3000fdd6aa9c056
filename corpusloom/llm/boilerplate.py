"""Main content of pages, by consensus paths of each host.

The containers of a page are its lines and the parts of lines that separators cut. A container's path is its
generalised form: lower case, numbers as ``#``, the host's name as ``<site>``; teasers are generalised to what stands
before the title (``related:*``) or to their numbering (``#. *``). A first pass scores every page's containers (cue
words, shape, prose or not) and votes, by host and by language, with the distinct articles that carry a path. A path
wins where enough of a host's or of a language's articles carry it; what only belongs to an article never does. A second
pass takes the winning paths of the page's host and extracts the rest: lines that are made of winning paths, and runs
of titles below a winning heading, are furniture, all else is the article's own.

Votes are counts that combine before the shuffle. Winners by language are at most (paths of a page) / (least share);
winners by host travel as one bounded array per host, joined to its pages.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import broadcast_if_small, persisted

from .quality import COMMON

#: Least share of a host's (and number of its) articles, and of a language's, that make a path win.
HOST_SHARE, HOST_ARTICLES = 0.12, 4
LANGUAGE_SHARE, CUED_SHARE, LANGUAGE_ARTICLES = 0.012, 0.0015, 3
#: Longer prose lines vote as a whole, by their hash.
LONG = 160
#: Function words that tell a text's language clearly, three times as many as of any other.
CLEAR = 12
#: Lines up to this are remembered, which changes no result; so are the sets of so many hosts at a time.
LONGEST, HOSTS = 300, 2_000
#: Most winning paths of all hosts together that are broadcast.
BROADCAST_PATHS = 200_000

#: Words that mark furniture in the four languages: fixed values.
CUES = re.compile(
    r"cookie|newsletter|subscri|sign up|member|inbox|advert|sponsor|rights reserved|privacy|terms of|imprint|careers|follow us|back to top|log in|share|copy link|print|comment|repl|min read|related|"
    r"read next|up next|see also|previous|more from|most read|trending|popular|editors' picks|on view|calendar|this week|filed under|tags?:|save for|"
    r"abonne|connexion|publicité|sponsorisé|droits réservés|mentions légales|données personnelles|confidentialité|suivre|haut de page|partager|copier|réagir|lecture|à lire|article suivant|sur le même|à la une|les plus lus|soutenez|"
    r"anzeige|werbung|rechte vorbehalten|impressum|datenschutz|folgen sie|nach oben|teilen|drucken|kommentar|lesezeit|lesen sie|zum thema|nächster|beliebt|meistgelesen|termine|unterstützen|anmelden|"
    r"suscri|publicidad|patrocinado|derechos reservados|aviso legal|privacidad|síguenos|volver arriba|compartir|copiar|comentario|lectura|lee también|relacionado|siguiente|destacados|más leído|agenda|apoya|socio|boletín|anuncio"
)
_LANGUAGES = {
    "en": frozenset("the of and is no its that this their another each any her which with from who yet".split()),
    "fr": frozenset("le la les des du et dans est une pour sur avec que qui se au".split()),
    "de": frozenset("der die das und ist den im ein eine mit auf für durch sich dem".split()),
    "es": frozenset("el la los las del y en que una con por para se al".split()),
}
#: The languages that each of these words tells.
_TELLS = {w: tuple(k for k, words in _LANGUAGES.items() if w in words) for w in frozenset().union(*_LANGUAGES.values())}
_CUT = re.compile(r"\s[|·•›»/>→]\s|\s[–—]\s|\s{2,}|\t")
_SOFT = re.compile(r"(?<=[^\W])[.,;]\s+|\s(?=[©¿])")
#: One of these stands wherever _CUT cuts: white space other than a single blank, or a separator.
_CUTTERS = ("|", "·", "•", "›", "»", "/", ">", "→", "–", "—", "  ", "\t", "\xa0", "\u2002", "\u2003", "\u2009", "\u202f", "\u3000", "\r", "\x0b", "\x0c")
_SOFTENERS = (".", ",", ";", "©", "¿")
#: Those of them that a line of ASCII alone can have.
_ASCII_CUTTERS, _ASCII_SOFTENERS = (tuple(c for c in x if c.isascii()) for x in (_CUTTERS, _SOFTENERS))
_ANY = re.compile(_SOFT.pattern + "|" + _CUT.pattern)
_TRAIL = re.compile(r"\s(?:>|»|/|›)\s")
_LEAD = re.compile(r"^([^\W\d][^:→|·]{1,40}?)\s?(?:[:→]|\s[–—])\s+(?=\S)")
_NUMBERED = re.compile(r"^(?:#\.){1,3}(?=\s)")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_DIGITS = re.compile("[0-9]+")
_SPACE = re.compile(r"\s+")
_CLOSING, _STOPS = "\"'”’»)]", (".", "!", "?", "…")
_EDGE = " .,;:|·•›»/>→–—"
_BULLET = re.compile(r"^[–—•*·-]\s")


def generalise(text: str, site: str | None) -> str:
    out = " ".join(text.split())
    if site:
        out = out.replace(site, "<site>")
    return numbers_as_signs(out.lower()).strip(_EDGE)


def has_number(text: str) -> bool:
    return any(map(text.__contains__, "0123456789"))


def numbers_as_signs(text: str) -> str:
    return _DIGITS.sub("#", text) if has_number(text) else text


def lead_of(text: str, site: str | None, g: str | None = None) -> str | None:
    """The path of what comes before a title: its introducing words or its numbering. ``g`` is the text generalised."""
    g = generalise(text, site) if g is None else g
    if text.lstrip()[:1] == "#" and re.match(r"\s*#\s", text):
        return "# tags *"
    m = _NUMBERED.match(g) if g.startswith("#.") else None
    if m:
        return m.group() + " *"
    m = _LEAD.match(" ".join(text.split())) if ":" in text or (not text.isascii() and any(map(text.__contains__, "→–—"))) else None
    if m and len(_WORD.findall(m.group(1))) <= 4:
        return generalise(m.group(1), site) + ": *"
    return None


def is_prose(text: str) -> bool:
    """Ends like a sentence, has seven words or more, and a fifth of them are common ones: over the whole text."""
    if text.rstrip().rstrip(_CLOSING)[-1:] not in _STOPS:
        return False
    words = text.lower().split()
    return len(words) >= 7 and sum(map(COMMON.__contains__, words)) >= 0.2 * len(words)


def title_like(text: str) -> bool:
    """Short, not a sentence, not a list entry, and more than a two-word subhead."""
    t = text.strip()
    if not t or len(t) > 110 or t[-1] in ".!;,…”\"»" or t[0] in "“\"«" or t[0].islower() or _BULLET.match(t):
        return False
    n = len(_WORD.findall(t))
    return 2 <= n <= 16 and (n >= 3 or ":" in t)


def language_of(text: str) -> str:
    """By the function words of the text."""
    return max(scores_of(text).items(), key=lambda x: (x[1], x[0] == "en"))[0]


def scores_of(text: str) -> dict[str, int]:
    """How many function words of each language a text has."""
    out = dict.fromkeys(_LANGUAGES, 0)
    for w, n in Counter(filter(_TELLS.__contains__, text.lower().split())).items():
        for k in _TELLS[w]:
            out[k] += n
    return out


def has_cutter(line: str) -> bool:
    """Whether ``_CUT`` may cut a line."""
    return any(map(line.__contains__, _ASCII_CUTTERS if line.isascii() else _CUTTERS))


def has_trail(line: str) -> bool:
    return (">" in line or "/" in line or "»" in line or "›" in line) and bool(_TRAIL.search(line))


def parts_of(line: str) -> list[str]:
    if not has_cutter(line):
        return [line]
    return [p for p in _CUT.split(line) if p and p.strip()]


def soft_parts(line: str, split: re.Pattern) -> list[str]:
    if any(map(line.__contains__, _ASCII_SOFTENERS if line.isascii() else _SOFTENERS)) or (split is not _SOFT and has_cutter(line)):
        return [p for p in split.split(line) if p and p.strip()]
    return [line]


def line_hash(s: str) -> str:
    """The path of a long line as a whole: the hash of its letters, numbers as one sign."""
    return "=" + hashlib.md5(numbers_as_signs(s).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def line_paths(s: str, site: str | None) -> list[tuple[str, float]]:
    """The paths of one stripped line, and whether (1 or 0) a cue word counts in them, which it does not in prose.

    Long prose is a container as a whole only, by its hash.
    """
    prose = is_prose(s) and "©" not in s and not (site and site in s)
    if len(s) > LONG:
        whole = [(line_hash(s), 0.0)]
        if prose:
            return whole
    else:
        whole = []
    found: list[str] = [generalise(s, site)]
    lead = lead_of(s, site, found[0])
    if lead:
        found.append(lead)
    parts = parts_of(s)
    if len(parts) > 1:
        found += [generalise(p, site) for p in parts]
    elif not prose:
        soft = soft_parts(s, _SOFT)
        if len(soft) > 1:
            found += [generalise(p, site) for p in soft]
    free = float(not prose)
    return whole + [(g, free) for g in found if g]


def page_paths(text: str, site: str | None, seen: dict[tuple[str | None, str], list] | None = None) -> dict[str, float]:
    """Path of a page's containers to whether (1 or 0) a cue word counts in it. ``seen`` remembers lines of a host."""
    out: dict[str, float] = {}
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            continue
        found = seen.get((site, s)) if seen is not None else None
        if found is None:
            found = line_paths(s, site)
            if seen is not None and len(s) <= LONGEST and len(seen) < 100_000:
                seen[(site, s)] = found
        out.update(found)
    return out


def _voters(articles: DataFrame) -> DataFrame:
    """One page of each article of a host: pages fetched twice vote once."""
    pages = articles.where("text is not null and trim(text) <> ''").withColumn("_who", F.coalesce(F.nullif(F.trim("title"), F.lit("")), "url", F.col("article_id").cast("string")))
    first = pages.groupBy("site", "_who").agg(F.min("article_id").alias("article_id"))
    return pages.join(broadcast_if_small(first.select("article_id")), "article_id", "left_semi").select("article_id", "site", "title", "text")


def votes(articles: DataFrame) -> DataFrame:
    """(site, language, path, free, n, titles): voting pages with a path, and titles that have it, added up by batch; free is
    whether a cue word counts in it. The empty path counts the pages themselves.
    """

    def batches(frames):
        seen: dict[tuple[str | None, str], list] = {}
        for pdf in frames:
            free: set[str] = set()
            pages: dict[tuple[str | None, str], Counter] = {}
            titles: dict[tuple[str | None, str], Counter] = {}
            for site, title, text in zip(pdf["site"], pdf["title"], pdf["text"], strict=True):
                by = (site, language_of(text))
                if by not in pages:
                    pages[by], titles[by] = Counter(), Counter()
                paths = page_paths(text, site, seen)
                free.update([g for g, c in paths.items() if c])
                pages[by][""] += 1
                pages[by].update(paths.keys())
                if title:
                    g = generalise(title, site)
                    titles[by].update(x for x in {g, lead_of(title, site, g)} if x)
            for by, n in pages.items():
                t = titles[by]
                every = [*n, *(t.keys() - n.keys())]
                yield pd.DataFrame({"site": [by[0]] * len(every), "language": by[1], "path": every, "free": [float(g in free) for g in every], "n": [n.get(g, 0) for g in every], "titles": [t.get(g, 0) for g in every]})

    return _voters(articles).mapInPandas(batches, "site string, language string, path string, free double, n long, titles long")


def winning_paths(articles: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
    """(site, paths) of the hosts, and the winning paths by language."""
    tally = votes(articles).groupBy("site", "language", "path").agg(F.sum("n").alias("n"), F.sum("titles").alias("titles"), F.max("free").alias("free"))
    # most long lines stand on one article: they are their article's own
    tally = persisted(tally.where("n > 1 or path not like '=%'"), "boilerplate-tally")
    by_language = tally.where("path not like '=%'").groupBy("language", "path").agg(F.sum("n").alias("n"), F.sum("titles").alias("titles"), F.max("free").alias("free"), F.count(F.when(F.col("n") > 0, 1)).alias("sites"))
    whole = {r.language: r.n for r in by_language.where("path = ''").toLocalIterator()}
    size = F.create_map(*[x for k, v in whole.items() for x in (F.lit(k), F.lit(v))]) if whole else F.create_map()
    pages = F.element_at(size.cast("map<string,bigint>"), F.col("language"))
    words = F.size(F.split("path", " "))
    least = F.when((F.col("free") > 0) & (words <= 14) & F.col("path").rlike(CUES.pattern), F.lit(CUED_SHARE)).otherwise(F.lit(LANGUAGE_SHARE))
    good = by_language.where((F.col("path") != "") & (F.col("sites") >= 2) & (F.col("n") >= LANGUAGE_ARTICLES) & (F.col("titles") <= 0.02 * F.col("n"))).where(F.col("n") >= least * pages)
    shared: dict[str, list[str]] = {}
    for r in good.select("language", "path").toLocalIterator():
        shared.setdefault(r.language, []).append(r.path)
    by_site = tally.groupBy("site", "path").agg(F.sum("n").alias("n"), F.sum("titles").alias("titles"))
    of_site = by_site.where("path = ''").select(F.col("site").alias("_site"), F.col("n").alias("pages"))
    won = by_site.where("path <> ''").where(F.col("n") >= HOST_ARTICLES).join(broadcast_if_small(of_site), F.col("site") == F.col("_site"))
    won = won.where((F.col("n") >= HOST_SHARE * F.col("pages")) & (F.col("titles") <= 0.02 * F.col("n")))
    # what introduces articles' own titles anywhere ("studio visit: *") introduces no teaser by itself
    of_titles = by_language.groupBy("path").agg(F.sum("titles").alias("t"), F.sum("n").alias("m")).where("t > 0.02 * m and path like '%: *'").select("path")
    won = won.join(of_titles, "path", "left_anti")
    # at most the paths of a page over the least share
    return won.groupBy("site").agg(F.collect_list("path").alias("paths")), shared


class Extractor:
    """Tells furniture lines of a page, given the winning paths of its host and language."""

    def __init__(self, shared: dict[str, list[str]]):
        self.shared = {k: frozenset(v) for k, v in shared.items()}
        self.all = frozenset(p for v in shared.values() for p in v)
        self.every, self.language = self.all, None
        self.memo: dict[tuple[str | None, str | None], dict[str, bool]] = {}
        #: Whether a host has long lines that win.
        self.hashed: dict[str | None, bool] = {}
        self.sets: dict[str | None, tuple[frozenset[str], frozenset[str]]] = {}

    def host(self, site: str | None, paths, heads=None) -> tuple[frozenset[str], frozenset[str]]:
        """A host's winning paths, and those of them that head lists of titles, as sets that are made once."""
        found = self.sets.get(site)
        if found is None:
            if len(self.sets) >= HOSTS:
                self.sets.clear()
                self.hashed.clear()
                self.memo.clear()
            found = self.sets[site] = tuple(frozenset(x) if x is not None else frozenset() for x in (paths, heads))
            self.hashed[site] = any(p.startswith("=") for p in found[0])
        return found

    def speak(self, text: str | None) -> None:
        """Take the winning paths of a text's language; those of all languages where the text does not tell it clearly."""
        told = sorted(((n, k) for k, n in scores_of(text).items()), reverse=True) if text and text.strip() else [(0, None), (0, None)]
        self.language = told[0][1] if told[0][0] >= CLEAR and told[0][0] >= 3 * told[1][0] else None
        self.every = self.all if self.language is None else self.shared.get(self.language, frozenset())

    def wins(self, text: str, site: str | None, host: frozenset[str]) -> bool:
        g = generalise(text, site)
        return bool(g) and (g in host or g in self.every)

    def whole(self, s: str, site: str | None, host: frozenset[str], title: str | None) -> bool:
        """Whether a line is made of winning paths. Short lines are remembered by host, unless the title may play a part."""
        if len(s) > LONG:
            if self.hashed.get(site) and line_hash(s) in host:
                return True
            if is_prose(s) and "©" not in s and not (site and site in s):
                return False
        if has_trail(s):
            return self._whole(s, site, host, title)
        known = self.memo.setdefault((site, self.language), {})
        found = known.get(s)
        if found is None:
            found = self._whole(s, site, host, None)
            if len(known) < 2_000:
                known[s] = found
        return found

    def _whole(self, s: str, site: str | None, host: frozenset[str], title: str | None) -> bool:
        g = generalise(s, site)
        if g and (g in host or g in self.every):
            return g in host or not is_prose(s)
        lead = lead_of(s, site, g)
        if lead and (lead in host or lead in self.every) and not is_prose(s):
            return True
        parts = parts_of(s)
        if len(parts) > 1:
            won = [self.wins(p, site, host) for p in parts]
            if won[0] and has_trail(s) and title and len(parts) <= 4 and generalise(title, site).startswith(generalise(parts[-1], site)[:30]):
                return True
            if sum(len(p) for p, w in zip(parts, won, strict=True) if w) >= 0.6 * sum(map(len, parts)):
                return True
            if won[0] and has_trail(s) and len(parts) <= 3:
                return True
        for split in (_SOFT, _ANY) if has_cutter(s) else (_SOFT,):  # without a cutter both cut the same
            soft = soft_parts(s, split)
            if len(soft) > 1 and sum(len(p) for p in soft if self.wins(p, site, host)) >= 0.6 * sum(map(len, soft)):
                return True
        return False

    def lines(self, text: str, site: str | None, title: str | None, host: frozenset[str], heads: frozenset[str]) -> list[int]:
        lines = text.split("\n")
        own = generalise(title, site) if title else ""
        kind: list[str] = []
        for line in lines:
            s = line.strip()
            if not s:
                kind.append("")
            elif own and s[:1].lower() == own[:1] and len(s) <= 2 * len(title) + 20 and generalise(s, site) == own:
                kind.append("own")
            elif self.whole(s, site, host, title):
                kind.append("won")
            else:
                kind.append("title" if title_like(s) else "own")
        i, n = 0, len(lines)
        while i < n:
            if kind[i] != "title":
                i += 1
                continue
            before = i - 1
            while before >= 0 and kind[before] == "":
                before -= 1
            run = []
            while i < n and kind[i] in ("title", ""):
                if kind[i]:
                    run.append(i)
                i += 1
            above = generalise(lines[before], site) if before >= 0 and kind[before] == "won" else ""
            heading = bool(above) and (above in heads or above in self.headings)
            if heading or (len(run) >= 2 and before >= 0 and kind[before] == "won" and not self._head(kind, before)):
                for j in run:
                    kind[j] = "won"
        return [i for i, k in enumerate(kind) if k == "won"]

    @staticmethod
    def _head(kind: list[str], before: int) -> bool:
        """Whether nothing of the article has come yet: what follows may be its headline."""
        return "own" not in kind[:before]

    headings: frozenset[str] = frozenset()

    def context(self, context: str, lines: list[str], furniture: set[int], site: str | None, title: str | None, host: frozenset[str]) -> bool:
        """Whether an image's context is furniture: as the page's line that it begins, else by itself."""
        c = _SPACE.sub(" ", context).strip()
        if not c:
            return False
        for i, line in enumerate(lines):
            s = _SPACE.sub(" ", line).strip()
            if s and (s == c or (len(c) >= 12 and s.startswith(c))):
                return i in furniture
        if self.whole(c, site, host, title):
            return True
        if title and generalise(c, site) == generalise(title, site):
            return False
        lead = lead_of(c, site)
        if lead and (lead in host or lead in self.every):
            return True
        # two containers end to end, the last one perhaps cut off
        g, paths = generalise(c, site), host | self.every
        cut = next((k for k in range(min(len(g), LONGEST), 3, -1) if g[:k].strip(" .,;:|·•›»/>→–—") in paths), 0)
        if cut >= 0.3 * len(g) or (cut >= 15 and not is_prose(g[cut:])):
            return True
        if len(g) >= 150 and any(p.startswith(g) for p in paths):
            return True
        if lines and any(len(p) >= 12 and p in g for p in paths):
            return True
        return title_like(c) and not is_prose(c)


def learn_headings(pages: DataFrame, shared: dict[str, list[str]]) -> tuple[DataFrame, frozenset[str]]:
    """(site, heads), and heads among the languages' winners: short winning paths below which titles stand more often
    than not, in at least three pages of the host, or of all.

    ``pages`` has site, title, text, paths. Hosts' heads stay in a table; what reaches the driver is bounded by ``shared``.
    """
    tool = Extractor(shared)

    def batches(frames):
        known: dict[tuple[str | None, str], str] = {}
        for pdf in frames:
            seen: Counter = Counter()
            for site, title, text, paths in zip(pdf["site"], pdf["title"], pdf["text"], pdf["paths"], strict=True):
                host, _ = tool.host(site, paths)
                lines = [x for line in text.split("\n") if (x := line.strip())]
                for a, b in zip(lines, lines[1:], strict=False):
                    if len(a) > 60 and len(a.strip(_EDGE)) > 40 and not (site and site in a) and not has_number(a) and len(" ".join(a.split())) > 60:
                        continue  # its path is as long
                    g = known.get((site, a))
                    if g is None:
                        g = generalise(a, site)
                        if len(known) < 100_000:
                            known[(site, a)] = g
                    if len(g) <= 40 and (g in host or g in tool.every) and not parts_of(a)[1:]:
                        lead = lead_of(b, site)
                        below = (title_like(b) and not tool.whole(b, site, host, title)) or bool(lead and lead.startswith("#."))
                        seen[(site, g, g in tool.every, below)] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["site", "path", "common", "below", "n"])

    counted = pages.mapInPandas(batches, "site string, path string, common boolean, below boolean, n long")
    counted = persisted(counted.groupBy("site", "path", "common").agg(F.sum(F.when(F.col("below"), F.col("n")).otherwise(0)).alias("yes"), F.sum("n").alias("n")), "boilerplate-heads")
    heads = "yes >= 3 and yes >= 0.5 * n"
    by_host = counted.where(heads).groupBy("site").agg(F.collect_list("path").alias("heads"))  # some of its winning paths
    common = counted.where("common").groupBy("path").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n")).where(heads)
    return by_host, frozenset(r.path for r in common.select("path").toLocalIterator())


def furniture(articles: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """(field_name, row_id, line_no): lines of ``text``, and whole image contexts, that are not the article's own.

    ``articles`` has article_id, site, url, title, text; ``images`` image_id, article_id, context. Null, empty and blank
    texts and lines give no rows; a page without site uses the paths of its language alone; pages of a host seen less
    than HOST_ARTICLES times likewise. Repeated pages each come out; an empty table gives an empty result.
    """
    pages = articles.select("article_id", "site", "url", "title", "text")
    hosts, shared = winning_paths(pages)
    hosts = persisted(hosts, "boilerplate-hosts")
    few = (hosts.agg(F.sum(F.size("paths"))).first()[0] or 0) <= BROADCAST_PATHS
    bounded = (lambda side: F.broadcast(side)) if few else (lambda side: side)
    by_host, heads = learn_headings(pages.where("text is not null").select("site", "title", "text").join(bounded(hosts), "site", "left"), shared)
    hosts = bounded(persisted(hosts.join(by_host, "site", "left"), "boilerplate-hosts"))

    def tool() -> Extractor:
        made = Extractor(shared)
        made.headings = heads
        return made

    def batches(frames):
        e = tool()
        for pdf in frames:
            rows = []
            for aid, site, title, text, paths, under, contexts in zip(*[pdf[c] for c in ("article_id", "site", "title", "text", "paths", "heads", "contexts")], strict=True):
                host, mine = e.host(site, paths, under)
                e.speak(text)
                won = e.lines(text, site, title, host, mine) if text else []
                rows += [("text", aid, i, None) for i in won]
                if contexts is not None and len(contexts):
                    lines, bad = text.split("\n") if text else [], set(won)
                    rows += [("context", aid, 0, c) for c in contexts if e.context(c, lines, bad, site, title, host)]
            yield pd.DataFrame(rows, columns=["field_name", "row_id", "line_no", "context"])

    schema = "field_name string, row_id long, line_no long, context string"
    placed = pages.join(hosts, "site", "left").select("article_id", "site", "title", "text", "paths", "heads")
    filled = "text is not null and trim(text) <> ''"
    if images is None:
        alone = placed.where(filled).withColumn("contexts", F.lit(None).cast("array<string>"))
        return alone.mapInPandas(batches, schema).select("field_name", "row_id", "line_no")
    with_context = images.where("context is not null and trim(context) <> ''").select("image_id", "article_id", "context")
    # a page's different contexts; each is at most 200 characters, and there are as many as the page has places
    distinct = with_context.select("article_id", "context").distinct().groupBy("article_id").agg(F.collect_list("context").alias("contexts"))
    told = persisted(placed.where(filled).join(distinct, "article_id", "left").union(placed.where(f"not coalesce({filled}, false)").join(distinct, "article_id").select("article_id", "site", "title", "text", "paths", "heads", "contexts")).mapInPandas(batches, schema), "boilerplate-told")
    bad = told.where("field_name = 'context'").select(F.col("row_id").alias("article_id"), "context")
    found = with_context.join(bad, ["article_id", "context"], "left_semi")
    return told.where("field_name = 'text'").select("field_name", "row_id", "line_no").union(found.select(F.lit("context"), "image_id", F.lit(0).cast("long")))


def main_text(articles: DataFrame) -> DataFrame:
    """(article_id, main_text): each page's text without its furniture lines; null stays null."""
    marked = furniture(articles).groupBy("row_id").agg(F.collect_set("line_no").alias("_lines"))  # a page's own lines
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains("_lines", i.cast("long")), F.lit(False))), "\n")
    return articles.join(marked, F.col("article_id") == F.col("row_id"), "left").select("article_id", kept.alias("main_text"))
