"""Template residue, filler, error pages and notices about scripts.

Sentences are the units, longer ones in overlapping windows of WINDOW words. Weak labels come from two sides: whole
short messages by their phrases, filler and the syntax of unfilled placeholders; and the response status of the page:
what stands on failed pages of several hosts more often than the same hosts' other pages would let expect. A linear
classifier with an L2 penalty is trained on hashed word n-grams, on length and on whether a sentence shares words with the
page's title, from the labelled sentences of a bounded sample of pages (``TRAIN_PAGES``, ``TRAIN_ROWS``) of three
quarters of the hosts; the other hosts validate it, and its threshold is the lowest one that keeps ``PRECISION`` there.
The labels only train: whether a sentence is a message is its score alone. A page is residue if a sentence is scored as a
message, or holds filler or a placeholder outside a mention (a short quotation within a longer sentence speaks of it);
both of these are found by their form, as a sentence's n-grams do not show an odd word within prose.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import persisted

from .quality import COMMON

#: The classifier is fitted on the sentences of at most so many pages, and on at most so many of them of either label.
TRAIN_PAGES, TRAIN_ROWS = 20_000, 40_000
DIMENSIONS = 1 << 17
PENALTY = 2e-6
STATUS_WEIGHT = 0.5
#: A sentence weighs as often as it stands, up to this.
OFTEN = 200
#: How much more often than expected a sentence stands on failed pages, to be labelled by the status.
LIFT = 4.0
#: The messages' weight in training, against that of all else.
BALANCE = 0.3
#: Least share of right ones among the messages of the held-out hosts, and the bounds of the threshold.
PRECISION, LOWEST, HIGHEST = 0.95, 0.5, 0.8
WINDOW = 24

#: Whole short messages, in four languages: fixed values. A number or a single word is one only where nothing else follows.
_END = r"[ .!…:)\"”»]*$"
MESSAGES = re.compile(
    r"(?:please |you (?:need|have) to |you must )?(?:enable|allow|activate|turn on) (?:javascript|scripts?|cookies)\b|this (?:app|site|page|website) (?:needs|requires) .*(?:javascript|scripts?|cookies|browser)|javascript (?:is (?:disabled|required|off|turned off|needed)|must be)|your browser (?:does not|doesn't|is not|isn't|must)\b|"
    r"loading(?:…|\.\.\.)|(?:http )?(?:error|erreur|fehler)[ :]*[45]\d\d\b|[45]\d\d" + _END + r"|[45]\d\d[ :–—-]+(?:not found|forbidden|bad gateway|gateway|internal|service|unauthori[sz]ed|too many|something went|page|error|server)\b|error \d+" + _END + r"|"
    r"access (?:to this page )?(?:is |has been )?denied\b|forbidden" + _END + r"|(?:sorry, )?(?:but )?(?:we|it seems we) (?:can't|cannot|could not|couldn't) find (?:that|this|the|what)\b|"
    r"(?:sorry, )?(?:the|this|that) (?:page|address|link|url|story|article|content|site)(?: you (?:were|are) looking for)? (?:could not be (?:found|reached|loaded)|couldn't be found|cannot be (?:found|reached|displayed)|can't be (?:found|reached|displayed)|does not exist|doesn't exist|is not available|is broken|is no longer|no longer exists)|page not found" + _END + r"|"
    r"too many requests|(?:the )?service (?:is )?(?:temporarily )?unavailable|error establishing|bad gateway" + _END + r"|gateway time-?out|nothing (?:here|to see)(?: here| yet)?" + _END + r"|(?:we are )?checking (?:that you|your browser)|we are checking that|just a moment" + _END + r"|you (?:do not|don't) have permission to (?:access|open|view)|"
    r"you have been blocked|(?:are you|verify (?:that )?you(?:'re| are)) (?:a |not a )?(?:robot|human)|request (?:blocked|timed out)|connection (?:timed out|refused|reset)" + _END + r"|"
    r"(?:headline|title|body copy|text|caption|your caption|your name|your text) goes here|this is (?:a sample|sample|dummy|placeholder) (?:text|paragraph|page|post|sentence)|dummy text|sample text" + _END + r"|test post\b|lorem ipsum|"
    r"veuillez activer|(?:ce site|cette page|cette application) (?:a besoin|nécessite) .*(?:scripts?|javascript|navigateur)|accès (?:refusé|interdit)|service (?:momentanément |temporairement )?indisponible|texte (?:provisoire|de remplissage|d'exemple)|(?:la|cette) page (?:demandée |que vous cherchez )?(?:n'existe|est introuvable)|page introuvable|trop de requêtes|oups, |"
    r"bitte (?:aktivieren|schalten) sie|diese (?:anwendung|seite|website) (?:benötigt|erfordert) .*(?:skripte?|javascript|browser)|diese (?:seite|website) (?:existiert nicht|wurde nicht gefunden)|zugriff verweigert|der dienst ist .*nicht (?:erreichbar|verfügbar)|hier steht (?:ein|der) .*text|blindtext|mustertext|beispieltext|seite nicht gefunden|zu viele anfragen|hoppla, |"
    r"activa (?:javascript|los scripts)|(?:este sitio|esta página|esta aplicación) (?:necesita|requiere) .*(?:scripts?|javascript|navegador)|esta página no existe|acceso denegado|texto (?:de muestra|de relleno|provisional)|página no encontrada|servicio no disponible|demasiadas (?:solicitudes|peticiones)|vaya, |¡?ups, ",
    re.IGNORECASE,
)
#: A message has at most so many words.
MESSAGE_WORDS = 16
#: Syntax of unfilled placeholders: fixed values.
PLACEHOLDER = re.compile(
    r"\{\{[^{}]{0,80}\}\}|\{%[^%]{0,80}%\}|<%[^%]{0,80}%>|\$\{[^{}]{0,60}\}|\[\[[^\[\]]{1,60}\]\]|%%\w{2,40}%%|@@\w{2,40}@@|__[A-Z][A-Z_]{2,40}__|%[A-Z][A-Z_]{2,40}%|#\{[^{}]{1,60}\}|\{\d{1,2}\}|(?<![\w{])\{[a-z][a-z_.]{1,40}\}|<!--.{0,80}?-->|"
    r"\$[A-Z][A-Z_]{2,40}\$|\[\w{2,20}:\w{2,30}\]|\[object \w+\]|\bNaN\b|\bundefined[ ,]+undefined\b|\bnull[ ,]+null\b|\bNone None\b|\bT[Kk](?:[ ,]+T[Kk])+\b|\bTKTK\b|\b(?:x{4,}\s+)+x{4,}\b|\b(?:asdf\s*){2,}|\bqwerty qwerty\b|%\(\w+\)s|"
    r"<[A-Z]{3,30}>|<(?:placeholder|title|name|author|date|body|text|headline|byline|image|caption|fetch_method|method|insert[^<>]{0,30}|your[^<>]{0,30})>|"
    r"\[(?:[^\[\]]{0,30}\b)?(?:INSERT|TBC|TBD|TODO|PLACEHOLDER|XX+|insert [a-z ]{1,30}|your [a-z ]{1,30}|[a-z ]{1,20} (?:goes )?here|placeholder|to come|method|name|title|author|date|caption|headline)(?:\b[^\[\]]{0,30})?\]"
)
_ALONE = re.compile(r"^(?:undefined|null|NaN|None|TODO|TBD|TBC|N/A|placeholder|lorem ipsum|test|xxx+)[.!]?$", re.IGNORECASE)
_FILLER = re.compile(r"\b(?:lorem|ipsum|dolor sit|consectetur|adipiscing)\b", re.IGNORECASE)
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»]?\s+(?=[^\W\d_]|[0-9¿¡“«{\[<%_$@&])")
_WORD = re.compile(r"[^\W\d_]+|\d+|[{}\[\]<>%$@_…]")
_DIGITS = re.compile(r"\d+")
_STOPS = (".", "!", "?", "…")
_QUOTED = re.compile(r"“[^“”]{1,200}”|\"[^\"]{1,200}\"|«[^«»]{1,200}»|(?<!\w)['‘][^'‘’]{2,120}['’](?!\w)|„[^„“”]{1,200}[“”]")
#: Values of fetch_method that a fetcher writes; case does not matter.
METHODS = ("static", "playwright", "failed", "")
_METHOD = re.compile(r"^[\[{<%$_#@(].*[\]}>%_)@]$|^(?:undefined|null|nan|none|todo|tbd|tbc|fixme|placeholder|xxx+|insert.*|n/a|\?+)$", re.IGNORECASE)


def sentences(text: str) -> list[str]:
    """The sentences of a text's lines, quotation marks around a whole line taken off."""
    out = []
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            continue
        if len(s) > 2 and s[0] in "“\"«„" and s[-1] in "”\"»“" and not any(c in s[1:-1] for c in "“”«»„\""):
            s = s[1:-1]
        out += [p for p in _SENTENCE.split(s) if p]
    return out


def mentions(sentence: str, at: int, end: int) -> bool:
    """Whether the place lies in a short quotation within a sentence that says more."""
    for m in _QUOTED.finditer(sentence):
        if m.start() <= at and end <= m.end():
            inside, outside = len(m.group().split()), len((sentence[: m.start()] + sentence[m.end() :]).split())
            if outside >= max(3, inside // 2):
                return True
    return False


def has_placeholder(sentence: str) -> bool:
    s = html.unescape(sentence) if "&" in sentence else sentence
    if _ALONE.match(s.strip()):
        return True
    return any(not mentions(s, m.start(), m.end()) for m in PLACEHOLDER.finditer(s))


def filler(sentence: str) -> bool:
    """Dummy Latin: its words, or five words and more without one that any of the four languages uses often."""
    m = _FILLER.search(sentence)
    if m and not mentions(sentence, m.start(), m.end()):
        return True
    words = [w.lower() for w in re.findall(r"[^\W\d_]{2,}", sentence)]
    return len(words) >= 6 and sentence.rstrip()[-1:] == "." and not any(w in COMMON for w in words) and len(set(words)) < len(words)


def phrase_label(sentence: str) -> bool:
    """The weak label by phrase: a message begins the sentence, or the sentence is filler or holds a placeholder."""
    return begins_like_message(sentence) or filler(sentence) or has_placeholder(sentence)


def begins_like_message(sentence: str) -> bool:
    """A whole short message: its phrase begins the sentence, and little follows."""
    return len(sentence) <= 200 and len(sentence.split()) <= MESSAGE_WORDS and bool(MESSAGES.match(sentence.strip(" \t–—-•*#\"“'‘")))


def generalised(sentence: str) -> str:
    """Lower case, numbers by their kind: what only differs in numbers counts as one sentence."""
    return _DIGITS.sub(lambda m: number_kind(m.group()), sentence.strip().lower())


def number_kind(digits: str) -> str:
    """The length of a number; of three digits (a status may be meant) also the first one."""
    return f"#3{digits[0]}" if len(digits) == 3 else f"#{min(len(digits), 9)}"


def words_of(sentence: str) -> list[str]:
    return [(number_kind(w) if w[0].isdigit() else w) for w in _WORD.findall(sentence.lower())]


def windows(words: list[str]) -> list[tuple[list[str], bool, bool]]:
    """(words, whether the sentence begins, whether it ends there): the whole, or overlapping windows of a long one."""
    if len(words) <= WINDOW + 1:
        return [(words, True, True)]
    starts = list(range(0, len(words) - WINDOW, WINDOW // 2)) + [len(words) - WINDOW]
    return [(words[i : i + WINDOW], i == 0, i + WINDOW >= len(words)) for i in starts]


def grams_of(words: list[str], begins: bool, ends: bool, stop: bool) -> set[str]:
    """Word unigrams, bigrams and the first three words; buckets of length; whether a full stop ends it."""
    grams = set(words)
    grams.update(map(" ".join, zip(words, words[1:], strict=False)))
    if begins:
        grams.update("^" + " ".join(words[:k]) for k in (1, 2, 3))
    grams.add(f"len{len(words) // 4}" if begins and ends else "part")
    if ends:
        grams.add(f"end{stop}")
    return grams


def title_gram(words: list[str], title_words: frozenset[str]) -> str:
    return f"title{min(2, sum(w in title_words for w in words))}"


def features(sentence: str, shared: str) -> np.ndarray:
    """Hashed grams of a sentence (its first window), with its bucket of title words."""
    part, begins, ends = windows(words_of(sentence))[0]
    return np.unique(np.array([_hash(g) for g in grams_of(part, begins, ends, sentence.rstrip()[-1:] in _STOPS) | {shared}], np.int64))


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) & (DIMENSIONS - 1)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    #: Lowest score of a message.
    threshold: float
    #: Precision and recall against the phrase labels on hosts that were not trained on, at the threshold.
    precision: float
    recall: float
    sentences: int

    def score(self, found: np.ndarray) -> float:
        return 1.0 / (1.0 + np.exp(-(self.bias + self.weights[found].sum() / np.sqrt(max(1, len(found))))))


class Scorer:
    """Scores sentences; the weights of grams are remembered, up to a bound, which changes no score."""

    def __init__(self, model: Classifier):
        self.model, self.known = model, {}
        t = min(max(model.threshold, 1e-6), 1 - 1e-6)
        self.least = float(np.log(t / (1 - t)))

    def weight(self, gram: str) -> float:
        w = self.known.get(gram)
        if w is None:
            w = float(self.model.weights[_hash(gram)])
            if len(self.known) < 400_000:
                self.known[gram] = w
        return w

    def is_message(self, sentence: str, titled: frozenset[str]) -> bool:
        """Whether a window of the sentence reaches the threshold, and the sentence does not only quote a message."""
        words = words_of(sentence)
        if not words:
            return False
        stop = sentence.rstrip()[-1:] in _STOPS
        for part, begins, ends in windows(words):
            grams = grams_of(part, begins, ends, stop)
            total = sum(map(self.weight, grams)) + self.weight(title_gram(part, titled))
            if self.model.bias + total / np.sqrt(len(grams) + 1) >= self.least:
                return not any(mentions(sentence, m.start() + 1, m.end() - 1) for m in _QUOTED.finditer(sentence))
        return False


def _words_of(title: str | None) -> frozenset[str]:
    return frozenset(w for w in _WORD.findall((title or "").lower()) if len(w) > 3 and w not in COMMON)


def train(rows: list[tuple[np.ndarray, float, float, bool]], rounds: int = 150, rate: float = 0.5, penalty: float = PENALTY) -> Classifier:
    """Logistic regression by full-batch AdaGrad. Rows: features, label, weight, whether the host is held out.

    The held-out hosts give the threshold and the figures; the weights are then fitted again on all hosts.
    """
    out = _logistic([r for r in rows if not r[3]], rounds, rate, penalty)
    held = sorted(((out.score(r[0]), r[1] == 1.0, r[2]) for r in rows if r[3] and r[1] in (0.0, 1.0)), key=lambda x: -x[0])
    figures = gate(held)
    if held:
        out = _logistic(rows, rounds, rate, penalty)
    out.threshold, out.precision, out.recall = figures
    return out


def _logistic(fit: list[tuple[np.ndarray, float, float, bool]], rounds: int, rate: float, penalty: float) -> Classifier:
    index = np.concatenate([r[0] for r in fit]) if fit else np.empty(0, np.int64)
    size = np.array([len(r[0]) for r in fit], np.int64)
    row = np.repeat(np.arange(len(fit)), size)
    scale = np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)
    y, w = np.array([r[1] for r in fit]), np.array([r[2] for r in fit])
    w = np.where(y > 0.5, w * BALANCE * max(w[y <= 0.5].sum(), 1.0) / max(w[y > 0.5].sum(), 1.0), w)
    theta, bias, seen, seen_bias = np.zeros(DIMENSIONS), -2.0, np.full(DIMENSIONS, 1e-8), 1e-8
    total = max(w.sum(), 1.0) if len(fit) else 1.0
    for _ in range(rounds if len(fit) else 0):
        z = np.bincount(row, theta[index] * scale, len(fit)) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * w / total
        grad = np.bincount(index, g[row] * scale, DIMENSIONS) + penalty * theta
        seen += grad**2
        theta -= rate * grad / np.sqrt(seen)
        seen_bias += g.sum() ** 2
        bias -= rate * g.sum() / np.sqrt(seen_bias)
    return Classifier(theta, float(bias), 0.5, float("nan"), float("nan"), len(fit))


def gate(held: list[tuple[float, bool, float]]) -> tuple[float, float, float]:
    """(threshold, precision, recall): the lowest score in bounds down to which the held-out sentences keep PRECISION.

    ``held`` has (score, whether labelled, weight), best first. Without held-out messages the threshold is 0.5.
    """
    right = wrong = 0.0
    whole = sum(w for _, t, w in held if t)
    if not whole:
        return 0.5, float("nan"), float("nan")
    best = (HIGHEST, 1.0, 0.0)
    for s, labelled, w in held:
        if s < LOWEST:
            break
        right, wrong = right + w * labelled, wrong + w * (not labelled)
        if s >= HIGHEST or right >= PRECISION * (right + wrong):
            best = (min(s, HIGHEST), right / (right + wrong), right / whole)
    return best


_LABELLED = "sentence string, g string, site string, held boolean, label int, shared string, n long, failed long"


def labelled_sentences(pages: DataFrame) -> DataFrame:
    """Sentences of the pages, those that only differ in numbers as one, with their label by phrase: counts by host."""

    def batches(frames):
        for pdf in frames:
            seen: dict[tuple, list] = {}
            for site, title, text, method in zip(pdf["site"], pdf["title"], pdf["text"], pdf["fetch_method"], strict=True):
                titled, failed = _words_of(title), method is not None and method.strip().lower() == "failed"
                for s in set(sentences(text)):
                    if filler(s) or has_placeholder(s):
                        continue  # found by their form
                    at = seen.setdefault((generalised(s), site), [s, title_gram(words_of(s), titled), 0, 0])
                    at[2] += 1
                    at[3] += failed
            rows = [(s, g, site, hash_of(site) % 4 == 0, int(begins_like_message(s)), shared, n, failed) for (g, site), (s, shared, n, failed) in seen.items()]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _LABELLED.split(", ")])

    return pages.select("site", "title", "text", "fetch_method").mapInPandas(batches, _LABELLED)


def fit(articles: DataFrame, pages: int = TRAIN_PAGES, most: int = TRAIN_ROWS) -> Classifier:
    """Train on the sentences of at most about ``pages`` pages, chosen by a hash of their id; one host of four validates.

    Of either label about ``most`` sentences at most reach the driver, chosen by their hash with a chance that follows their
    weight; each stands for those that were left out.
    """
    read = articles.where("text is not null and trim(text) <> ''").select("article_id", "site", "title", "text", "fetch_method")
    n = read.count()
    share = min(1.0, pages / max(n, 1))
    sample = read.where((F.pmod(F.xxhash64("article_id"), F.lit(1_000_000)) < int(share * 1_000_000)) | F.lit(share >= 1.0))
    method = F.lower(F.trim("fetch_method"))
    of_site = sample.groupBy("site").agg((F.count_if(method == "failed") / F.count(F.lit(1))).alias("_rate")).select(F.col("site").alias("_site"), "_rate")
    told = labelled_sentences(sample)
    by_host = told.groupBy("g", "site").agg(F.min("sentence").alias("sentence"), F.max("held").alias("held"), F.max("label").alias("label"), F.min("shared").alias("shared"), F.sum("n").alias("n"), F.sum("failed").alias("failed"))
    by_host = by_host.join(of_site, F.col("site").eqNullSafe(F.col("_site")), "left")
    # the status labels what failed pages of several hosts say, beyond what these hosts' other pages do
    by_kind = by_host.groupBy("g", "held").agg(
        F.min("sentence").alias("sentence"), F.max("label").alias("label"), F.min("shared").alias("shared"), F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count_if(F.col("failed") > 0).alias("hosts"), F.sum(F.col("n") * F.col("_rate")).alias("expected")
    )
    status = (F.col("hosts") >= 2) & (F.col("failed") >= LIFT * F.col("expected")) & (5 * F.col("failed") >= F.col("n"))
    made = persisted(by_kind.select("g", "sentence", "held", "label", "shared", "n", "failed", F.coalesce(status, F.lit(False)).alias("status")), "residue-labelled")
    rows = []
    for wanted in ("label = 1 or status", "label = 0 and not status"):
        some = made.where(wanted).withColumn("w", F.least("n", F.lit(OFTEN)).cast("double"))
        # sentences are chosen in proportion to their weight, so that frequent ones all come
        rate = most / max(some.agg(F.sum("w")).first()[0] or 0.0, float(most))
        chance = F.least(F.lit(1.0), F.lit(rate) * F.col("w"))
        part = some.withColumn("chance", chance).where(F.pmod(F.xxhash64("g"), F.lit(1_000_000)) < F.col("chance") * 1_000_000).limit(2 * most)
        for r in part.orderBy("g", "held").toLocalIterator():
            lone = r.status and not r.label
            rows.append((features(r.sentence, r.shared), 0.9 if lone else float(r.label), r.w / r.chance * (STATUS_WEIGHT if lone else 1.0), r.held))
    return train(rows)


def hash_of(text: str | None) -> int:
    return _hash(text or "")


def residue(articles: DataFrame, model: Classifier | None = None) -> DataFrame:
    """(article_id) of the pages to leave out.

    A null, empty or blank text is no case by itself; an unfilled placeholder as ``fetch_method`` is one whatever the
    text; a null or capitalised method is none. Repeated pages each come out; the model is bounded by DIMENSIONS.
    """
    model = model or fit(articles)
    shared = articles.sparkSession.sparkContext.broadcast(model)

    def batches(frames):
        known: dict[tuple[str, frozenset[str]], bool] = {}
        scorer = Scorer(shared.value)
        for pdf in frames:
            out = []
            for aid, title, text, method in zip(pdf["article_id"], pdf["title"], pdf["text"], pdf["fetch_method"], strict=True):
                bad = method is not None and method.strip().lower() not in METHODS and bool(_METHOD.match(method.strip()))
                if not bad and text and text.strip():
                    titled = _words_of(title)
                    for s in sentences(text):
                        # a sentence is scored with the title words it shares: others do not matter to it
                        key = (s, frozenset(w for w in titled if w in s.lower())) if len(s) <= 120 else None
                        hit = known.get(key) if key else None
                        if hit is None:
                            hit = has_placeholder(s) or filler(s) or scorer.is_message(s, titled)
                            if key and len(known) < 50_000:
                                known[key] = hit
                        if hit:
                            bad = True
                            break
                if bad:
                    out.append(aid)
            yield pd.DataFrame({"article_id": pd.Series(out, dtype="int64")})

    return articles.select("article_id", "title", "text", "fetch_method").mapInPandas(batches, "article_id long")


def validation(articles: DataFrame) -> DataFrame:
    """(sentences, threshold, precision, recall): the classifier's figures on the hosts it was not trained on."""
    m = fit(articles)
    return articles.sparkSession.createDataFrame([(m.sentences, m.threshold, m.precision, m.recall)], "sentences long, threshold double, precision double, recall double")
