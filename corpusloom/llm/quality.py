"""Text statistics and posterior text types.

Every line of a document is a block. Thresholds on its statistics are noisy labelling functions that vote for a
type (prose, list, table, junk) or abstain. Their accuracies are learnt without labels: the votes of all blocks
of all documents are counted by vote pattern, and expectation-maximization over these counts (Dawid and Skene's
model, started from the majority vote) fits the class shares and each function's vote distribution by class. A
document's types are the posteriors of its blocks, weighted by their characters.

The text is read once. What reaches the driver is one row for each distinct pattern, at most 5 to the power of
the number of functions in theory and some hundreds in fact, however many documents there are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.runtime import persisted

TYPES = ("prose", "list", "table", "junk")
ABSTAIN, PROSE, LIST, TABLE, JUNK = range(5)
BASE = 5

#: Common words of English, French, German and Spanish.
COMMON = frozenset(
    """
    a about after again against all also although always an and another any are as at be because been before behind
    below between both but by can could did do does each every for from had has have he her here his how i if in inside
    into is it its like many more most my near never no nobody not nothing now of often on once one only or other our
    out over own she since so some still than that the their them then there these they this those through to together
    too under until up was we were what when where which while who why will with without would yet you your
    au aux avec avant car ce ces cet cette chez comme comment contre dans de des devant donc dont du elle elles en encore
    entre est et eux il ils je jamais la le les leur leurs lui mais mes moi mon même ne nos notre nous on ou où par pas
    pendant peut plus pour pourquoi puis qu que quel quelle qui sa sans se selon ses si son sont sous sur ta tandis te
    tes toi ton très tu un une vers votre vous y à été être
    aber als am an auch auf aus bei beim bin bis bist da dann das dass dem den denn der des die dies diese doch dort du
    durch ein eine einem einen einer eines er es fern für gegen haben hat hinter ich ihr im in ins ist ja kein keine
    kann man mit nach neben nicht noch nur ob oder ohne seit sei sein seine sich sie sind so über um und uns unter vom
    von vor war warum was weil wenn wer wie wieder wir wird wo zu zum zur zwischen
    al algo ante aquel aquella aunque bajo cada como con contra cual cuando cómo de del desde donde dos durante e el ella
    en entre era es esa ese eso esta este esto está fue ha hacia hasta hay la las le lo los mas me mi mientras muy más ni
    no nos o otra otro para pero por porque que quien qué quién se según ser si sin sobre son su sus sí también te tras
    tu un una uno vez y ya
    """.split()
)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_BULLET = re.compile(r"\s*(?:[•‣▪·◦●○■□*+→>#-]|[–—]\s|\(?\d{1,3}[.):]\s|\(?[a-zA-Z][.)]\s|\[[ xX]\])")
_CELLS = re.compile(r"\t|\s\|\s|^\s*\||\S {3,}\S|\.{4,}|^[^,\n]{0,40}(?:,[^,\s][^,\n]{0,40}|,){2,}$|^[\w .-]{1,24}\s?[:=]\s?\S{1,24}\s*$|;[^;\s][^;\n]{0,40};")
_CODE = re.compile(r"[{}]\s*[.;)]|[{};]\s*(?:var|function|return)\b|=\s*function|\);|</?\w+[^>]*>|^\s*[\[{\"].*[\]}\",]\s*$|\d{4}-\d\d-\d\dT\d|https?://\S+\s*$|^\s*\S{40,}\s*$|\\x[0-9a-f]{2}")
_END = re.compile(r"[.!?…][\"'”’»)\]]*\s*$")
_LEADER = re.compile(r"\.{4,}\s*\d*\s*$")
_LINES = re.compile("[\n\r\u2028\u2029\x85\x0b\x0c]+")
_KEPT = frozenset(".,;:!?…'’‘\"“”«»„()-–—/%&¿¡_")


class _Classes(dict):
    """Code point to class: a letter, d digit, s white space, p usual punctuation, o other."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "a" if c.isalpha() else "d" if c.isdigit() else "s" if c.isspace() else "p" if c in _KEPT else "a" if c.isalnum() else "o"
        return kind


_CLASS = _Classes()
_common = COMMON.__contains__


class Line:
    """Counts of one line."""

    __slots__ = ("chars", "common", "digits", "ended", "length", "letters", "odd", "text", "words")

    def __init__(self, text: str):
        kinds = text.translate(_CLASS)
        words = _WORD.findall(text.lower())
        self.text, self.words, self.chars = text, words, len(text)
        self.letters, self.digits, self.odd = kinds.count("a"), kinds.count("d"), kinds.count("o")
        self.common, self.length = sum(map(_common, words)), sum(map(len, words))
        self.ended = bool(_END.search(text[-12:]))


def line_votes(x: Line, short_lines: bool, repeats: bool, continues: bool = False) -> tuple[int, ...]:
    """The labelling functions' votes for a line; ``continues``: the line above is unended prose."""
    n, line = len(x.words), x.text
    common = x.common / n if n else 0.0
    digits, odd = x.digits / x.chars, x.odd / x.chars
    share = (x.letters + line.count(" ")) / x.chars
    mean = x.length / n if n else 0.0
    leader = "...." in line and bool(_LEADER.search(line))
    speech = n >= 5 and common >= 0.18 and not leader
    plain = speech and x.ended and not odd and share > 0.75
    return (
        PROSE if common >= 0.18 and n >= 3 and not leader else JUNK if n >= 8 and common < 0.06 else ABSTAIN,
        PROSE if share >= 0.92 and n >= 4 else JUNK if share < 0.55 else ABSTAIN,
        TABLE if digits > 0.12 else ABSTAIN,
        LIST if not speech and _BULLET.match(line) else ABSTAIN,
        TABLE if leader or (common < 0.15 and _CELLS.search(line)) else ABSTAIN,
        PROSE if n >= 4 and x.ended and common > 0.1 else ABSTAIN,
        LIST if short_lines and n <= 4 and common < 0.6 else TABLE if leader else ABSTAIN,
        PROSE if (speech and odd < 0.03 and digits < (0.25 if x.ended else 0.12)) or (continues and x.ended and not leader) else ABSTAIN,
        JUNK if odd > 0.08 or (not plain and _CODE.search(line)) else ABSTAIN,
        JUNK if n and (mean > 13 or (mean < 2.2 and n >= 4)) else ABSTAIN,
        JUNK if repeats else ABSTAIN,
    )


FUNCTIONS = 11


def describe(text: str | None) -> tuple[dict[str, float | int | None], dict[int, int]]:
    """Statistics of a text, and the characters of its lines by vote pattern. Null and blank texts have no lines."""
    lines = [Line(x) for x in _LINES.split(text) if x and not x.isspace()] if text else []
    counts = sorted(len(x.words) for x in lines)
    words, chars = sum(counts), sum(x.chars for x in lines)
    common = sum(x.common for x in lines)
    stats = {
        "n_words": words,
        "n_lines": len(lines),
        "mean_word_length": sum(x.length for x in lines) / words if words else None,
        "symbol_ratio": sum(x.odd for x in lines) / chars if chars else None,
        "ended_line_share": sum(x.ended for x in lines) / len(lines) if lines else None,
        "common_word_share": common / words if words else None,
    }
    short = len(lines) >= 4 and counts[len(counts) // 2] <= 4
    repeats = words >= 20 and common / words < 0.2 and len({w for x in lines for w in x.words}) / words < (0.3 if words < 400 else 0.12)
    by_pattern: dict[int, int] = {}
    continues = False
    for x in lines:
        code = 0
        for v in line_votes(x, short, repeats, continues):
            code = code * BASE + v
        by_pattern[code] = by_pattern.get(code, 0) + x.chars
        continues = not x.ended and len(x.words) >= 4 and x.common >= 0.18 * len(x.words)
    return stats, by_pattern


_STATS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("mean_word_length", T.DoubleType()),
        T.StructField("symbol_ratio", T.DoubleType()),
        T.StructField("ended_line_share", T.DoubleType()),
        T.StructField("common_word_share", T.DoubleType()),
    ]
)
_BLOCKS = T.StructType([*_STATS.fields, T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("chars", T.ArrayType(T.LongType()))])


def blocks(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, statistics, pattern codes and their characters) of each row; one pass over the texts."""

    def batches(it):
        names = [f.name for f in _BLOCKS.fields]
        for batch in it:
            rows = [describe(t) for t in batch.column(1).to_pylist()]
            cols = [batch.column(0)]
            cols += [pa.array([s[f.name] for s, _ in rows], pa.int64() if isinstance(f.dataType, T.LongType) else pa.float64()) for f in _STATS.fields]
            cols += [pa.array([list(p) for _, p in rows], pa.list_(pa.int64())), pa.array([list(p.values()) for _, p in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *names])

    schema = T.StructType([df.schema[key], *_BLOCKS.fields])
    return df.select(key, text).mapInArrow(batches, schema)


def votes_of(codes: np.ndarray, functions: int = FUNCTIONS) -> np.ndarray:
    return np.stack([(codes // BASE**i) % BASE for i in range(functions - 1, -1, -1)], axis=1).astype(int)


def learn_types(codes: np.ndarray, counts: np.ndarray, functions: int = FUNCTIONS, rounds: int = 60, prior: float = 1.0) -> np.ndarray:
    """Posterior of each type for each pattern, by expectation-maximization on the vote counts.

    Votes are tied to their class by the start (majority vote, prose where none votes) and a prior that the
    functions are better than chance; an abstention is evidence like any vote.
    """
    votes, k = votes_of(codes, functions), len(TYPES)
    tally = np.stack([(votes == c + 1).sum(1) for c in range(k)], axis=1) + 1e-3
    tally[:, 0] += 2e-3
    post = tally / tally.sum(1, keepdims=True)
    onehot = np.eye(BASE)[votes]  # pattern, function, vote
    for _ in range(rounds):
        weight = post * counts[:, None]
        share = (weight.sum(0) + 1) / (weight.sum() + k)
        theta = np.einsum("pk,pfv->kfv", weight, onehot) + prior
        for c in range(k):
            theta[c, :, c + 1] += prior
        theta /= theta.sum(2, keepdims=True)
        log = np.log(share)[None] + np.einsum("pfv,kfv->pk", onehot, np.log(theta))
        new = np.exp(log - log.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post


def text_types(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics, posterior types and the leading type of each row.

    Columns: ``key``, the six statistics, ``prose, list, table, junk`` (shares of the characters, by posterior)
    and ``text_type``. Null, empty and blank texts have zero words and lines, null ratios, null shares and a null
    type. Repeated rows each come out; other columns are dropped; an empty table gives an empty result.
    """
    made = persisted(blocks(df, key, text), "blocks")
    table = made.select(F.explode("codes").alias("code")).groupBy("code").count().toPandas()
    if len(table) == 0:
        known: dict[int, list[float]] = {}
    else:
        table = table.sort_values("code")
        known = dict(zip(table["code"].tolist(), learn_types(table["code"].to_numpy(), table["count"].to_numpy()).tolist(), strict=True))

    schema = T.StructType([df.schema[key], *_STATS.fields, *[T.StructField(t, T.DoubleType()) for t in TYPES]])

    def batches(it):
        for batch in it:
            shares = []
            for codes, chars in zip(batch.column("codes").to_pylist(), batch.column("chars").to_pylist(), strict=True):
                total = sum(chars)
                shares.append([sum(known[c][t] * n for c, n in zip(codes, chars, strict=True)) / total for t in range(len(TYPES))] if total else [None] * len(TYPES))
            cols = [batch.column(0), *[batch.column(f.name) for f in _STATS.fields], *[pa.array([s[t] for s in shares], pa.float64()) for t in range(len(TYPES))]]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    top = F.greatest(*TYPES)
    named = F.lit(None).cast("string")
    for t in reversed(TYPES):
        named = F.when(F.col(t) == top, F.lit(t)).otherwise(named)
    return made.mapInArrow(batches, schema).withColumn("text_type", F.when(top.isNotNull(), named))
