"""A prefix-tree hash forest over short texts, kept as sorted runs.

The words of a text, hashed within its group, are its signature; each word leads one permutation of it. The permutations of
all texts, sorted by their leading hash, are a forest of prefix trees, and every batch adds one run of it. Four sorted
runs belong to a batch: ``posts`` (a row for each permutation), ``words`` (each word with its count and,
where it is one, the text that has it), ``near`` (the words one slip apart, one of them of the batch; they are found by what is left of
them without one letter, among words that begin or end alike) and ``askers`` (the
prefix that a text is looked up by).

An entry is located by the range of permutations that begin with its rarest word or a near one. Of two texts that
``articles.same_title`` can call the same, each word of the shorter one stands in the longer, at most one slip away
(``lenient``: all but two words); so the range of one word, with its near words, holds every partner, and that is the
recall target: all. Where a range of one word holds more than ``bucket`` texts the prefix is kept at two words, which
misses nothing either, as the second word stands in the partner too. Ranges are never cut. What is located is checked by
bit sets of the words before texts are compared.

Both directions are searched: the batch's entries in all runs, and the older askers in the batch. Older runs are only
joined, neither shortened nor written again; ``merge`` makes one run of many and picks anew the prefixes whose ranges
have filled up since.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.runtime import broadcast_if_small, persisted, shared_dir, together

#: Where more texts have a text's rarest word, or nearly, its two rarest words are looked up together.
BUCKET = 64
#: The files of permutations and askers are split by so many leading bits of the hash.
RANGE_BITS = 8
#: At most so many letters at either end tell which words meet in a task.
END = 3
MISSING = 2
SHORT = 4
#: Places, a power of two, that a batch's few words are marked in before they are searched.
SEEN = 1 << 23


def _number(w: Column) -> Column:
    return w.rlike("^[0-9]+$")


def _left_over(batches):
    """(c, w, own): each word of (w, g, word, own) under hashes of itself and of what is left of it without one letter."""
    odd, mix, step = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 1 << 20
    for b in batches:
        w, g, own = (b.column(x).to_numpy(zero_copy_only=False) for x in ("w", "g", "own"))
        word, length = b.column("word").to_numpy(zero_copy_only=False), pc.utf8_length(b.column("word")).to_numpy(zero_copy_only=False)
        for n in np.unique(length).tolist():
            every = np.flatnonzero(length == n)
            for part in np.array_split(every, 1 + len(every) * n // step):
                letters = word[part].astype(f"<U{n}").view(np.uint32).reshape(-1, n).astype(np.uint64) * mix
                letters ^= letters >> np.uint64(31)
                place = np.cumprod(np.full(n, odd))  # powers, modulo 2 ** 64
                at = letters * place
                moved = np.zeros_like(at)
                moved[:, 1:] = letters[:, 1:] * place[:-1]  # what comes after the letter moves up
                whole = at.sum(axis=1, keepdims=True)
                left = np.cumsum(at, axis=1) - at + moved.sum(axis=1, keepdims=True) - np.cumsum(moved, axis=1)
                c = (np.hstack([whole, left]) ^ (g[part].view(np.uint64) * odd)[:, None]) * mix
                c ^= c >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([pa.array(c.ravel().view(np.int64)), pa.array(np.repeat(w[part], n + 1)), pa.array(np.repeat(own[part], n + 1))], ["c", "w", "own"])


def _pairs(c: np.ndarray, w: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """(w, v): the pairs under one key of which one is the batch's, both ways round."""
    one, two, at, by = [w[:0]], [w[:0]], np.arange(len(c)), 1
    while len(at := at[at + by < len(c)]) and len(at := at[c[at] == c[at + by]]):  # as many words a key as the alphabet allows
        i = at[(w[at] != w[at + by]) & (own[at] | own[at + by])]
        one, two, by = [*one, w[i], w[i + by]], [*two, w[i + by], w[i]], by + 1
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(one)), pa.array(np.concatenate(two))], ["w", "v"])


def _sharing(batches):
    """The pairs of words that share a key, of all rows (w, g, word, own) of a task; a row may come twice."""
    batches = [b for b in batches if b.num_rows]
    if batches:
        rows = pa.Table.from_batches(batches)
        w, own = (rows.column(x).to_numpy() for x in ("w", "own"))
        order = np.lexsort((~own, w))
        once = order[np.append(True, np.diff(w[order]) != 0)]  # of a word that is old and the batch's, the batch's row
        keys = list(_left_over(rows.take(pa.array(once)).combine_chunks().to_batches()))
        c, w, own = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in keys]) for i in range(3))
        order = np.argsort(c)
        yield _pairs(c[order], w[order], own[order])


def _ends() -> Column:
    """Keys of which words (g, word) one slip apart share one: the slip leaves half of the letters but one at one end as they are.

    A word meets those as long as it is, one letter longer and one letter shorter; the shorter one tells how many letters count.
    """

    def of(letters: int) -> list[Column]:
        return [F.xxhash64(F.lit(at), "g", F.substring("word", at, letters)) for at in (1, -letters)]

    def number(shorter: int) -> int:
        return min(END, (shorter - 1) // 2)

    def both(n: int) -> Column:
        return F.array(*[key for letters in sorted({number(n), number(max(n - 1, 3))}) for key in of(letters)])

    out = F.when(F.length("word") == 3, both(3))
    for n in range(4, 2 * END + 2):
        out = out.when(F.length("word") == n, both(n))
    return out.otherwise(both(2 * END + 2))


def _matching(words: pa.Table):
    """What gives the pairs of rows (w, g, word, own) with these words, both ways round."""

    keys = list(_left_over(words.to_batches()))
    c, w = (np.concatenate([np.empty(0, np.int64), *[b.column(i).to_numpy(zero_copy_only=False) for b in keys]]) for i in (0, 1))
    order = np.argsort(c)
    c, w = c[order], w[order]

    def match(batches):
        seen = np.zeros(SEEN, bool)  # most keys that are asked for are none of these
        seen[c & (SEEN - 1)] = True
        for b in _left_over(batches):
            asked, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            likely = seen[asked & (SEEN - 1)]
            asked, v = asked[likely], v[likely]
            first = np.searchsorted(c, asked)
            hit = np.flatnonzero(c[np.minimum(first, len(c) - 1)] == asked) if len(c) else first[:0]
            n = np.searchsorted(c, asked[hit], "right") - first[hit]
            at = np.repeat(first[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
            one, two = w[at], np.repeat(v[hit], n)
            one, two = one[one != two], two[one != two]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([one, two])), pa.array(np.concatenate([two, one]))], ["w", "v"])

    return match


def _near(own: DataFrame, older: DataFrame | None) -> DataFrame:
    """(w, v): the batch's words (w, g, word) and words of a group one slip apart from them, both ways round.

    Two words one slip apart share what is left of one or both without one letter. Numbers and short words only match themselves. A batch of
    counted few words goes to the tasks of the older ones; else the words are shuffled by their ends, and what is left of them stays in the task.
    """
    words = own.select("w", "g", "word", F.lit(True).alias("own"))
    if older is not None:
        words = words.union(older.select("w", "g", "word", F.lit(False)))
    words = words.where((F.length("word") >= 3) & ~_number(F.col("word")))
    if older is not None:
        few = words.where("own").limit(runtime.BROADCAST_ROWS + 1).toArrow()
        if few.num_rows <= runtime.BROADCAST_ROWS:
            return words.mapInArrow(_matching(few), "w long, v long").distinct()
    return words.select("*", F.explode(_ends()).alias("_end")).repartition("_end").drop("_end").mapInArrow(_sharing, "w long, v long").distinct()


def _widened(rows: DataFrame, near: DataFrame, c: str) -> DataFrame:
    """The rows, and again with each near word in the place of the word in column ``c``."""
    beside = near.select(F.col("w").alias("_w"), "v")
    return rows.union(rows.join(beside, F.col(c) == F.col("_w")).select(*[F.col("v" if x == c else x).alias(x) for x in rows.columns]))


def _texts_with(words: DataFrame, near: DataFrame) -> DataFrame:
    """The words (w, df, …) with nd for df: how many texts have the word or one near it."""
    more = near.join(words.select(F.col("w").alias("v"), "df"), "v").groupBy("w").agg(F.sum("df").alias("more"))
    kept = [c for c in words.columns if c != "df"]
    return words.join(more, "w", "left").select(*kept, (F.col("df") + F.coalesce("more", F.lit(0))).alias("nd"))


def _located(askers: DataFrame, posts: DataFrame, on: list[str], lenient: bool) -> DataFrame:
    """(a, b): pairs of a shorter text that asks and a longer one in its range whose words' bits leave them possible."""
    pairs = askers.alias("l").join(posts.alias("r"), on).where("l.k <> r.k and l.n <= r.n")
    missing = F.bit_count(F.col("l.bits").bitwiseAND(F.bitwise_not(F.col("r.bits"))))
    allowed = F.when(F.col("l.n") <= SHORT, MISSING - 1).otherwise(MISSING) + (2 if lenient else 0)
    return pairs.where(missing <= allowed).select(F.least("l.k", "r.k").alias("a"), F.greatest("l.k", "r.k").alias("b"))


def _one() -> list[Column]:
    """Of the texts that have a word, one, where it is the only one; else the least of each column."""
    return [F.min(c).alias(c) for c in ("k", "n", "bits")]


def _group(group: str, text: str) -> Column:
    """Texts of one group have the same numbers, but for years."""
    numbers = F.array_join(F.filter(F.split(text, " "), lambda w: _number(w) & ~w.rlike("^(19|20)[0-9][0-9]$")), " ")
    return F.xxhash64(F.col(group), F.when(F.col(text).rlike("[0-9]"), numbers).otherwise(""))


def _signed(entries: DataFrame, group: str, text: str, key: str) -> DataFrame:
    """(k, g, n, _w, bits): the entries' keys, groups, sizes, different words and bit sets."""
    words = F.split(text, " ")
    named = entries.select(F.col(key).alias("k"), _group(group, text).alias("g"), F.size(words).alias("n"), F.array_distinct(words).alias("_w"))
    bits = F.aggregate("_w", F.lit(0).cast("long"), lambda acc, w: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64("g", w).bitwiseAND(F.lit(63)).cast("int"))))
    return named.withColumn("bits", bits)


def _led(texts: DataFrame) -> DataFrame:
    """(g, k, n, bits, word, w): a row for each word of the texts (g, k, n, bits, _w)."""
    return texts.select("g", "k", "n", "bits", F.explode("_w").alias("word")).withColumn("w", F.xxhash64("g", "word"))


class HashForest:
    """The forest in the folder ``path``: ``<part>/run=<n>``."""

    def __init__(self, spark: SparkSession, path: str, lenient: bool = False, bucket: int = BUCKET, once: bool = False):
        self.spark, self.path, self.lenient, self.bucket = spark, path.rstrip("/"), lenient, bucket
        #: A forest that is located once and not kept needs no order on disk.
        self.once = once

    def read(self, part: str, before: int | None = None) -> DataFrame | None:
        """A part of all runs, or of those before a run; null where there are none."""
        try:
            found = self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException:
            return None
        found = found if before is None else found.where(F.col("run") < before)
        return found.drop("run")

    def _write(self, rows: DataFrame, part: str, run: int, lead: str, spread: bool = False) -> DataFrame:
        """``spread``: an aggregation has dealt the rows out evenly, so they are sorted where they are."""
        if not self.once:
            # hashes are spread evenly, so their first bits are ranges of like size and no sample is needed
            rows = (rows if spread else rows.repartition(F.shiftright(lead, 64 - RANGE_BITS))).sortWithinPartitions(lead)
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}/run={run}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{part}/run={run}")

    def add(self, entries: DataFrame, group: str, text: str, key: str, run: int = 0) -> DataFrame:
        """Persist a batch as a run and locate it: (a, b), a < b, the pairs with an entry of the batch, each once.

        ``key`` is a number that no older entry has; texts are words with single blanks between them. Entries with equal
        words pair too; an empty batch gives no pairs and an empty run.
        """
        older = self.read("posts", run) if run else None
        signed = persisted(_signed(entries, group, text, key), "forest-signed")
        led = _led(signed)
        mine, own = together(
            lambda: self._write(led.select("w", "g", "k", "n", "bits"), "posts", run, "w"),
            lambda: self._write(led.groupBy("w", "g", "word").agg(F.count(F.lit(1)).alias("df"), *_one()), "words", run, "w", spread=True),
        )
        every = mine if older is None else older.select(*mine.columns).union(mine)

        # all words one slip apart from the batch's words, and how many texts each of them has
        known_words = self.read("words", run) if run else None
        near = self._write(_near(own, known_words), "near", run, "w", spread=True)
        counted = own.select("w", "g", "k", "n", "bits", "df")
        if known_words is not None:
            wanted = broadcast_if_small(persisted(own.select("w").union(near.select("v")).distinct(), "forest-wanted"))
            before = known_words.select(*counted.columns).join(wanted, "w", "left_semi")
            counted = persisted(before.union(counted).groupBy("w", "g").agg(*_one(), F.sum("df").alias("df")), "forest-summed")

        # the prefix a text is looked up by: its rarest words
        counted = persisted(_texts_with(counted, near), "forest-counted")
        if self.lenient:
            chosen = self._prefixes(mine.join(counted.select("w", "nd").hint("shuffle_hash"), "w"))
        else:
            # a word that no other text has, or nearly has, is the rarest: only texts without one rank their words
            lone = counted.where("nd = 1").groupBy("k", "g").agg(F.min("w").alias("w"))
            told = persisted(signed.join(lone, ["k", "g"], "left").withColumn("_w", F.when(F.col("w").isNull(), F.col("_w"))), "forest-lone")
            lone = told.where("w is not null").select("w", F.lit(None).cast("long").alias("w2"), F.lit(1).cast("long").alias("nd"), "g", "k", "n", "bits")
            rest = _led(told.where("w is null")).drop("word")
            chosen = lone.union(self._prefixes(rest.join(counted.where("nd > 1").select("w", "nd").hint("shuffle_hash"), "w")))
        waiting = self.read("askers", run) if run else None
        asked = self._write(chosen, "askers", run, "w").where("nd > 1")  # a word that no other text has, or nearly has, finds nothing

        # the batch in all runs
        lone = broadcast_if_small(persisted(_widened(asked.where("w2 is null").select("w", "k", "n", "bits"), near, "w"), "forest-asking"))
        out = _located(lone, every.select("w", "k", "n", "bits"), ["w"], self.lenient)
        two = asked.where("w2 is not null")
        if not self.lenient and not two.isEmpty():
            both = _widened(two.select("k", "n", "bits", F.col("w").alias("v1"), F.col("w2").alias("v2")), near, "v1")
            both = persisted(_widened(both, near, "v2"), "forest-two")
            held = every.select(F.col("w").alias("v1"), "g", "k", "n", "bits").join(both.select("v1").distinct(), "v1", "left_semi")
            held = held.join(every.select("g", "k", F.col("w").alias("v2")), ["g", "k"]).select("v1", "v2", "k", "n", "bits")
            out = out.union(_located(both, held, ["v1", "v2"], False))
        if waiting is not None:
            out = out.union(self._waiting(waiting, mine, near, wanted))
        return out.distinct()

    def _prefixes(self, led: DataFrame) -> DataFrame:
        """What each text is looked up by: its rarest word, with the next one where the range of the first is full.

        Lenient texts, two words of which may be others, ask with up to three words one by one.
        """
        by = Window.partitionBy("g", "k").orderBy("nd", "w")  # a text's words
        ranked = led.withColumns({"_at": F.row_number().over(by), "_next": F.lead("w").over(by)})
        if self.lenient:
            asks = ranked.where(F.col("_at") <= F.least(F.lit(3), F.expr("n div 2") + 1))
            return asks.select("w", F.lit(None).cast("long").alias("w2"), "nd", "g", "k", "n", "bits")
        return ranked.where("_at = 1").select("w", F.when(F.col("nd") > self.bucket, F.col("_next")).alias("w2"), "nd", "g", "k", "n", "bits")

    def _waiting(self, askers: DataFrame, mine: DataFrame, near: DataFrame, known: DataFrame) -> DataFrame:
        """Older askers that find a text of the batch: near words stand for each other, so the batch's words are widened; ``known`` are all these."""
        wide = _widened(mine.select("w", "k", "n", "bits"), near, "w")
        out = _located(askers.where("w2 is null").select("w", "k", "n", "bits").join(known, "w", "left_semi"), wide, ["w"], self.lenient)
        two = persisted(askers.where("w2 is not null").select("w", "w2", "k", "n", "bits").join(known, "w", "left_semi"), "forest-waiting")
        if two.isEmpty():
            return out
        first = wide.join(two.select("w").distinct(), "w", "left_semi")
        second = wide.select(F.col("w").alias("w2"), "k").join(two.select("w2").distinct(), "w2", "left_semi")
        return out.union(_located(two, first.join(second, "k").select("w", "w2", "k", "n", "bits"), ["w", "w2"], False))

    def merge(self, into: str) -> HashForest:
        """All runs as one, at ``into``; where the range of one word is full by now, the prefix is chosen anew. The old folder stays."""
        merged = HashForest(self.spark, into, self.lenient, self.bucket)
        posts = self.read("posts")
        if posts is None:
            return merged
        posts, words, near = together(
            lambda: merged._write(posts.select("w", "g", "k", "n", "bits"), "posts", 0, "w"),
            lambda: merged._write(self.read("words").groupBy("w", "g", "word").agg(F.sum("df").alias("df"), *_one()), "words", 0, "w", spread=True),
            lambda: merged._write(self.read("near").distinct(), "near", 0, "w", spread=True),
        )
        askers = self.read("askers").select("w", "w2", "nd", "g", "k", "n", "bits")
        if not self.lenient:
            known = persisted(_texts_with(words.select("w", "df"), near), "forest-known")
            often = broadcast_if_small(known.where(F.col("nd") > self.bucket).select("w"))
            full = persisted(askers.where("w2 is null").join(often, "w", "left_semi").select("g", "k"), "forest-full")
            if not full.isEmpty():
                full = broadcast_if_small(full)
                again = broadcast_if_small(persisted(posts.join(full, ["g", "k"], "left_semi").select(*posts.columns), "forest-again"))
                chosen = self._prefixes(known.select("w", "nd").join(again, "w"))
                askers = askers.join(full, ["g", "k"], "left_anti").select(*askers.columns).union(chosen.select(*askers.columns))
        merged._write(askers, "askers", 0, "w")
        return merged


def near_pairs(entries: DataFrame, group: str, text: str, key: str, lenient: bool = False, bucket: int = BUCKET, path: str | None = None) -> DataFrame:
    """(a, b), a < b: every pair of entries of a group that ``articles.same_title`` can call the same, through a new forest.

    Without ``path`` the forest is only made for this and goes when the application ends.
    """
    spark, once = entries.sparkSession, path is None
    if path is None:
        path = f"{shared_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return HashForest(spark, path, lenient, bucket, once).add(entries, group, text, key)
