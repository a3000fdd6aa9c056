"""Schemas that drift between files: one consistent table and a report of each change.

Every (feed, file, field) gets a profile: counts by type, the shape of its values and a MinHash signature of them.
All of it is sums and minima, so Spark combines it before the shuffle and no group is ever collected; what is
left is bounded by the number of files and fields, not of records. Each file is then matched with the one before
it by similarity flooding: the two schemas are graphs of fields, types, parents and value shapes, the pairs of
their nodes start with the likeness of names and values, scores flow between neighbouring pairs until they
converge, and a stable one-to-one choice of the pairs above the threshold names the renamed fields. Two names that stand
side by side in some file mean different things and are never matched.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import persisted

TYPES = ("string", "number", "boolean", "array")
HASHES = 16
SHAPES = ("n_values", "length", "spaced", "capital", "digits", "url", "dated", "truth", "size")
_MIX = np.random.default_rng(7).integers(1, 2**61 - 1, size=(2, HASHES), dtype=np.int64) | 1


def flatten(record: dict, prefix: str = ""):
    """(path, value) of each key; nested objects give outer.inner and do not count themselves."""
    for k, v in record.items():
        if isinstance(v, dict):
            yield from flatten(v, f"{prefix}{k}.")
        else:
            yield f"{prefix}{k}", v


def read_record(payload: str | None) -> dict | None:
    """The object in a payload; null if it is missing, no JSON, or no object."""
    if not payload:
        return None
    try:
        found = json.loads(payload)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def type_of(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int | float):
        return "number"
    return "array" if isinstance(value, list) else "string"


def _atoms(value) -> list[str]:
    if isinstance(value, list):
        return [str(x) for x in value if x is not None]
    return [] if value is None else [str(value)]


def _signature(text: str, seen: dict[str, np.ndarray]) -> np.ndarray:
    found = seen.get(text)
    if found is None:
        base = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little")
        found = (np.int64(base) * (_MIX[0] % 2_147_483_647) + _MIX[1] % 2_147_483_647) % 2_147_483_647
        if len(seen) < 100_000:
            seen[text] = found
    return found


def _profile_batches(batches):
    seen: dict[str, np.ndarray] = {}
    for pdf in batches:
        stats: dict[tuple, list] = {}
        for feed, file_no, payload in zip(pdf["feed"], pdf["file_no"], pdf["payload"], strict=True):
            for path, value in flatten(read_record(payload) or {}):
                key = (feed, file_no, path, type_of(value) or "null")
                s = stats.get(key)
                if s is None:
                    s = stats[key] = [0, [0.0] * len(SHAPES), np.full(HASHES, 2**31 - 1, np.int64)]
                s[0] += 1
                for a in _atoms(value):
                    low = a.lower()
                    for i, x in enumerate((1, min(len(a), 400), " " in a, a[:1].isupper(), a[:1].isdigit(), "://" in a, len(a) >= 7 and a[4:5] == "-" and a[:4].isdigit(), low == "true", 0)):
                        s[1][i] += x
                    if isinstance(value, int | float) and not isinstance(value, bool):
                        s[1][8] += math.log10(1 + abs(value)) if math.isfinite(value) else 0.0
                    np.minimum(s[2], _signature(a, seen), out=s[2])
        rows = [(*k, s[0], *s[1], *s[2].tolist()) for k, s in stats.items()]
        yield pd.DataFrame(rows, columns=["feed", "file_no", "field", "kind", "n", *SHAPES, *[f"h{i}" for i in range(HASHES)]])


def profiles(raw: DataFrame) -> DataFrame:
    """One row for each (feed, file_no, field, kind): counts, shape sums and MinHash minima.

    Unreadable payloads count as records without keys; a null feed or file number is a value of its own.
    """
    shapes = ", ".join(f"{s} double" for s in SHAPES)
    schema = f"feed string, file_no int, field string, kind string, n long, {shapes}, " + ", ".join(f"h{i} long" for i in range(HASHES))
    made = raw.select(F.col("feed").cast("string").alias("feed"), F.col("file_no").cast("int").alias("file_no"), F.col("payload").cast("string").alias("payload")).mapInPandas(_profile_batches, schema)
    return made.groupBy("feed", "file_no", "field", "kind").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in SHAPES], *[F.min(f"h{i}").alias(f"h{i}") for i in range(HASHES)])


class Field:
    """The profile of a field in one file."""

    def __init__(self, name: str):
        self.name, self.counts = name, defaultdict(int)
        self.sums, self.minima = np.zeros(len(SHAPES)), np.full(HASHES, 2**31 - 1, np.int64)

    def add(self, kind: str, n: int, sums: np.ndarray, minima: np.ndarray) -> None:
        if kind != "null":
            self.counts[kind] += n
        self.sums += sums
        self.minima = np.minimum(self.minima, minima)

    @property
    def kind(self) -> str | None:
        """The type of most non-null values, by the order of TYPES where they tie; null if all are null."""
        return max(TYPES, key=lambda t: (self.counts[t], -TYPES.index(t))) if any(self.counts.values()) else None

    @property
    def mean(self) -> np.ndarray:
        return self.sums[1:] / max(self.sums[0], 1)

    @property
    def label(self) -> bool:
        """Whether the values look like words of a small vocabulary."""
        length, spaced, _, digits, url = self.mean[:5]
        return length <= 24 and spaced < 0.95 and digits < 0.5 and url < 0.5

    def shape(self) -> str:
        length, spaced, capital, digits, url, dated = self.mean[:6]
        if self.kind in ("number", "boolean", None):
            return str(self.kind)
        return "url" if url > 0.5 else "date" if dated > 0.5 else "text" if length > 30 else "name" if capital > 0.5 else "code" if digits > 0.5 else "word"


def names_alike(a: str, b: str) -> float:
    def grams(x: str) -> set[str]:
        x = f"^{x.rpartition('.')[2].lower()}$"
        return {x[i : i + 3] for i in range(len(x) - 2)}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def values_alike(a: Field, b: Field) -> float:
    """0 for values of different kinds, up to 1. Words of small vocabularies must share some."""
    if a.kind != b.kind or a.kind is None:
        return 0.0
    shared = float((a.minima == b.minima).mean())
    x, y = a.mean, b.mean
    if a.kind == "boolean":
        return 0.6 + 0.4 * (1 - abs(x[6] - y[6]))
    if a.kind == "number":
        return max(0.0, 1 - abs(x[7] - y[7])) * 0.8 + 0.2 * shared
    far = abs(math.log((1 + x[0]) / (1 + y[0]))) / math.log(4) + float(np.abs(x[1:6] - y[1:6]).sum())
    like = max(0.0, 1 - far)
    if a.label and b.label:
        return 0.0 if shared == 0 and a.shape() == "word" else 0.3 * like + 0.7 * min(1.0, shared * 2)
    return like


def flood(old: dict[str, Field], new: dict[str, Field], gone: list[str], come: list[str], rounds: int = 50) -> dict[tuple[str, str], float]:
    """Scores of (gone, come) pairs after similarity flooding over the two schemas' graphs."""
    both = [n for n in old if n in new]
    start: dict[tuple, float] = {("f", a, b): 0.5 * values_alike(old[a], new[b]) + 0.5 * names_alike(a, b) for a in gone for b in come}
    start |= {("f", a, a): 1.0 for a in both}
    nodes = dict(start)
    links: dict[tuple, list[tuple]] = defaultdict(list)
    for pair in start:
        _, a, b = pair
        x, y = old[a], new[b]
        for around in (("t", x.kind, y.kind), ("s", x.shape(), y.shape()), ("p", a.rpartition(".")[0], b.rpartition(".")[0])):
            nodes.setdefault(around, 1.0 if around[1] == around[2] else 0.0)
            links[pair].append(around)
            links[around].append(pair)
    score = dict(nodes)
    for _ in range(rounds):
        flow = {n: nodes[n] + score[n] + sum((nodes[m] + score[m]) / len(links[m]) for m in links[n]) for n in nodes}
        top = max(flow.values()) or 1.0
        flow = {n: v / top for n, v in flow.items()}
        done = max(abs(flow[n] - score[n]) for n in nodes) < 1e-4
        score = flow
        if done:
            break
    return {(a, b): score[("f", a, b)] for a in gone for b in come}


def match(old: dict[str, Field], new: dict[str, Field], apart: set[tuple[str, str]], linked: dict[str, str], least: float = 0.45) -> list[tuple[str, str]]:
    """Renamed pairs: flooded scores, best first, each name once, values alike by at least ``least``.

    Names that other files link (``linked`` gives them the same name) need only the same type.
    """
    gone, come = sorted(n for n in old if n not in new), sorted(n for n in new if n not in old)
    if not gone or not come:
        return []
    score = flood(old, new, gone, come)
    good = []
    for (a, b), s in score.items():
        known = a in linked and linked[a] == linked.get(b) and old[a].kind == new[b].kind
        if (min(a, b), max(a, b)) not in apart and (known or values_alike(old[a], new[b]) >= least):
            good.append((s + known, a, b))
    pairs, used = [], set()
    for _, a, b in sorted(good, key=lambda x: (-x[0], x[1], x[2])):
        if ("old", a) not in used and ("new", b) not in used:
            used |= {("old", a), ("new", b)}
            pairs.append((a, b))
    return pairs


def _changes_of_feed(pdf: pd.DataFrame, apart: set[tuple[str, str]], linked: dict[str, str]) -> pd.DataFrame:
    files: dict[int, dict[str, Field]] = defaultdict(dict)
    for r in pdf.itertuples(index=False):
        known = files[r.file_no]
        if r.field is not None:
            known.setdefault(r.field, Field(r.field)).add(r.kind, r.n, np.array([getattr(r, s) for s in SHAPES]), np.array([getattr(r, f"h{i}") for i in range(HASHES)]))
    rows, feed = [], pdf["feed"].iloc[0]
    order = sorted(files)
    for before, now in zip(order, order[1:], strict=False):
        old, new = files[before], files[now]
        renamed = match(old, new, apart, linked)
        rows += [(feed, now, "renamed", a, b) for a, b in renamed]
        left, right = {a for a, _ in renamed}, {b for _, b in renamed}
        rows += [(feed, now, "removed", a, "") for a in old if a not in new and a not in left]
        rows += [(feed, now, "added", b, "") for b in new if b not in old and b not in right]
        rows += [(feed, now, "retyped", a, "") for a in old if a in new and None not in (old[a].kind, new[a].kind) and old[a].kind != new[a].kind]
    return pd.DataFrame(rows, columns=["feed", "file_no", "change_kind", "field_name", "new_name"])


def side_by_side(profiled: DataFrame) -> set[tuple[str, str]]:
    """Pairs of names that stand in one file together; bounded by the square of the number of names."""
    names = profiled.groupBy("feed", "file_no").agg(F.array_sort(F.collect_set("field")).alias("names"))
    pairs = names.select(F.explode("names").alias("a"), "names").select("a", F.explode("names").alias("b")).where("a < b").distinct()
    return {(r.a, r.b) for r in pairs.toLocalIterator()}


def changes(raw: DataFrame, profiled: DataFrame | None = None) -> DataFrame:
    """(feed, file_no, change_kind, field_name, new_name): each change of a file against the one before it.

    Files are ordered by number within their feed; numbers may have gaps. A file whose payloads are all unreadable
    has no fields. A field with only nulls has no type and is never retyped. An empty table gives no changes.
    """
    profiled = persisted(profiles(raw), "profiles") if profiled is None else profiled
    apart = side_by_side(profiled)
    files = raw.select(F.col("feed").cast("string").alias("feed"), F.col("file_no").cast("int").alias("file_no")).distinct()
    whole = files.where("feed is not null and file_no is not null").join(profiled, ["feed", "file_no"], "left")
    numbers = {s: 0.0 for s in SHAPES} | {"n": 0} | {f"h{i}": 2**31 - 1 for i in range(HASHES)}
    by_feed = whole.fillna(numbers).groupBy("feed")

    def run(linked: dict[str, str]) -> DataFrame:
        return by_feed.applyInPandas(lambda pdf: _changes_of_feed(pdf, apart, linked), "feed string, file_no int, change_kind string, field_name string, new_name string")

    return run(canonical_names(run({}), profiled, apart, support=2))


def canonical_names(changed: DataFrame, profiled: DataFrame, apart: set[tuple[str, str]], support: int = 1) -> dict[str, str]:
    """Each name's name in the consistent table: of names linked by ``support`` renamings or more the most used one.

    Bounded by the number of names, whatever the number of records; ties go to the first name.
    """
    used = {r.field: r.files for r in profiled.select("feed", "file_no", "field").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("files")).toLocalIterator()}
    group = {n: n for n in used}

    def root(x: str) -> str:
        while group[x] != x:
            x = group[x]
        return x

    links = changed.where("change_kind = 'renamed'").groupBy("field_name", "new_name").count().where(F.col("count") >= support).orderBy(F.desc("count"), "field_name", "new_name")
    members: dict[str, set[str]] = {n: {n} for n in used}
    for r in links.toLocalIterator():
        a, b = root(r.field_name), root(r.new_name)
        if a != b and not any((min(x, y), max(x, y)) in apart for x in members[a] for y in members[b]):
            group[b] = a
            members[a] |= members.pop(b)
    named = {}
    for names in members.values():
        best = min(names, key=lambda n: (-used[n], n))
        named |= {n: best for n in names}
    return named


def _as_text(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, list):
        return json.dumps(value, ensure_ascii=False)
    return str(value)


#: What each type of a field is in the consistent table.
COLUMNS = {"string": "string", "number": "double", "boolean": "boolean", "array": "array<string>"}


def cast_value(value, kind: str):
    """A value as a field's type; null with the text kept apart (``rejects``) where it does not fit.

    Text takes everything; numbers take what reads as one, booleans "true" and "false" in any case; arrays take a lone
    value as their only element. Booleans are no numbers.
    """
    if value is None:
        return None, False
    if kind == "string":
        return _as_text(value), False
    if kind == "array":
        return [_as_text(v) for v in value] if isinstance(value, list) else [_as_text(value)], False
    if kind == "boolean":
        said = value if isinstance(value, bool) else {"true": True, "false": False}.get(value.strip().lower()) if isinstance(value, str) else None
        return said, said is None
    if isinstance(value, bool) or isinstance(value, list):
        return None, True
    try:
        number = float(value)
    except (ValueError, OverflowError):
        return None, True
    return (number, False) if math.isfinite(number) else (None, True)


def field_types(profiled: DataFrame, named: dict[str, str]) -> dict[str, str]:
    """Each consistent name's type: that of most non-null values under any of its names, by the order of TYPES where they tie."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for r in profiled.where("field is not null and kind <> 'null'").groupBy("field", "kind").agg(F.sum("n").alias("n")).toLocalIterator():  # a few rows a name
        counts[named.get(r.field, r.field)][r.kind] += r.n
    return {n: max(TYPES, key=lambda t: (counts[n][t], -TYPES.index(t))) if counts[n] else "string" for n in set(named.values())}


def consistent_table(raw: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """All records in one table: the record's own columns, then ``f_<name>`` for each consistent name, typed, and ``rejects``.

    A field has the type of most of its values over all files (``field_types``); single values are cast to it, and those
    that do not fit are null there and kept as text in the map ``rejects`` by column. Unreadable payloads give nulls in
    every field and ``readable`` false; where two old names of one record lead to one consistent name, the first non-null
    in the order of the names stands. Own columns of these names give way.
    """
    profiled = persisted(profiles(raw), "profiles")
    named = canonical_names(changes(raw, profiled), profiled, side_by_side(profiled))
    kinds = field_types(profiled, named)
    targets = sorted(kinds) if fields is None else fields
    columns = [f"f_{t.replace('.', '_')}" for t in targets]
    place = {n: (i, kinds.get(n, "string")) for i, n in enumerate(targets)}
    keep = [c for c in raw.columns if c not in {"payload", "readable", "rejects", *columns}]

    def batches(frames):
        for pdf in frames:
            rows, readable, rejects = [], [], []
            for payload in pdf["payload"]:
                record, row, odd = read_record(payload), [None] * len(targets), {}
                readable.append(record is not None)
                for path, value in sorted(flatten(record or {}), key=lambda x: x[0]):
                    i, kind = place.get(named.get(path, path), (None, ""))
                    if i is not None and row[i] is None and columns[i] not in odd:
                        row[i], unfit = cast_value(value, kind)
                        if unfit:
                            odd[columns[i]] = _as_text(value)
                rows.append(row)
                rejects.append(odd)
            made = pd.DataFrame(rows, columns=columns, index=pdf.index, dtype=object)
            yield pd.concat([pdf[keep], pd.Series(readable, index=pdf.index, name="readable", dtype=bool), made, pd.Series(rejects, index=pdf.index, name="rejects", dtype=object)], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields if f.name in keep)
    typed = [f"`{c}` {COLUMNS[kinds.get(t, 'string')]}" for c, t in zip(columns, targets, strict=True)]
    return raw.mapInPandas(batches, ", ".join(x for x in (own, "readable boolean", *typed, "rejects map<string,string>") if x))
