"""Corpus encoding with a public byte-level BPE, through a minimal acyclic transducer.

Frequent words (pre-token pieces) and their id sequences are compiled into an automaton that shares
suffixes: equal sub-automata are one state (hash-consing while adding the sorted words). The words'
positions in sorted order come out as a perfect hash by counting the words that pass each edge, so one
offsets array and one flat id array hold the outputs. The arrays are saved in the shared folder and
memory-mapped by the workers. A word that the automaton does not know is merged exactly, pair by pair
in rank order. The lexicon only decides which words are looked up, never what comes out.
"""

from __future__ import annotations

import ast
import base64
import os
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.runtime import shared_dir

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: The lexicon is compiled from at most so many texts; it bounds its size, and results do not depend on it.
LEXICON_TEXTS = 2_000
LEXICON_WORDS = 50_000


def load_ranks(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def piece_pattern(folder: str = TOKENIZERS) -> str:
    """The pre-token pattern published beside the vocabulary; the file is read, not run."""
    with open(f"{folder}/__init__.py") as f:
        for node in ast.parse(f.read()).body:
            if isinstance(node, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "PATTERN" for t in node.targets):
                return ast.literal_eval(node.value)
    raise ValueError(f"no pattern in {folder}")


def merge_exactly(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merge: always the adjacent pair of lowest rank, leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 512:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merge with a heap and a linked list, for very long pieces."""
    import heapq

    n = len(word)
    part: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i] if part[i] is not None else n
        if j >= n or part[i] is None or part[j] is None or part[i] + part[j] != both:
            continue
        part[i], part[j] = both, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(both + part[k])) is not None:
                heapq.heappush(heap, (r, i, both + part[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(part[h] + both)) is not None:
            heapq.heappush(heap, (r, h, part[h] + both))
    return [ranks[p] for p in part if p is not None]


class Transducer:
    """A minimal acyclic automaton over bytes with a list of ids for each word.

    ``first[s] : first[s + 1]`` are the edges of state ``s``, sorted by label; ``label``, ``target`` and
    ``skip`` (words of the state that sort before those of the edge) are by edge; ``final`` by state.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.first, self.label, self.target, self.skip, self.final, self.offset, self.ids = (arrays[k] for k in ("first", "label", "target", "skip", "final", "offset", "ids"))

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Transducer:
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        ordered = sorted(words)
        path: list[list] = [[False, []]]  # open nodes of the last word: [final, edges]
        last = b""
        for w in ordered:
            common = len(os.path.commonprefix([last, w]))
            for depth in range(len(last), common, -1):
                child = freeze(path.pop())
                path[-1][1].append((last[depth - 1], child))
            path += [[False, []] for _ in range(len(w) - common)]
            path[-1][0] = True
            last = w
        for depth in range(len(last), 0, -1):
            child = freeze(path.pop())
            path[-1][1].append((last[depth - 1], child))
        root = freeze(path[0])
        count = [0] * len(states)
        first, label, target, skip = [0], [], [], []
        for s, (final, edges) in enumerate(states):  # children are frozen before their parents
            passed = int(final)
            for b, child in edges:
                label.append(b)
                target.append(child)
                skip.append(passed)
                passed += count[child]
            count[s] = passed
            first.append(len(label))
        outs = [words[w] for w in ordered]
        return cls(
            {
                "first": np.array(first, np.int32),
                "label": np.array(label, np.uint8),
                "target": np.array(target, np.int32),
                "skip": np.array(skip, np.int32),
                "final": np.array([f for f, _ in states] + [root], np.int32),  # the last entry is the root
                "offset": np.cumsum([0, *map(len, outs)]).astype(np.int32),
                "ids": np.array([i for o in outs for i in o], np.int32),
            }
        )

    def __len__(self) -> int:
        return len(self.offset) - 1

    def get(self, word: bytes) -> list[int] | None:
        s, at = int(self.final[-1]), 0
        for b in word:
            lo, hi = int(self.first[s]), int(self.first[s + 1])
            e = lo + int(np.searchsorted(self.label[lo:hi], b))
            if e >= hi or self.label[e] != b:
                return None
            at += int(self.skip[e])
            s = int(self.target[e])
        return self.ids[self.offset[at] : self.offset[at + 1]].tolist() if self.final[s] else None

    def save(self, folder: str) -> None:
        os.makedirs(folder, exist_ok=True)
        for k, a in self.arrays.items():
            np.save(f"{folder}/{k}.npy", a)

    @classmethod
    def mapped(cls, folder: str) -> Transducer:
        return cls({k: np.load(f"{folder}/{k}.npy", mmap_mode="r") for k in ("first", "label", "target", "skip", "final", "offset", "ids")})


class Encoder:
    """Text to ids; one per worker. Words seen by this worker are remembered, up to a bound.

    Pre-token pieces never cross a space unless white space stands on both its sides, so a text is cut at
    its spaces and each stretch is split into pieces only when it is first seen. A space with white space on
    both sides (or at the end after white space) belongs to a longer run; such texts are split as a whole.
    """

    REMEMBER = 500_000
    RUN = re.compile(r"\s (?:\s|\Z)")

    def __init__(self, ranks: dict[bytes, int], pattern: str, lexicon: Transducer | None = None):
        self.ranks, self.lexicon = ranks, lexicon
        self.split = regex.compile(pattern).findall
        self.words: dict[str, list[int]] = {}
        self.stretches: dict[str, list[int]] = {}

    def word(self, piece: str) -> list[int]:
        ids = self.words.get(piece)
        if ids is None:
            raw = piece.encode("utf-8", "surrogatepass")
            ids = self.lexicon.get(raw) if self.lexicon is not None else None
            if ids is None:
                ids = merge_exactly(raw, self.ranks)
            if len(self.words) < self.REMEMBER:
                self.words[piece] = ids
        return ids

    def pieces(self, text: str) -> list[int]:
        return [i for piece in self.split(text) for i in self.word(piece)]

    def stretch(self, text: str) -> list[int]:
        ids = self.pieces(" " + text)
        if len(self.stretches) < self.REMEMBER:
            self.stretches[text] = ids
        return ids

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.RUN.search(text) or text[0] == " ":
            return self.pieces(text)
        head, *rest = text.split(" ")
        out = self.pieces(head)
        known, extend, stretch = self.stretches.get, out.extend, self.stretch
        for part in rest:
            extend(known(part) or stretch(part))
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def _worker_encoder(name: str, folder: str, lexicon_dir: str | None, shared) -> Encoder:
    """One encoder a worker and lexicon: mapped from a mounted folder, else from the broadcast arrays."""
    key = (name, folder, lexicon_dir, None if shared is None else id(shared.value))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        lexicon = Transducer.mapped(lexicon_dir) if lexicon_dir else Transducer(shared.value)
        _ENCODERS[key] = Encoder(load_ranks(name, folder), piece_pattern(folder), lexicon)
    return _ENCODERS[key]


def compile_lexicon(texts: DataFrame, column: str, name: str, folder: str = TOKENIZERS) -> Transducer:
    """The frequent words of at most LEXICON_TEXTS texts, chosen by their hash over the whole table, with their ids."""
    split, ranks, count = regex.compile(piece_pattern(folder)).findall, load_ranks(name, folder), Counter()
    share = min(1.0, 2 * LEXICON_TEXTS / max(texts.count(), 1))
    some = texts.where((F.length(column) > 0) & ((F.pmod(F.xxhash64(column), F.lit(1_000_000)) < int(share * 1_000_000)) | F.lit(share >= 1.0)))
    for row in some.select(F.col(column).alias("t")).limit(LEXICON_TEXTS).toLocalIterator():
        count.update(split(row.t))
    return Transducer.compile({w.encode(): merge_exactly(w.encode(), ranks) for w, _ in count.most_common(LEXICON_WORDS)})


def _as_local(path: str) -> str | None:
    """The path as a plain file path if the shared folder is a mounted one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def encode(df: DataFrame, column: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Add ``ids`` (array<int>): the text's ids without special tokens.

    Null and empty texts get an empty array; special tokens' strings in a text are ordinary text; repeated and
    very long texts are encoded like any other. Workers map the lexicon from the shared folder where that is a mounted
    path; on an object store its arrays, bounded by LEXICON_WORDS, are broadcast instead.
    """
    spark: SparkSession = df.sparkSession
    root = _as_local(shared_dir(spark))
    lexicon, lexicon_dir, shared = compile_lexicon(df, column, name, folder), None, None
    if root:
        lexicon_dir = f"{root.rstrip('/')}/lexicon-{uuid.uuid4().hex}"
        lexicon.save(lexicon_dir)
    else:
        shared = spark.sparkContext.broadcast(lexicon.arrays)

    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def batches(it):
        enc = _worker_encoder(name, folder, lexicon_dir, shared)
        for batch in it:
            flat, offsets = [], [0]
            for text in batch.column(column).to_pylist():
                flat += enc(text)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.array(offsets, np.int32)), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return df.mapInArrow(batches, schema)
