"""Similarity clusters of embedding vectors, by Gaussian mixtures.

Vectors are reduced to their principal axes and standardised. A mixture with regularised (diagonal plus ridge)
covariances is fitted by expectation-maximization on all rows, in passes of partial sums, with the number of components
chosen by the Bayesian information criterion over all rows; only its start comes from a sample. It routes every row to its most probable components, twice with different starts. What
is routed to one component is small (the number of components follows the number of rows), and a component that holds
more rows than a leaf is split by salt: its leaves are reduced to representatives first, which then meet in one leaf.

In a leaf a finer mixture is fitted the same way, again with the number of components by the criterion. The densest
member represents its component, and an exact check on the whole vectors follows: a row is linked to a representative
whose cosine reaches ``ALIKE``; rows that no representative takes become ones. Links are a star for each
representative, never all pairs, and their connected components over all leaves are the clusters. A component is a
cluster if it has ``LEAST`` members, no two of them less alike than ALIKE, and no leaf shows a stranger that
reaches ``APART``.
"""

from __future__ import annotations

import base64
import binascii

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.operators.graph import connected_components
from corpusloom.runtime import persisted

ALIKE, APART, LEAST = 0.7, 0.65, 5
BYTES = 128
#: A router's fit starts from about so many rows; where there are more, it goes on over all of them.
SAMPLE = 20_000
#: A router has at most so many components.
COMPONENTS = 2_500
AXES = 48
LEAF = 1_000
#: How many components each router sends a row to; components of rows that are linked then meet by their centres.
ROUTES, CENTRE_ROUTES = (1, 1), (2, 2)
RIDGE = 0.05
#: A router's fit ends when the mean likelihood gains less than this share of itself, or after so many rounds.
CONVERGED, ROUNDS = 1e-4, 40
FLOAT = np.float32


def decode(text: str | None) -> bytes | None:
    """The bytes of a usable vector: valid base64 of exactly 128 bytes, not all zero; else null."""
    if not text:
        return None
    try:
        raw = base64.b64decode(text.encode("ascii"), validate=True)
    except (binascii.Error, ValueError, UnicodeEncodeError):
        return None
    return raw if len(raw) == BYTES and any(raw) else None


def matrix(raws) -> np.ndarray:
    """Unit rows of the byte vectors."""
    x = np.frombuffer(b"".join(raws), np.int8).reshape(-1, BYTES).astype(FLOAT)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(ord, v) of the rows with a usable vector."""

    def batches(frames):
        for pdf in frames:
            v = [decode(t) for t in pdf[vec]]
            out = pd.DataFrame({"ord": pdf[key], "v": v})
            yield out[out["v"].notna()]

    return df.select(F.col(key).cast("long").alias(key), vec).mapInPandas(batches, "ord long, v binary")


class Axes:
    """Standardised principal axes, from a mean and a covariance; reduced rows keep their direction only, as the cosine does."""

    def __init__(self, mean: np.ndarray, covariance: np.ndarray, axes: int = AXES):
        self.mean = mean.astype(FLOAT)
        squares, rows = np.linalg.eigh(covariance)
        values = np.sqrt(np.maximum(squares[::-1], 0))
        k = max(1, min(axes, int((values > 1e-6).sum())))
        self.rows = rows.T[::-1][:k].astype(FLOAT)
        self.scale = np.maximum(values[:k].astype(FLOAT), 1e-3)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.rows.T / self.scale
        z *= np.sqrt(z.shape[1]) / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-6)
        return z.astype(FLOAT)


class Mixture:
    """Gaussians with diagonal, spherical or tied covariances, each with a ridge."""

    def __init__(self, means: np.ndarray, variance: np.ndarray, weights: np.ndarray, shape: str = "diagonal"):
        self.means, self.variance, self.weights, self.shape = means, variance, weights, shape

    @property
    def parameters(self) -> int:
        """Free ones: means, weights but one, and variances by their shape."""
        k, width = self.means.shape
        return k * width + k - 1 + {"diagonal": k * width, "spherical": k, "tied": 1}[self.shape]

    def log_density(self, z: np.ndarray) -> np.ndarray:
        """log(weight * density) of each row under each component, up to the common constant."""
        inverse = 1 / self.variance
        own = -0.5 * (inverse if self.shape == "diagonal" else inverse[:, :1])
        fixed = np.log(np.maximum(self.weights, 1e-12)) - 0.5 * ((self.means**2 * inverse).sum(1) + np.log(self.variance).sum(1))
        # all terms in one product: rows times components are the large side
        return np.column_stack([z, self.squares(z), np.ones(len(z), z.dtype)]) @ np.column_stack([self.means * inverse, own, fixed]).T

    def shares(self, z: np.ndarray, d: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The share of each component in each row, and the rows' log likelihoods; ``d`` is overwritten."""
        d = self.log_density(z) if d is None else d
        top = d.max(1, keepdims=True)
        d -= top
        r = np.exp(d, out=d)
        whole = r.sum(1, keepdims=True)
        r /= whole
        return r, (top + np.log(whole))[:, 0]

    def sums(self, z: np.ndarray, d: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``maximised`` takes: the components' shares of the rows, and by share the rows and their squares; and the rows' log likelihoods.

        The rows are divided, not their shares, of which there are many more; ``d`` is overwritten.
        """
        d = self.log_density(z) if d is None else d
        top = d.max(1, keepdims=True)
        d -= top
        r = np.exp(d, out=d)
        whole = r.sum(1, keepdims=True)
        t = r.T @ (np.column_stack([np.ones(len(z), z.dtype), z, self.squares(z)]) / whole)
        width = z.shape[1] + 1
        return t[:, 0], t[:, 1:width], t[:, width:], (top + np.log(whole))[:, 0]

    def criterion(self, likelihood: float, n: int) -> float:
        """Bayesian information criterion; smaller is better."""
        return -2 * likelihood + self.parameters * np.log(n)

    def squares(self, z: np.ndarray) -> np.ndarray:
        """What a row adds to its components' squares: by axis, or over all axes where these share a variance."""
        return z**2 if self.shape == "diagonal" else (z**2).sum(1, keepdims=True)

    def maximised(self, n: np.ndarray, sums: np.ndarray, squares: np.ndarray, ridge: float) -> Mixture:
        """The mixture by the components' shares, sums and ``squares`` of the rows."""
        width = sums.shape[1]
        n = n + 1e-6
        m = sums / n[:, None]
        if self.shape == "diagonal":
            v = np.maximum(squares / n[:, None] - m**2, 0)
        else:
            v = np.maximum(squares / n[:, None] - (m**2).sum(1, keepdims=True), 0) / width
            if self.shape == "tied":
                v[:] = (n[:, None] * v).sum() / n.sum()
            v = np.repeat(v, width, 1)
        # small components lean on the ridge: their own variance says little
        v = (n[:, None] * v + ridge * 4) / (n[:, None] + 4) + ridge
        return Mixture(m.astype(FLOAT), v.astype(FLOAT), (n / n.sum()).astype(FLOAT), self.shape)

    @classmethod
    def fit(cls, z: np.ndarray, means: np.ndarray, rounds: int, ridge: float = RIDGE, spherical: bool = False, tied: bool = False, start: Mixture | None = None, first: np.ndarray | None = None) -> Mixture:
        k, shape, last = len(means), "tied" if tied else "spherical" if spherical else "diagonal", -np.inf
        mix = start or cls(means.astype(FLOAT), np.full((k, z.shape[1]), max(0.3, ridge), FLOAT), np.full(k, 1 / k, FLOAT), shape)
        for i in range(rounds):
            n, sums, squares, each = mix.sums(z, first if i == 0 else None)
            likelihood = float(each.mean())
            if likelihood - last < CONVERGED * abs(likelihood):
                break
            last = likelihood
            mix = mix.maximised(n, sums, squares, ridge)
        return mix


#: Ridge of a router's covariances, and rows of a step of its fit over all rows.
ROUTER_RIDGE, STEP = 0.3, 2_048


def starts(z: np.ndarray, n: int, components: int, seed: int) -> list[Mixture]:
    """Mixtures over the sampled rows of ``n``, of once, one and a half times and twice so many components."""
    rng = np.random.default_rng(seed)
    most = max(1, min(COMPONENTS, n // 8, len(z)))
    sizes = sorted({min(most, max(1, k)) for k in (components, components * 3 // 2, components * 2)})
    return [Mixture.fit(z, z[rng.choice(len(z), k, replace=False)], ROUNDS, ridge=ROUTER_RIDGE, tied=True) for k in sizes]


def moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of (ord, v) rows, their mean and their covariance."""

    def batches(frames):
        n, sums = 0, np.zeros((BYTES + 1, BYTES))
        for pdf in frames:
            if len(pdf):
                x = matrix(pdf["v"]).astype(np.float64)
                n += len(x)
                sums[0] += x.sum(0)
                sums[1:] += x.T @ x
        yield pd.DataFrame({"at": range(BYTES + 1), "n": n, "total": list(sums)})

    parts = rows.select("v").mapInPandas(batches, "at int, n long, total array<double>")
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(BYTES)]).alias("total")).orderBy("at").toPandas()  # a row an axis
    n = int(found["n"].iloc[0]) if len(found) else 0
    if n == 0:
        return 0, np.zeros(BYTES), np.zeros((BYTES, BYTES))
    sums = np.stack(found["total"].to_numpy())
    mean = sums[0] / n
    return n, mean, sums[1:] / n - np.outer(mean, mean)


def fit_all(rows: DataFrame, n: int, axes: Axes, mixes: list[Mixture], rounds: int = ROUNDS) -> list[tuple[float, Mixture]]:
    """Each mixture with its criterion, after expectation-maximization over all ``n`` rows.

    A round is one pass of partial sums for all mixtures that have not converged; a row a component reaches the driver.
    """
    mixes, last, told = list(mixes), [-np.inf] * len(mixes), {}
    width = mixes[0].means.shape[1]
    for i in range(rounds + 1):
        shared = rows.sparkSession.sparkContext.broadcast((axes, {m: mix for m, mix in enumerate(mixes) if m not in told}))  # bounded: COMPONENTS a mixture

        def batches(frames, shared=shared):
            ax, now = shared.value
            total = {m: np.zeros((len(mix.means), width + 3)) for m, mix in now.items()}
            for pdf in frames:
                z = ax(matrix(pdf["v"])) if len(pdf) else np.zeros((0, width), FLOAT)
                for m, mix in now.items():
                    for at in range(0, len(z), STEP):
                        part = z[at : at + STEP]
                        share, sums, squares, each = mix.sums(part)
                        total[m] += np.column_stack([np.zeros(len(mix.means)), share, squares, sums])
                        total[m][0, 0] += each.sum(dtype=np.float64)
            for m, t in total.items():
                yield pd.DataFrame({"mix": m, "component": range(len(t)), "t": list(t)})

        parts = rows.select("v").mapInPandas(batches, "mix int, component int, t array<double>")
        sums = parts.groupBy("mix", "component").agg(F.array(*[F.sum(F.col("t")[j]) for j in range(width + 3)]).alias("t")).toPandas()
        shared.destroy()
        for m, found in sums.groupby("mix"):
            t = np.stack(found.sort_values("component")["t"].to_numpy())
            likelihood = t[:, 0].sum()
            if i == rounds or likelihood - last[m] < CONVERGED * abs(likelihood):
                told[m] = (mixes[m].criterion(likelihood, n), mixes[m])
            else:
                last[m], mixes[m] = likelihood, mixes[m].maximised(t[:, 1], t[:, 3:], t[:, 2:3], ROUTER_RIDGE)
        if len(told) == len(mixes):
            break
    return [told[m] for m in range(len(mixes))]


#: Rows of a leaf up to which all its cosines are held at once (64 MB); beyond, they are made row by row.
HELD = 4_096


class Cosines:
    """The cosines of unit rows, row by row."""

    def __init__(self, unit: np.ndarray):
        self.unit, self.all = unit, unit @ unit.T if len(unit) <= HELD else None

    def of(self, i: int) -> np.ndarray:
        return self.unit @ self.unit[i] if self.all is None else self.all[i]

    def blocks(self, step: int = 1024):
        """(at, cosines of the rows from ``at`` on with all rows)."""
        for at in range(0, len(self.unit), step):
            yield at, self.unit[at : at + step] @ self.unit.T if self.all is None else self.all[at : at + step]


def leaders(cosines: Cosines, least: float) -> np.ndarray:
    """Rows no earlier leader of which is as near as ``least`` (cosine)."""
    free, found = np.ones(len(cosines.unit), bool), []
    for i in range(len(free)):
        if free[i]:
            found.append(i)
            free &= cosines.of(i) < least  # a row of zeros is near nothing, not even itself
    return np.array(found)


def solve_leaf(ords: np.ndarray, x: np.ndarray, axes: Axes) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, representative) and conflicts (representatives of rows that are neither alike nor apart), a pair a row."""
    n = len(ords)
    z = axes(x)
    best, reduced = None, Cosines(z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-6))
    for least in (0.5, 0.75):
        seeds = leaders(reduced, least)
        if best is not None and 2 * len(seeds) > n:
            continue  # the criterion never pays for components of fewer than two rows
        mix = Mixture.fit(z, z[seeds], 1, spherical=True)
        *sums, each = mix.sums(z)
        c = mix.criterion(float(each.sum()), n)
        if best is None or c < best[0]:
            best = (c, mix, sums)
    del reduced
    d = best[1].maximised(*best[2], RIDGE).log_density(z)
    label, dense = d.argmax(1), d.max(1)
    order = np.lexsort((ords, -dense))  # the densest first
    whole, taken = Cosines(x), np.full(n, -1, np.int32)
    seen: set[int] = set()

    def represent(i: int) -> None:
        taken[(whole.of(i) >= ALIKE) & (taken < 0)] = i
        taken[i] = i

    for i in order.tolist():  # the densest member of each component represents it
        if label[i] not in seen:
            seen.add(label[i])
            if taken[i] < 0:
                represent(i)
    for i in order.tolist():  # rows that no representative takes
        if taken[i] < 0:
            represent(i)
    own = np.flatnonzero(taken != np.arange(n))
    links, conflicts = [np.stack([own, taken[own]], 1)], [np.empty((0, 2), np.int64)]
    for at, s in whole.blocks():
        # what is told by the first of two representatives is not told again by the second
        rows, cols = np.divmod(np.flatnonzero((s >= APART) & (taken[at : at + len(s), None] < taken)), n)
        alike = s[rows, cols] >= ALIKE
        pairs = np.stack([taken[rows + at], taken[cols]], 1)
        links.append(np.unique(pairs[alike], axis=0))
        conflicts.append(np.unique(pairs[~alike], axis=0))
    return ords[np.concatenate(links)], ords[np.unique(np.concatenate(conflicts), axis=0)]


_LINKS = "a long, b long, kind int"


def _leaf_frame(pdf: pd.DataFrame, axes: Axes) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("ord").sort_values("ord")
    links, conflicts = solve_leaf(pdf["ord"].to_numpy(), matrix(pdf["v"]), axes)
    pairs = np.concatenate([links, conflicts])
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "kind": np.repeat(np.array([0, 1], np.int32), [len(links), len(conflicts)])})


def links_of(rows: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, routes: tuple[int, ...] = ROUTES, seed: int = 0) -> DataFrame:
    """Links (kind 0) and conflicts (kind 1) of (ord, v) rows."""
    spark = rows.sparkSession
    n, mean, covariance = moments(rows)
    if n == 0:
        return spark.createDataFrame([], _LINKS)
    axes = Axes(mean, covariance)
    share = min(1.0, sample / n)
    some = rows.where((F.pmod(F.xxhash64("ord"), F.lit(1_000_000)) < int(share * 1_000_000)) | F.lit(share >= 1.0)).limit(2 * sample).toPandas()
    z = axes(matrix(some["v"]))
    begun = [starts(z, n, max(1, n * r // leaf), seed + i) for i, r in enumerate(routes)]
    if share < 1:
        told = iter(fit_all(rows, n, axes, [mix for mixes in begun for mix in mixes]))
        fitted = [[next(told) for _ in mixes] for mixes in begun]
    else:
        fitted = [[(mix.criterion(float(mix.shares(z)[1].sum(dtype=np.float64)), n), mix) for mix in mixes] for mixes in begun]
    routers = [min(mixes, key=lambda f: f[0])[1] for mixes in fitted]
    shared = spark.sparkContext.broadcast((axes, routers))  # bounded: axes, and COMPONENTS a router

    def cells(pdf: pd.DataFrame) -> list[np.ndarray]:
        """The rows' cells, by router and rank."""
        ax, mixes = shared.value
        zz, found = ax(matrix(pdf["v"])), []
        for m, mix in enumerate(mixes):
            top = min(routes[m], len(mix.means))
            d = mix.log_density(zz)
            best = d.argmax(1)[:, None] if top == 1 else np.argpartition(-d, top - 1, axis=1)[:, :top]
            found += [best[:, j].astype("int64") * len(mixes) + m for j in range(top)]
        return found

    def route(frames):
        for pdf in frames:
            if len(pdf):
                yield pd.concat([pd.DataFrame({"cell": cell, "ord": pdf["ord"], "v": pdf["v"]}) for cell in cells(pdf)])

    def tally(frames):
        for pdf in frames:
            if len(pdf):
                cell, k = np.unique(np.concatenate(cells(pdf)), return_counts=True)
                yield pd.DataFrame({"cell": cell, "k": k})

    routed = rows.mapInPandas(route, "cell long, ord long, v binary")
    counts = rows.select("v").mapInPandas(tally, "cell long, k long").groupBy("cell").agg(F.sum("k").alias("k"))
    sizes = {r.cell: r.k for r in counts.toLocalIterator()}  # one number a component
    salts = {c: -(-k // (2 * leaf)) for c, k in sizes.items() if k > 2 * leaf}
    cell_salts = F.create_map(*[F.lit(v) for kv in salts.items() for v in kv]) if salts else F.create_map()
    salted = routed.withColumn("salt", F.pmod(F.xxhash64("ord"), F.coalesce(F.element_at(cell_salts.cast("map<bigint,int>"), F.col("cell")), F.lit(1)).cast("long")))
    solved = persisted(salted.groupBy("cell", "salt").applyInPandas(lambda pdf: _leaf_frame(pdf, shared.value[0]), _LINKS), "cluster-links")
    if salts:
        # what is left of a split cell: the rows that no other row of their leaf represents
        split = routed.where(F.col("cell").isin([int(c) for c in salts]))
        stood = solved.where("kind = 0").select(F.col("a").alias("ord")).distinct()
        again = split.join(stood, "ord", "left_anti")
        more = again.groupBy("cell").applyInPandas(lambda pdf: _leaf_frame(pdf, shared.value[0]), _LINKS)
        solved = solved.union(persisted(more, "cluster-links"))
    return solved


def clusters(df: DataFrame, key: str = "ord", vec: str = "vec") -> DataFrame:
    """(cluster_ord, ord): every record of a cluster, with the smallest key of the cluster.

    Unusable vectors (null, empty, undecodable, of another length, all zero) come out nowhere; exact copies of a
    vector are alike; an empty table gives an empty result. ``key`` must be unique.
    """
    rows = persisted(usable(df, key, vec), "cluster-vectors")
    links = links_of(rows)
    first = persisted(connected_components(links.where("kind = 0").select("a", "b")), "cluster-parts").select(F.col("component").alias("cluster_ord"), F.col("node").alias("ord"))

    def centre_rows(frames):
        for pdf in frames:
            if len(pdf):
                c = unpacked(pdf["c"])
                q = np.rint(c / np.abs(c).max(1, keepdims=True) * 127).astype(np.int8)
                yield pd.DataFrame({"ord": pdf["cluster_ord"], "v": [r.tobytes() for r in q]})

    # parts of one cluster that no leaf brought together meet by their centres
    alone = rows.join(first.select("ord"), "ord", "left_anti")
    parts = persisted(alone.select("ord", "v").union(centres(rows, first).select("cluster_ord", "c").mapInPandas(centre_rows, "ord long, v binary")), "cluster-centres")
    joined = connected_components(links_of(parts, routes=CENTRE_ROUTES, seed=100).where("kind = 0").select("a", "b"))
    joined = joined.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    everyone = first.union(alone.select("ord", "ord"))
    found = everyone.join(joined, F.col("cluster_ord") == F.col("part"), "left").select(F.coalesce("whole", "cluster_ord").alias("cluster_ord"), "ord")
    lowest = found.groupBy("cluster_ord").agg(F.min("ord").alias("lowest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = persisted(found.join(lowest.drop("n"), "cluster_ord").select(F.col("lowest").alias("cluster_ord"), "ord"), "cluster-members")
    ends = found.select(F.col("ord").alias("a"), F.col("cluster_ord").alias("ca"))
    conflicts = links.where("kind = 1").select("a", "b").distinct()
    bad = conflicts.join(ends, "a", "left").join(ends.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
    bad = bad.where("ca is null or cb is null or ca <> cb").select(F.explode(F.array("ca", "cb")).alias("cluster_ord")).where("cluster_ord is not null").distinct()
    sizes = found.groupBy("cluster_ord").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).join(bad, "cluster_ord", "left_anti")
    members = found.join(sizes.select("cluster_ord"), "cluster_ord")
    return members.join(broken(rows, members), "cluster_ord", "left_anti").select("cluster_ord", "ord")


def _sums(batches):
    for b in batches:
        if b.num_rows:
            x = matrix(b.column("v").to_pylist()).astype(np.float64)
            c, at, n = np.unique(b.column("cluster_ord").to_numpy(), return_inverse=True, return_counts=True)
            total = np.add.reduceat(x[np.argsort(at, kind="stable")], np.cumsum(n) - n, axis=0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * BYTES), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n), lists], ["cluster_ord", "n", "total"])


def _packed(batches):
    """The elements of ``c`` as the bytes of their doubles, which go to each member as one value."""
    for b in batches:
        if b.num_rows:
            c = b.column("c").flatten().to_numpy().reshape(-1, BYTES)
            yield pa.RecordBatch.from_arrays([b.column("cluster_ord"), b.column("n"), pa.array([r.tobytes() for r in c])], ["cluster_ord", "n", "c"])


def unpacked(column) -> np.ndarray:
    return np.frombuffer(b"".join(column)).reshape(-1, BYTES)


def centres(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster_ord, n, c): the sums of the unit vectors, added up by batch first and element by element after, as ``unpacked`` reads them."""
    placed = members.join(rows, "ord").select("cluster_ord", "v")
    sums = placed.mapInArrow(_sums, "cluster_ord long, n long, total array<double>")
    added = sums.groupBy("cluster_ord").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(BYTES)]).alias("c"))
    return added.mapInArrow(_packed, "cluster_ord long, n long, c binary")


def angles(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster_ord, ord, v, cosine) of each member to its cluster's centre."""
    placed = members.join(rows, "ord").join(centres(rows, members), "cluster_ord")

    def batches(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            c = unpacked(pdf["c"])
            c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
            yield pd.DataFrame({"cluster_ord": pdf["cluster_ord"], "ord": pdf["ord"], "v": pdf["v"], "cosine": (matrix(pdf["v"]) * c).sum(1).astype("float64")})

    return placed.select("cluster_ord", "ord", "v", "c").mapInPandas(batches, "cluster_ord long, ord long, v binary, cosine double")


#: Members of a block; a cluster's blocks are compared pair by pair, each pair as a task of its own.
BLOCK = 2_000


def broken(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Clusters two members of which are less alike than ALIKE.

    Two members within half of arccos(ALIKE) of the centre are alike by the triangle inequality. Only members
    beyond, together with the farthest others, can break a cluster; all of these are compared, block against block.
    """
    limit = float(np.arccos(ALIKE))
    seen = angles(rows, members).withColumn("angle", F.acos(F.least("cosine", F.lit(1.0))))
    seen = persisted(seen, "cluster-angles")
    wide = seen.groupBy("cluster_ord").agg(F.max("angle").alias("far")).where(F.col("far") > limit / 2)
    outer = seen.join(wide, "cluster_ord").where(F.col("angle") + F.col("far") > limit).select("cluster_ord", "ord", "v")
    blocks = outer.groupBy("cluster_ord").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_n"))
    outer = outer.join(blocks, "cluster_ord").withColumn("block", F.pmod(F.xxhash64("ord"), F.col("_n").cast("long")).cast("int"))
    paired = outer.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    paired = paired.select("cluster_ord", F.least("block", "_o").alias("lo"), F.greatest("block", "_o").alias("hi"), "block", "v")

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf["v"][pdf["block"] == pdf["lo"]], pdf["v"][pdf["block"] == pdf["hi"]]
        bad = False
        if len(one) and len(two):
            x, y = matrix(one), matrix(two)
            bad = any((x[i : i + 1024] @ y.T).min() < ALIKE for i in range(0, len(x), 1024))
        return pdf[["cluster_ord"]].head(int(bad))

    return paired.groupBy("cluster_ord", "lo", "hi").applyInPandas(check, "cluster_ord long").distinct()


def described(df: DataFrame, key: str = "ord", vec: str = "vec", typical: int = 3) -> DataFrame:
    """(cluster_ord, size, typical): each cluster with its members nearest to the centre, where it is densest."""
    rows = persisted(usable(df, key, vec), "cluster-vectors")
    members = persisted(clusters(df, key, vec), "cluster-found")
    near = angles(rows, members).select("cluster_ord", "ord", F.round("cosine", 6).alias("cosine"), F.pmod(F.xxhash64("ord"), F.lit(64)).alias("salt"))
    for part in (["cluster_ord", "salt"], ["cluster_ord"]):
        near = near.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy(F.desc("cosine"), "ord"))).where(F.col("_r") <= typical).drop("_r")
    best = near.groupBy("cluster_ord").agg(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("c"), "ord"))).alias("t")).select("cluster_ord", F.transform("t", lambda s: s["ord"]).alias("typical"))
    return members.groupBy("cluster_ord").agg(F.count(F.lit(1)).alias("size")).join(best, "cluster_ord")
