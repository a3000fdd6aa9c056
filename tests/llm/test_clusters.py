import base64

import numpy as np

from corpusloom.llm import clusters as C


def near(rng, centre, n, spread):
    x = centre + rng.normal(0, spread, (n, C.BYTES))
    return np.rint(x / np.linalg.norm(x, axis=1, keepdims=True) * 500).clip(-127, 127).astype(np.int8)


def encode(v):
    return base64.b64encode(v.tobytes()).decode()


def data(groups, singles, seed=1):
    rng = np.random.default_rng(seed)
    centre = lambda: (c := rng.normal(size=C.BYTES)) / np.linalg.norm(c)
    rows, at = [], 1
    for size, spread in groups:
        for v in near(rng, centre(), size, spread):
            rows.append((at, encode(v)))
            at += 1
    for _ in range(singles):
        rows.append((at, encode(near(rng, centre(), 1, 0.01)[0])))
        at += 1
    return rows


def truth(rows):
    ok = [(o, b) for o, v in rows if (b := C.decode(v))]
    if not ok:
        return set()
    x, ords = C.matrix([b for _, b in ok]), [o for o, _ in ok]
    s, seen, out = x @ x.T, set(), set()
    for i in range(len(ok)):
        if i in seen:
            continue
        group, open_ = {i}, [i]
        while open_:
            for j in np.nonzero(s[open_.pop()] >= C.APART)[0]:
                if j not in group:
                    group.add(int(j))
                    open_.append(int(j))
        seen |= group
        g = sorted(group)
        if len(g) >= C.LEAST and s[np.ix_(g, g)].min() >= C.ALIKE:
            out |= {(min(ords[j] for j in g), ords[j]) for j in g}
    return out


def test_decode():
    good = encode(np.arange(128).astype(np.int8))
    assert C.decode(good) and [C.decode(x) for x in (None, "", "?!", good[:-4], encode(np.zeros(128, np.int8)), "é", good + "AAAA")] == [None] * 7


def test_clusters_against_brute_force(spark):
    rows = data([(40, 0.03), (5, 0.03), (4, 0.03), (300, 0.04), (12, 0.045)], 60)
    rows += [(9001, None), (9002, ""), (9003, "x"), (9004, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "ord long, vec string, cluster_ord int")
    got = {tuple(r) for r in C.clusters(df).collect()}
    assert got == truth(rows) and (1, 9004) in got and len({c for c, _ in got}) == 4
    described = {r.cluster_ord: r for r in C.described(df).collect()}
    assert described[1]["size"] == 41 and all(len(r.typical) == 3 for r in described.values())


def test_many_leaves_find_small_and_hot_clusters(spark):
    rows = data([(900, 0.03), *[(8, 0.035)] * 60], 300, seed=4)
    df = spark.createDataFrame(rows, "ord long, vec string")
    leaf, C.links_of.__defaults__ = C.links_of.__defaults__, (C.SAMPLE, 150, C.ROUTES, 0)
    try:
        got = {tuple(r) for r in C.clusters(df).collect()}
    finally:
        C.links_of.__defaults__ = leaf
    want = truth(rows)
    assert len(got & want) >= 0.97 * len(want) and not got - want


def test_clusters_that_are_no_clusters(spark):
    rng = np.random.default_rng(2)
    a, b = np.linalg.qr(rng.normal(size=(C.BYTES, 2)))[0].T
    arc = np.stack([np.cos(t) * a + np.sin(t) * b for t in np.linspace(0, 1.2, 9)])  # neighbours alike, ends not
    rows = [(i + 1, encode(np.rint(v * 400).clip(-127, 127).astype(np.int8))) for i, v in enumerate(arc)]
    assert C.clusters(spark.createDataFrame(rows, "ord long, vec string")).count() == 0 == len(truth(rows))
    assert C.clusters(spark.createDataFrame([], "ord long, vec string")).count() == 0
    same = [(i, rows[0][1]) for i in range(1, 8)]
    assert {tuple(r) for r in C.clusters(spark.createDataFrame(same, "ord long, vec string")).collect()} == {(1, i) for i in range(1, 8)}


def test_every_pair_of_a_hot_wide_cluster_is_checked(spark):
    rng = np.random.default_rng(5)
    centre, side = np.eye(C.BYTES)[:2]
    away = rng.normal(size=(18_000, C.BYTES))
    away[:, :2] = 0
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    at = lambda degrees, d: np.cos(np.radians(degrees)) * centre + np.sin(np.radians(degrees)) * d
    ring = [at(25.5, d) for d in away]
    vectors = lambda points: [np.rint(p * 127).clip(-127, 127).astype(np.int8).tobytes() for p in points]
    for points, bad in ((ring, 0), ([*ring, at(24, side), at(24, -side)], 1)):  # the two are not alike, and not the farthest
        rows = spark.createDataFrame(list(enumerate(vectors(points))), "ord long, v binary")
        assert C.broken(rows, rows.selectExpr("cast(0 as long) as cluster_ord", "ord")).count() == bad


def test_routers_are_fitted_on_all_rows(spark, monkeypatch):
    rows = data([(400, 0.03), (40, 0.04), *[(20, 0.035)] * 20], 1500, seed=7)
    x = C.matrix([C.decode(v) for _, v in rows])
    vectors = C.usable(spark.createDataFrame(rows, "ord long, vec string"), "ord", "vec")
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: sent.append(value) or send(sc, value))
    C.links_of(vectors, sample=200, leaf=200)
    axes, routers = sent[-1]
    assert np.allclose(axes.mean, x.mean(0), atol=1e-6)
    z = axes(x)
    assert np.allclose(z.std(0).mean(), 1, atol=0.2) and len(z.T) == C.AXES
    for router in routers:
        r, each = router.shares(z)
        assert np.abs(router.weights - r.mean(0)).sum() < 0.02
        again = router.maximised(r.sum(0), r.T @ z, r.T @ router.squares(z), C.ROUTER_RIDGE)
        assert again.shares(z)[1].mean() - each.mean() < C.CONVERGED * abs(each.mean())
    n, mean, covariance = C.moments(vectors)
    assert n == len(x) and np.allclose(covariance, np.cov(x.T, bias=True), atol=1e-6) and np.allclose(mean, x.mean(0))


def test_a_leaf_needs_no_product_for_each_row(monkeypatch):
    rows = data([(60, 0.03), (9, 0.045)], 200, seed=3)
    ords, x = np.array([o for o, _ in rows]), C.matrix([C.decode(v) for _, v in rows])
    axes = C.Axes(x.mean(0), np.cov(x.T.astype(float), bias=True))

    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += 1
            return np.asarray(self) @ np.asarray(other)

    held = C.solve_leaf(ords, x.view(Counted), axes)
    assert Counted.products < 10  # not one for each representative, of which there are more than 200
    monkeypatch.setattr(C, "HELD", 10)  # a leaf too large to hold all cosines
    assert all(np.array_equal(a, b) for a, b in zip(held, C.solve_leaf(ords, x, axes), strict=True))
    assert set(range(1, 61)) <= set(held[0].ravel().tolist())


def test_partial_sums_are_those_of_the_shares():
    rng = np.random.default_rng(6)
    z = rng.normal(size=(300, 7)).astype(np.float32)
    for shape in ("diagonal", "spherical", "tied"):
        variance = rng.uniform(0.5, 2, (5, 1 if shape != "diagonal" else 7)) * np.ones((5, 7)) if shape != "tied" else np.full((5, 7), 0.8)
        mix = C.Mixture(z[:5], variance.astype(np.float32), np.full(5, 0.2, np.float32), shape)
        dense = np.log(0.2) - 0.5 * (((z[:, None] - mix.means) ** 2 / mix.variance).sum(2) + np.log(mix.variance).sum(1))
        assert np.allclose(mix.log_density(z), dense, atol=1e-3)
        r, each = mix.shares(z)
        *sums, likelihood = mix.sums(z)
        for got, want in zip(sums, (r.sum(0), r.T @ z, r.T @ mix.squares(z)), strict=True):
            assert np.allclose(got, want, rtol=1e-3, atol=1e-3)
        assert np.allclose(likelihood, each, atol=1e-4)
