import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import pages as G
from corpusloom.operators import planes as P
from corpusloom.operators import search as R
from corpusloom.operators import worklist as W
from corpusloom.sources import signals as S

CORPUS = "ord long, id string, source string, category string, title string, url string, pub_date string, summary string, forward_looking boolean, recommended_substrate string, cross_substrate_notes string, novelty_note string, tier string, need string, _runs array<string>, _first_seen string"


def row(i, title="", need=None, tier=None, runs=("r1",), first="r1", url="https://x.com/a", date=None, fwd=None, summary=None):
    return (i, f"i{i}", "src", None, title, url, date, summary, fwd, None, None, None, tier, need, list(runs), first)


def scores(spark, rows, query, **kw):
    return {r.ord: round(r.score, 6) for r in R.scored(spark.createDataFrame(rows, CORPUS), query, **kw).collect()}


def test_score(spark):
    rows = [row(1, "rest rests", first="r2", runs=("r1", "r2")), row(2, "restaurant"), row(3, "rest", tier="core", first="zz")]
    got = scores(spark, rows, "rest", synonyms={})
    assert got == {1: round(6 * 1.1, 6), 2: 0.0, 3: round(3 * 1.2, 6)}  # a first run that is unknown costs nothing


def test_duplicate_term_doubles_score_not_breadth(spark):
    one, two = scores(spark, [row(1, "stone")], "stone"), scores(spark, [row(1, "stone")], "stone stone")
    assert two[1] == 2 * one[1]


def test_synonyms_count_half_and_toward_their_term(spark):
    got = scores(spark, [row(1, "handmade craft")], "craft")
    assert got == {1: 3.0 * 1 + 3.0 * 0.5}


def test_search_order_does_not_depend_on_row_order(spark):
    rows = [row(i, "stone", runs=("r1",) * (1 + i % 2)) for i in range(1, 9)]
    want = [r.ord for r in R.search(spark.createDataFrame(rows, CORPUS), "stone", 5).collect()]
    assert [r.ord for r in R.search(spark.createDataFrame(rows[::-1], CORPUS), "stone", 5).collect()] == want


def test_search_excludes_after_ranking_and_needs_default(spark):
    rows = [row(1, "stone"), row(2, "stone", need="Kinship")]
    assert [r.ord for r in R.search(spark.createDataFrame(rows, CORPUS), "stone", exclude=["UNSETTLED"]).collect()] == [2]
    assert {r.need for r in R.browse(spark.createDataFrame(rows, CORPUS), "need", "untagged").collect()} == {"untagged", "Kinship"}


def test_search_of_nothing(spark):
    assert R.search(spark.createDataFrame([], CORPUS), "stone").count() == 0
    assert R.search(spark.createDataFrame([row(1, "stone")], CORPUS), "the of").count() == 0


def test_worklist(spark):
    now = "2026-07-17"
    rows = [
        row(1, need="N", date="2026-07-07", tier="extended", fwd=False, runs=("b",)),
        row(2, need="N", date="2026-07-07", tier="core", fwd=True, runs=("b",)),
        row(3, need="N", date="2026-07-07", tier="core", url="https://x.com/", runs=("b",)),
        row(4, need="K", date="2026-07-07", tier="core", runs=("b",)),
        row(5, need="N", date="2025-06-12", tier="core", runs=("a",)),
        row(6, need="N", date=None, tier="core", runs=("b",)),
    ]
    df = spark.createDataFrame(rows, CORPUS)
    order = lambda **kw: [r.ord for r in W.select_worklist(df, "N", now, **kw).collect()]
    assert order() == [2, 5, 6, 1]  # undated after dated
    assert order(days=90) == [2, 1]
    assert order(run="a") == [5]


def test_cumulative_stop(spark):
    df = spark.createDataFrame([("g", i, 15) for i in range(5)], "g string, i int, n long")
    assert sorted(r.i for r in W.cumulative_stop(df, "g", "n", ["i"], 45).collect()) == [0, 1, 2]
    assert W.cumulative_stop(df, "g", "n", ["i"], 0).count() == 5


def test_paging(spark):
    df = spark.createDataFrame([("a", i) for i in range(14)], "g string, i int")
    got = {r.i: (r.sheet, r.slot, r.grid_col, r.grid_row) for r in W.numbered(df, "g", "i").collect()}
    assert got[11] == (1, 11, 2, 3) and got[12] == (2, 0, 0, 0) and len(got) == 14


def test_cap_keeps_the_true_size(spark):
    df = spark.createDataFrame([("a", i) for i in range(20)], "g string, i int")
    rows = W.cap_per_group(df, ["g"], ["i"], 15).collect()
    assert len(rows) == 15 and {r.n_found for r in rows} == {20}


def test_junk(spark):
    rows = [("https://x.com/A.SVG", None), ("data:image/png;base64,x", None), ("https://myfacebook.com/a.jpg", None), ("https://x.com/logo.jpg", None), ("https://x.com/a.jpg", "80px"), ("https://x.com/a.jpg", "100%"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, u string, w string")
    got = [r[0] for r in df.orderBy("i").select(G.junk_reason(F.col("u"), F.col("w"), F.lit(None).cast("string"))).collect()]
    assert got == ["svg", "data-uri", "ad-domain", "junk-hint:logo", "too-small", None, None]


PAGE = """<html><head><title>T</title><meta name=author content="Ann"></head><nav><img src=/nav.jpg></nav><article><h1>Head</h1>
<p>This paragraph is the one that stands before the first picture.</p><figure><picture><source srcset="/hero-400.jpg 400w, /hero-1600.jpg 1600w"><img src="/hero-400.jpg" alt="Hero"></picture><figcaption>The hero</figcaption></figure>
<img srcset="/b.jpg 800w, /c.jpg 2400w"><div class="photo-credit">By Bo</div><img src="data:x" data-src="/late.jpg"><img data-src="/lazy.jpg" title="Lazy">
<img src="https://ad.doubleclick.net/x.jpg"><img src="/tiny.jpg" width=1 height=1><img src="/hero-400.jpg"><p>short</p></article><footer><img src=/f.jpg></footer>"""


def test_images_of_a_page():
    got = G.images_of(PAGE, "https://x.com/a/")
    assert [g["url"] for g in got] == ["https://x.com/hero-1600.jpg", "https://x.com/c.jpg", "https://x.com/lazy.jpg"]
    assert [g["caption"] for g in got] == ["The hero", "By Bo", "Lazy"]
    assert all(g["context"].startswith("This paragraph") for g in got)
    assert G.images_of(None, "https://x.com") == [] == G.images_of("<img src=", "")


def test_only_addresses_make_two_images_one():
    of = lambda html: [g["url"] for g in G.images_of(html, "https://x.com/")]
    assert len(of("".join(f'<img src="gallery-0{i}.jpg">' for i in range(1, 6)))) == 5
    assert len(of("".join(f'<img src="img?id={i}">' for i in range(1, 6)))) == 5
    assert of('<img srcset="p-small.jpg 400w, p-large.jpg 1600w"><p>x</p><img src="p-small.jpg">') == ["https://x.com/p-large.jpg"]
    assert of('<picture><source srcset="a.webp"><span><img src="a.jpg"></span></picture><img src="a.jpg">') == ["https://x.com/a.webp"]


def test_fields_of_a_page():
    got = G.article_fields(PAGE)
    assert (got["title"], got["author"]) == ("Head", "Ann") and "stands before" in got["text"]
    assert G.article_fields("")["title"] == ""


def plain_kmeans(x, k, seated, rounds=25):
    """The two variants, row by row, as they are stated."""
    unit = lambda v: v / (np.linalg.norm(v) + 1e-9) if not seated else v / (np.linalg.norm(v) or 1)
    x = np.array([unit(v) for v in x])
    c = [x[0]]
    while len(c) < min(k, len(x)):
        c.append(x[min(range(len(x)), key=lambda i: (round(max(x[i] @ s for s in c), 11), i))])
    label = [0 if seated else -1] * len(x)
    for _ in range(rounds):
        new = [max(range(len(c)), key=lambda j: (round(v @ c[j], 11), -j)) for v in x]
        if new == label and not seated:
            break
        still, label = new == label, new
        c = [unit(sum(x[i] for i in range(len(x)) if label[i] == j)) if j in label else c[j] for j in range(len(c))]
        if still:
            break
    return label


@pytest.mark.parametrize("rollup", [True, False])
def test_kmeans_by_need_equals_the_plain_algorithm(spark, rollup):
    rng = np.random.default_rng(4)
    needs = {"a": rng.integers(-90, 90, (70, 6)), "b": np.ones((5, 6), int), "c": rng.integers(-9, 9, (1, 6)), "d": np.vstack([rng.integers(-90, 90, (9, 6)), np.zeros((2, 6), int)])}
    rows = [(n, 1000 * i + j, [float(v) for v in r]) for i, (n, x) in enumerate(needs.items()) for j, r in enumerate(x)]
    df = spark.createDataFrame([*rows, ("a", 9999, None)], "need string, ord long, v array<double>").repartition(5)
    got = {(r.need, r.ord): r.cluster for r in P.cluster_by_need(df, rollup=rollup).collect()}
    for i, (n, x) in enumerate(needs.items()):
        want = plain_kmeans(x.astype(float), 3 if rollup else P.range_k(len(x)), rollup)
        assert [got[n, 1000 * i + j] for j in range(len(x))] == want
    assert P.cluster_by_need(df.limit(0), rollup=rollup).count() == 0


def test_planes_equal_the_decomposition(spark):
    rng = np.random.default_rng(5)
    needs = {"a": rng.normal(size=(40, 6)) * [5, 3, 1, 1, 1, 1], "b": rng.normal(size=(3, 6)), "c": rng.normal(size=(1, 6))}
    rows = [(n, 100 * i + j, [float(v) for v in r]) for i, (n, x) in enumerate(needs.items()) for j, r in enumerate(x)]
    got = {(r.need, r.ord): r for r in P.plane_of_need(spark.createDataFrame(rows, "need string, ord long, v array<double>").repartition(4), width=6).collect()}
    assert {n for n, _ in got} == {"a", "b"}
    for i, n in enumerate("ab"):
        centred = needs[n] - needs[n].mean(0)
        _, s, v = np.linalg.svd(centred, full_matrices=False)
        v = v[:2] * np.where(np.take_along_axis(v[:2], np.abs(v[:2]).argmax(1)[:, None], 1) < 0, -1, 1)
        at = np.array([[got[n, 100 * i + j].x, got[n, 100 * i + j].y] for j in range(len(centred))])
        assert np.allclose(at, centred @ v.T, atol=1e-6) and np.isclose(got[n, 100 * i].share_x, s[0] ** 2 / (s**2).sum())


def test_vectors_as_text(spark):
    df = spark.createDataFrame([(1, "AP+AfwE="), (2, ""), (3, None), (4, "%%"), (5, "AAA")], "i int, t string")
    from corpusloom.functions import vectors as V

    v = V.decode_bytes(F.col("t"))
    got = {r.i: (r.v, r.t2) for r in df.select("i", v.alias("v"), V.encode_bytes(v).alias("t2")).collect()}
    assert got[1] == ([0, -1, -128, 127, 1], "AP+AfwE=") and all(got[i] == (None, None) for i in (2, 3, 4))


def test_inject():
    assert P.inject("a/*__X__*/old/*__END__*/b", "X", "new") == "a/*__X__*/new/*__END__*/b"


def test_sources(spark, tmp_path):
    (tmp_path / "tagged_b.json").write_text('{"tagging_date": "2026-01-01", "signals": [{"id": "1", "title": "t"}, {"id": "2"}]}')
    (tmp_path / "tagged_a.json").write_text('{"signals": [{"id": "3"}]}')
    runs = S.scan_runs(spark, str(tmp_path / "tagged_*.json"))
    assert sorted((r.run_date, r.seq, r.id) for r in runs.collect()) == [("2026-01-01", 0, "1"), ("2026-01-01", 1, "2"), ("tagged_a", 0, "3")]
    (tmp_path / "urls.txt").write_text("# head\n\n https://x.com/a \nftp://y\nhttp://z\n")
    assert sorted(r.url for r in S.scan_url_list(spark, str(tmp_path / "urls.txt"), "N").collect()) == ["http://z", "https://x.com/a"]
    assert S.read_or_empty(spark, str(tmp_path / "none"), S.SIGNAL).count() == 0
    got = S.fetched(spark.createDataFrame([("https://x.com/a",)], "url string"), lambda u: (200, "text/html", u)).collect()
    assert [(r.status, r.body) for r in got] == [(200, "https://x.com/a")]


def test_stream_appends_each_key_once(spark, tmp_path):
    from corpusloom.streaming.ingest import append_new, read_files

    data = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    data.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        append_new(read_files(spark, str(tmp_path / "in"), data.schema), "k", str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_pictures(spark):
    rows = [("N", 0, 0.0, 1.0, 4, "a & b"), ("N", 1, 2.0, 1.0, 9, "c" * 30), ("M", 0, 5.0, 5.0, 400, "x")]
    groups = spark.createDataFrame(rows, "need string, cluster int, x double, y double, n long, label string")
    at = {(r.need, r.cluster): r for r in P.geometry(groups).collect()}
    assert (at["N", 0].r, at["N", 1].r, at["M", 0].r) == (15.0, 18.0, 30.0)
    assert (at["N", 0].px, at["N", 1].px, at["N", 0].py, at["M", 0].px) == (290 - (212 - 28), 290 + (212 - 28), 216.0, 290.0)
    assert at["N", 1].shown == "c" * 25 + "…" and at["N", 0].label_y == 216 - 15 - 6
    svg = {r.need: r.svg for r in P.pictures(groups, {"N": (("l", "r"), ("d", "<u>"))}, {"N": "#000000"}).collect()}
    assert "a &amp; b" in svg["N"] and "&lt;u&gt;" in svg["N"] and svg["N"].index("ccc") < svg["N"].index("a &amp;") and "#8f9092" in svg["M"]
    assert P.pictures(groups.limit(0), {}).count() == 0
