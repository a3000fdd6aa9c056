import itertools

import pytest

from corpusloom.operators import corpus as C
from corpusloom.operators.graph import connected_components

FIELDS = "row_id long, file_name string, run_date string, id string, source string, category string, title string, url string, date string, summary string, tier string, need string"


def record(i, run="r1", title="A", url="https://x.com", summary="s", category=None, tier=None, ident=None, need=None):
    return (i, f"{run}.json", run, ident or f"id{i}", "S", category, title, url, None, summary, tier, need)


def fold(rows):
    """The merge by its definition, in plain Python."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2] or "", r[1] or "", r[0])):
        url = (r[7] or "").strip().rstrip("/").lower() or (r[3] or "")
        title = " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in (r[6] or "").lower()).split())
        slots = groups.setdefault(url, [])
        for s in slots:
            if C.titles_agree(s["t"], title):
                s.update(t=title, last=r[0], summary=r[9], category=r[5] or s["category"], tier=r[10] or s["tier"])
                s["runs"].add(r[2] or "")
                break
        else:
            slots.append({"t": title, "last": r[0], "summary": r[9], "category": r[5] or None, "tier": r[10] or None, "runs": {r[2] or ""}})
    return sorted((s["last"], s["summary"], s["category"], s["tier"], tuple(sorted(s["runs"]))) for g in groups.values() for s in g)


def merged(spark, rows):
    got = C.merge_corpus(spark.createDataFrame(rows, FIELDS)).collect()
    return sorted((r.row_id, r.summary, r.category, r.tier, tuple(r._runs)) for r in got)


def test_newer_nulls_win_but_category_and_tier_stay(spark):
    rows = [record(1, "r1", "Without Exception", category="art", tier="core"), record(2, "r2", "Without Exception: photographs", summary=None)]
    assert merged(spark, rows) == [(2, None, "art", "core", ("r1", "r2"))]


def test_order_and_empty_titles(spark):
    rows = [record(1, title="alpha"), record(2, title="alpha beta"), record(3, title="beta gamma"), record(4, title=""), record(5, title="delta"), record(6, url="", ident="k"), record(7, url=None, ident="k")]
    assert merged(spark, rows) == fold(rows)


def test_against_the_plain_fold(spark):
    words = ["alpha", "beta", "alpha beta", "gamma", "beta gamma", "", "alpha beta gamma"]
    rows = [record(i, f"r{i % 3}", t, url=f"https://x.com/{u}", category=["", "art", None][i % 3], tier=[None, "core"][i % 2]) for i, (t, u) in enumerate(itertools.product(words, "ab"), 1)]
    rows += [(100, None, None, None, None, None, None, None, None, None, None, None)]
    assert merged(spark, rows) == fold(rows)


def test_merge_of_nothing(spark):
    assert C.merge_corpus(spark.createDataFrame([], FIELDS)).count() == 0


def test_shares(spark):
    df = spark.createDataFrame([record(i, need=n) for i, n in enumerate(["a", "a", None, ""], 1)], FIELDS)
    got = {(r.need, r.n): r.share for r in C.shares(C.need_history(df), ["run"]).collect()}
    assert got == {("a", 2): 0.5, ("unsettled", 2): 0.5}


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, few):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 1), (20, 21), (None, 4)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()}
    want = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20} | dict.fromkeys(range(100, 160), 100)
    assert got == want


@pytest.mark.parametrize("few", [0, 1000])
def test_components_of_a_chain(spark, few):
    edges = [(i, i + 1) for i in range(60)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()
    assert len(got) == 61 and {r.component for r in got} == {0}
