import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.llm import articles as A
from corpusloom.llm import hashforest, history, queries, survivors
from corpusloom.llm.hashforest import HashForest

SIGNALS = "row_id long, file_name string, run_date string, id string, source string, category string, tier string, title string, url string, extra string"


@pytest.mark.parametrize(
    ("url", "page"),
    [
        (" HTTPS://www.X.example:443/a/b/?utm_source=q#c ", "x.example/a/b"),
        ("m.x.example/a%2Db.html", "x.example/a-b"),
        ("https://x.example/amp/a/index.html", "x.example/a"),
        ("https://x.example/?p=82&ref=h", "x.example?p=82"),
        ("https://x.example/", "x.example"),
        ("  ", None),
        (None, None),
        ("http://[", None),
    ],
)
def test_pages(url, page):
    assert A.page_of(url)[0] == page


W = A.title_words


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("The colllector of Gipaleza", "THE COLLECTOR OF GIPALEZA &ndash; Q", True),
        ("Studio vist: Kumicamu", "Studio visit: Kumicamu", True),
        ("Studio visit: Kumicamu", "Studio visit: Jorateci", False),
        ("Blunt syllabus Nusa, no. 5", "Blunt syllabus Nusa, part 3", False),
        ("Notes on Sekinuko and each 2026 locker", "Notes on Sekinuko and each locker", True),
        ("Ramuruse and the quiet museum: harvest through gesture", "Ramuruse and the quiet museum", True),
        ("Pezafadi, la plume &amp; le héros", "Pezafadi, la plume et le heros", True),
        ("", "x", False),
    ],
)
def test_titles(a, b, same):
    assert A.same_title(W(a, "Q"), W(b, "Q")) is same
    assert A.same_title(W(b, "Q"), W(a, "Q")) is same


def rec(i, title, url, source="Q Review", ident=None, run="2026-01-01", category=None, tier=None):
    return (i, f"f{run}", run, ident or f"id{i}", source, category, tier, title, url, None)


U = "https://q.example/p/"
RECORDS = [
    rec(1, "The collector of Gipaleza", U + "the-collector"),
    rec(2, "The colllector of Gipaleza", "https://www.q.example/posts/gipaleza-5"),
    rec(3, None, U + "the-collector/"),
    rec(4, "The echo of Viwado", "https://q.example"),
    rec(5, "The root of Cabelo", "https://q.example/"),
    rec(6, "In brief", "https://q.example/issues/1/in-brief"),
    rec(7, "In brief", "https://q.example/issues/2/in-brief"),
    rec(8, "In brief", "https://z.example/issues/2/in-brief", source="Z"),
    rec(9, "Mixed up words", None, ident="id4"),
    rec(10, "The echo of Viwado", " ", ident="k"),
    rec(11, None, None, source=None),
    rec(12, "", "https://q.example", ident="m"),
    rec(13, "Cracked recipe Quso, no. 1", "https://q.example/columns/quso"),
    rec(14, "Cracked recipe Quso, no. 2", "https://q.example/columns/quso"),
    rec(15, "In brief", "https://Q.example/issues/1/in-brief#x"),
]


def groups(labels):
    out = {}
    for r in labels.collect():
        out.setdefault(r["class"], set()).add(r.row_id)
    return {frozenset(g) for g in out.values() if len(g) > 1}


def test_groups(spark):
    got = groups(A.article_labels(spark.createDataFrame(RECORDS, SIGNALS)))
    assert got == {frozenset({1, 2, 3}), frozenset({4, 9, 10}), frozenset({6, 15})}


def test_no_records(spark):
    empty = spark.createDataFrame([], SIGNALS)
    assert A.article_labels(empty).count() == 0 and history.repeats(empty).count() == 0


def test_repeats(spark):
    got = {tuple(r) for r in history.repeats(spark.createDataFrame(RECORDS, SIGNALS)).collect()}
    assert got == {(1, 2), (1, 3), (4, 9), (4, 10), (6, 15)}


def test_batches_give_what_all_at_once_gives(spark, tmp_path):
    h = history.History(spark, str(tmp_path / "history"))
    parts = [RECORDS[:5], RECORDS[5:10], RECORDS[10:]]
    seen = set()
    for run, part in enumerate(parts):
        seen |= {tuple(r) for r in h.accept(spark.createDataFrame(part, SIGNALS), run).collect()}
    assert seen == {(1, 2), (1, 3), (4, 9), (4, 10), (6, 15)} == {tuple(r) for r in history.repeats(spark.createDataFrame(RECORDS, SIGNALS)).collect()}
    merged = h.merge_runs(str(tmp_path / "merged"), 3)
    more = [rec(20, "The root of Cabela", None, ident="new"), rec(21, "Cracked recipe Quso, no. 2", None, ident="x"), rec(22, "Other", "https://q.example/zzz")]
    last = spark.createDataFrame(more, SIGNALS)
    want = {tuple(r) for r in h.accept(last, 3).collect()}
    assert {tuple(r) for r in merged.accept(last, 1).collect()} == want == {(5, 20), (14, 21)}


def test_a_batch_joins_articles_of_the_history(spark, tmp_path):
    h = history.History(spark, str(tmp_path / "history"))
    rows = [rec(1, "The echo of Viwado", "https://q.example/p1"), rec(2, "A wholly other heading Zabolu", "https://q.example/p2"), rec(3, "A wholly other heading Zabolu", "https://q.example/p2"), rec(4, "Wholly other heading Zabolu", "https://q.example/p1"), rec(5, None, "https://q.example/p2")]
    assert {tuple(r) for r in h.accept(spark.createDataFrame(rows[:3], SIGNALS), 0).collect()} == {(2, 3)}
    got = {tuple(r) for r in h.accept(spark.createDataFrame([rows[3], rows[4]], SIGNALS), 1).collect()}
    assert got == {(2, 4), (2, 5)}
    bridge = rec(6, "The echo of Viwado", None, ident="id4")
    assert {tuple(r) for r in h.accept(spark.createDataFrame([bridge], SIGNALS), 2).collect()} == {(1, 6)}
    assert {tuple(r) for r in h.joined(2).collect()} == {(2, 1)} and h.joined(1).count() == 0


def test_files_one_by_one_equal_all_at_once(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(3))
    shapes = ["The {} of {}", "Notes on {} and {}", "{} {} studio", "Quiet {}s room {} at night"]
    told = [(rng.choice(shapes).format(word(), word()), rng.random() < 0.7) for _ in range(40)]
    rows = []
    for i in range(1, 91):
        j = rng.randrange(40)
        title, paged = told[j]
        at = rng.randrange(len(title))
        title = title[:at] + title[at + 1 :] if rng.random() < 0.4 else title
        rows.append((i, f"f{(i - 1) // 30}", "2026-01", f"id{j}", "Q", None, None, title, f"https://q.example/p{j}?utm_source=x" if paged and rng.random() < 0.8 else None, "x"))
    df = spark.createDataFrame(rows, SIGNALS)
    got, figures = history.by_files(history.History(spark, str(tmp_path / "h")), df)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in history.repeats(df).collect()}
    assert [f["records"] for f in figures] == [30] * 3 and got.count() > 30


def test_the_query_locates_new_files_in_the_history(spark, sf, monkeypatch):
    seen, accept, merge = [], history.History.accept, history.History.merge_runs
    monkeypatch.setattr(history.History, "accept", lambda h, batch, run: seen.append((run, batch.count(), h.nodes(run) is not None if run else False)) or accept(h, batch, run))
    monkeypatch.setattr(history.History, "merge_runs", lambda h, into, runs: seen.append(("merge", runs)) or merge(h, into, runs))
    signals = spark.read.parquet(f"{sf}/tagged_signals.parquet")
    got = [tuple(r) for r in queries.p7_found(spark, sf).collect()]
    sizes = [r["count"] for r in signals.groupBy("file_name").agg(F.min("row_id").alias("first"), F.count("*").alias("count")).orderBy("first").collect()]
    assert seen == [(0, sum(sizes[:-2]), False), (1, sizes[-2], True), ("merge", 2), (1, sizes[-1], True)]
    assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in history.repeats(signals).collect()}


@pytest.mark.parametrize("options", [{}, {"bucket": 2}, {"lenient": True}])
def test_runs_of_the_forest_equal_brute_force(spark, tmp_path, options):
    rng = random.Random(11)
    name = lambda: "".join(rng.choice("bdk") + rng.choice("ai") for _ in range(3))
    rows = [(i, "hot", " ".join([*rng.sample(["the", "quiet", "lens", "echo", "room", "5", "6"], rng.randrange(1, 5)), name()])) for i in range(240)]
    want = brute(rows, options.get("lenient", False))
    text = {k: t.split() for k, _, t in rows}
    forest, pairs = HashForest(spark, str(tmp_path / "f"), **options), set()
    df = lambda part: spark.createDataFrame(part, "k long, g string, t string")
    for run in range(3):
        pairs |= {(r.a, r.b) for r in forest.add(df(rows[60 * run : 60 * run + 60]), "g", "t", "k", run).collect()}
    merged = forest.merge(str(tmp_path / "m"))
    pairs |= {(r.a, r.b) for r in merged.add(df(rows[180:]), "g", "t", "k", 1).collect()}
    assert {(a, b) for a, b in pairs if A.same_title(text[a], text[b], options.get("lenient", False))} == want and len(want) > 100


@pytest.mark.parametrize("rows", [hashforest.runtime.BROADCAST_ROWS, 0])
def test_near_words_are_kept_with_their_run(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(hashforest.runtime, "BROADCAST_ROWS", rows)  # few words are sent out, others shuffled
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abké𝔘") for _ in range(rng.randrange(2, 6)))
    texts = [list(dict.fromkeys(word() for _ in range(3))) for _ in range(90)] + [["12345", "1234"], ["x" * 3000]]
    df = lambda part: spark.createDataFrame([(i, "g", " ".join(texts[i])) for i in part], "k long, g string, t string")
    forest = HashForest(spark, str(tmp_path / "f"))
    forest.add(df(range(60)), "g", "t", "k", 0)
    forest.add(df(range(60, len(texts))), "g", "t", "k", 1)
    pairs = lambda f: {(r.w, r.v) for r in f.read("near").collect()}
    name = {r.w: r.word for r in forest.read("words").collect()}
    got = {(name[w], name[v]) for w, v in pairs(forest)}
    words = {w for t in texts for w in t}
    assert {(a, b) for a in words for b in words if a != b and A._near(a, b)} <= got and ("12345", "1234") not in got
    assert all(abs(len(a) - len(b)) <= 1 for a, b in got)
    assert pairs(forest.merge(str(tmp_path / "m"))) == pairs(forest)


def test_words_one_slip_apart_meet_in_a_task(spark):
    rng = random.Random(17)
    word = lambda n: "".join(rng.choice("abk\u00e9\U0001d518") for _ in range(n))
    pairs = {("abc", "abcd"), ("abc", "xbc"), ("abc", "axc"), ("abc", "acb"), ("abcd", "acbd"), ("abcdefg", "abcedfg")}
    for n in [*range(3, 12)] * 8:
        w, at = word(n), rng.randrange(n)
        pairs |= {(w, w[:at] + "q" + w[at + 1 :]), (w, w[:at] + "q" + w[at:]), (w, w[:at] + w[at + 1 : at + 2] + w[at : at + 1] + w[at + 2 :])}
    pairs = [(a, b) for a, b in pairs if A._near(a, b)]
    df = spark.createDataFrame([(i, side, 7, w) for i, pair in enumerate(pairs) for side, w in enumerate(pair)], "i long, side long, g long, word string")
    rows = df.select("i", "side", "word", hashforest._ends().alias("ends")).collect()
    ends = {(r.i, r.side): set(r.ends) for r in rows}
    assert all(ends[i, 0] & ends[i, 1] for i in range(len(pairs))) and len(pairs) > 150
    assert all(len(r.ends) <= 4 for r in rows)  # not a key for each of the letters


def test_texts_with_a_word_of_their_own_rank_no_words(spark, tmp_path, monkeypatch):
    ranked, prefixes = [], HashForest._prefixes
    monkeypatch.setattr(HashForest, "_prefixes", lambda f, led: ranked.extend(r.k for r in led.select("k").distinct().collect()) or prefixes(f, led))
    texts = ["quiet room gipaleza", "quiet room", "room quiet", "quiet room gipalesa 5", "quiet viwado", "studio 5"]
    forest = HashForest(spark, str(tmp_path / "f"))
    df = lambda part: spark.createDataFrame([(i, "g", texts[i]) for i in part], "k long, g string, t string")
    assert {(r.a, r.b) for r in forest.add(df(range(5)), "g", "t", "k", 0).collect()} >= {(0, 1), (0, 2), (1, 2)}
    assert sorted(ranked) == [1, 2]
    assert {r.k: r.nd for r in forest.read("askers").collect()} == {0: 1, 1: 3, 2: 3, 3: 1, 4: 1}


def test_a_batch_leaves_only_its_run(spark, tmp_path):
    left = lambda: {p.name for p in Path(runtime.shared_dir(spark).removeprefix("file:")).iterdir() if p.name.startswith(("article-", "forest-", "placed-", "reached-"))}
    before = left()
    assert history.History(spark, str(tmp_path / "h")).accept(spark.createDataFrame(RECORDS, SIGNALS), 0).count() == 5
    assert left() == before


def test_survivors(spark):
    rows = [
        (1, "g", "2026-01", " Art ", "core", "s"),
        (2, "g", "2026-03", "none", None, "s"),
        (3, "g", None, "music", "extended", "s"),
        (4, "g", "2026-02", "film", "other", "t"),
        (5, "h", "2026-02", "film", "core", None),
        (6, "i", None, None, None, None),
        (7, "i", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "row_id long, g string, run_date string, category string, tier string, source string")
    usable = {"category": spark.createDataFrame([("art",), ("film",), ("music",), (None,)], "category string"), "tier": ["core", "extended"]}
    got = {tuple(r) for r in survivors.survivors(df, "g", "row_id", "run_date", usable).collect()}
    assert got == {("g", 1, 1, "film", "core"), ("i", 6, 7, "", "")}
    slow = survivors.survivors(df, "g", "row_id", "run_date", usable, "source", spark.createDataFrame([("s", 5.0)], "source string, weight double"), half_life_days=3650)
    # dates that are none are as old as can be: the trusted votes win, of them the later one
    assert {r.g: r.category for r in slow.collect()}["g"] == "art"
    assert survivors.survivors(df.limit(0), "g", "row_id", "run_date", usable).count() == 0


def test_votes_decide(spark):
    rows = [
        (1, "g", "2026-01-01", "art", "core", "s"),
        (2, "g", "2026-01-01", "art", "core", "s"),
        (3, "g", "2026-03-01", "film", "extended", "t"),
        (4, "h", "2026-01-01", "art", "core", "s"),
        (5, "h", "2026-01-01", "film", "core", "s"),
        (6, "h", "2026-02-01", None, "core", "t"),
    ]
    df = spark.createDataFrame(rows, "row_id long, g string, run_date string, category string, tier string, source string")
    usable = {"category": ["art", "film"], "tier": ["core", "extended"]}

    def won(**options):
        return {r.g: (r.category, r.tier) for r in survivors.survivors(df, "g", "row_id", "run_date", usable, "source", **options).collect()}

    trust = lambda s, t: spark.createDataFrame([("s", s), ("t", t)], "source string, weight double")
    assert won() == {"g": ("film", "extended"), "h": ("film", "core")}  # the latest outweighs all earlier ones
    assert won(trust=trust(1000.0, 0.001))["g"] == ("film", "extended")  # whatever the trusts
    assert won(half_life_days=20.0)["g"] == ("film", "extended")  # 2 * 0.5 ** (59 / 20) < 1
    assert won(half_life_days=200.0)["g"] == ("art", "core")  # 2 * 0.5 ** (59 / 200) > 1
    assert won(half_life_days=20.0, trust=trust(5.0, 1.0))["g"] == ("art", "core")  # trust overturns recency
    assert won(half_life_days=20.0)["h"] == ("film", "core")  # a tie goes to the latest record


def brute(rows, lenient=False):
    same = lambda a, b: A.same_title(a.split(), b.split(), lenient)
    return {(a, b) for a, g, x in rows for b, h, y in rows if a < b and g == h and same(x, y)}


def verified(spark, rows, **options):
    text = {k: t.split() for k, _, t in rows}
    pairs = {(r.a, r.b) for r in hashforest.near_pairs(spark.createDataFrame(rows, "k long, g string, t string"), "g", "t", "k", **options).collect()}
    return {(a, b) for a, b in pairs if A.same_title(text[a], text[b], options.get("lenient", False))}


@pytest.mark.parametrize("options", [{}, {"bucket": 2}, {"lenient": True}])
def test_near_pairs_equal_brute_force_on_a_hot_source(spark, options):
    rng = random.Random(7)
    common = ["the", "quiet", "lens", "echo", "room", "notes", "studio", "visit", "of", "2026", "5", "6"]
    slip = lambda w: (w[:2] + w[3:], w[:1] + "q" + w[1:], w[:1] + w[2] + w[1] + w[3:], w[:-1] + "x")[rng.randrange(4)]
    rows = []
    for i in range(250):
        name = "".join(rng.choice("bdklmnrst") + rng.choice("aiou") for _ in range(3))
        words = rng.sample(common, rng.randrange(1, 6)) + [name] * (i % 5 > 0)
        rng.shuffle(words)
        edited = [slip(w) if w == name or (len(w) > 3 and rng.random() < 0.2 and not w.isdigit()) else w for w in words] + rng.sample(common[:9], rng.randrange(3))
        rows += [(2 * i, "hot" if i % 9 else "z", " ".join(words)), (2 * i + 1, "hot" if i % 9 else "z", " ".join(edited))]
    want = brute(rows, options.get("lenient", False))
    assert verified(spark, rows, **options) == want and len(want) > 200


def test_a_slip_in_the_only_rare_word_is_found_in_a_full_source(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5)) for _ in range(60)]
    rows = [rec(i + 1, f"Studio visit with the {n}", f"{U}{i}") for i, n in enumerate(names)] + [rec(999, f"Studio visit with the {names[30][:-1]}", "https://q.example/other")]
    assert {tuple(r) for r in history.repeats(spark.createDataFrame(rows, SIGNALS)).collect()} == {(31, 999)}


def test_a_crowded_page_is_compared_as_loosely_as_others(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5))
    titles = [" ".join(word() for _ in range(6)) for _ in range(A.PAGE_TITLES + 10)]
    edited = " ".join([*titles[7].split()[:4], word(), word()])
    rows = [rec(i + 1, t, U + "hot") for i, t in enumerate([*titles, edited])]
    assert {tuple(r) for r in history.repeats(spark.createDataFrame(rows, SIGNALS)).collect()} == {(8, len(rows))}


@pytest.mark.parametrize("most", [A.CROWDED_PAIRS, 0])
def test_few_titles_of_crowded_pages_are_compared_without_a_forest(spark, monkeypatch, most):
    monkeypatch.setattr(A, "CROWDED_PAIRS", most)
    made, add = [], HashForest.add
    monkeypatch.setattr(HashForest, "add", lambda f, *x: made.append(f.lenient) or add(f, *x))
    titles = [f"{a}bo{b}du quiet {b}ke{a}ri room" for a in "bdfgklmn" for b in "prstvzbd"]
    assert len(titles) > A.PAGE_TITLES
    rows = [rec(i + 1, t, U + "hot") for i, t in enumerate([*titles, "bbopdu quiet lodami vazuro"])]
    assert (1, len(rows)) in {tuple(r) for r in history.repeats(spark.createDataFrame(rows, SIGNALS)).collect()}
    assert sorted(made) == ([False] if most else [False, True])


def test_steps_together_write_within_their_scratch(spark):
    met = threading.Barrier(2, timeout=60)  # broken if one step waits for the other

    def step():
        met.wait()
        return runtime.persisted(spark.range(3), "together")

    left = lambda: {p.name for p in Path(runtime.shared_dir(spark).removeprefix("file:")).iterdir() if p.name.startswith("together-")}
    with runtime.scratch(spark):
        assert [df.count() for df in runtime.together(step, step)] == [3, 3] and len(left()) == 2
    assert not left()


@pytest.mark.parametrize("rows", [hashforest.runtime.BROADCAST_ROWS, 0])
def test_pairs_and_keys_that_are_not_sent_out_are_shuffled(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", rows)
    signals = spark.createDataFrame([rec(1, "Studio visit with Gipaleza", U + "a", run="1"), rec(2, "Quiet rooms of Viwado", U + "b", run="1"), rec(3, "Studio vist with Gipaleza", U + "c", run="2"), rec(4, None, U + "b", run="3")], SIGNALS)
    got = {tuple(r) for r in history.newest_last(history.History(spark, str(tmp_path / "h")), signals).collect()}
    assert got == {(1, 3), (2, 4)}


def test_recurring_values_of_record_keys_are_worked_out_once():
    for f in (A.publisher_of, A._name_words, A._single):
        f.cache_clear()
    for _ in range(3):
        assert A.title_words("Bookkeeping &amp; <b>Caf\u00e9</b> 0011 | Caf\u00e9 Nuun", "Caf\u00e9 Nuun") == ["bokeping", "cafe", "0011"]
        assert A.publisher_of("Caf\u00e9 Nuun", "x.example") == "cafenuun"
    assert A.publisher_of.cache_info().misses == A._name_words.cache_info().misses == 1
    assert A._single.cache_info().misses == 3
    pages = {"x.com//amp//a": "x.com/a", "x.com/mobile/": "x.com", "x.com/ampx/b": "x.com/ampx/b", "http://x.com/amp/amp/b?B=2&utm_x=1": "x.com/amp/b?b=2"}
    assert {u: A.page_of(u)[0] for u in pages} == pages


def test_plain_urls_need_no_parsing(monkeypatch):
    parsed, split = [], A.urlsplit
    monkeypatch.setattr(A, "urlsplit", lambda url: parsed.append(url) or split(url))
    urls = ["https://www.x.example/a/b-c_1", "http://m.x.example/2025/06/a", "https://x.example/a/amp", "https://x.example/amp/a", "https://x.example/ampx/a", "https://x.example/mobile/a/", "https://x.example/A", "https://x.example/a?b=1"]
    pages = [A.page_of(u) for u in urls]
    assert parsed == [urls[2], urls[3], *urls[5:]]
    assert [A.page_of(f" {u}") for u in urls] == pages  # a blank has them parsed


def test_row_ids_beside_a_null_keep_all_digits(spark):
    rows = spark.createDataFrame([(2**60 + 1, None, "S", "A title", "https://x.example/a"), (None, "i", None, None, None)], "row_id long, id string, source string, title string, url string").coalesce(1)
    assert {(r.row_id, r.page, r.words) for r in A.record_keys(rows).collect()} == {(2**60 + 1, "x.example/a", "a title"), (None, None, "")}
