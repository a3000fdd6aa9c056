import math
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import boilerplate as B
from corpusloom.llm import distinctive, leakage, quality, queries, residue, tokenizing

# --- distinctive terms ---


def test_ppmi_against_counts(spark):
    rows = [(1, "Stone stone", "stone root"), (2, None, "Stone, root! root"), (3, "", None), (4, "leaf leaf leaf ab", "leaf")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "ord long, title string, summary string, term string")
    got = {(r.ord, r.term): (r.tf, r.df, r.ppmi) for r in distinctive.ppmi(df, "ord", ["title", "summary"]).collect()}
    docs = {1: Counter(stone=3, root=1), 2: Counter(stone=1, root=2), 4: Counter(leaf=4)}
    n, z = 11, sum(sum(d.values()) ** 0.75 for d in docs.values())
    for o, d in docs.items():
        for t, tf in d.items():
            nt = sum(x[t] for x in docs.values())
            want = max(0, math.log2((tf / n) / ((nt / n) * (sum(d.values()) ** 0.75 / z))))
            assert got[o, t][:2] == (tf, sum(t in x for x in docs.values())) and math.isclose(got[o, t][2], want, abs_tol=1e-9)
    assert len(got) == 5
    assert distinctive.ppmi(df.limit(0), "ord", ["title", "summary"]).count() == 0


def test_found_terms_are_counted_and_nothing_is_scored(spark, tmp_path):
    rows = [(1, "rare " * 3, " ".join(f"other{i}" for i in range(400))), (2, "Rare rare", "RARE"), (3, "own own own", None), (4, None, "")]
    spark.createDataFrame(rows, "ord long, title string, summary string").write.parquet(str(tmp_path / "corpus.parquet"))
    found = queries.p6_found(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == [(1, "rare"), (2, "rare")]
    scores = {(r.ord, r.term): r.ppmi for r in queries.p6_scores(spark, str(tmp_path)).collect()}
    assert scores[1, "rare"] == 0 < scores[2, "rare"]  # a score of nought keeps its row
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "log2" not in plan and "pow" not in plan and "cross" not in plan


def test_found_terms_come_from_the_scored_pairs(spark, tmp_path):
    rows = [(1, "rare " * 3, " ".join(f"other{i}" for i in range(400))), (2, "Rare rare", "RARE"), (3, "own own own", None), (None, "rare rare rare", "")]
    spark.createDataFrame(rows, "ord long, title string, summary string").write.parquet(str(tmp_path / "corpus.parquet"))
    found = queries.p6_found(spark, str(tmp_path))
    assert {tuple(r) for r in found.collect()} == {(1, "rare"), (2, "rare"), (None, "rare")}
    scored = {(r.ord, r.term): r for r in spark.read.parquet(*found.inputFiles()).collect()}
    scores = {(r.ord, r.term): (r.tf, r.df, r.ppmi) for r in queries.p6_scores(spark, str(tmp_path)).collect()}
    assert {k: (r.tf, r.df, round(r.ppmi, 6)) for k, r in scored.items()} == {k: scores[k] for k in scored}
    assert len(scored) == 3 and scored[1, "rare"].ppmi == 0 < scored[2, "rare"].ppmi


# --- tokenizer ---


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = tokenizing.load_ranks("byte_bpe_50k")
    return ranks, tiktoken.Encoding("own", pat_str=tokenizing.piece_pattern(), mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_the_library(reference):
    ranks, own = reference
    words = {w: tokenizing.merge_exactly(w, ranks) for w in (b" the", b"the", b" then", b"other", b" other", b"")if w}
    for lexicon in (None, tokenizing.Transducer.compile(words)):
        enc = tokenizing.Encoder(ranks, tokenizing.piece_pattern(), lexicon)
        rng = random.Random(5)
        texts = ["".join(rng.choice(["a", " ", "\n", "  ", "'s", "the", " other", "7", ".", "\t", "é", "東", "👩🏽‍🎨", " "]) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
        texts += ["x" * 2000, "<|endoftext|>", "  lead", "trail  ", "a" * 600 + " b"]
        assert all(enc(t) == own.encode_ordinary(t) for t in texts)


def test_transducer_is_exact_and_shares_suffixes(tmp_path):
    words = {f"{a}{b}ing".encode(): [i, i + 1] for i, (a, b) in enumerate((a, b) for a in "abcdef" for b in "xyz")}
    t = tokenizing.Transducer.compile(words)
    t.save(str(tmp_path / "lexicon"))
    for m in (t, tokenizing.Transducer.mapped(str(tmp_path / "lexicon"))):
        assert all(m.get(w) == ids for w, ids in words.items())
        assert m.get(b"axin") is None and m.get(b"axings") is None and m.get(b"") is None
    assert len(t.first) - 1 == 6 and len(t) == 18  # the states of a minimal automaton


def test_encode(spark):
    df = spark.createDataFrame([(1, "hello world", 5), (2, "", 5), (3, None, 5), (4, "hello world", 5)], "doc_id long, text string, other int")
    got = {r.doc_id: r.ids for r in tokenizing.encode(df).collect()}
    assert got[2] == got[3] == [] and got[1] == got[4] and len(got[1]) == 2
    assert tokenizing.encode(df.limit(0)).count() == 0


def test_encode_without_a_mounted_folder(spark, monkeypatch):
    df = spark.createDataFrame([(1, "The echo of the lens, the lens."), (2, None), (3, "")], "doc_id long, text string")
    want = {r.doc_id: r.ids for r in tokenizing.encode(df).collect()}
    monkeypatch.setattr(tokenizing, "_as_local", lambda path: None)
    assert {r.doc_id: r.ids for r in tokenizing.encode(df).collect()} == want and want[2] == want[3] == []


# --- leaked passages ---

VOCABULARY = [f"w{i}" for i in range(400)]


def contains(doc, item):
    a, b = leakage.words(doc), leakage.words(item)
    return any(sum(x != y for x, y in zip(a[i : i + 20], b[j : j + 20], strict=True)) <= 2 for i in range(len(a) - 19) for j in range(len(b) - 19))


def test_passages_against_brute_force():
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(15, 60)))) for i in range(12)]
    index = leakage.ItemIndex([(i, leakage.words(t)) for i, t in items])
    docs = []
    for _ in range(150):
        w = rng.choice(items)[1].split()
        k = rng.randint(16, 30)
        part = w[rng.randint(0, 5) :][:k]
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = "other"
        docs.append(" ".join([*rng.choices(VOCABULARY, k=rng.randint(0, 30)), *part, *rng.choices(VOCABULARY, k=rng.randint(0, 30))]))
    got = set(index.find(docs))
    assert got == {(d, i) for d, t in enumerate(docs) for i, x in items if contains(t, x)}
    assert any(got) and len({d for d, _ in got}) < len(docs)


def test_words_ignore_marks():
    assert leakage.words("L'É­té [sic] <b>vaut</b>&nbsp;(1) kit-\nchen ﬁn") == ["l", "ete", "vaut", "kitchen", "fin"]
    assert leakage.words(None) == [] == leakage.words("")


def test_leaks(spark):
    text = " ".join(VOCABULARY[:40])
    docs = spark.createDataFrame([(1, "x " + text.upper(), 1), (2, text[:50], 1), (3, None, 1), (4, "", 1), (5, "x " + text, 1)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, text), (8, None), (9, "too short")], "item_id long, text string")
    assert {tuple(r) for r in leakage.leaks(docs, items).collect()} == {(1, 7), (5, 7)}
    assert leakage.leaks(docs, items.limit(0)).count() == 0 == leakage.leaks(docs.limit(0), items).count()


# --- text types ---

PROSE = "There is a quiet lens in the room that nobody has seen, and it opens the old house to all of us. Who would have thought that it is there?"
TABLE = "\n".join(f"Cowu\t{i * 37}\t{i}%" for i in range(30))
LISTED = "\n".join(f"• lens {i}" for i in range(30))
JUNK = "xa#@*xp@5m9w219 u#5 ^e0a 7p71a%2_ 6^^ q @9xopmbv_=#031#j&@m v^6 e+xp " * 4


def test_types(spark):
    rows = [(1, PROSE), (2, TABLE), (3, LISTED), (4, JUNK), (5, None), (6, ""), (7, " \n"), (8, PROSE.lower()), (9, "There is a lens in the\nroom that nobody has\nseen, and it opens the\nhouse."), (10, PROSE * 2000)]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, prose double")
    got = {r.doc_id: r for r in quality.text_types(df).collect()}
    assert sorted(i for i in got if got[i].text_type == "prose") == [1, 8, 9, 10]
    assert {i for i in got if got[i].prose is not None and got[i].prose < 0.5} == {2, 3, 4}
    assert all(got[i].text_type is None and got[i].n_words == 0 and got[i].mean_word_length is None for i in (5, 6, 7))
    assert got[1].n_lines == 1 and got[1].ended_line_share == 1.0
    assert quality.text_types(df.limit(0)).count() == 0


# --- furniture ---


def name(i):
    return "Na" + chr(97 + i // 10) * 2 + chr(97 + i % 10) + "o"


def page(i, site="Daf Review"):
    text = f"Home | Art | Film | Contact\n\nThe lens of {name(i)}\n{PROSE} {name(i)} was there.\nSponsored content\n“{name(i)} {PROSE}”\nMost read\nThe root of {name(i + 40)}\nNotes on {name(i + 50)} and the sea\n© 2024 {site}. All rights reserved."
    return (i, site, f"https://d.example/{i}", f"The lens of {name(i)}", text)


def test_furniture(spark):
    rows = [page(i) for i in range(1, 21)] + [page(i, "Ces Letters") for i in range(21, 41)] + [(90, None, None, None, None), (91, "X", None, "", "  \n"), (92, None, None, None, PROSE)]
    articles = spark.createDataFrame(rows, "article_id long, site string, url string, title string, text string")
    images = spark.createDataFrame([(1, 1, "Sponsored content"), (2, 1, PROSE[:60]), (3, 1, None), (4, 90, ""), (5, 1, f"The lens of {name(1)}"), (6, 2, "Home | Art | Film | Contact Sponsored content")], "image_id long, article_id long, context string")
    got = {tuple(r) for r in B.furniture(articles, images).collect()}
    assert {x for x in got if x[:2] == ("text", 3)} == {("text", 3, i) for i in (0, 4, 6, 7, 8, 9)}
    assert {x[1] for x in got if x[0] == "context"} == {1, 6}
    assert not any(x[1] >= 90 for x in got)
    main = {r.article_id: r.main_text for r in B.main_text(articles).collect()}
    assert main[90] is None and "Sponsored" not in main[1] and PROSE in main[1]
    assert B.furniture(articles.limit(0), images.limit(0)).count() == 0


# --- residue ---


@pytest.mark.parametrize(
    ("sentence", "found"),
    [
        ("It took days before {{title}} quietly opens.", True),
        ("It opens with “Dear {{first_name}}”, curly brackets and all, read aloud.", False),
        ("[INSERT QUOTE HERE]", True),
        ("Posted on %%DATE%%", True),
        ("&lt;placeholder&gt;", True),
        ("each silence NaN stitches", True),
        ("The play calls its hero Undefined, and the chorus answers.", False),
        ("undefined", True),
        ("100% of 12 and $5", False),
    ],
)
def test_placeholders(sentence, found):
    assert residue.has_placeholder(sentence) is found


def test_residue(spark):
    errors = ["Please enable JavaScript to continue.", "403 Forbidden", "Sorry, we can't find that page."]
    rows = [(i, f"s{i % 9}", f"Title {i}", PROSE + f" And {i} more of it. She prints the words 'please enable JavaScript' on towels and sells them.", "static") for i in range(60)]
    rows += [(100 + i, f"s{i % 9}", None, errors[i % 3], "failed" if i % 2 else "static") for i in range(30)]
    rows += [(200, "s", None, None, None), (201, "s", None, "", "Static"), (202, "s", None, PROSE, "{{method}}"), (203, "s", None, PROSE, "undefined"), (204, None, None, PROSE + "\n“" + PROSE[:40] + " {{x}} and on.”", "static")]
    df = spark.createDataFrame(rows, "article_id long, site string, title string, text string, fetch_method string")
    assert {r.article_id for r in residue.residue(df).collect()} == set(range(100, 130)) | {202, 203, 204}
    assert residue.residue(df.limit(0)).count() == 0


def test_training_separates():
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 50, 8) + (1000 if i % 5 == 0 else 0)), float(i % 5 == 0), 1.0, i % 4 == 0) for i in range(400)]
    model = residue.train(rows)
    assert model.precision > 0.9 and model.recall > 0.9


@pytest.mark.parametrize(
    ("sentence", "message"),
    [
        ("404 people came to the opening.", False),
        ("Forbidden love is the theme of the novel.", False),
        ("Just a moment of silence opened the evening.", False),
        ("Nothing here is new, and that is the point.", False),
        ("This page requires patience.", False),
        ("404", True),
        ("Just a moment…", True),
        ("This page requires JavaScript.", True),
        ("500 – something went wrong on our side.", True),
    ],
)
def test_phrase_labels_need_a_whole_message(sentence, message):
    assert residue.begins_like_message(sentence) is message


def test_scores_decide_not_phrases():
    """A model without weights finds no message, whatever the phrase; a long sentence is read to its end."""
    blank = residue.Classifier(np.zeros(residue.DIMENSIONS), -2.0, 0.5, 1.0, 1.0, 0)
    assert not residue.Scorer(blank).is_message("403 Forbidden", frozenset())
    rows = [(residue.features(s, "title0"), y, 1.0, False) for s, y in [("access denied by the server", 1.0), ("403 forbidden", 1.0), *[(f"the garden {w} keeps its wall", 0.0) for w in "abcdef"]] for _ in range(9)]
    model = residue.train(rows)
    assert residue.Scorer(model).is_message("403 Forbidden", frozenset())
    long = " ".join(["the garden keeps its wall"] * 12)
    scorer = residue.Scorer(residue.Classifier(model.weights, model.bias, 0.2, 1.0, 1.0, 0))
    assert not scorer.is_message(long, frozenset()) and scorer.is_message(long + " access denied by the server access denied by the server access denied by the server access denied by the server", frozenset())


def test_the_gate_keeps_precision():
    held = [(0.95, True, 1.0), (0.8, True, 1.0), (0.75, True, 1.0), (0.7, False, 5.0), (0.6, True, 1.0)]
    threshold, precision, recall = residue.gate(held)
    assert (threshold, precision, recall) == (0.75, 1.0, 0.75)
    assert residue.gate([])[0] == 0.5


def test_a_long_notice_in_full_sentences_is_furniture_of_its_host_only(spark):
    notice = "This house keeps the records of its visitors for 12 months and gives them to no one, as it was agreed in the year in which the first of the two buildings was opened to all who live in the town and around it."
    rows = [(i, "s.example", f"https://s.example/{i}", f"Title {i}", f"{PROSE[: 60 + 7 * i]} the {'abcdefgh'[i] * 5} of it.\n{notice.replace('12', str(i))}") for i in range(8)]
    rows += [(100 + i, f"o{i}.example", None, None, f"{PROSE} Another {i}.\n{notice}") for i in range(3)]
    df = spark.createDataFrame(rows, "article_id long, site string, url string, title string, text string")
    assert len(notice) > B.LONG and B.is_prose(notice)
    assert {(r.row_id, r.line_no) for r in B.furniture(df).collect()} == {(i, 1) for i in range(8)}


def test_long_lines_are_judged_to_their_end():
    assert not B.is_prose("Index of the works, " + ", ".join(f"Plate{i}" for i in range(80)) + " and the rest.") and B.is_prose("It is the end of the day and " * 20 + "so.”")


def test_cue_words_are_looked_for_in_counted_paths_only(monkeypatch):
    monkeypatch.setattr(B, "CUES", None)
    assert B.page_paths("Related: A long walk\nIt is the end of the day and so on.", None) == {"related: a long walk": 1.0, "related: *": 1.0, "it is the end of the day and so on": 0.0}
    assert B.scores_of("La la THE que") == {"en": 1, "fr": 3, "de": 0, "es": 3}
