import io
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.__main__ import main
from corpusloom.functions import vectors as V
from corpusloom.operators import curation as K
from corpusloom.operators import embedding as E
from corpusloom.operators import worklist as W
from corpusloom.sources import signals as S
from corpusloom.sources import sinks


def test_a_scrape_batch_caps_stops_and_keeps_its_ledger(spark, tmp_path):
    def pages(url):
        if url.endswith("gone"):
            return 404, "text/html", "gone"
        n = int(url.rpartition("-")[2])
        return 200, "text/html", "<title>T</title><article><p>" + "Words of the page. " * 40 + "</p>" + "".join(f"<img src='/p{i}.jpg'>" for i in range(n)) + "</article>"

    ledger = str(tmp_path / "ledger")
    work = spark.createDataFrame([(i, f"https://x.example/a{i}-20") for i in range(1, 6)] + [(6, "https://x.example/a1-20"), (0, "https://x.example/gone"), (7, None)], "ord long, url string")
    articles, images = K.scrape_batch(work, ledger, pages, cap=15, target=45)
    got = {r.ord: (r.images_found, r.images_kept, r.fetch_method) for r in articles.collect()}
    assert got == {0: (0, 0, "failed"), 1: (20, 15, "static"), 2: (20, 15, "static"), 3: (20, 15, "static")}
    assert images.count() == 45
    again, _ = K.scrape_batch(work, ledger, pages, cap=15, target=45)
    assert sorted(r.ord for r in again.collect()) == [4, 5]
    forced, _ = K.scrape_batch(work, ledger, pages, cap=0, target=0, force=True)
    assert forced.count() == 6 and {r.images_kept for r in forced.collect()} == {0, 20}
    assert K.scrape_batch(work.limit(0), ledger, pages)[0].count() == 0


def test_each_text_is_encoded_once_ever(spark, tmp_path):
    cache, log = str(tmp_path / "cache"), str(tmp_path / "log")
    inner = E.hash_encoder(8)

    def encode(texts):
        with open(log, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return inner(texts)

    df = spark.createDataFrame([(i, f"title {i % 7}", None if i % 2 else "") for i in range(20)], "ord long, title string, summary string")
    made, about = E.embedded(df, cache, encode, dims=4)
    rows = made.withColumn("v", V.decode_bytes(F.col("vec"))).collect()
    assert len(rows) == 20 and {len(r.v) for r in rows} == {4} and max(abs(x) for r in rows for x in r.v) == 127
    assert len(open(log).readlines()) == 7 and about["dim"] == 4 and about["count"] == 20
    more, _ = E.embedded(df.union(spark.createDataFrame([(99, "new", "")], df.schema)), cache, encode, dims=4)
    assert more.count() == 21 and len(open(log).readlines()) == 8
    assert E.embedded(df, cache, None, dims=4)[0].count() == 20  # without an encoder the cached ones
    assert E.embedded(df, str(tmp_path / "none"), None)[0].count() == 0 and E.embedded(df.limit(0), cache, encode)[0].count() == 0
    with pytest.raises(ValueError):
        E.backfilled(df, cache, None)


def test_ledgers_add_only_new_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", "static", 1), ("b", "static", 2), ("a", "static", 1)], S.LEDGER)
    assert sinks.add_rows(df, str(tmp_path / "l"), "url").count() == 2
    assert sinks.add_rows(df, str(tmp_path / "l"), "url").count() == 0 and spark.read.parquet(str(tmp_path / "l")).count() == 2


def test_a_failed_question_costs_nothing(spark):
    def ask(name, url):
        if url is None:
            raise ValueError
        return "[]", 10, 2

    got = K.harvested(spark.createDataFrame([("a", "u"), ("b", None)], "name string, base_url string"), ask)
    assert K.token_usage(got).first() == (10, 2, 1)


def test_running_sums_of_a_hot_group(spark):
    df = spark.createDataFrame([("hot" if i % 3 else None, i, i % 5) for i in range(500)], "g string, i long, n long")
    got = W.running_before(df, "g", ["i"], F.col("n"), "b").collect()
    sums = {}
    for r in sorted(got, key=lambda r: r.i):
        assert r.b == sums.get(r.g, 0)
        sums[r.g] = r.b + r.n
    assert len(got) == 500


def test_shortened(spark):
    long = "word " * 60
    df = spark.createDataFrame([(1, " a \n b "), (2, long), (3, None), (4, "x" * 300), (5, "y" * 214 + " z" * 9)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", K.shortened(F.col("t")).alias("s")).collect()}
    assert got[1] == "a b" and got[3] == "" and got[4] == "[...]" and got[5] == "y" * 214 + " [...]"
    assert got[2] == " ".join(["word"] * 43) + " [...]"


def test_command_line(spark, sf, tmp_path):
    out = io.StringIO()
    assert main(["search", f"{sf}/corpus.parquet", "garden", "memory", "--limit", "3", "--json"], spark, out) == 0
    hits = [json.loads(x) for x in out.getvalue().splitlines()]
    assert 0 < len(hits) <= 3 and "title" in hits[0]
    text = io.StringIO()
    assert main(["search", f"{sf}/corpus.parquet", "garden", "memory", "--limit", "3", "--full"], spark, text) == 0 and hits[0]["title"] in text.getvalue()
    assert main(["search", f"{sf}/corpus.parquet", "the"], spark, text) == 1
    assert main(["search", f"{sf}/corpus.parquet", "--browse"], spark, text) == 0 and "category\t" in text.getvalue()
    (tmp_path / "tagged_a.json").write_text('{"tagging_date": "2026-01-01", "signals": [{"id": "1", "title": "t", "url": "u"}, {"id": "2", "title": "T", "url": "u/"}]}')
    assert main(["merge", str(tmp_path / "tagged_*.json"), str(tmp_path / "out")], spark, text) == 0
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_code_files_the_later_file_counts(spark, tmp_path):
    (tmp_path / "codes_a.json").write_text('{"need": "N", "codes": [{"id": "old"}]}')
    (tmp_path / "codes_b.json").write_text('{"need": "N", "codes": [{"id": "new", "status": "emergent"}]}')
    (tmp_path / "codes_c.json").write_text('{"need": "N", "codes": []}')
    (tmp_path / "codes_d.json").write_text("{broken")
    assert [(r.need, r.codes[0].id) for r in S.scan_codes(spark, str(tmp_path / "codes_*.json")).collect()] == [("N", "new")]


def test_side_pages(tmp_path):
    (tmp_path / "a.html").write_text("x")
    assert sinks.copy_pages(["a.html", "b.html"], str(tmp_path), str(tmp_path / "site")) == ["a.html"]
