"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import glob
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from corpusloom import plans


def plain(v):
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def rows_of(rows):
    return sorted((tuple(plain(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_against_sql(spark, sf, duck, name):
    df = plans.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = duck.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({plans.SQL[name]})").fetchall()
    assert rows_of(df.select([f"`{c}`" for c in columns]).collect()) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_runs(spark, sf, name):
    assert plans.QUERIES[name](spark, sf).collect() is not None


def test_the_rest_stands_without_the_optional_subpackage(tmp_path):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = "import __spark_entry__ as e, corpusloom; print(corpusloom.__file__); assert set(e.oracle_sql()) <= set(e.queries()) and 'search_topk' in e.queries() and 'p8_ids' not in e.queries()"
    done = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0 and str(tmp_path) in done.stdout, done.stderr


def test_images_of_a_full_page_all_come_out(spark, tmp_path):
    from corpusloom.plans.scraping import extract_images

    spark.createDataFrame([(1, "https://q.example/a", "T", "x")], "article_id long, url string, title string, text string").write.parquet(str(tmp_path / "articles.parquet"))
    images = [(1, 4 * i + 1, f"https://q.example/pictures/n{i}.jpg", f"caption {i}", "", None) for i in range(1200)]
    spark.createDataFrame(images, "article_id long, image_id long, image_url string, caption string, alt string, context string").write.parquet(str(tmp_path / "article_images.parquet"))
    got = extract_images(spark, str(tmp_path)).collect()
    assert {r.image_url for r in got} == {r[2] for r in images} and sorted(r.seq for r in got) == list(range(1200))
