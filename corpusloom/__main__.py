"""Command line: search and browse a corpus, merge run files, draw needs' planes."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import query_terms
from corpusloom.operators import corpus as C
from corpusloom.operators import curation as K
from corpusloom.operators import search as R
from corpusloom.operators import worklist as W
from corpusloom.sources import signals as S
from corpusloom.sources import sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("search", help="rank records against free text")
    s.add_argument("corpus")
    s.add_argument("query", nargs="*")
    s.add_argument("--limit", type=int, default=25)
    s.add_argument("--full", action="store_true", help="also the notes")
    s.add_argument("--json", action="store_true", help="hits as JSON lines")
    s.add_argument("--browse", action="store_true", help="counts instead of hits")
    s.add_argument("--exclude-need", action="append", default=[])
    m = sub.add_parser("merge", help="merge run files into one corpus")
    m.add_argument("runs")
    m.add_argument("out")
    w = sub.add_parser("worklist", help="urls to scrape for a need")
    w.add_argument("corpus")
    w.add_argument("need")
    w.add_argument("--now", required=True)
    w.add_argument("--days", type=int)
    w.add_argument("--run")
    w.add_argument("--limit", type=int, default=60)
    return p


def shown(row, full: bool) -> str:
    """A hit as text."""
    head = f"[{row.score:5.1f}] {row.need or row.recommended_substrate or '?'}/{row.fit_confidence or '?'} {'→fwd' if row.forward_looking else '    '}  {row.category or '—':<12} {row.source} · {row.pub_date}  runs:{row.badge}"
    lines = [head, f"        {row.title}", f"        {row.short}"]
    if full:
        lines += [f"        {name}: {note}" for name, note in (("novelty", row.novelty_note), ("cross", row.cross_substrate_notes)) if note]
    return "\n".join([*lines, f"        {row.url}"])


def main(argv: list[str] | None = None, spark: SparkSession | None = None, out=sys.stdout) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusloom").getOrCreate()
    if args.command == "merge":
        runs = S.scan_runs(spark, args.runs).withColumn("row_id", F.xxhash64("file_name", "seq"))
        sinks.write_json(C.merge_corpus(runs), args.out, ["_first_seen", "source", "_first_key"])
        return 0
    corpus = spark.read.parquet(args.corpus)
    if args.command == "worklist":
        for r in W.select_worklist(corpus, args.need, args.now, args.days, args.run, args.limit).collect():  # at most the limit
            print(r.url, file=out)
        return 0
    if args.browse or not args.query:
        for column, default in (("category", "untagged"), ("need", "untagged"), ("recommended_substrate", None)):
            for r in R.browse(corpus, column, default).orderBy(F.desc("n"), column).collect():  # closed vocabularies
                print(f"{column}\t{r[0]}\t{r.n}", file=out)
        return 0
    text = " ".join(args.query)
    if not query_terms(text):
        print("no searchable terms", file=sys.stderr)
        return 1
    hits = R.search(corpus, text, args.limit, args.exclude_need)
    if args.json:
        for r in hits.select(sinks.as_json(*[c for c in corpus.columns if c != "vec"]).alias("j")).collect():  # at most the limit
            print(json.dumps(json.loads(r.j), ensure_ascii=False), file=out)
        return 0
    for r in hits.withColumn("badge", K.run_badge(F.col("_runs"))).withColumn("short", K.shortened(F.col("summary"))).collect():  # at most the limit
        print(shown(r, args.full) + "\n", file=out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
