import json

import pytest

from corpusloom.operators import schema_drift as D

RAW = "record_id long, feed string, file_no int, file_name string, payload string, readable string"


def feed(name, files):
    rows = []
    for no, records in files.items():
        for r in records:
            rows.append((len(rows) + 1, name, no, f"{name}_{no}", r if isinstance(r, str) or r is None else json.dumps(r), None))
    return rows


def changed(spark, rows):
    return {tuple(r) for r in D.changes(spark.createDataFrame(rows, RAW).drop("readable")).collect()}


TIERS = [{"id": f"x{i}", "tier": t, "n": i} for i, t in enumerate(["core", "extended", "core", "core"])]


def test_changes(spark):
    graded = [{"id": r["id"], "meta": {"grade": r["tier"]}, "n": r["n"]} for r in TIERS]
    texts = [{**g, "n": str(g["n"]), "lang": "en"} for g in graded]
    rows = feed("f", {1: TIERS, 2: graded, 3: texts, 5: [{"id": "q"}, "{broken", None, "[1]"]})
    assert changed(spark, rows) == {
        ("f", 2, "renamed", "tier", "meta.grade"),
        ("f", 3, "retyped", "n", ""),
        ("f", 3, "added", "lang", ""),
        ("f", 5, "removed", "meta.grade", ""),
        ("f", 5, "removed", "n", ""),
        ("f", 5, "removed", "lang", ""),
    }


def test_other_values_are_no_rename(spark):
    rows = feed("f", {1: TIERS, 2: [{"id": "a", "flag": True, "n": 1}, {"id": "b", "flag": False, "n": 2}]})
    assert changed(spark, rows) == {("f", 2, "removed", "tier", ""), ("f", 2, "added", "flag", "")}


def test_names_side_by_side_are_never_matched(spark):
    both = feed("g", {1: [{"tier": "core", "grade": "core"}, {"tier": "extended", "grade": "core"}]})
    rows = feed("f", {1: TIERS, 2: [{"id": "a", "grade": "core", "n": 1}, {"id": "b", "grade": "extended", "n": 3}]})
    assert ("f", 2, "removed", "tier", "") in changed(spark, rows + both)


def test_majority_type_and_nulls(spark):
    rows = feed("f", {1: [{"a": 1}, {"a": 2}, {"a": "x"}, {"b": None}], 2: [{"a": 3, "b": "t"}]})
    assert changed(spark, rows) == set()


def test_unreadable_file_has_no_fields(spark):
    assert changed(spark, feed("f", {1: [{"a": 1}], 2: ["{"]})) == {("f", 2, "removed", "a", "")}


def test_nothing(spark):
    assert changed(spark, []) == set()


def test_consistent_table(spark):
    graded = [{"id": r["id"], "grade": r["tier"], "n": [1, None]} for r in TIERS[:3]]
    raw = spark.createDataFrame(feed("f", {1: TIERS, 2: graded, 3: ["{"]}), RAW)  # with a column of a name that clashes
    got = D.consistent_table(raw)
    assert got.columns == ["record_id", "feed", "file_no", "file_name", "readable", "f_grade", "f_id", "f_n", "rejects"]  # a tie: the first by name
    rows = got.orderBy("record_id").collect()
    assert [r.f_grade for r in rows] == ["core", "extended", "core", "core", "core", "extended", "core", None]
    assert rows[0].f_n == 0.0 and rows[0].rejects == {} and not rows[-1].readable  # mostly numbers
    assert rows[4].f_n is None and rows[4].rejects == {"f_n": "[1, null]"}


@pytest.mark.parametrize(
    ("value", "kind", "cast"),
    [(True, "string", "true"), ("12.5", "number", 12.5), (True, "number", None), ("x", "number", None), ("nan", "number", None), (" TRUE ", "boolean", True), (1, "boolean", None), ("a", "array", ["a"]), ([1, None], "array", ["1", None]), (None, "number", None)],
)
def test_values_are_cast_or_kept_apart(value, kind, cast):
    got, unfit = D.cast_value(value, kind)
    assert got == cast and unfit == (cast is None and value is not None)
