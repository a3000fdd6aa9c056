"""Queries by name, each with the SQL that states the same, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# SQL of the text functions, for the statements beside the queries
def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def s_norm_url(x: str = "url") -> str:
    return rf"lower(regexp_replace({s_strip(f'coalesce({x}, {chr(39) * 2})')}, '/+$', ''))"


def s_norm_title(x: str = "title") -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def s_path(x: str) -> str:
    return rf"regexp_extract({x}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def s_date(x: str = "pub_date") -> str:
    raw = s_strip(f"replace(replace({x}, '(approx)', ''), '~', '')")
    return rf"coalesce(CASE WHEN regexp_matches({raw}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') THEN try_cast({raw} AS DATE) END, CASE WHEN regexp_matches({raw}, '^\d{{4}}-\d{{1,2}}$') THEN try_cast({raw} || '-15' AS DATE) END)"


def s_words(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9]+')"


def s_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
