"""Queries over the test tables; importing the modules registers them."""

from . import curation, ingest, planes, registry, retrieval, scraping  # noqa: F401

QUERIES, SQL = registry.QUERIES, registry.SQL
