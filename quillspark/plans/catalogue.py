"""All queries over the reference operators, by name, with the SQL they are checked against."""

from __future__ import annotations

from quillspark.plans import archives, conversations, events, indexes, numbers, records, services, stores, tables, texts

QUERIES: dict = {}
SQL: dict = {}
for _module in (events, archives, texts, conversations, numbers, stores, records, indexes, services, tables):
    QUERIES |= _module.book.queries
    SQL |= _module.book.sql
