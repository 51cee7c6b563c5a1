"""Every registered query with the SQL text it is checked against."""

from __future__ import annotations

from tamizal.plans import access_queries, document_queries, quality_queries, relational_queries

QUERIES = {
    **relational_queries.QUERIES,
    **document_queries.QUERIES,
    **quality_queries.QUERIES,
    **access_queries.QUERIES,
}
