"""All registered queries of the library, by name."""

from __future__ import annotations

from . import agreement_queries, catalog, change_queries, column_queries, evaluation_queries, form_queries, gate_queries, metric_queries, model_queries, parsed_queries, report_queries, sample_queries, source_queries, stream_queries, text_queries, theme_queries  # noqa: F401


def queries() -> dict[str, catalog.Query]:
    return dict(catalog.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(catalog.SQL)
