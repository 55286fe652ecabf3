"""All queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.plans import artifacts, composition, context, drafts, gate, ingest, layout, matching, pages, reflowed, relations, rendering, reports, rules, scalars, scenes, script, selection, style, summaries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = scalars.QUERIES | relations.QUERIES | matching.QUERIES | script.QUERIES | selection.QUERIES | reports.QUERIES | rules.QUERIES | rendering.QUERIES | ingest.QUERIES | artifacts.QUERIES | composition.QUERIES | gate.QUERIES | context.QUERIES | pages.QUERIES | layout.QUERIES | reflowed.QUERIES | style.QUERIES | summaries.QUERIES | scenes.QUERIES | drafts.QUERIES
SQL: dict[str, str] = scalars.SQL | relations.SQL | matching.SQL | script.SQL | selection.SQL | reports.SQL | rules.SQL | rendering.SQL | ingest.SQL | artifacts.SQL | composition.SQL | gate.SQL | context.SQL | pages.SQL | layout.SQL | reflowed.SQL | style.SQL | summaries.SQL | scenes.SQL | drafts.SQL
FLAGSHIP = QUERIES["O01_context_package"]
