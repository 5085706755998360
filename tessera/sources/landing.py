"""Rows out of pages and pulls: links, articles, capped and filtered pulls, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.nested import worked_out
from tessera.functions.text import CITY_WORDS, contains_any, intro_paragraphs, link_targets


def discovered_links(pages: DataFrame, html: str, pattern: str, name: str = "found") -> DataFrame:
    """Distinct values of the pattern's first group over all link targets, ascending."""
    targets = pages.select(F.explode(link_targets(F.col(html))).alias("_href"))
    values = targets.select(F.regexp_extract("_href", pattern, 1).alias(name)).filter(F.col(name) != "")
    return values.distinct().orderBy(name)


def articles_from_pages(pages: DataFrame, html: str, words=CITY_WORDS) -> DataFrame:
    """Intro paragraphs of each page and what became of it.

    ``status`` is "error" without paragraphs, "wrong_location" when none of the words
    occurs in the text, and otherwise "ok".
    """
    found = pages.withColumn("intro_paragraphs", worked_out(intro_paragraphs(F.col(html)))).drop(html)
    text = found.withColumn("intro_text", F.array_join("intro_paragraphs", "\n\n"))
    return text.select(
        "*",
        F.size("intro_paragraphs").alias("paragraph_count"),
        F.length("intro_text").alias("char_count"),
        F.when(F.size("intro_paragraphs") == 0, "error")
        .when(~contains_any(F.col("intro_text"), words), "wrong_location")
        .otherwise("ok")
        .alias("status"),
    )


def accepted(articles: DataFrame) -> DataFrame:
    """The articles that are stored: those whose status is "ok"."""
    return articles.filter(F.col("status") == "ok")


def prefix_and_range(df: DataFrame, text: str, prefix: str, when: str, start, end, columns: list[str]) -> DataFrame:
    """Rows whose text starts with the prefix within a closed time range; reaches the file scan."""
    return df.filter(F.col(text).startswith(prefix) & F.col(when).between(start, end)).select(*columns)


def capped_pull(df: DataFrame, order: list[str], cap: int = 0) -> DataFrame:
    """The first ``cap`` rows in order; 0 means all rows."""
    ordered = df.orderBy(*order)
    return ordered.limit(cap) if cap else ordered


def coverage_changed(wanted: DataFrame, stored_start, stored_end) -> DataFrame:
    """One row saying whether a stored daily source covers another range than is wanted."""
    same = F.col("start_date").eqNullSafe(F.lit(stored_start).cast("date")) & F.col("end_date").eqNullSafe(
        F.lit(stored_end).cast("date")
    )
    return wanted.withColumn("refetch", ~same)
