"""Session metadata from listing pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listing_rows(
    pages: DataFrame, page: str, html: str, row_pattern: str, fields: Mapping[str, str]
) -> DataFrame:
    """``(page, pos, <fields>)`` from page text; rows lacking any field are skipped.

    ``row_pattern`` and each field pattern hold one capture group.
    """
    rows = pages.select(
        page, F.posexplode(F.regexp_extract_all(html, F.lit(row_pattern), F.lit(1))).alias("pos", "_row")
    )
    found = rows.select(
        page,
        "pos",
        *[F.nullif(F.regexp_extract("_row", p, 1), F.lit("")).alias(name) for name, p in fields.items()],
    )
    return found.dropna(subset=list(fields))


def mentions(df: DataFrame, col: str, word: str = "Acta") -> DataFrame:
    """Rows whose listing text holds the search word."""
    return df.filter(F.col(col).contains(word))


def prefixed_id(raw_id: Column, prefix: str = "gaceta_") -> Column:
    return F.concat(F.lit(prefix), raw_id)


def unique_ids(rows: DataFrame, page: str, pos: str, raw_id: str, out: str = "session_id") -> DataFrame:
    """Prefixed id per row, unique on its page.

    In the order of ``pos``, a row whose id is taken gets `` (1)``, `` (2)`` and so on, up
    to the first that is free. The rows of one page, bounded by its text, are folded
    together.
    """
    others = [c for c in rows.columns if c != page]
    entry = F.struct(F.col(pos).alias("_at"), F.struct(*others).alias("_row"))
    pages = rows.groupBy(page).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))

    def free(taken: Column, raw: Column) -> Column:
        base = prefixed_id(raw)
        numbers = F.sequence(F.lit(1), F.size(taken) + 1)
        numbered = F.transform(numbers, lambda n: F.concat(base, F.lit(" ("), n.cast("string"), F.lit(")")))
        others_free = F.filter(numbered, lambda name: ~F.array_contains(taken, name))
        return F.when(F.array_contains(taken, base), F.get(others_free, F.lit(0))).otherwise(base)

    ids = F.aggregate(
        "_entries",
        F.array().cast("array<string>"),
        lambda taken, e: F.concat(taken, F.array(free(taken, e["_row"][raw_id]))),
    )
    named = pages.select(page, F.explode(F.arrays_zip(F.col("_entries"), ids.alias("_ids"))).alias("_n"))
    return named.select(page, *[F.col(f"_n._entries._row.{c}").alias(c) for c in others], F.col("_n._ids").alias(out))


def latest_rows(rows: DataFrame, key: str, page: str, pos: str, values: list[str]) -> DataFrame:
    """One row per key, the one from the last page (and last position) winning."""
    last = F.max_by(F.struct(*values), F.struct(page, pos)).alias("_v")
    return rows.groupBy(key).agg(last).select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def listing_chamber(label: Column) -> Column:
    return F.when(label.contains("Cámara"), "house").otherwise("senate")


def session_info(rows: DataFrame, page: str, pos: str) -> DataFrame:
    """``(session_id, date, chamber)`` from ``raw_id, date, chamber`` listing rows."""
    named = unique_ids(rows, page, pos, "raw_id")
    latest = latest_rows(named, "session_id", page, pos, ["date", "chamber"])
    return latest.withColumn("chamber", listing_chamber(F.col("chamber")))
