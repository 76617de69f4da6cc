"""Session text from decoded spans, and the cleaned session record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..session import stored
from .keywords import keyword_arrays
from .segments import headline_pairs


def _joined(position: str, piece: str) -> Column:
    """Concatenate the pieces of a group by position."""
    ordered = F.sort_array(F.collect_list(F.struct(position, piece)))
    return F.array_join(F.transform(ordered, lambda e: e[piece]), "")


def assemble_spans(spans: DataFrame) -> DataFrame:
    """``(doc, raw_text)`` from a span table, bold spans marked.

    A block without lines is a row whose ``line`` and ``text`` are null. Spans are
    joined up to page level in the partitioning of ``(doc, page)``, then one more
    shuffle of page strings completes the document.
    """
    bold = F.lower("font").contains("bold")
    marked = F.when(bold, F.concat(F.lit(K.BOLD_OPEN), "text", F.lit(K.BOLD_CLOSE))).otherwise(
        F.col("text")
    )
    pieces = spans.select(
        "doc", "page", "block", "line", "span", F.concat(marked, F.lit(" ")).alias("_s")
    )
    lines = (
        pieces.repartition("doc", "page")
        .groupBy("doc", "page", "block", "line")
        .agg(_joined("span", "_s").alias("_s"))
        .withColumn("_s", F.when(F.col("line").isNull(), "").otherwise(F.concat("_s", F.lit("\n"))))
    )
    blocks = lines.groupBy("doc", "page", "block").agg(
        F.concat(_joined("line", "_s"), F.lit("\n")).alias("_s")
    )
    pages = blocks.groupBy("doc", "page").agg(_joined("block", "_s").alias("_s"))
    return pages.groupBy("doc").agg(_joined("page", "_s").alias("raw_text"))


def with_session_info(df: DataFrame, text_col: str) -> DataFrame:
    """Add date, chamber and type found in the (cleaned) text."""
    text = F.col(text_col)
    return df.withColumns(
        {
            "date": X.session_date(text),
            "chamber": X.session_chamber(text),
            "type": X.session_type(text),
        }
    )


def session_records(
    documents: DataFrame,
    doc_id: str = "doc",
    raw_text: str = "raw_text",
    stop_words: list[str] | None = None,
    threshold: float = 0.1,
) -> DataFrame:
    """One record per document: info, texts, headline pairs, keywords per intervention.

    Cleaned texts and pairs are stored, so that every text is cleaned and split once.
    """
    cleaned = documents.select(
        F.col(doc_id).alias("session_id"),
        F.col(raw_text).alias("raw_text"),
        X.clean_raw_text(F.col(raw_text)).alias("clean_text"),
    )
    info = stored(with_session_info(cleaned, "clean_text"), "sessions")
    pairs = stored(headline_pairs(info.select("session_id", "clean_text"), "session_id", "clean_text"), "pairs")
    words = keyword_arrays(
        pairs, session="session_id", doc="pair", text="body", stop_words=stop_words, threshold=threshold
    )
    in_order = F.sort_array(F.collect_list(F.struct("pair", "headline", "body", "keywords")))
    per_session = (
        pairs.join(words.select("session_id", "pair", "keywords"), ["session_id", "pair"])
        .groupBy("session_id")
        .agg(in_order.alias("_rows"))
        .select(
            "session_id",
            F.transform("_rows", lambda r: F.struct(r["headline"], r["body"])).alias("pairs"),
            F.transform("_rows", lambda r: r["keywords"]).alias("keywords"),
        )
    )
    no_pairs = F.array().cast("array<struct<headline:string,body:string>>")
    no_words = F.array().cast("array<array<string>>")
    return info.join(per_session, "session_id", "left").select(
        "session_id",
        "date",
        "chamber",
        "type",
        "raw_text",
        "clean_text",
        F.coalesce("pairs", no_pairs).alias("pairs"),
        F.coalesce("keywords", no_words).alias("keywords"),
    )
