"""Headline and speech pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import scale
from ..functions import text as X
from ..session import stored

#: Positions per chunk of the ordered scan.
CHUNK = 10_000
#: A text segment shorter than this belongs to the headline.
MIN_BODY = 5


def segment_events(df: DataFrame, session: str, text_col: str) -> DataFrame:
    """``(session, pos, kind, part)`` per segment, rejected headlines left out.

    Kinds: ``H`` accepted headline, ``T`` speech text, ``S`` text too short to be one.
    """
    segments = df.select(session, F.posexplode(X.split_bold(F.col(text_col))).alias("pos", "_segment"))
    bold = X.is_bold(F.col("_segment"))
    part = F.when(bold, X.headline_text(F.col("_segment"))).otherwise(X.strip(F.col("_segment")))
    kind = (
        F.when(F.col("_bold") & X.is_headline(F.col("part")), "H")
        .when(F.col("_bold"), None)
        .when(F.length("part") >= MIN_BODY, "T")
        .otherwise("S")
    )
    return (
        segments.select(session, "pos", bold.alias("_bold"), part.alias("part"))
        .select(session, "pos", kind.alias("kind"), "part")
        .filter(F.col("kind").isNotNull())
    )


def pair_events(events: DataFrame, session: str, chunk: int = CHUNK) -> DataFrame:
    """``(session, pair, headline, body)`` from ordered events.

    A pair opens at a headline that follows speech text (or at the first headline)
    and takes in everything up to the next opening. The scan runs over chunks of
    positions: each chunk is summed up in one row, the summaries are scanned per
    session, and the carried state is joined back. A session of any length is
    therefore spread over its chunks.
    """
    key = [session, "_chunk"]
    events = events.withColumn("_chunk", F.floor(F.col("pos") / chunk))
    in_chunk = Window.partitionBy(*key).orderBy("pos")
    earlier = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    heard = F.when(F.col("kind") != "S", F.col("kind"))
    is_head = F.col("kind") == "H"
    scanned = events.withColumn("_prev", F.last(heard, ignorenulls=True).over(earlier)).withColumns(
        {
            "_opens": (is_head & F.coalesce(F.col("_prev") == "T", F.lit(False))).cast("int"),
            # The first headline of a chunk opens a pair only if the chunk before allows it.
            "_asks": (is_head & F.col("_prev").isNull()).cast("int"),
        }
    )
    summary = scanned.groupBy(*key).agg(
        F.max_by("kind", F.when(F.col("kind") != "S", F.col("pos"))).alias("_last"),
        F.max(F.col("kind") != "S").alias("_any"),
        F.sum("_opens").alias("_sure"),
        F.max("_asks").alias("_ask"),
    )
    by_chunk = Window.partitionBy(session).orderBy("_chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn(
            "_carry", F.last(F.when(F.col("_any"), F.col("_last")), ignorenulls=True).over(before)
        )
        .withColumn("_granted", F.when(F.coalesce(F.col("_carry"), F.lit("T")) == "H", 0).otherwise(1))
        .withColumn(
            "_base",
            F.coalesce(F.sum(F.col("_sure") + F.col("_ask") * F.col("_granted")).over(before), F.lit(0)),
        )
        .select(*key, "_granted", "_base")
    )
    opened = F.col("_opens") + F.col("_asks") * F.col("_granted")
    grouped = scale.same_group(scanned, carried, key).withColumn(
        "pair", F.col("_base") + F.sum(opened).over(in_chunk.rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = F.sort_array(F.collect_list(F.struct("pos", "kind", "part")))
    spoken = F.filter("_parts", lambda p: p["kind"] == "T")
    titles = F.filter("_parts", lambda p: p["kind"] != "T")
    return (
        grouped.filter(F.col("pair") > 0)
        .groupBy(session, "pair")
        .agg(parts.alias("_parts"))
        .filter(F.exists("_parts", lambda p: p["kind"] == "T"))
        .select(
            session,
            "pair",
            F.array_join(F.transform(titles, lambda p: p["part"]), " ").alias("headline"),
            F.array_join(F.transform(spoken, lambda p: p["part"]), " ").alias("body"),
        )
    )


def headline_pairs(df: DataFrame, session: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """Headline and speech pairs of each text, numbered in order from 1.

    The events are read twice, once without their text, and therefore stored.
    """
    return pair_events(stored(segment_events(df, session, text_col), "events"), session, chunk)
