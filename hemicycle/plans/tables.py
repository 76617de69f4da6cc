"""The given tables, seen in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import tokens as N
from ..operators import assembly, keywords
from ..sources.readers import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def digest(tokens: Column) -> Column:
    """Array of strings as one comparable value."""
    return F.md5(F.array_join(tokens, " "))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, vector, cluster)``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").alias("cluster")
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(intervention_id, cluster)``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("intervention_id"), F.col("label").alias("cluster")
    )


def interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(intervention_id, session_id, intervention_words)``; words are lower-case valid tokens."""
    words = N.valid_words(N.word_tokens(F.lower("text")))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("intervention_id"),
        F.col("source").alias("session_id"),
        words.alias("intervention_words"),
    )


def speech_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(intervention_id, session_id, num_words)``: counted where the text is read."""
    speeches = interventions(spark, sf_dir)
    return speeches.select("intervention_id", "session_id", F.size("intervention_words").alias("num_words"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(session_id, date, chamber)``: one session per document source.

    Its date is that of the largest order of the customers that share its number.
    """
    number = F.col("o_custkey") % 20
    return (
        table(spark, sf_dir, "orders")
        .groupBy(number.alias("_k"))
        .agg(F.max_by("o_orderdate", F.struct("o_totalprice", "o_orderkey")).alias("_ts"))
        .select(
            F.concat(F.lit("src"), "_k").alias("session_id"),
            F.to_date("_ts").alias("date"),
            F.when(F.col("_k") % 2 == 0, "house").otherwise("senate").alias("chamber"),
        )
    )


def document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, doc_id, keywords)``: tf-idf keywords, one corpus per source."""
    documents = table(spark, sf_dir, "documents")
    return keywords.keyword_arrays(documents, "source", "doc_id", "text", K.STOP_WORDS, digits=9)


def labelled_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cluster, doc_id, keywords)`` for documents that have a vector; other documents count in their source only."""
    labels = clusters(spark, sf_dir).withColumnRenamed("intervention_id", "doc_id")
    documents = table(spark, sf_dir, "documents")
    wanted = documents.join(labels, "doc_id", "left_semi")
    found = keywords.keyword_arrays(documents, "source", "doc_id", "text", K.STOP_WORDS, digits=9, only=wanted)
    return found.join(labels, "doc_id").select("cluster", "doc_id", "keywords")


#: Lines put before the turns of a conversation to make a gazette of it.
GAZETTE_HEAD = (
    "Edición de 32 páginas",
    "IMPRENTA NACIONAL DE COLOMBIA - www.imprenta.gov.co",
    "Página 7 del acta",
    "Año XXV Nº 120 - Bogotá",
    "SENADO DE LA REPÚBLICA",
)


def turn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as spans: four turns a page, a span ends at a comma; users speak bold."""
    turns = table(spark, sf_dir, "conversations")
    lines = turns.select(
        "conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("line", "_line")
    )
    return lines.select(
        F.col("conv_id").alias("doc"),
        F.floor(F.col("turn") / 4).cast("int").alias("page"),
        F.col("turn").cast("int").alias("block"),
        "line",
        F.posexplode(F.split("_line", ", ")).alias("span", "text"),
        F.when(F.col("role") == "user", "Arial-Bold").otherwise("Arial").alias("font"),
    )


def gazettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc, raw_text)``: each conversation as a gazette with masthead, act number and date.

    Every turn is one span. Some headlines name a bill, some days do not exist.
    """
    turns = table(spark, sf_dir, "conversations")
    doc = F.col("conv_id")
    months = F.array(*[F.lit(m) for m in K.MONTHS])
    bill = F.when((doc + F.col("turn")) % 5 == 0, "Proyecto de ley ").otherwise("")
    body = turns.select(
        doc.alias("doc"),
        F.lit(1).alias("page"),
        F.col("turn").cast("int").alias("block"),
        F.lit(0).alias("line"),
        F.lit(0).alias("span"),
        F.when(F.col("role") == "user", F.concat(bill, "text")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("role") == "user", "Arial-Bold").otherwise("Arial").alias("font"),
    )
    place = (
        F.when(doc % 3 == 0, "Cámara de Representantes")
        .when(doc % 3 == 1, "Senado, Comisión Primera")
        .otherwise("Senado, sesión plenaria")
    )
    day = F.concat(
        F.lit("Bogotá, "), doc % 31 + 1, F.lit(" de "), F.get(months, (doc % 12).cast("int")),
        F.lit(" de "), doc % 20 + 2000,
    )
    act = F.concat(F.lit("ACTA NÚMERO "), doc, F.lit(" DE 2016"))
    lines = [(F.lit(text), "Arial") for text in GAZETTE_HEAD]
    lines += [(act, "Arial-Bold"), (place, "Arial"), (day, "Arial")]
    entries = F.array(*[F.struct(text.alias("text"), F.lit(font).alias("font")) for text, font in lines])
    head = turns.select("conv_id").distinct().select(doc.alias("doc"), F.posexplode(entries).alias("line", "_e"))
    head = head.select(
        "doc", F.lit(0).alias("page"), F.lit(0).alias("block"), "line", F.lit(0).alias("span"), "_e.text", "_e.font"
    )
    return assembly.assemble_spans(head.unionByName(body))
