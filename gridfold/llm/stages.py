"""The corpus pipeline's stages: each takes and returns documents, the last returns packed sequences.

Defined cases, in all stages: a null text counts as empty; null ids, languages and sources are values like
others; repeated rows are documents of their own (but for the Jaccard join, which is there to drop them);
texts of any length are taken whole; an empty table gives an empty one with the same columns; columns beyond
those of documents are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.llm import jaccard, langid, linededup, mixing, packing
from gridfold.llm.queries import tokenizer_path
from gridfold.llm.tables import ROW, settled, with_row

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: without a letter (so null and empty ones), or coded no better than by
    equal odds for all bytes. An unknown language is filled in; without any labelled row, all documents go."""
    found = langid.predict(docs.select(*COLUMNS), langid.fit(docs))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < 8))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that stand in ten documents and more; every document stays, an empty one if need be."""
    done = linededup.clean(docs.select(*COLUMNS) if set(docs.columns) != set(COLUMNS) else docs)
    return done.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long")).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by 5-word n-grams at a similarity of 0.8, the least id stays: of equal
    ids the first in place, of documents without ids any before none. Documents without words all stay."""
    docs = settled(docs.select(*COLUMNS))
    found = jaccard.join(docs, jaccard.Rule(5, 80, 100))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("o")).select(F.col(f"o.{ROW}").alias(ROW))
    stay = first.unionByName(found.where("component IS NULL").select(ROW))
    return with_row(docs).join(stay, ROW, "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix does: up to three times; those without words
    weigh nothing and are taken by their source's rate."""
    rows = with_row(docs.select(*COLUMNS))
    sized = mixing.scratch.cut(mixing.with_sizes(rows, (ROW,)), "mix-sizes")
    times = mixing.mix_sizes(sized).where("times > 0").select(ROW, "times")
    return rows.join(times, ROW).withColumn("gf_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences of all documents; an empty one is its end token."""
    return packing.digest(packing.pack(docs, tokenizer_path()))
