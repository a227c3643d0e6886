"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridfold.llm import scratch, stages
from gridfold.llm.tables import documents

STAGES = [
    ("language ID", stages.language_id),
    ("line dedup", stages.line_dedup),
    ("n-gram Jaccard join", stages.jaccard_join),
    ("mixing", stages.mix),
    ("packing", stages.pack),
]

#: SQL can express neither learnt models nor balanced sampling nor a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.cut(docs, f"stage-{k}")
    return docs
