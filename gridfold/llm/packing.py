"""Packing by power-of-two decomposition.

A document of n tokens becomes n // length pieces of the full length and one piece for each binary digit
of the rest, longest first. Pieces of one length form a bucket; a training batch takes its sequences from
one bucket. Each sequence is one piece, so none crosses documents and none needs padding.

Defined cases: a null or empty text is its end token alone; equal or repeated rows are packed each on its
own; a null doc_id stays null; an empty table gives no pieces; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.llm import bytebpe
from gridfold.llm.textvec import parts

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def decompose(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of n tokens: of each piece the document's position, its start and its length."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    whole = n // longest
    digits = [longest >> i for i in range(1, longest.bit_length())]
    counts = np.stack([whole, *((n % longest & d > 0).astype(np.int64) for d in digits)], 1)
    per = counts.ravel()
    doc = np.repeat(np.repeat(np.arange(len(n)), counts.shape[1]), per)
    length = np.repeat(np.tile(np.array([longest, *digits], np.int64), len(n)), per)
    ends = np.cumsum(length)
    before = np.cumsum(n) - n
    return doc, ends - length - before[doc], length


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each sequence: doc_id, start, length, ids (little-endian unsigned 32-bit, as bytes),
    doc_tokens, sequence_id, offset. ``length`` names the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bytebpe.load(tokenizer)
        for part, _, _ in parts(batches, 1 << 20, 512):
            yield from _pieces(part, encoder, longest, end_id)

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
    # Sequences need a number of their own, not a dense one: no shuffle and no count over all of them.
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def _pieces(batch: pa.RecordBatch, encoder: bytebpe.ByteBpe, longest: int, end_id: int) -> Iterator[pa.RecordBatch]:
    ids, count = encoder.encode(bytebpe.texts_of(batch.column("text")))
    ids = np.insert(ids, np.cumsum(count), end_id).astype("<u4")
    count = count + 1
    doc, start, length = decompose(count, longest)
    bounds = np.concatenate([[0], np.cumsum(length * 4)])
    binary = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
    taken = pa.array(doc)
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(taken), pa.array(start), pa.array(length), binary, pa.array(count[doc])],
        names=["doc_id", "start", "length", "ids", "doc_tokens"],
    )


def digest(pieces: DataFrame) -> DataFrame:
    """The sequences with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
