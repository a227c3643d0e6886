"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents is expected: the whole part is taken
for certain, and the fraction is its inclusion probability. Within a source, the cube method moves these
probabilities through the null space of two constraints (the number of documents, the number of words)
until all but two are 0 or 1. Large sources are cut into blocks of bounded size that are moved
independently, which keeps both constraints exactly; the few documents that each block leaves undecided
form the next, far smaller population. The last two or so of a source are the landing problem: they are
rounded to the nearest total of words.

Defined cases: a null text has size 0, and a document of size 0 takes nothing; texts of any length are
counted whole, in slices; a null source is a source, ordered last; a null doc_id or repeated rows are
documents like others (each row counts for itself); documents are always taken in the order of a hash of
their id and size, ties by all their columns, so that reruns agree however rows arrive; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridfold.llm import scratch
from gridfold.llm.textvec import parts, word_counts

#: Documents that one task moves at a time.
BLOCK = 8_192
MOST_TIMES = 3
EPS = 1e-9
#: Documents that each block keeps undecided, so that the landing has a choice.
RESERVE = 14
#: Blocks of a source that are moved on as one.
FAN = 512


def targets(sizes: dict[str | None, int], weights: tuple[float, ...], most: float = MOST_TIMES) -> dict[str | None, float]:
    """Each source's share of all words by weight, at most ``most`` times its own; excess is reshared."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    out: dict[str | None, float] = {}
    free = [s for s in order if sizes[s] > 0]
    out.update({s: 0.0 for s in order if sizes[s] == 0})
    while free:
        left, share = total - sum(out.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / share > most * sizes[s]]
        if not above:
            out.update({s: left * weight[s] / share for s in free})
            break
        out.update({s: float(most * sizes[s]) for s in above})
        free = [s for s in free if s not in out]
    return out


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities until at most two lie strictly between 0 and 1; sums of p and p*size stay."""
    p = p.tolist()
    s = size.tolist()
    dice = iter(rng.random(2 * len(p) + 8).tolist())
    inside: list[int] = []
    for k in range(len(p)):
        if EPS < p[k] < 1 - EPS:
            inside.append(k)
        else:
            p[k] = float(round(p[k]))
        if len(inside) < 3:
            continue
        a, b, c = inside
        # The null space of [[1, 1, 1], [sa, sb, sc]] is the line through their cross product.
        u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(inside, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if next(dice) * (up + down) < down else -down
        for i, d in zip(inside, u, strict=True):
            p[i] += step * d
            if p[i] < EPS or p[i] > 1 - EPS:
                p[i] = float(p[i] > 0.5)
        inside = [i for i in inside if 0 < p[i] < 1]
    return np.array(p)


def reserve(p: np.ndarray, size: np.ndarray, n: int = RESERVE) -> np.ndarray:
    """Positions of n undecided documents that are kept for the landing: of all sizes but the largest
    tenth, small ones to come near and middling ones to make up for a large one among the last."""
    left = np.flatnonzero((p > EPS) & (p < 1 - EPS) & (size > 0))
    ordered = left[np.argsort(size[left], kind="stable")][: max(n, len(left) - len(left) // 10)]
    return ordered[np.unique(np.linspace(0, len(ordered) - 1, n).astype(np.int64))] if len(ordered) else ordered


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last undecided documents: of all choices the one whose words come nearest to those
    expected, and of these the one whose number of documents does."""
    out = p.copy()
    left = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    if not len(left):
        return out
    choices = np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1
    words = np.abs(choices @ size[left] - (p[left] * size[left]).sum())
    count = np.abs(choices.sum(1) - p[left].sum())
    out[left] = choices[np.lexsort((count, words))[0]]
    return out


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8], "little")


def with_sizes(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size and the columns ``keep``: one pass over the texts, which don't stay."""
    names = ["doc_id", "source", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in parts(batches):
            size = word_counts(data, bounds)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(size)], names=[*names, "size"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), *keep, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([*rows.drop("text").schema.fields, T.StructField("size", T.LongType())]))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = MOST_TIMES, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, times (how often the mix takes the document), taken."""
    return mix_sizes(scratch.cut(with_sizes(docs), "mix-sizes"), weights, most, block, seed)


def mix_sizes(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = MOST_TIMES, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """The same from doc_id, source, size and any further columns, which stay."""
    spark = sized.sparkSession
    # One row for each source: their number, not the documents', is what comes to the driver.
    stats = {r["source"]: (r["n"], r["words"]) for r in sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()}
    target = targets({s: w for s, (_, w) in stats.items()}, weights, most)
    plan = spark.createDataFrame(
        pd.DataFrame([(s, w, target[s], max(1, -(-n // block))) for s, (n, w) in stats.items()], columns=["mix_source", "source_size", "target", "mix_blocks"]),
        "mix_source string, source_size long, target double, mix_blocks long",
    )
    keep = [c for c in sized.columns if c not in ("source_size", "target", "times", "taken")]
    times = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = (
        sized.select(*keep)
        .join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
        .withColumn("mix_p", times)
        # A block is dealt by the document, never by where a row happens to lie, so that reruns agree.
        .withColumn("mix_block", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.col("mix_blocks")))
    )
    return _decide(rows, [*keep, "source_size", "target"], max([1, *(-(-n // block) for n, _ in stats.values())]), seed)


def settle(table: pa.Table, keep: list[str], key: tuple, seed: int) -> pa.Table:
    """The rows of one block in their fixed order, moved until only the reserve and two more are undecided."""
    table = table.sort_by([(c, "ascending") for c in ("mix_rank", *keep) if not pa.types.is_nested(table.schema.field(c).type)])
    p, size = table["mix_p"].to_numpy(), table["size"].to_numpy()
    base = np.floor(p + EPS)
    part = np.clip(p - base, 0, 1)
    moving = np.ones(len(p), bool)
    moving[reserve(part, size)] = False
    part[moving] = flight(part[moving], size[moving], np.random.default_rng(_seed(seed, *key)))
    return _with_p(table, base + part)


def _with_p(table: pa.Table, p: np.ndarray) -> pa.Table:
    return table.set_column(table.schema.get_field_index("mix_p"), "mix_p", pa.array(p, pa.float64()))


def _decide(rows: DataFrame, keep: list[str], most_blocks: int, seed: int) -> DataFrame:
    ranked = rows.withColumn("mix_rank", F.xxhash64("doc_id", "size", F.lit(seed + 1)))
    schema = ranked.schema

    def block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return settle(table, keep, tuple(str(k.as_py()) for k in key), seed)

    def final(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = settle(table, keep, ("landing", str(key[0].as_py())), seed)
        p = table["mix_p"].to_numpy()
        base = np.floor(p + EPS)
        return _with_p(table, base + land(p - base, table["size"].to_numpy()))

    moved = scratch.cut(ranked.groupBy("source", "mix_block").applyInArrow(block, schema), "mix-moved")
    undecided = F.abs(F.col("mix_p") - F.round("mix_p")) > EPS
    done, left = moved.where(~undecided), moved.where(undecided)
    # A few documents of each block are left: a population smaller by the factor BLOCK / RESERVE.
    if most_blocks > FAN:
        fewer = F.pmod(F.xxhash64("mix_block"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("mix_blocks") / FAN)))
        decided = _decide(left.withColumn("mix_block", fewer).drop("mix_rank"), keep, -(-most_blocks // FAN), seed + 2)
    else:
        decided = _taken(left.groupBy("source").applyInArrow(final, schema), keep)
    return _taken(done, keep).unionByName(decided)


def _taken(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.withColumn("times", F.round("mix_p").cast("long")).withColumn("taken", F.col("size") * F.col("times")).select(*keep, "times", "taken")
