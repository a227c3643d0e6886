"""Language identification by prediction by partial matching over bytes.

Each language has a variable-order context tree: how often a byte followed the last 3, 2, 1 and 0 bytes.
A byte seen in the longest context has its count there over the context's count plus its number of
distinct successors; otherwise an escape (that number of successors over the same sum) is paid and the
next shorter context is asked; below order 0 all 256 bytes are alike. The trees are learnt once and
frozen, so a byte's exact code length is a function of itself and the 3 bytes before it, and whole texts
are scored by table lookups. The language with the shortest code wins.

Learning takes a bounded sample of labelled rows: of each language at most ``per_language`` different texts,
those of least hash, whole. Their byte windows are counted where they lie; only the counts come to the
driver. Prediction reads every text whole, in slices, and sees nothing but the text. The trees grow with
the number of languages and the variety of the samples, not with the table.

Defined cases: a null text, an empty one or one without a letter is ``und`` with score 0; texts of any
length are scored whole; without any labelled row every document is ``und``; rows without a label or text
teach nothing; ties go to the language first by code point; repeated rows are scored alike, and teach once;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridfold.llm.tables import remainder
from gridfold.llm.textvec import LOWER, parts

ORDER = 3
SLICE = 1 << 19
U32, U64 = np.uint32, np.uint64


class Lookup:
    """Keys of up to 32 bits to positions: tables of falling size, each with what the last had no room for."""

    def __init__(self, keys: np.ndarray) -> None:
        keys = keys.astype(U32)
        todo = np.arange(len(keys))
        self.tables: list[tuple[np.uint64, np.uint64, np.ndarray, np.ndarray]] = []
        while len(todo):
            bits = max(4, int(np.ceil(np.log2(3 * len(todo)))))
            factor, shift = U64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * len(self.tables) & 0xFFFFFFFFFFFFFFFF | 1), U64(64 - bits)
            slot, first = np.unique(((keys[todo].astype(U64) + U64(1)) * factor >> shift).astype(np.int64), return_index=True)
            key, at = np.zeros(1 << bits, U32), np.full(1 << bits, -1, np.int32)
            key[slot], at[slot] = keys[todo[first]], todo[first]
            self.tables.append((factor, shift, key, at))
            todo = np.delete(todo, first)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        ask, where = keys, None
        for factor, shift, key, at in self.tables:
            slot = ((ask.astype(U64) + U64(1)) * factor >> shift).astype(np.int64)
            found = at[slot]
            hit = (key[slot] == ask) & (found >= 0)
            if where is None:
                out = np.where(hit, found, -1)
                where = np.flatnonzero(~hit & (found >= 0))
                ask = keys[where]
            else:
                out[where[hit]] = found[hit]
                on = ~hit & (found >= 0)  # an empty slot means that the key is nowhere
                where, ask = where[on], ask[on]
            if not len(where):
                break
        return out


@dataclass
class Level:
    """One order's part of all trees: code lengths in bits by language, of grams and of escapes."""

    grams: Lookup
    bits: np.ndarray
    contexts: Lookup
    escape: np.ndarray


@dataclass
class Trees:
    languages: list[str]
    levels: list[Level]

    def code(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of the last byte of each window by language. keys: the windows' last order + 1 bytes."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0, np.float32)
        level = self.levels[order]
        at = level.grams.find(keys)
        out = level.bits[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest = keys[miss]
            context = level.contexts.find(rest >> U32(8))
            paid = np.where((context >= 0)[:, None], level.escape[context], 0)
            out[miss] = paid + self.code(rest & U32((1 << 8 * order) - 1), order - 1)
        return out


def windows(data: np.ndarray, order: int) -> np.ndarray:
    """Each byte with those before it, as one number; bytes before the first count as 0."""
    out = data.astype(U32)
    for i in range(1, order + 1):
        out[i:] |= data[:-i].astype(U32) << U32(8 * i)
    return out


def text_windows(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slice after slice of many texts, with its bounds: each byte's window, without the text before it."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        low = max(0, at - ORDER)
        w = windows(LOWER[data[low:end]], ORDER)[at - low :]
        rows = bounds[np.searchsorted(bounds, at - ORDER, "left") : np.searchsorted(bounds, end, "left") + 1]
        # A text's first bytes have no context from the text before it.
        for i in range(ORDER):
            near = rows + i
            near = near[(near >= at) & (near < end)] - at
            w[near] &= U32((1 << 8 * (i + 1)) - 1)
        yield at, end, w
        at = end


def learn(samples: dict[str, bytes]) -> Trees:
    """Trees of one text a language."""
    one = {x: next((w for _, _, w in text_windows(np.frombuffer(t, np.uint8), np.array([0, len(t)]))), np.zeros(0, U32)) for x, t in samples.items()}
    return grown({x: np.unique(w, return_counts=True) for x, w in one.items()})


def grown(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """The trees of languages whose windows are counted."""
    languages = sorted(counts)
    levels: list[Level] = []
    for order in range(ORDER + 1):
        mask = U32((1 << 8 * (order + 1)) - 1)
        counted = {}
        for x, (w, n) in counts.items():
            keys, back = np.unique(w & mask, return_inverse=True)
            counted[x] = (keys, np.bincount(back, n, len(keys)))
        grams = np.unique(np.concatenate([k for k, _ in counted.values()])) if counted else np.zeros(0, U32)
        contexts = np.unique(grams >> U32(8))
        bits = np.zeros((max(1, len(grams)), len(languages)), np.float32)
        escape = np.zeros((max(1, len(contexts)), len(languages)), np.float32)
        for j, x in enumerate(languages):
            keys, count = counted[x]
            context, back = np.unique(keys >> U32(8), return_inverse=True)
            n, distinct = np.bincount(back, count), np.bincount(back)
            where = np.searchsorted(contexts, context)
            escape[where, j] = np.log2((n + distinct) / distinct)
            # Grams other languages have and this one lacks: an escape if it knows the context, and then
            # what the next shorter context says.
            shorter = Trees(languages, levels).code(grams & (mask >> U32(8)), order - 1)[:, j]
            bits[: len(grams), j] = escape[np.searchsorted(contexts, grams >> U32(8)), j] + shorter
            bits[np.searchsorted(grams, keys), j] = np.log2((n + distinct)[back] / count)
        levels.append(Level(Lookup(grams), bits, Lookup(contexts), escape))
    return Trees(languages, levels)


def score(trees: Trees, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code lengths in bits of whole texts, by language."""
    out = np.zeros((len(bounds) - 1, len(trees.languages)))
    for at, end, w in text_windows(data, bounds):
        first = np.searchsorted(bounds, at, "right") - 1
        rows = bounds[first : np.searchsorted(bounds, end, "left") + 1]
        bits = trees.code(w)
        begins = np.clip(rows, at, end) - at
        full = np.flatnonzero(np.diff(begins) > 0)
        out[first + full] += np.add.reduceat(bits, begins[full], axis=0, dtype=np.float64)
    return out


def sample(docs: DataFrame, training: Column, per_language: int) -> DataFrame:
    """lang, text: of each language the ``per_language`` different texts of least hash.

    What the driver learns on the way is a number for each language and some 4 to 16 times
    ``per_language`` hashes of each: a share of the rows whose expected size that is."""
    spark = docs.sparkSession
    rank = F.shiftrightunsigned(F.xxhash64(F.col("text").cast("string")), 1)
    labelled = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), rank.alias("rank")
    )
    n = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    whole = (1 << 63) - 1
    likely = [(x, whole if rows <= 16 * per_language else whole * 4 * per_language // rows) for x, rows in sorted(n.items())]
    # Sent to all tasks: a row for each language, which the driver has just counted.
    within = lambda limits: labelled.join(F.broadcast(spark.createDataFrame(limits, "lang string, most long")), "lang").where("rank <= most")
    ranks: dict[str, list[int]] = {}
    for r in within(likely).select("lang", "rank").distinct().collect():
        ranks.setdefault(r["lang"], []).append(r["rank"])
    least = [(x, sorted(found)[:per_language][-1]) for x, found in sorted(ranks.items())]
    return within(least).dropDuplicates(["lang", "rank"]).select("lang", "text")


def counted(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By language, the windows of whole texts and how often each stands there. From lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in parts(batches):
            names, code = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            of_byte = np.repeat(code, np.diff(bounds)).astype(U64)
            for at, end, w in text_windows(data, bounds):
                keys, n = np.unique(of_byte[at:end] << U64(32) | w, return_counts=True)
                lang = pa.DictionaryArray.from_arrays(pa.array((keys >> U64(32)).astype(np.int32)), pa.array(names.tolist(), pa.string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, pa.array((keys & U64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    table = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return {x: (part["gram"].to_numpy(np.int64).astype(U32), part["n"].to_numpy(np.int64)) for x, part in table.groupby("lang")}


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with lang_pred, score, and bits_per_byte of the best language's code."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the sample
    new = ("lang_pred", "score", "bits_per_byte")
    rows = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in docs.columns if c not in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch, data, bounds in parts(batches):
            size = np.diff(bounds)
            bits = score(trees, data, bounds) if trees.languages else np.zeros((len(size), 1))
            best = bits.argmin(1)
            least = bits[np.arange(len(size)), best]
            # Code lengths that differ by d bits differ by 2**d in likelihood; the exponent is damped by
            # the length's root, for bytes of one text aren't independent of each other.
            damped = (bits - least[:, None]) / np.sqrt(np.maximum(size, 1))[:, None]
            posterior = 1 / np.exp2(-np.minimum(damped, 60)).sum(1)
            known = _letters(batch.column("text"), data, bounds) & bool(trees.languages)
            names = np.array([*trees.languages, "und"], object)
            more = [
                pa.array(np.where(known, names[best], "und"), pa.string()),
                pa.array(np.where(known, posterior, 0.0)),
                pa.array(least / np.maximum(size, 1)),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *new])

    out = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    return rows.mapInArrow(run, out)


def _letters(texts: pa.Array, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    low = LOWER[data]
    total = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    out = np.diff(total[bounds]) > 0
    for i in np.flatnonzero(~out & (np.diff(bounds) > 0)):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
    return out


def fit(docs: DataFrame, training: Column | None = None, per_language: int = 400) -> Trees:
    training = remainder(F.col("doc_id"), 3) != 1 if training is None else training
    flagged = docs.select("doc_id", "lang", "text", training.alias("gf_training"))
    return grown(counted(sample(flagged, F.col("gf_training"), per_language)))
