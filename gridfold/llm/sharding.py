"""Sharding by histogram sort.

Documents are ordered by (hash of the text, hash of the row's place). Where shard i begins is found by
counting exact bytes below candidate boundaries: a first histogram over the hash's leading bits says in
which of its cells each splitter lies; the next one divides these cells alone, and so on, until the bytes
below a boundary are within the tolerance of what they should be. Each round is one map-side combined
count whose result has a fixed size. Then rows are dealt out once.

Equal texts are neighbours in that order. A splitter stands between groups of equal texts wherever that
meets the tolerance; only a group that is too large for it is divided, by the rows' places.

Law ``bytes``: shard sizes differ from equal ones by the tolerance, or by one document where documents
are larger than that.

Defined cases: a null text has no bytes and counts 1, like an empty one, but a checksum of its own kind:
both have the checksum of no bytes; repeated rows and null ids are documents of their own; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridfold.llm import scratch
from gridfold.llm.tables import ROW, settled, with_row

#: Bits that one round adds to the boundaries that it counts; a divisor of 64.
DIGIT = 8
LEAST = -(1 << 63)
Splitter = tuple[int, int]


def _count(rows: DataFrame, column: str, shift: int, cells: set[int] | None) -> dict[int, list[tuple[int, int]]]:
    """Bytes by cell of 2**shift hashes; of the parent cells given alone. By parent: (cell, bytes), sorted."""
    parent = F.shiftright(column, shift + DIGIT) if shift + DIGIT < 64 else F.lit(0)
    if cells is not None:
        rows = rows.where(parent.isin(list(cells)))
    cell = F.shiftright(column, shift) if shift else F.col(column)
    out: dict[int, list[tuple[int, int]]] = {}
    for r in sorted(rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("bytes")).collect()):
        out.setdefault(r["cell"] >> DIGIT if shift + DIGIT < 64 else 0, []).append((r["cell"], r["bytes"]))
    return out


def _search(rows: DataFrame, column: str, wanted: dict[int, float], tolerance: float) -> tuple[dict[int, int], dict[int, tuple[int, float]]]:
    """For each splitter, by the bytes that should lie below it: a boundary in ``column`` that meets the
    tolerance; or else the one value within whose rows it falls, and the bytes wanted below it there."""
    met: dict[int, int] = {}
    open_: dict[int, tuple[int, float]] = {i: (0, w) for i, w in wanted.items()}
    shift, first = 64 - DIGIT, True
    while open_:
        found = _count(rows, column, shift, None if first else {cell for cell, _ in open_.values()})
        for i, (parent, want) in list(open_.items()):
            below, cells = 0, found.get(parent, [])
            for at, (cell, size) in enumerate(cells):
                if below + size >= want or at == len(cells) - 1:
                    if abs(below - want) <= tolerance and (below or at):
                        met[i] = cell << shift
                    elif abs(below + size - want) <= tolerance:
                        met[i] = cell + 1 << shift
                    else:
                        open_[i] = (cell, want - below)
                    break
                below += size
            if i in met or not cells:
                met.setdefault(i, LEAST)
                del open_[i]
        if shift == 0:
            break
        shift, first = shift - DIGIT, False
    return met, open_


def splitters(rows: DataFrame, total: int, shards: int, tolerance: float) -> list[Splitter]:
    """Where shards 1, 2, ... begin, as (hash of text, hash of place)."""
    slack = tolerance * total / shards
    met, inside = _search(rows, "h", {i: total * i / shards for i in range(1, shards)}, slack)
    out: dict[int, Splitter] = {i: (h, LEAST) for i, h in met.items()}
    values = {v for v, _ in inside.values()}
    held = rows.where(F.col("h").isin(list(values))).groupBy("h").agg(F.count("*"), F.sum("size")).collect() if values else []
    for value, n, size in held:
        mine = {i: want for i, (v, want) in inside.items() if v == value}
        if n == 1:  # one document: the splitter goes to its nearer side
            out |= {i: (value, LEAST) if want < size / 2 else (value + 1, LEAST) for i, want in mine.items()}
            continue
        group = rows.where(F.col("h") == value)
        met, last = _search(group, "g", mine, slack)
        out |= {i: (value, g) for i, g in met.items()}
        for i, (g, want) in last.items():
            size = group.where(F.col("g") == g).agg(F.sum("size")).first()[0]
            out[i] = (value, g) if want < size / 2 else (value, g + 1)
    return [out[i] for i in sorted(out)]


def _above(splitter: Splitter) -> Column:
    h, g = splitter
    if h >= 1 << 63:
        return F.lit(0)
    at = F.col("h") >= h if g == LEAST else (F.col("h") > h) | ((F.col("h") == h) & (F.col("g") >= F.lit(g))) if g < 1 << 63 else F.col("h") > h
    return at.cast("int")


def assign(docs: DataFrame, shards: int = 16, tolerance: float = 0.01, rows_a_cell: int = 100_000) -> DataFrame:
    """gf_row, doc_id, size, text_crc32, shard, slot for each document."""
    place = with_row(docs.select("doc_id", "text"))
    text = F.col("text").cast("string").cast("binary")
    keyed = place.select(
        ROW,
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(b""))).alias("h"),
        F.xxhash64(ROW).alias("g"),
    )
    rows = scratch.cut(keyed, "shard-keys")  # all rounds read these few bytes a document, not the texts
    sums = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    edges = splitters(rows, sums["bytes"], shards, tolerance) if sums["n"] else []
    shard = sum((_above(e) for e in edges), F.lit(0)).alias("shard")
    # Slots are numbered within cells, which come after one another; their counts have a fixed size.
    cells = min(4_096, max(8, sums["n"] // shards // rows_a_cell))
    dealt = rows.select("*", shard.cast("int"), F.pmod("g", F.lit(cells)).alias("cell"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n")).select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("h", "g"))
    return (
        dealt.withColumn("number", number)
        .join(F.broadcast(starts), ["shard", "cell"])  # at most shards * 4096 rows
        .select(ROW, "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).cast("long").alias("slot"))
    )


def write(docs: DataFrame, out: str, **how: object) -> None:
    """Write the documents with shard and slot, one folder a shard. Files are runs of slots, each in order, and follow
    one another as they are numbered; the exchange is by ranges of (shard, slot). Columns shard and slot are these."""
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("gf_doc"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    own = settled(own)
    joined = with_row(own).join(assign(own, **how).select(ROW, "shard", "slot"), ROW)
    kept = [F.col("gf_doc").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    placed = joined.select(*kept, "shard", "slot")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(out)
