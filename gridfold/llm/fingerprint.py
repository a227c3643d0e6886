"""Document fingerprints from closed syncmers, with DataFrame functions only.

The symbols are words. A k-mer of ``K`` consecutive words is an anchor if the least hash among its inner
s-mers (``S`` words) is that of its first or its last one: whether it is depends on the k-mer alone, not
on what stands around it, so an edit changes no anchor that it doesn't touch; and of K - S k-mers in a row
one at least is an anchor. A text's fingerprint has all its anchors in the order in which they stand in the
text, repeats included: 8 hexadecimal digits of the anchor's 32-bit hash and one of how many words it
stands behind the anchor before it, so that all positions can be read back.

The likeness of two fingerprints matches anchors by position. Anchors that both have are ranked by where
they first stand in either; one that holds the same rank in both counts whole, one that is displaced by d of
n ranks counts 1 - 2d/n, and not below nothing. The likeness is their sum over all anchors that either has.
Where the order is kept this is the exact Jaccard similarity of the anchor sets; of two texts whose halves
are swapped almost nothing is left; what is inserted or cut out elsewhere moves no rank.

Defined cases: a null or empty text has an empty fingerprint; a text of fewer than K words, or of more
among which no k-mer is an anchor, has one anchor, all its words; two empty fingerprints are alike (1), an
empty and another one are not (0); texts of any length are taken whole, in n log n; equal ids are ordered by
a hash of their places; null ids come last; a single document is its own next one; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridfold.llm import ranges
from gridfold.llm.arrays import let, upto
from gridfold.llm.tables import ROW, with_row

K, S = 5, 2
#: Documents that one window group holds.
GROUP = 2_048
#: A packed anchor: its hash above, a mark and its place below.
MARK, PLACE = 1 << 31, (1 << 31) - 1


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """A text's closed syncmers in order, repeats included: hashes above, word positions below 32 bits."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    width = k - s + 1
    packed = lambda hashed, at: hashed.bitwiseAND(F.lit(-1 << 32)).bitwiseOR(at.cast("long"))

    def of_inner(inner: Column) -> Column:
        def at(i: Column) -> Column:
            around = [F.get(inner, i + j) for j in range(width)]
            least = F.least(*around)
            return F.when((least == around[0]) | (least == around[-1]), packed(F.xxhash64(*around), i))

        return F.array_compact(upto(F.size(inner) - width + 1, at))

    def of_words(word: Column) -> Column:
        inner = upto(F.size(word) - s + 1, lambda i: F.xxhash64(*[F.get(word, i + j) for j in range(s)]))
        found = F.when(F.size(word) >= k, let(inner, of_inner)).otherwise(F.array().cast("array<long>"))
        return let(found, lambda x: F.when((F.size(x) == 0) & (F.size(word) > 0), F.array(packed(F.xxhash64(word), F.lit(0)))).otherwise(x))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(PLACE))


def _firsts(found: Column) -> Column:
    """The different anchors by hash, each where it first stands."""
    return let(F.sort_array(found), lambda x: F.filter(x, lambda a, i: (i == 0) | (_hash(F.get(x, i - 1)) != _hash(a))))


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two arrays of anchors, 0 to 1."""

    def pairs(z: Column) -> Column:
        # An anchor of both is two neighbours: its place in a goes above, its place in b below.
        follows = lambda v, i: F.when(_hash(v) == _hash(F.get(z, i + 1)), F.shiftleft(_place(v), 32).bitwiseOR(_place(F.get(z, i + 1))))
        return F.array_compact(F.transform(z, follows))

    def ranked(c: Column) -> Column:
        # Sorted by place in b, with the rank in a below.
        return F.sort_array(F.transform(c, lambda v, i: F.shiftleft(_place(v), 32).bitwiseOR(i.cast("long"))))

    def compared(x: Column, y: Column) -> Column:
        every = F.sort_array(F.concat(x, F.transform(y, lambda v: v.bitwiseOR(F.lit(MARK)))))

        def share(r: Column) -> Column:
            n = F.size(r).cast("long")
            kept = F.transform(r, lambda v, i: F.greatest(n - 2 * F.abs(_place(v) - i), F.lit(0).cast("long")))
            matched = F.aggregate(kept, F.lit(0).cast("long"), lambda total, v: total + v)
            return F.when(n == 0, 0.0).otherwise(matched / (n * (F.size(x) + F.size(y) - n)))

        return let(let(F.sort_array(let(every, pairs)), ranked), share)

    alike = let(_firsts(a), lambda x: let(_firsts(b), lambda y: compared(x, y)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(alike)


def text_of(found: Column) -> Column:
    """Anchors as a string: 8 hexadecimal digits of the hash and one of the words since the anchor before."""

    def digits(x: Column) -> Column:
        behind = lambda v, i: F.least(_place(v) - F.when(i == 0, -1).otherwise(_place(F.get(x, i - 1))), F.lit(15).cast("long"))
        number = lambda v, i: F.shiftleft(_hash(v).bitwiseAND(F.lit(0xFFFFFFFF)), 4).bitwiseOR(behind(v, i))
        return F.transform(x, lambda v, i: F.lpad(F.lower(F.hex(number(v, i))), 9, "0"))

    return F.array_join(let(found, digits), "")


def followed(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Each document with the text and anchors of the next one in descending order of id.

    Ids are cut into ranges of about equal numbers of rows, however they lie; texts are read and dealt out
    once, by range, and each range also gets the first document of the range that follows."""
    spark = docs.sparkSession
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = with_row(wanted).withColumn("place", F.xxhash64(ROW))
    cut = ranges.cells(placed.select("doc_id", "place"), "doc_id", "place", group)
    # The first document of each cell: about ranges.CELLS rows.
    order = F.struct("doc_id", "place", ROW)
    by_cell = cut.of(placed.select("doc_id", "place", ROW)).groupBy("cell").agg(F.count("*").alias("n"), F.max(order).alias("head"))
    heads_of = {r["cell"]: (r["n"], r["head"][ROW]) for r in by_cell.collect()}
    of_cell: list[tuple[int, int]] = []
    heads: list[str] = []
    held = group
    for cell in reversed(cut.order):
        if cell not in heads_of:
            continue
        n, head = heads_of[cell]
        if held >= group:
            heads.append(head)
            held = 0
        of_cell.append((cell, len(heads) - 1))
        held += n
    own = F.broadcast(spark.createDataFrame(of_cell, "cell int, range int"))
    guests = F.broadcast(spark.createDataFrame([(p, (i - 1) % len(heads)) for i, p in enumerate(heads)], f"{ROW} string, guest_range int"))
    found = cut.of(placed).join(own, "cell").join(guests, ROW, "left")
    guest = F.when(F.col("guest_range").isNotNull(), F.struct(F.col("guest_range").alias("range"), F.lit(1).alias("guest")))
    seats = F.array_compact(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")), guest))
    seated = found.withColumn("seat", F.explode(seats)).select("doc_id", "place", ROW, "text", "seat.range", "seat.guest")
    # Anchors are worked out behind the shuffle, which carries texts alone.
    both = seated.repartition("range").withColumn("anchors", anchors(F.col("text")))
    by_range = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.desc("place"), F.desc(ROW))
    return both.withColumn("next_text", F.lead("text").over(by_range)).withColumn("next_anchors", F.lead("anchors").over(by_range)).where("guest = 0")


def fingerprint(docs: DataFrame) -> DataFrame:
    """``docs`` with column ``fingerprint``: a projection, nothing is shuffled."""
    return docs.withColumn("fingerprint", text_of(anchors(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    pairs = followed(docs).select("doc_id", n.cast("long").alias("n_chars"), "anchors", "next_anchors", edited.alias("edited"))
    compared = pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "anchors", "next_anchors", anchors(F.col("edited")).alias("edited_anchors"))
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("anchors")).alias("fingerprint"),
        text_of(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
