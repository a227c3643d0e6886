"""Exact join of documents whose sets of word n-grams are alike, in the metric space of Jaccard distance.

1.  Documents with equal sets are one class; all that follows is over classes.
2.  Level one's pivots are sets of one n-gram. A set of n lies at distance 1 - 1/n from the pivots that it
    holds and at 1 from all others, so regions are ties, broken by one global order (n-grams that are
    common among many documents last). A partner within distance r can lack at most the share r of a
    set's n-grams: the window in which a document is copied to further regions is its first
    n - ceil((1 - r) n) + 1 n-grams in that order. Two linked sets share one of these regions.
3.  Each such region is named by one of its documents, the pivot. Regions with one pivot are one region.
    Members without any partner there whose size and parity map allow a link (exact bounds) are dropped;
    the others bring their texts. There, distances to pivots are worked out exactly: what lies within r
    of a pivot is linked to it; the rest falls into the Voronoi regions of several pivots, each with a
    window by the triangle inequality (a document is copied to region i if it is at most 2 r farther from
    pivot i than from its own one; sets that share nothing with any pivot are a region of their own,
    whose window is distance 1 - r and more). Regions join recursively until few or linked members are
    left.
4.  If regions have more than ``most`` members, the n-grams that more than ``most`` of these members hold
    are counted over all of them and put last in the global order; the windows that change are worked out
    again. What is still larger never meets in one task. A job first cuts such regions by size (the distance
    from the empty set: linked sizes are at most one band apart); then each job takes some pivots of each,
    links what lies within their radius, and leaves the pivots out. Members that pivots tie together are a
    group, whose pairs are settled; all other pairs stay to be joined, but for members that the triangle
    inequality keeps from every partner outside their group. Regions that have become small are joined at
    once; only what is left of large ones is written again.
5.  Connected components over the links give classes' components.

No pair of a group is listed: a group of near copies costs a link for each member. n-grams and sets are
told apart by 63-bit and 126-bit hashes.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing;
a text of fewer than ``n`` words has one n-gram, all its words; rows with equal sets are linked, equal ids
or not; a component of rows without ids has a null id; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridfold.llm import scratch
from gridfold.llm.components import components
from gridfold.llm.tables import ROW, most_frequent, with_row
from gridfold.llm.textvec import U, mix, parts, utf8, words

#: n-grams that the global order puts last, at most; in how many documents of a part they must stand.
COMMON, COMMON_IN_PART = 1 << 17, 3
#: Members of a region that one task joins.
MOST = 2_048
#: Pivots of one step in a task; members below which, depth and overlap beyond which pivots are used singly.
PIVOTS, FEW, DEPTH, SPREAD = 8, 48, 8, 1.2
#: Pivots that one job takes of each region too large for a task, and members that they meet in one task.
JOB_PIVOTS, SPAN = 32, 1_024
#: Bits of the parity maps of short and long sets, and how many n-grams make a set long.
MAP_BITS, LONG = (1_024, 16_384), 2_048
#: The group of members that are tied to no pivot yet; groups have the number of one of their pivots.
NO_GROUP = -1
#: A pivot of a region too large for a task has at most so many n-grams, if any member has.
PIVOT_SIZE = 4_096


@dataclass(frozen=True)
class Rule:
    """Linked: den * |a & b| >= num * |a | b|, over sets of n words."""

    n: int = 4
    num: int = 85
    den: int = 100

    @property
    def radius(self) -> float:
        return 1 - self.num / self.den + 1e-9

    def linked(self, inter: np.ndarray, union: np.ndarray) -> np.ndarray:
        return self.den * inter >= self.num * union

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return np.where(size > 0, size + (-self.num * size // self.den) + 1, 0)


def grams(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each row, as 63-bit hashes sorted within the row, and their rows."""
    found = list(words(data, bounds))
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64)
    key, row = np.concatenate([k for k, _ in found]), np.concatenate([r for _, r in found])
    whole = row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    gram = key[at]
    for j in range(1, n):
        gram = mix(gram * U(0xA24BAED4963EE407) + key[at + j])
    per = np.bincount(row, minlength=len(bounds) - 1)
    first = np.cumsum(per) - per
    hashes, rows = [gram], [row[at]]
    for size in range(1, n):
        short = np.flatnonzero(per == size)
        if len(short):
            h = key[first[short]]
            for j in range(1, size):
                h = mix(h * U(0xA24BAED4963EE407) + key[first[short] + j])
            hashes.append(mix(h + U(size)))
            rows.append(short)
    h, r = np.concatenate(hashes) >> U(1), np.concatenate(rows)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def common_grams(docs: DataFrame, rule: Rule) -> np.ndarray:
    """n-grams that repeat within parts of the table, by how often, at most COMMON of them.

    They only settle the order in which a set's n-grams are taken, so any choice gives the same links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in parts(batches):
            key, n = np.unique(grams(data, bounds, rule.n)[0], return_counts=True)
            often = n >= COMMON_IN_PART
            yield pa.RecordBatch.from_arrays([pa.array(key[often].view(np.int64)), pa.array(n[often])], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = most_frequent(scratch.cut(counted, "common"), "n", COMMON).toPandas().sort_values(["n", "gram"])
    return top["gram"].to_numpy(np.int64).astype(U)  # rarest first


def parities(gram: np.ndarray, row: np.ndarray, size: np.ndarray) -> list[bytes]:
    """A bit map of each set: how many of its n-grams fall on each bit, modulo 2.

    Two maps differ in at most as many bits as their sets do in n-grams; a long map folds to a short one."""
    out: list[bytes] = [b""] * len(size)
    for wide, mine in ((False, size <= LONG), (True, size > LONG)):
        at = np.flatnonzero(mine)
        bits = MAP_BITS[wide]
        step = max(1, (1 << 21) // bits)
        place = np.full(len(size), -1)
        for low in range(0, len(at), step):
            block = at[low : low + step]
            place[:] = -1
            place[block] = np.arange(len(block))
            own = place[row] >= 0
            odd = np.bincount(place[row[own]] * bits + (gram[own] % U(bits)).astype(np.int64), minlength=len(block) * bits) & 1
            packed = np.packbits(odd.astype(np.uint8).reshape(len(block), bits), axis=1, bitorder="little")
            for i, m in zip(block.tolist(), packed, strict=True):
                out[i] = m.tobytes()
    return out


def sets(docs: DataFrame, rule: Rule, common: np.ndarray) -> DataFrame:
    """gf_row, doc_id, size, sig_a, sig_b (the set's identity), prefix (the regions' n-grams), map."""
    by_hash = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[by_hash], by_hash.astype(U)))  # at most COMMON

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch, data, bounds in parts(batches, 1 << 21, 1_024):
            gram, row = grams(data, bounds, rule.n)
            size = np.bincount(row, minlength=batch.num_rows)
            first = np.cumsum(size) - size
            sums = []
            for salt in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165):
                total = np.concatenate([np.zeros(1, U), np.cumsum(mix(gram ^ U(salt)))])
                sums.append((total[first + size] - total[first]).view(np.int64))
            place = gram.copy()
            if len(known) and len(gram):
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                last = known[at] == gram
                place[last] = (U(1) << U(63)) + rank[at[last]]
            order = np.lexsort((place, row))
            take = rule.prefix(size)
            near = np.arange(len(gram)) - np.repeat(first, size) < np.repeat(take, size)
            bounds_out = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(bounds_out), pa.array(gram[order][near].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(size), pa.array(sums[0]), pa.array(sums[1]), prefix, pa.array(parities(gram, row, size), pa.binary())], names=[ROW, "doc_id", "size", "sig_a", "sig_b", "prefix", "map"])

    return docs.mapInArrow(run, f"{ROW} string, doc_id long, size long, sig_a long, sig_b long, prefix array<long>, map binary")


def regions(classes: DataFrame, rule: Rule) -> DataFrame:
    """pivot, class: of each n-gram in more than one class's window, its classes under its pivot.

    The pivot is the class of least hash, so that regions of one group of near copies have the same."""
    rows = classes.select(F.explode("prefix").alias("gram"), "class", "size").withColumn("turn", F.xxhash64("class"))
    by_size = Window.partitionBy("gram").orderBy("size", "class")
    alike = lambda small, great: rule.den * F.col(small) >= rule.num * F.col(great)
    near = rows.withColumn("less", F.lag("size").over(by_size)).withColumn("more", F.lead("size").over(by_size))
    # Whoever has no partner of a size that allows a link has none in this region.
    dealt = near.where(F.coalesce(alike("less", "size"), F.lit(False)) | F.coalesce(alike("size", "more"), F.lit(False))).sortWithinPartitions("gram", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_gram, last_pivot, told = None, 0, False
        for batch in batches:
            gram, member = (batch.column(c).to_numpy() for c in ("gram", "class"))
            if not len(gram):
                continue
            begin = np.ones(len(gram), bool)
            begin[1:] = gram[1:] != gram[:-1]
            goes_on = gram[0] == last_gram
            begin[0] = not goes_on
            starts = np.flatnonzero(begin)
            group = np.cumsum(begin) - (0 if goes_on else 1)
            pivots = np.concatenate([[last_pivot], member[starts]]) if goes_on else member[starts]
            pivot = pivots[group]
            pairs = np.stack([pivot, member], 1)[pivot != member]
            heads = np.unique(pairs[:, 0])
            out = np.unique(np.concatenate([pairs, np.stack([heads, heads], 1)]), axis=0)
            last_gram, last_pivot = gram[-1], pivot[-1]
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], names=["pivot", "class"])

    return dealt.select("gram", "class").mapInArrow(run, "pivot long, class long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int, size: int = 1 << 22) -> Iterator[pa.Table]:
    """Rows sorted by key, in tables of whole groups with about ``rows`` rows or ``size`` bytes, whichever is less."""
    held: list[pa.RecordBatch] = []
    n = 0
    for whole in batches:
        # Pieces of a batch, so that a table isn't as large as what happens to come at once.
        step = max(1, min(rows, whole.num_rows * size // max(1, whole.nbytes)))
        for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
            held.append(batch)
            n += max(batch.num_rows * size, rows * batch.nbytes)
            keys = batch.column(key).to_numpy()
            if n >= rows * size and (keys[0] != keys[-1] or len(held) > 1 and held[-2].column(key)[-1].as_py() != keys[0]):
                cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
                yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
                held = [batch.slice(cut)]
                n = max(held[0].num_rows * size, rows * held[0].nbytes)
    if held:
        yield pa.Table.from_batches(held)


def _fold(m: bytes) -> np.ndarray:
    """A map of the short length, as 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(m, U).reshape(-1, MAP_BITS[0] // 64), axis=0)


def may_link(size: np.ndarray, maps: list[bytes], rule: Rule) -> np.ndarray:
    """Which members of a region have a partner that neither sizes nor parity maps exclude."""
    n = len(size)
    out = np.zeros(n, bool)
    folded = np.stack([_fold(m) for m in maps])
    wide = {i: np.frombuffer(m, U) for i, m in enumerate(maps) if len(m) * 8 > MAP_BITS[0]}
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        small, great = np.minimum(size[i], size[rest]), np.maximum(size[i], size[rest])
        rest = rest[rule.den * small >= rule.num * great]
        apart = np.bitwise_count(folded[i] ^ folded[rest]).sum(1)
        rest = rest[(rule.den + rule.num) * apart.astype(np.int64) <= (rule.den - rule.num) * (size[i] + size[rest])]
        if i in wide:
            fine = [j for j in rest.tolist() if j not in wide or (rule.den + rule.num) * int(np.bitwise_count(wide[i] ^ wide[j]).sum()) <= (rule.den - rule.num) * (size[i] + size[j])]
            rest = np.array(fine, np.int64)
        if len(rest):
            out[i] = True
            out[rest] = True
    return out


def pruned(placed: DataFrame, rule: Rule, most: int) -> DataFrame:
    """pivot, class, size, gf_row: members that may have a partner in their region. From these and map.

    Regions of more than ``most`` members are left as they are."""

    every = Window.partitionBy("pivot")
    counted = placed.withColumn("members", F.count("*").over(every))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pivot", 4_096):
            pivot = table.column("pivot").to_numpy()
            size, maps = table.column("size").to_numpy(), table.column("map").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
            keep = np.zeros(len(pivot), bool)
            for low, high in zip(starts, np.append(starts[1:], len(pivot)), strict=True):
                keep[low:high] = may_link(size[low:high], maps[low:high], rule)
            yield from table.select(["pivot", "class", "size", ROW]).filter(pa.array(keep)).combine_chunks().to_batches()

    schema = f"pivot long, class long, size long, {ROW} string"
    small = counted.where(F.col("members") <= most).select("pivot", "class", "size", ROW, "map").mapInArrow(prune, schema)
    return small.unionByName(counted.where(F.col("members") > most).select("pivot", "class", "size", ROW))


class Region:
    """Sets of one region, and the links among them as a forest."""

    def __init__(self, gram: np.ndarray, row: np.ndarray, n: int, rule: Rule) -> None:
        self.rule = rule
        _, self.code = np.unique(gram, return_inverse=True)
        self.size = np.bincount(row, minlength=n)
        self.first = np.cumsum(self.size) - self.size
        self.mark = np.zeros(int(self.code.max()) + 1 if len(gram) else 1, bool)
        self.parent = np.arange(n)

    def connect(self, group: np.ndarray) -> None:
        """Members of one group are of one component already."""
        tied = np.flatnonzero(group != NO_GROUP)
        _, first, back = np.unique(group[tied], return_index=True, return_inverse=True)
        self.parent[tied] = tied[first][back]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self, members: np.ndarray) -> np.ndarray:
        out = self.parent[members]
        while not np.array_equal(up := self.parent[out], out):
            out = up
        return out

    def distances(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """To the pivot; members within the radius are linked to it on the way."""
        own = self.code[self.first[pivot] : self.first[pivot] + self.size[pivot]]
        self.mark[own] = True
        size = self.size[members]
        ends = np.cumsum(size)
        flat = np.repeat(self.first[members] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)
        hits = np.concatenate([[0], np.cumsum(self.mark[self.code[flat]])])
        self.mark[own] = False
        inter = hits[ends] - hits[ends - size]
        union = size + len(own) - inter
        for i in np.unique(self.roots(members[self.rule.linked(inter, union)])):
            self.parent[self.root(int(i))] = self.root(pivot)
        return 1 - inter / np.maximum(union, 1)

    def solve(self, kernel: np.ndarray, window: np.ndarray, depth: int = 0) -> None:
        """Link all linked pairs within the kernel and between kernel and window."""
        r = self.rule.radius
        members = np.concatenate([kernel, window])
        if not len(kernel) or len(members) < 2 or len(np.unique(self.roots(members))) < 2:
            return
        if len(members) <= FEW or depth > DEPTH:
            self.one_by_one(kernel, window)
            return
        pivots = kernel[np.unique(np.linspace(0, len(kernel) - 1, PIVOTS).astype(np.int64))]
        d = np.stack([self.distances(int(p), members) for p in pivots])
        nearest, least = d.argmin(0), d.min(0)
        nearest[least >= 1] = len(pivots)
        in_kernel = np.arange(len(members)) < len(kernel)
        children: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(len(pivots)):
            mine = in_kernel & (nearest == i)
            if mine.any():
                later = in_kernel & (nearest > i) & (nearest < len(pivots)) | ~in_kernel
                children.append((members[mine], members[later & (d[i] <= least + 2 * r) & (d[i] <= d[i][mine].max() + r)]))
        far = in_kernel & (nearest == len(pivots))
        children.append((members[far], members[(least >= 1 - r) & ~far]))
        if sum(len(k) + len(w) for k, w in children if len(k)) > SPREAD * len(members):
            # The windows hold nearly all: pivots as close to one another as that are better used singly.
            self.one_by_one(kernel, window)
            return
        for inner, outer in children:
            self.solve(inner, outer, depth + 1)

    def one_by_one(self, kernel: np.ndarray, window: np.ndarray) -> None:
        """One pivot after the other; the triangle inequality drops what can't be linked to any later one."""
        r = self.rule.radius
        while len(kernel) and len(kernel) + len(window) > 1:
            members = np.concatenate([kernel, window])
            if len(np.unique(self.roots(members))) < 2:
                return
            d = self.distances(int(kernel[0]), members)
            own, rest = d[: len(kernel)], d[len(kernel) :]
            # Members within the radius are linked to the pivot and so to one another. Their pairs with the
            # window are settled here; from now on they matter as partners only.
            left = own > r
            left[0] = False
            self.across(kernel[~left][1:], own[~left][1:], window, rest)
            partner, partner_d = np.concatenate([kernel[~left][1:], window]), np.concatenate([own[~left][1:], rest])
            kernel, own = kernel[left], own[left]
            if len(kernel):
                order = np.sort(own)
                near = np.searchsorted(order, partner_d - r) < np.searchsorted(order, partner_d + r, "right")
                window = partner[near]

    def across(self, group: np.ndarray, group_d: np.ndarray, window: np.ndarray, window_d: np.ndarray) -> None:
        """Link linked pairs of group and window, given their distances to one pivot."""
        r = self.rule.radius
        for member, d in zip(group, group_d, strict=True):
            apart = self.roots(window) != self.root(int(member))
            window, window_d = window[apart], window_d[apart]
            if not len(window):
                return
            near = window[np.abs(window_d - d) <= r]
            if len(near):
                self.distances(int(member), near)


def join_regions(table: pa.Table, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """class, root of members that are linked to another one of their region. Whole regions, sorted."""
    gram, row = grams(*utf8(table.column("text")), rule.n)
    pivot, member, kernel, group = (table.column(c).to_numpy() for c in ("pivot", "class", "kernel", "group"))
    starts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
    ends = np.append(starts[1:], len(pivot))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low, high, first, last in zip(starts, ends, np.searchsorted(row, starts), np.searchsorted(row, ends), strict=True):
        region = Region(gram[first:last], row[first:last] - low, high - low, rule)
        every = np.arange(high - low)
        region.connect(group[low:high])
        own = kernel[low:high]
        region.solve(every[own], every[~own])
        root = region.roots(every)
        tied = np.flatnonzero(root != every)
        a.append(member[low + tied])
        b.append(member[low + root[tied]])
    return np.concatenate(a), np.concatenate(b)


def crowded_grams(rows: DataFrame, members: DataFrame, rule: Rule, most: int, known: np.ndarray) -> np.ndarray:
    """n-grams that more than ``most`` members of too large regions hold, rarest first, but for known ones."""
    large = members.groupBy("pivot").count().where(F.col("count") > most)
    if large.isEmpty():
        return np.zeros(0, U)
    crowd = members.join(large, "pivot", "left_semi").select(ROW).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in parts(batches):
            key, n = np.unique(grams(data, bounds, rule.n)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["gram", "n"])

    counted = rows.join(crowd, ROW, "left_semi").select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    top = most_frequent(scratch.cut(counted, "crowded"), "n", COMMON).toPandas().sort_values(["n", "gram"])["gram"].to_numpy(np.int64).astype(U)
    return top[~np.isin(top, known)]


REGION = ("pivot", "class", "kernel", "level", "group", "size", "text")


def links(members: DataFrame, rule: Rule, most: int) -> DataFrame:
    """a, b: links that connect all linked classes. members: pivot, class, size, text."""
    spark = members.sparkSession

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pivot", 1_024):
            a, b = join_regions(table, rule)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    todo = members.select("pivot", "class", F.lit(True).alias("kernel"), F.lit(0).alias("level"), F.lit(NO_GROUP).cast("long").alias("group"), "size", "text")
    found: list[DataFrame] = []
    while True:
        out = scratch.write(todo.select(*REGION), "regions")
        part = spark.read.schema(todo.select(*REGION).schema).parquet(out)
        large = scratch.cut(part.groupBy("pivot").agg(F.count("*").alias("members")).where(F.col("members") > most), "large-regions")
        none = large.isEmpty()
        small = part if none else part.join(large, "pivot", "left_anti")
        found.append(scratch.cut(small.repartition("pivot").sortWithinPartitions("pivot").mapInArrow(in_task, "a long, b long"), "region-links"))
        if none:
            scratch.drop(spark, out)
            break
        # These regions never meet in a task: one step of the recursion for all of them as a job, then again.
        rest = part.join(large, "pivot")
        tied, left = _divide(rest.where("level > 0"), rule)
        found.append(scratch.cut(tied, "pivot-links"))
        todo = scratch.cut(_by_size(rest.where("level = 0"), rule).unionByName(left), "region-rest")
        scratch.drop(spark, out)
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every


def _by_size(part: DataFrame, rule: Rule) -> DataFrame:
    """Regions by size, the distance from the empty set: linked sizes are at most one band apart."""
    band = F.floor(F.log(F.col("size")) / float(np.log(rule.den / rule.num) + 1e-12))
    below = F.struct((band - 1).alias("band"), F.lit(False).alias("kernel"))
    copies = F.explode(F.array(F.struct(band.alias("band"), F.col("kernel").alias("kernel")), below)).alias("to")
    dealt = part.select("pivot", "class", "group", "size", "text", copies)
    out = dealt.select(F.xxhash64("pivot", "to.band").alias("pivot"), "class", "to.kernel", F.lit(1).alias("level"), "group", "size", "text")
    # Bands that are the least of their own only have partners.
    return out.join(out.where("kernel").select("pivot").distinct(), "pivot", "left_semi").select(*REGION)


class Pivots:
    """The pivots of one region, as they come in; n-grams sorted, with whose they are."""

    def __init__(self) -> None:
        self.names: list[int] = []
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, names: list[int], gram: np.ndarray, row: np.ndarray) -> None:
        self.found.append((gram, row + len(self.names)))
        self.names += names

    def settle(self) -> None:
        gram, row = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.argsort(gram, kind="stable")
        self.keys, self.owner, self.sizes = gram[order], row[order], np.bincount(row, minlength=len(self.names))

    def meet(self, gram: np.ndarray, row: np.ndarray, n: int, rule: Rule, width: int) -> tuple[np.ndarray, list[list[int]]]:
        """Of n members their distances to the pivots and the names of those that they are linked to."""
        low, high = np.searchsorted(self.keys, gram), np.searchsorted(self.keys, gram, "right")
        hits = high - low
        hit = self.owner[np.repeat(low - np.cumsum(hits) + hits, hits) + np.arange(int(hits.sum()))]
        inter = np.bincount(np.repeat(row, hits) * len(self.names) + hit, minlength=n * len(self.names)).reshape(n, len(self.names))
        union = np.bincount(row, minlength=n)[:, None] + self.sizes - inter
        distance = np.ones((n, width))
        distance[:, : len(self.names)] = 1 - inter / np.maximum(union, 1)
        return distance, [[self.names[k] for k in np.flatnonzero(x)] for x in rule.linked(inter, union)]


def _met(batches: Iterator[pa.RecordBatch], rule: Rule, width: int) -> Iterator[pa.RecordBatch]:
    """Members with their distances to their region's pivots, which come before them."""
    at, pivots, ready = None, Pivots(), False
    for batch, data, bounds in parts(batches, 1 << 21, 1_024):
        gram, row = grams(data, bounds, rule.n)
        place = [batch.column(c).to_numpy() for c in ("pivot", "salt", "side")]
        cuts = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in place], axis=0)])) if batch.num_rows else []
        for low, high in zip(cuts, np.append(cuts[1:], batch.num_rows), strict=True):
            region, member = (int(place[0][low]), int(place[1][low])), bool(place[2][low])
            if region != at:
                at, pivots, ready = region, Pivots(), False
            own = slice(*np.searchsorted(row, [low, high]))
            if not member:
                pivots.add(batch.column("class")[low:high].to_pylist(), gram[own], row[own] - low)
                continue
            if not ready:
                pivots.settle()
                ready = True
            d, ties = pivots.meet(gram[own], row[own] - low, int(high - low), rule, width)
            mine = batch.slice(low, high - low).select(list(REGION))
            yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(list(d), pa.list_(pa.float64())), pa.array(ties, pa.list_(pa.int64()))], names=[*REGION, "d", "ties"])


def _divide(part: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """One step for regions too large for a task: the links to some pivots, and what is left to be joined.

    To be joined are the pairs of a kernel member and any member that is not of its group. A pivot is
    compared with all members and needs no further join, so kernel members without a group go first;
    then whatever stands on the smaller side of the pairs that are left. Members are dealt out by SPAN
    with a copy of the pivots each; regions' groups, a few times JOB_PIVOTS rows, are settled by region."""
    free = F.col("kernel") & (F.col("group") == NO_GROUP)
    # Rows of each group of a region, and of the window without one: as many as there were pivots at most.
    sides = part.where(~free).groupBy("pivot", "group").agg(F.count("*").alias("others"))
    ranked = part.withColumn("gf_free", free).join(sides, ["pivot", "group"], "left")
    turn = F.struct(F.when(F.col("gf_free"), 0).otherwise(F.col("others")).alias("side"), (F.col("size") > PIVOT_SIZE).alias("long"), F.xxhash64("class").alias("turn"), "class")
    nth = F.row_number().over(Window.partitionBy("pivot").orderBy("t"))
    salts = F.ceil(F.col("members") / SPAN).cast("int")
    picked = ranked.select("pivot", turn.alias("t"), "text", "members").withColumn("nth", nth).where(F.col("nth") <= JOB_PIVOTS)
    heads = picked.select("pivot", F.col("t.class").alias("class"), "text", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("side"))
    dealt = part.select(*REGION, F.pmod(F.xxhash64("class"), salts).cast("int").alias("salt"), F.lit(1).alias("side")).unionByName(heads, allowMissingColumns=True)
    schema = "pivot long, class long, kernel boolean, level int, group long, size long, text string, d array<double>, ties array<long>"
    sorted_ = dealt.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "side", "class")
    width = JOB_PIVOTS
    step = scratch.cut(sorted_.mapInArrow(lambda batches: _met(batches, rule, width), schema), "region-step")
    tied = step.select(F.col("class").alias("a"), F.explode("ties").alias("b")).where("a <> b")
    # Pivots and groups with a tied member in common are one group: JOB_PIVOTS times both at most a region.
    met = step.where(F.size("ties") > 0).select("pivot", "group", F.get("ties", F.lit(0)).alias("a"), "ties")
    edges = met.select("pivot", "a", F.explode("ties").alias("b")).unionByName(met.where(F.col("group") != NO_GROUP).select("pivot", "a", F.col("group").alias("b")))
    names = edges.distinct().groupBy("pivot").applyInArrow(_groups, "pivot long, old long, new long")
    left = step.where(~F.array_contains("ties", F.col("class"))).withColumn("old", F.coalesce(F.get("ties", F.lit(0)), F.col("group")))
    left = left.join(names, ["pivot", "old"], "left").withColumn("group", F.coalesce("new", "group"))
    d = [F.get("d", F.lit(q)) for q in range(JOB_PIVOTS)]
    reach = left.groupBy("pivot", "group", "kernel").agg(F.array(*map(F.min, d)).alias("low"), F.array(*map(F.max, d)).alias("high"))
    sought = reach.groupBy("pivot").applyInArrow(_partners, "pivot long, group long, kernel boolean, low array<double>, high array<double>")
    near = F.forall(F.arrays_zip("d", "low", "high"), lambda x: (x["d"] >= x["low"] - rule.radius) & (x["d"] <= x["high"] + rule.radius))
    # A region without pairs to be joined is done.
    return tied, left.join(sought, ["pivot", "group", "kernel"]).where(near).select(*REGION)


def _groups(edges: pa.Table) -> pa.Table:
    """Of one region, name and name of its component, for edges of two names."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist(), strict=True):
        parent[root(a)] = root(b)
    old = list(parent)
    return pa.table({"pivot": pa.array([edges["pivot"][0].as_py()] * len(old), pa.int64()), "old": pa.array(old, pa.int64()), "new": pa.array(list(map(root, old)), pa.int64())})


def _partners(reach: pa.Table) -> pa.Table:
    """Of one region's groups, by kernel: the least and greatest distances to pivots of what these rows are to be joined with."""
    rows = reach.to_pylist()
    out = []
    for x in rows:
        others = [y for y in rows if (y["group"] != x["group"] or y["group"] == NO_GROUP) and (y["kernel"] or x["kernel"])]
        if others:
            out.append(x | {"low": np.min([y["low"] for y in others], 0).tolist(), "high": np.max([y["high"] for y in others], 0).tolist()})
    return pa.Table.from_pylist(out, schema=reach.schema)


def join(docs: DataFrame, rule: Rule = Rule(), most: int = MOST) -> DataFrame:
    """gf_row, doc_id, n_shingles, component_id of each document, and component: a number that the
    documents of a component share, null for empty sets."""
    rows = with_row(docs.select("doc_id", "text")).select(ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = common_grams(rows, rule)
    every = scratch.cut(sets(rows, rule, common), "sets")
    full = every.where("size > 0")
    signature = ["sig_a", "sig_b", "size"]
    grouped = full.groupBy(*signature).agg(F.min("doc_id").alias("least_id"), F.min(ROW).alias(ROW), F.first("prefix").alias("prefix"), F.first("map").alias("map"))
    classes = scratch.cut(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")

    def placed(classes: DataFrame) -> DataFrame:
        dealt = regions(classes.select("class", "size", "prefix"), rule).join(classes.select("class", "size", ROW, "map"), "class")
        return scratch.cut(pruned(dealt, rule, most), "members")

    members = placed(classes)
    more = crowded_grams(rows, members, rule, most, common)
    if len(more):
        crowded = rows.sparkSession.createDataFrame([(g,) for g in more.astype(np.int64).tolist()], "gram long")
        # Where they aren't among a set's first n-grams, putting them last changes nothing.
        changed = classes.select(ROW, F.explode("prefix").alias("gram")).join(crowded, "gram", "left_semi").select(ROW).distinct()
        again = sets(rows.join(changed, ROW, "left_semi"), rule, np.concatenate([common, more])).select(ROW, F.col("prefix").alias("later"))
        classes = scratch.cut(classes.join(again, ROW, "left").withColumn("prefix", F.coalesce("later", "prefix")).drop("later"), "classes")
        members = placed(classes)
    # Texts are dealt out by place at every size; sending a small member list around instead would make
    # the plan change, and the shuffle jump, somewhere on the way up.
    texts = rows.select(ROW, "text").hint("merge")
    roots = scratch.cut(components(links(members.join(texts, ROW).select("pivot", "class", "size", "text"), rule, most)), "roots")
    named = classes.select("class", "least_id", *signature).join(roots, classes["class"] == roots["node"], "left").withColumn("root", F.coalesce("root", "class"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = named.join(least, "root").select(*signature, F.col("root").alias("component"), "component_id")
    linked = full.join(labels, signature).select(ROW, "doc_id", F.col("size").alias("n_shingles"), "component_id", "component")
    alone = every.where("size = 0").select(ROW, "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return linked.unionByName(alone)
