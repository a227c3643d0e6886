"""Joins and key-set comparisons that the pipeline needs, as plans that Catalyst can see through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_ids(events: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose value in each column is among the keys' values there: independent semi joins.

    No broadcast hint: adaptive execution broadcasts a key set that is measured to be small."""
    for c in columns:
        events = events.join(keys.select(c).where(F.col(c).isNotNull()), c, "left_semi")
    return events


def keep_owned_tokens(events: DataFrame, markets: DataFrame, groups: Sequence[str] = ("asset",)) -> DataFrame:
    """Rows by group (an asset) whose condition and token both are among that group's: F(asset, condition) and
    F(asset, token), where ``keep_ids`` would take any pair. Rows get the group's columns."""
    conditions = markets.select(*groups, "condition_id")
    tokens = markets.select(*groups, F.explode(F.array("token_up", "token_down")).alias("token_id")).distinct()
    return events.join(conditions, "condition_id").join(tokens, [*groups, "token_id"], "left_semi")


def in_window(events: DataFrame, windows: DataFrame, key: str, time: str, start: str, end: str) -> DataFrame:
    """Rows within their key's half-open window: an equi join whose residual condition is the range."""
    w = windows.select(F.col(key).alias("gf_key"), F.col(start).alias("gf_start"), F.col(end).alias("gf_end"))
    hit = (F.col(key) == F.col("gf_key")) & (F.col(time) >= F.col("gf_start")) & (F.col(time) < F.col("gf_end"))
    return events.join(w, hit, "left_semi")


def overlapping(left: DataFrame, right: DataFrame, l_bounds: tuple[str, str], r_bounds: tuple[str, str], width: int) -> DataFrame:
    """Pairs of intervals that overlap, by equi join on cells of ``width``; each pair once.

    An interval goes to each cell that it meets; the pair is kept in the later of both first cells."""
    cell = lambda a, b: F.explode(F.sequence(F.expr(f"{a} div {width}"), F.expr(f"({b} - 1) div {width}")))
    a = left.where(F.col(l_bounds[0]) < F.col(l_bounds[1])).withColumn("gf_cell", cell(*l_bounds))
    b = right.where(F.col(r_bounds[0]) < F.col(r_bounds[1])).withColumn("gf_cell", cell(*r_bounds))
    both = a.join(b, "gf_cell").where((F.col(l_bounds[0]) < F.col(r_bounds[1])) & (F.col(r_bounds[0]) < F.col(l_bounds[1])))
    own = F.greatest(F.expr(f"{l_bounds[0]} div {width}"), F.expr(f"{r_bounds[0]} div {width}"))
    return both.where(F.col("gf_cell") == own).drop("gf_cell")


def require_few(pairs: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """``pairs`` as they are; more than ``most`` rows of one key are an error."""
    n = F.count("*").over(Window.partitionBy(*keys))
    text = F.concat_ws(" ", F.lit(f"more than {most} rows of"), *[F.col(k).cast("string") for k in keys])
    return pairs.withColumn("gf_n", F.when(n > most, F.raise_error(text)).otherwise(n)).where("gf_n > 0").drop("gf_n")


def owned(events: DataFrame, owners: DataFrame, key: str, owner: str) -> DataFrame:
    """Each row with its key's owner; a row without one is an error."""
    joined = events.join(owners.select(key, owner), key, "left")
    text = F.concat(F.lit(f"no {owner} for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return joined.withColumn(owner, F.when(F.col(owner).isNotNull(), F.col(owner)).otherwise(F.raise_error(text)))


def missing(plan: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plan rows that aren't done."""
    return plan.join(done.select(*keys), list(keys), "left_anti")


def compare_sets(expected: DataFrame, found: DataFrame, key: str, first: int = 10) -> DataFrame:
    """side ('missing' or 'unexpected') and key, the first few of each."""
    e, f = expected.select(key).distinct().withColumn("e", F.lit(True)), found.select(key).distinct().withColumn("f", F.lit(True))
    sides = e.join(f, key, "full").select(F.when(F.col("f").isNull(), "missing").when(F.col("e").isNull(), "unexpected").alias("side"), key)
    pick = lambda s: sides.where(F.col("side") == s).orderBy(key).limit(first)
    return pick("missing").unionByName(pick("unexpected"))


def dispositions(expected: DataFrame, accepted: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """key, disposition: accepted, excluded, both (an error), none (an error) or unplanned (an error)."""
    flag = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    joined = flag(expected, "e").join(flag(accepted, "a"), key, "full").join(flag(excluded, "x"), key, "full")
    state = F.when(F.col("e").isNull(), "unplanned").when(F.col("a") & F.col("x"), "both").when(F.col("a"), "accepted").when(F.col("x"), "excluded").otherwise("none")
    return joined.select(key, state.alias("disposition"))


def changed(expected: DataFrame, found: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, field of found rows that differ from the expected row in a field; nulls are values."""
    e = expected.select(F.col(key).alias("gf_key"), F.struct(*fields).alias("gf_e"))
    both = found.join(e, F.col(key) == F.col("gf_key"))
    names = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"gf_e.{f}")), F.lit(f)) for f in fields]))
    return both.select(key, F.explode(names).alias("field"))


def same_pairs(expected: DataFrame, found: DataFrame, key: str = "condition_id", tokens: tuple[str, str] = ("token_up", "token_down")) -> DataFrame:
    """side, key of markets whose condition and set of tokens only one side has."""
    of = lambda df, name: df.select(key, pair_identity(*map(F.col, tokens)).alias("gf_pair")).distinct().withColumn(name, F.lit(True))
    both = of(expected, "e").join(of(found, "f"), [key, "gf_pair"], "full")
    return both.where("e IS NULL OR f IS NULL").select(F.when(F.col("f").isNull(), "missing").otherwise("unexpected").alias("side"), key)


def pair_identity(a: Column, b: Column) -> Column:
    """Two tokens as a set."""
    return F.array_sort(F.array(a, b))
