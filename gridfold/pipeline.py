"""From archives and markets to the five tables of a partition, as one lazy plan and five writes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold import lineage, schemas, sinks
from gridfold.operators import book, grid, guards, order, quality
from gridfold.sources import events as source
from gridfold.storage import Store

STEP_NS = 200_000_000


@dataclass
class Limits:
    """What a partition may have at most; each is optional, and an error where it is exceeded, never a cut.

    rows_a_market and events count what the archive has, repeats too, in the same pass that drops them; the others are
    held against what a table's tasks have written before it gets its name."""

    rows_a_market: int | None = None
    events: int | None = None
    samples: int | None = None
    underlying_rows: int | None = None
    bytes: int | None = None

    def of_table(self, name: str) -> int | None:
        return {"book_200ms": self.samples, "underlying": self.underlying_rows}.get(name)


@dataclass
class Inputs:
    """What a partition is built from. rows: the archive's scan; markets: the markets table's columns. objects: source_object
    and sha256 of the archive's files, with which the build keeps its lineage."""

    partition: str
    markets: DataFrame
    rows: DataFrame
    exclusions: DataFrame | None = None
    underlying: DataFrame | None = None
    objects: DataFrame | None = None
    provenance: list[dict] = field(default_factory=list)
    limits: Limits = field(default_factory=Limits)


@dataclass
class Tables:
    markets: DataFrame
    book_events: DataFrame
    book_200ms: DataFrame
    underlying: DataFrame
    exclusions: DataFrame
    lineage: DataFrame | None = None
    kept: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


def sample(states: DataFrame, markets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples on the grid of each market's tokens, and the leading gaps."""
    tokens = markets.select("condition_id", F.explode(F.array("token_up", "token_down")).alias("token_id"), F.col("market_start_ns").alias("start"), F.col("market_end_ns").alias("end"))
    placed = states.join(tokens, ["condition_id", "token_id"])
    samples = grid.asof_grid(placed, ["condition_id", "token_id"], "receive_ts_ns", ["sequence"], STEP_NS, grid="grid_ts_ns")
    gaps = grid.leading_gaps(tokens, samples, ["condition_id", "token_id"], grid="grid_ts_ns")
    return samples, gaps


def transform(inputs: Inputs, tokens: DataFrame | None = None) -> Tables:
    """The five tables and the lineage, lazily. Only the fold runs Python; events are shuffled once, by token. tokens: of
    all markets of the partition, if ``inputs`` has only some.

    Events and what the fold gives are read by several tables and kept on the executors' disks until
    ``Tables.release``; a lost part is worked out again."""
    spark = inputs.markets.sparkSession
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.DISK_ONLY))
        return kept[-1]

    selected = source.select_rows(inputs.rows, inputs.markets, tokens=tokens)
    about = lineage.about() if inputs.objects is not None else {lineage.COPIES: F.count("*")}
    counted = keep(order.distinct_events(source.strict(source.decode(selected)), about))
    for keys, cap in ((["condition_id"], inputs.limits.rows_a_market), ([], inputs.limits.events)):
        if cap is not None:
            guards.require_cap(counted, keys, cap, lineage.COPIES)  # of what is kept anyway: the archive is scanned once
    distinct = counted.drop(*about)
    fed = lineage.of_markets(inputs.markets, counted, inputs.objects) if inputs.objects is not None else None
    ordered = order.number_events(distinct)
    folded = keep(book.rebuilt(ordered, STEP_NS))
    states, errors = book.states_of(folded), book.errors_of(folded)
    foreign = distinct.join(inputs.markets.select("condition_id", F.array("token_up", "token_down").alias("own")), "condition_id").where(~F.array_contains("own", F.col("token_id")))
    unknown = foreign.groupBy("condition_id").agg(F.min("token_id").alias("token_id")).select("condition_id", "token_id", F.lit("EVENT_CONFLICT").alias("error_kind"), F.concat(F.lit("unknown token "), "token_id").alias("error"))
    samples, gaps = sample(states, inputs.markets)
    # A fold's error comes first: states are only looked at once all tokens have been rebuilt.
    unknown = unknown.join(errors.select("condition_id").distinct(), "condition_id", "left_anti")
    accepted, excluded = quality.classify(inputs.markets, errors.unionByName(unknown), gaps, distinct)
    accepted = keep(accepted)
    good = accepted.select("condition_id")
    if inputs.exclusions is not None:
        excluded = excluded.unionByName(inputs.exclusions)
    shown = samples.join(good, "condition_id", "left_semi").select(
        "condition_id", "token_id", "grid_ts_ns", F.col("source_ts_ns").alias("asof_source_ts_ns"), F.col("receive_ts_ns").alias("asof_receive_ts_ns"), "bids", "asks",
        grid.staleness("grid_ts_ns", "receive_ts_ns", 1_000_000).alias("stale_ms"), F.col("sequence").alias("source_event_sequence"), F.lit("TIER_A").alias("quality_tier"), F.lit(200).alias("native_interval_ms"),
    )
    underlying = inputs.underlying if inputs.underlying is not None else spark.createDataFrame([], schemas.table("underlying"))
    return Tables(accepted, ordered.join(good, "condition_id", "left_semi"), shown, underlying, excluded, fed, kept)


def identity(inputs: Inputs) -> str:
    of = [inputs.partition, sinks.logical_digest(inputs.markets), inputs.provenance]
    return hashlib.sha256(sinks.canonical(of if inputs.objects is None else [*of, sinks.logical_digest(inputs.objects)])).hexdigest()


def place(root: str, partition: str) -> str:
    asset, frame, day = partition.split("/")
    return f"{root}/asset={asset}/timeframe={frame}/date={day}"


def build(inputs: Inputs, root: str, state: sinks.StateStore) -> dict:
    """Write, verify and record a partition; a verified one with the same identity is left alone."""
    return _build(inputs, root, state, transform)


def rebuild(inputs: Inputs, earlier: str, root: str, state: sinks.StateStore) -> dict:
    """Build a partition from another version of its sources or markets, folding only the markets that these touch.

    ``earlier`` is the root that has the partition's last version with its lineage. Rows of the other markets are taken from
    there, and the result has the digests that a full build has. Of the archive only objects that were added or changed are
    read, and then the rows of touched markets; all objects are searched for tokens that only one version of the markets has.
    A new version goes under a new root: what is on record never changes. ``inputs.exclusions`` are of markets that aren't
    among ``inputs.markets``. Without changes nothing is folded; without an earlier lineage it is an error."""
    if inputs.objects is None:
        raise ValueError("a rebuild goes by the digests of the source objects")
    return _build(inputs, root, state, lambda new: _renewed(new, place(earlier, inputs.partition)))


def _renewed(inputs: Inputs, base: str) -> Tables:
    spark = inputs.markets.sparkSession
    old = lambda name: spark.read.schema(schemas.table(name)).parquet(f"{base}/{name}")
    before = old("lineage")
    changed = lineage.changed_objects(before, inputs.objects).persist(StorageLevel.DISK_ONLY)
    fed = source.select_rows(source.of_objects(inputs.rows, changed.where("change <> 'absent'")), inputs.markets).select("condition_id")
    tokens = lineage.changed_tokens(before, inputs.markets)
    if not tokens.isEmpty():
        fed = fed.unionByName(source.select_rows(inputs.rows, inputs.markets, tokens=tokens).select("condition_id"))
    touched = lineage.touched(before, inputs.markets, changed, fed).persist(StorageLevel.DISK_ONLY)
    among = lambda df, how: df.join(touched.select("condition_id"), "condition_id", how)
    stay = among(inputs.markets, "left_anti").select("condition_id", "market_id")
    as_before = lambda df, key="condition_id": df.join(stay.select(key), key, "left_semi")
    limits = inputs.limits
    if limits.events is not None:
        rows = as_before(before).groupBy("condition_id").agg(F.max("rows").alias("rows")).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        limits = replace(limits, events=limits.events - rows)
    tables = transform(replace(inputs, markets=among(inputs.markets, "left_semi"), limits=limits), source.tokens_of(inputs.markets))
    return replace(
        tables,
        markets=tables.markets.unionByName(as_before(old("markets"))),
        book_events=tables.book_events.select(*schemas.table("book_events").names).unionByName(as_before(old("book_events"))),
        book_200ms=tables.book_200ms.unionByName(as_before(old("book_200ms"))),
        exclusions=tables.exclusions.unionByName(as_before(old("exclusions"), "market_id")),
        lineage=tables.lineage.unionByName(as_before(before)),
        kept=[*tables.kept, touched, changed],
    )


def _build(inputs: Inputs, root: str, state: sinks.StateStore, tables_of: Callable[[Inputs], Tables]) -> dict:
    who = identity(inputs)
    now = state.read(inputs.partition)
    if now and now["identity"] == who and now["phase"] in ("VERIFIED", "PUBLISHED"):
        return {"partition": inputs.partition, "no_op": True, **now}
    state.advance(inputs.partition, "INVENTORIED", who)
    spark = inputs.markets.sparkSession
    base = place(root, inputs.partition)
    tables = tables_of(inputs)
    state.advance(inputs.partition, "ACQUIRED", who)
    found: dict[str, dict] = {}
    try:
        for name in schemas.TABLES:
            so_far = sum(f["bytes"] for t in found.values() for f in t["files"])
            left = None if inputs.limits.bytes is None else inputs.limits.bytes - so_far
            found[name] = sinks.write_table(getattr(tables, name), name, f"{base}/{name}", inputs.limits.of_table(name), left)
        if tables.lineage is not None:
            sinks.write_table(lineage.whole(tables.lineage, inputs.objects), "lineage", f"{base}/lineage")
    finally:
        tables.release()
    if not found["markets"]["rows"] and not found["exclusions"]["rows"]:
        raise ValueError(f"{inputs.partition} has neither a market nor a reason for having none")
    state.advance(inputs.partition, "TRANSFORMED", who)
    read = lambda name: spark.read.schema(schemas.table(name)).parquet(f"{base}/{name}")
    statistics = quality.statistics(read("markets"), read("exclusions"), read("book_200ms")).first().asDict()
    document = sinks.manifest(inputs.partition, quality.partition_tier(read("markets")), found, inputs.provenance, statistics)
    content = sinks.canonical(document)
    Store(spark, base).write(sinks.MANIFEST, content)
    sinks.verify_partition(spark, base)
    digest = hashlib.sha256(content).hexdigest()
    return {"partition": inputs.partition, "no_op": False, "manifest_document": document, **state.advance(inputs.partition, "VERIFIED", who, digest)}
