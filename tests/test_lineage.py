"""A partition rebuilt by its lineage equals a full build, and reads and folds only what a change touches."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gridfold import lineage, pipeline, schemas, sinks
from gridfold.operators import guards
from gridfold.sources import events as source
from tests.test_engine import FIELDS, NS, T, change, markets, row, snapshot

DAY = "BTC/1h/2026-05-01"
CONDS = ["0x" + c * 64 for c in "abcdef01"]


def of(market, rows):
    """Rows as another market's, whose tokens are 2k + 1 and 2k + 2."""
    return [r | {"market": CONDS[market].encode(), "asset_id": str(int(r["asset_id"]) + 2 * market)} for r in rows]


def rows_of(*sets):
    return [r for market, rows in sets for r in of(market, rows)]


BOTH = [snapshot("1"), snapshot("2")]
#: File b repeats a's rows of market 3. Market 4 has a row of token 15, which would be market 7's.
FILES = {
    "one": rows_of((0, BOTH), (1, BOTH)),
    "two": rows_of((0, [change(200, "0.45", "5.000000")]), (2, BOTH)),
    "three": rows_of((1, [change(400, "0.44", "2.000000")]), (2, [change(600, "0.43", "3.000000")])),
    "a": of(3, BOTH),
    "b": of(3, BOTH),
    "d": [*rows_of((4, BOTH), (5, BOTH)), of(4, BOTH)[0] | {"asset_id": "15"}],
    "idle": [row(T, T, "book", "99", bids="[]", asks="[]")],
}


def some_markets(spark, *which, **of_five):
    """Markets of a minute, so that grids are short."""
    minute = {"market_end_ns": T * NS + 60_000 * NS}
    rows = [markets(spark, CONDS[k], str(2 * k + 1), str(2 * k + 2), market_id=f"m{k}", **(minute | (of_five if k == 5 else {}))).first() for k in which]
    return spark.createDataFrame(rows, schemas.table("markets")).coalesce(1)


class Archive:
    """Files of rows on disk, with their digests."""

    def __init__(self, spark, root, files):
        self.spark, self.root = spark, root
        for name, rows in files.items():
            spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], schemas.source()).coalesce(1).write.parquet(str(root / f"_{name}"))
            next((root / f"_{name}").glob("*.parquet")).rename(root / f"{name}.parquet")
        self.objects = spark.createDataFrame([(f"{n}.parquet", hashlib.sha256(repr(r).encode()).hexdigest()) for n, r in files.items()], "source_object string, sha256 string")
        self.rows = source.scan(spark, *(str(root / f"{n}.parquet") for n in files))

    def inputs(self, some, **more):
        return pipeline.Inputs(DAY, some, self.rows, objects=self.objects, **more)


class Place:
    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def state(self, name):
        return sinks.StateStore(self.spark, self.path / f"state-{name}")

    def root(self, name):
        return str(self.path / name)

    def build(self, name, inputs):
        return pipeline.build(inputs, self.root(name), self.state(name))

    def rebuild(self, name, earlier, inputs):
        return pipeline.rebuild(inputs, self.root(earlier), self.root(name), self.state(name))

    def digests(self, name):
        base = pipeline.place(self.root(name), DAY)
        tables = {t: self.spark.read.schema(schemas.table(t)).parquet(f"{base}/{t}") for t in (*schemas.TABLES, "lineage")}
        return {t: sinks.logical_digest(df) for t, df in tables.items()}

    def lineage(self, name):
        return self.spark.read.schema(schemas.table("lineage")).parquet(f"{pipeline.place(self.root(name), DAY)}/lineage")


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    return Place(spark, tmp_path_factory.mktemp("lineage"))


@pytest.fixture(scope="module")
def first(spark, at):
    archive = Archive(spark, at.path / "files", FILES)
    at.build("v1", archive.inputs(some_markets(spark, *range(6))))
    return archive


def test_lineage_names_markets_and_objects(at, first):
    got = {}
    for r in at.lineage("v1").collect():
        got.setdefault(r["condition_id"] and CONDS.index(r["condition_id"]), []).append((r["source_object"].removesuffix(".parquet"), r["rows"]))
    assert {k: sorted(v) for k, v in got.items()} == {
        0: [("one", 3), ("two", 3)], 1: [("one", 3), ("three", 3)], 2: [("three", 3), ("two", 3)], 3: [("a", 4), ("b", 4)], 4: [("d", 2)], 5: [("d", 2)], None: [("idle", None)],
    }


def poisoned(files, market):
    """The files with all rows of a market made such that decoding them ends the job."""
    return {n: [r | {"event_type": "nonsense"} if r["market"] == CONDS[market].encode() else r for r in rows] for n, rows in files.items()}


def test_a_rebuild_equals_a_full_build_and_folds_only_what_is_touched(spark, at, first):
    """Market 0 isn't touched: its rows would end the job if anything decoded them. Of the others, 1 loses a row, 2 is no
    longer there, 3's rows are in file b alone, 4's row of token 15 becomes a fault, 5 has another outcome, and 7 is new."""
    files = {k: v for k, v in FILES.items() if k != "a"} | {"three": FILES["three"][1:], "more": of(7, BOTH)}
    some = some_markets(spark, 0, 1, 3, 4, 5, 7, official_outcome="UNRESOLVED")
    good, bad = Archive(spark, at.path / "good", files), Archive(spark, at.path / "bad", poisoned(files, 0))
    limits = pipeline.Limits(rows_a_market=3, events=14)
    at.build("full", good.inputs(some, limits=limits))
    again = pipeline.Inputs(DAY, some, bad.rows, objects=good.objects, limits=limits)
    done = at.rebuild("v2", "v1", again)
    assert not done["no_op"] and done["manifest_document"]["statistics"]["market_count"] == 4
    assert at.digests("v2") == at.digests("full") != at.digests("v1")
    excluded = spark.read.parquet(f"{pipeline.place(at.root('v2'), DAY)}/exclusions").collect()
    assert {(r["market_id"], r["reason_code"]) for r in excluded} == {("m4", "EVENT_CONFLICT"), ("m5", "UNRESOLVED_MARKET")}
    assert "unknown token 15" in str(excluded)
    assert at.rebuild("v2", "v1", again)["no_op"]


def test_poison_ends_a_full_build(spark, at):
    with pytest.raises(Exception, match="no known event"):
        at.build("broken", Archive(spark, at.path / "worse", poisoned(FILES, 0)).inputs(some_markets(spark, 0)))


def test_without_changes_nothing_is_folded(spark, at, first):
    worse = Archive(spark, at.path / "unread", {k: [r | {"event_type": "nonsense"} for r in v] for k, v in FILES.items()})
    at.rebuild("same", "v1", pipeline.Inputs(DAY, some_markets(spark, *range(6)), worse.rows, objects=first.objects))
    assert at.digests("same") == at.digests("v1")


def test_caps_hold_for_the_whole_partition(spark, at, first):
    """The limit on events counts the rows of markets that aren't folded again: 17 in all."""
    with pytest.raises(guards.GuardError):
        at.rebuild("over", "v1", first.inputs(some_markets(spark, *range(6), official_outcome="UNRESOLVED"), limits=pipeline.Limits(events=16)))


def test_objects_need_digests_and_scans_open_changed_files_only(spark, at, first):
    unnamed = pipeline.Inputs(DAY, some_markets(spark, 0, 2), first.rows, objects=first.objects.where("source_object <> 'two.parquet'"))
    with pytest.raises(Exception, match="no digest of two.parquet"):
        at.build("unnamed", unnamed)
    with pytest.raises(ValueError, match="digests"):
        at.rebuild("undigested", "v1", pipeline.Inputs(DAY, some_markets(spark, 0, 2), first.rows))
    one = spark.createDataFrame([("two.parquet",)], "source_object string")
    df = source.of_objects(first.rows, one)
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    scan = plan.collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 1


def test_changed_objects_and_reasons(spark):
    before = spark.createDataFrame([("c1", 1, 1, "1", "2", "a", "x", 3), ("c1", 1, 1, "1", "2", "b", "y", 3), (None, None, None, None, None, "idle", "z", None), ("c2", 1, 1, "3", "4", None, None, 0)], schemas.table("lineage"))
    now = spark.createDataFrame([("a", "x"), ("b", "other"), ("idle", None), ("new", "n")], "source_object string, sha256 string")
    assert {tuple(r) for r in lineage.changed_objects(before, now).collect()} == {("b", "changed"), ("idle", "changed"), ("new", "added")}
    assert {tuple(r) for r in lineage.changed_objects(before, now.limit(0)).collect()} == {("a", "absent"), ("b", "absent"), ("idle", "absent")}
    assert lineage.changed_objects(before.limit(0), now.limit(0)).count() == 0
