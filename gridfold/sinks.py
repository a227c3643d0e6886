"""Writing, verifying and publishing partitions."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridfold import schemas, tablefiles
from gridfold.operators.guards import GuardError
from gridfold.operators.order import fingerprint
from gridfold.storage import Conflict, Store

MANIFEST = "manifest.json"
#: The phases, and the licence that asks for attribution.
ATTRIBUTED = "CC-BY-4.0"
PHASES = ("INVENTORIED", "ACQUIRED", "TRANSFORMED", "VERIFIED", "PUBLISHED")


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    wide = lambda h: h.cast("decimal(20,0)")
    one, two = fingerprint(sorted(columns))
    return [F.count(F.lit(1)).alias("n"), F.sum(wide(one)).alias("a"), F.sum(wide(two)).alias("b")]


def _digest(x: dict) -> str:
    return hashlib.sha256(f"{x['n']}:{x['a']}:{x['b']}".encode()).hexdigest()


def logical_digest(df: DataFrame) -> str:
    """A digest of the rows whatever their order and files: count and sums of two row hashes."""
    return _digest(df.agg(*_row_hashes(df.columns)).first().asDict())


def write_table(df: DataFrame, name: str, out: str, most_rows: int | None = None, most_bytes: int | None = None) -> dict:
    """Write one of the fixed tables sorted: its rows, logical digest and files.

    The rows are counted and hashed as they are written, and the tasks report each file's rows, bytes and digest, so
    nothing is read again. A table is there whole or not at all: what a crash leaves has another
    name. The same rows again are no change; other rows under the same path are a conflict. More rows or bytes than
    allowed are an error before the table has its name."""
    spark = df.sparkSession
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.table(name)])
    at, leaf = out.rstrip("/").rsplit("/", 1)
    store = Store(spark, at)
    part = f"_{leaf}.{uuid.uuid4().hex[:8]}.part"
    order = schemas.row_order(name)
    seen = Observation()
    ordered = typed.repartitionByRange(*order).sortWithinPartitions(*order).observe(seen, *_row_hashes(typed.columns))
    try:
        tablefiles.write(ordered, store.fs.makeQualified(store._at(part)).toString())
        files = json.loads(store.read(f"{part}/{tablefiles.RECORD}"))
        meant = {"rows": seen.get["n"], "digest": _digest(seen.get)}
        if sum(f["rows"] for f in files) != meant["rows"]:
            raise ValueError(f"{out} was written with other rows than were seen")
        size = sum(f["bytes"] for f in files)
        if most_rows is not None and meant["rows"] > most_rows or most_bytes is not None and size > most_bytes:
            raise GuardError(f"{name} has {meant['rows']} rows in {size} bytes; {most_rows} rows and {most_bytes} bytes are allowed")
        if store.exists(leaf):
            if logical_digest(spark.read.schema(schemas.table(name)).parquet(out)) != meant["digest"]:
                raise Conflict(f"{out} holds other rows")
            files = json.loads(store.read(f"{leaf}/{tablefiles.RECORD}"))
        else:
            store.move(part, leaf)
    finally:
        store.remove(part)
    return meant | {"files": files}


def verify(spark: SparkSession, name: str, path: str, rows: int, digest: str | None = None, files: list[dict] | None = None) -> None:
    """Hold a table's files against its schema and what is on record of its rows and of its files."""
    df = spark.read.parquet(path)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in schemas.table(name)}
    if have != want:
        raise ValueError(f"{path} has other columns than {name}")
    found = df.agg(*_row_hashes(df.columns)).first().asDict()
    if found["n"] != rows or digest is not None and _digest(found) != digest:
        raise ValueError(f"{path} holds other rows than the {rows} on record")
    if files is not None and {f: n for f, n in Store(spark, path).files() if not f.startswith(("_", "."))} != {f["name"]: f["bytes"] for f in files}:
        raise ValueError(f"{path} holds other files than on record")


def verify_partition(spark: SparkSession, path: str) -> dict:
    """Hold a partition's tables against its manifest; the manifest."""
    content = Store(spark, path).read(MANIFEST)
    document = json.loads(content)
    if canonical(document) != content:
        raise ValueError(f"{path}/{MANIFEST} isn't in its canonical form")
    if set(document["tables"]) != set(schemas.TABLES):
        raise ValueError(f"{path}/{MANIFEST} lists {sorted(document['tables'])}")
    for name, on_record in document["tables"].items():
        verify(spark, name, f"{path}/{name}", **on_record)
    return document


def canonical(document: object) -> bytes:
    return (json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n").encode()


def manifest(partition: str, tier: str, tables: dict[str, dict], provenance: list[dict], statistics: dict | None = None) -> dict:
    ordered = sorted(provenance, key=lambda p: (p.get("source_id", ""), p.get("url", ""), p.get("sha256", "")))
    return {"schema_version": schemas.SCHEMA_VERSION, "partition": partition, "quality_tier": tier, "tables": tables, "provenance": ordered, "statistics": statistics or {}}


class StateStore:
    """Phases of partitions as logs of numbered entries: no way back, and what is recorded never changes.

    An entry is made only if its number isn't there yet, so of two that advance a partition at once one is a Conflict.
    An entry that is there is whole, and the last one counts: a crash between any two steps loses nothing."""

    def __init__(self, spark: SparkSession, root: str | Path) -> None:
        self.spark, self.root = spark, str(root).rstrip("/")

    def _log(self, partition: str) -> Store:
        return Store(self.spark, f"{self.root}/{partition.replace('/', '-')}")

    def _last(self, log: Store) -> int:
        return max((int(x.removesuffix(".json")) for x in log.names() if not x.startswith(".") and x.endswith(".json")), default=0)

    def read(self, partition: str) -> dict | None:
        log = self._log(partition)
        last = self._last(log)
        return json.loads(log.read(f"{last:06d}.json")) if last else None

    def history(self, partition: str) -> list[dict]:
        log = self._log(partition)
        return [json.loads(log.read(f"{n:06d}.json")) for n in range(1, self._last(log) + 1)]

    def advance(self, partition: str, phase: str, identity: str, manifest_sha256: str | None = None) -> dict:
        log = self._log(partition)
        last = self._last(log)
        now = json.loads(log.read(f"{last:06d}.json")) if last else None
        if now is not None:
            if now["identity"] != identity:
                raise Conflict(f"{partition} is on record with other inputs")
            if PHASES.index(phase) < PHASES.index(now["phase"]):
                raise Conflict(f"{partition} is {now['phase']} and can't go back to {phase}")
            if now.get("manifest") and manifest_sha256 and now["manifest"] != manifest_sha256:
                raise Conflict(f"{partition} is on record with another manifest")
        state = {"phase": phase, "identity": identity, "manifest": manifest_sha256 or (now or {}).get("manifest")}
        if state != now and not log.create(f"{last + 1:06d}.json", canonical(state)):
            raise Conflict(f"{partition} was advanced by another writer")
        return state


def tree_digest(files: dict[str, bytes]) -> str:
    """A digest of named files; line ends count as \\n."""
    out = hashlib.sha256()
    for name in sorted(files):
        for part in (name.encode(), files[name].replace(b"\r\n", b"\n")):
            out.update(part + b"\0")
    return out.hexdigest()


def folder_bytes(spark: SparkSession, root: str) -> int:
    return sum(size for _, size in Store(spark, root).files())


def release_index(manifests: list[dict], version: str, cutoff_ns: int) -> dict:
    """The partitions of a release by id, each with its manifest's place, length and digest."""
    rows = []
    for m in manifests:
        content = canonical(m)
        asset, frame, day = m["partition"].split("/")
        rows.append({"partition": m["partition"], "manifest_path": f"asset={asset}/timeframe={frame}/date={day}/{MANIFEST}", "byte_length": len(content), "sha256": hashlib.sha256(content).hexdigest()})
    if len({r["partition"] for r in rows}) != len(rows):
        raise Conflict("a partition appears twice")
    return {"schema_version": schemas.SCHEMA_VERSION, "release_version": version, "release_cutoff_ns": cutoff_ns, "partitions": sorted(rows, key=lambda r: r["partition"])}


def notice(sources: list[dict]) -> dict:
    """What must be said of each source that a release includes. sources: source_id, license_class, license, and url and role."""
    included = sorted((s for s in sources if s["license_class"] != "EXCLUDED"), key=lambda s: s["source_id"])
    said = [{"source_id": s["source_id"], "source_url": s.get("url"), "license_id": s["license"], "role": s.get("role"), "attribution_required": s["license"] == ATTRIBUTED} for s in included]
    return {"schema_version": schemas.SCHEMA_VERSION, "combined_dataset_license": None, "sources": said}
