"""Market identities from cached JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold import schemas
from gridfold.functions.identity import CONDITION, bound_source, hourly_slug, named_asset, outcome, slug_start
from gridfold.functions.timefn import held_ns, iso_to_timestamp
from gridfold.functions.values import apart, canonical_json, json_list, sha256
from gridfold.operators.guards import divergent

_MARKET = "struct<id:string,slug:string,conditionId:string,outcomes:string,clobTokenIds:string,closed:boolean,outcomePrices:string,endDate:string,resolutionSource:string,description:string>"
PAYLOAD = f"array<struct<id:string,markets:array<{_MARKET}>>>"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def bind(payloads: DataFrame) -> DataFrame:
    """One row for each event of the payloads: ``disposition`` and the columns of the markets table.

    Dispositions: ok, gap (no tokens), unresolved, or ``error: ...``; checked in a fixed order, for a gap
    counts only if the identity holds, and an open market only if it has tokens. Start and end are compared as timestamps;
    their nanoseconds are null where BIGINT doesn't hold them (after 2262)."""
    event = payloads.select("payload", F.explode(F.from_json("payload", PAYLOAD)).alias("event"))
    m = event.select("payload", F.col("event.id").alias("event_id"), F.size("event.markets").alias("n"), F.get("event.markets", F.lit(0)).alias("m"))
    rules = F.coalesce("description", F.lit(""))
    read = m.select("payload", "event_id", "n", "m.*").withColumns(
        {
            "start": slug_start(F.col("slug")),
            "tokens": json_list(F.col("clobTokenIds")),
            "outcome": outcome(json_list(F.col("outcomePrices"))),
            "sides": F.transform(json_list(F.col("outcomes")), F.upper),
            "low": F.lower(rules),
        }
    )
    # The payload goes beside: it is wide, and only its digest is asked for.
    flat = apart(read.drop("outcomes", "outcomePrices"), ["payload"]).withColumn("asset", F.when(F.col("start").isNotNull(), named_asset(F.col("slug"))))
    bound = flat.withColumn("source", bound_source(F.col("asset"), rules, F.col("resolutionSource"))).drop("resolutionSource")
    named = apart(bound, ["payload"])
    end = F.col("start") + F.expr("INTERVAL 1 HOUR")
    low = F.col("low")
    falsy = lambda c: F.coalesce(~c, F.lit(True))
    # What must hold, in this order; the first that doesn't names the row's error.
    identity = {
        "an event has one market": F.col("n") == 1,
        "the slug is given": F.col("slug").isNotNull(),
        "the slug is canonical": F.col("start").isNotNull(),
        "the end is an hour after the slug's start": iso_to_timestamp(F.col("endDate")) == end,
        "the outcomes are Up and Down": F.col("sides") == F.array(F.lit("UP"), F.lit("DOWN")),
        "the condition id is 64 hexadecimal digits": F.col("conditionId").rlike(CONDITION),
        "there are rules": F.trim(rules) != "",
        "the rules name the hourly candle": F.col("source").isNotNull(),
        "the rules settle ties": low.contains("greater than or equal") & low.contains("otherwise"),
        "both ids are given": (F.coalesce("event_id", F.lit("")) != "") & (F.coalesce("id", F.lit("")) != ""),
    }
    has_tokens = F.col("clobTokenIds").isNotNull()
    two_tokens = (F.size("tokens") == 2) & F.forall("tokens", lambda t: t.rlike("^[0-9]+$"))
    disposition = (
        F.when(~has_tokens, "gap")
        .when(falsy(two_tokens), "error: not so: there are two numeric tokens")
        .when(falsy(F.col("closed")) | F.col("outcome").isNull(), "unresolved")
        .otherwise("ok")
    )
    for text, holds in reversed(identity.items()):
        disposition = F.when(falsy(holds), F.lit(f"error: not so: {text}")).otherwise(disposition)
    columns = {
        "schema_version": F.lit(schemas.SCHEMA_VERSION), "venue": F.lit("clob"), "timeframe": F.lit("1h"), "market_id": F.col("id"), "condition_id": F.col("conditionId"),
        "market_start_ns": held_ns(F.col("start")), "market_end_ns": held_ns(end),
        "token_up": F.get("tokens", F.lit(0)), "token_down": F.get("tokens", F.lit(1)), "rules_text_sha256": sha256(rules), "resolution_source_url": F.col("source"),
        "official_outcome": F.col("outcome"), "official_resolution_ts_ns": F.lit(None).cast("long"), "quality_tier": F.lit("TIER_A"), "evidence_sha256": sha256(F.col("payload")),
        "exclusion_reason": F.lit(None).cast("string"),
    }
    return named.withColumn("disposition", disposition).withColumns(columns).select("disposition", "slug", *schemas.table("markets").names)


def conflicts(payloads: DataFrame) -> DataFrame:
    """condition_id of markets that several payloads give with different content.

    A payload is parsed once, and its contents are shuffled as digests of their canonical form."""
    whole = F.expr("try_cast(try_parse_json(payload) AS array<variant>)")
    # What doesn't parse as one: the events before the fault count, and a name twice in an event is an error.
    in_parts = F.transform(F.from_json("payload", "array<string>"), F.parse_json)
    event = payloads.select(F.explode(F.coalesce(whole, in_parts)).alias("event"))
    condition = F.try_variant_get("event", "$.markets[0].conditionId", "string")
    named = apart(event.select(condition.alias("condition_id"), sha256(F.to_json("event")).alias("content")))
    return divergent(named.where("condition_id IS NOT NULL"), ["condition_id"], ["content"]).select("condition_id")


def merged(payloads: DataFrame) -> DataFrame:
    """One row a condition of what ``bind`` accepts; a condition with two contents is an error.

    A text that is given several times is parsed once: texts are dealt out before, which costs far less than parsing
    them, and spreads the parsing evenly however the rows were stored."""
    once = payloads.groupBy("payload").agg(F.count("*")).select("payload")
    bad = conflicts(once).withColumnRenamed("condition_id", "gf_condition")
    rows = bind(once).where("disposition = 'ok'").dropDuplicates(["condition_id"])
    joined = rows.join(bad, F.col("condition_id") == F.col("gf_condition"), "left")
    text = F.concat(F.lit("payloads differ on "), "gf_condition")
    return joined.withColumn("condition_id", F.when(F.col("gf_condition").isNull(), F.col("condition_id")).otherwise(F.raise_error(text))).drop("gf_condition")


#: How the published table of exclusions words a market that can't be had.
NO_TOKENS = ("SOURCE_GAP", "official Gamma slot has no tradable CLOB token identity")
NOT_SETTLED = ("UNRESOLVED_MARKET", "official Gamma market has no final outcome")
NOTHING = ("SOURCE_GAP", "official Gamma slug returned no market")


def dispose(expected: DataFrame, payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Markets and exclusions of the expected slots; each slot ends up in one of the two or is an error.

    expected: asset, start (timestamp). payloads: slug, payload, as they were cached, one a slot. A slot
    whose payload holds no event, or that has no payload, is a gap; a payload that names another slot, or
    doesn't bind, is an error."""
    slots = expected.select("asset", "start", hourly_slug(F.col("asset"), F.col("start")).alias("slot"))
    given = payloads.select(F.col("slug").alias("slot"), "payload")
    bound = bind(given.select("payload").distinct()).withColumn("found", F.lit(True))
    joined = slots.join(given, "slot", "left").withColumn("digest", sha256(F.col("payload")))
    every = joined.join(bound.drop("asset"), F.col("digest") == F.col("evidence_sha256"), "left")
    wrong = F.when(F.col("disposition").startswith("error"), F.col("disposition")).when(F.col("found") & ~F.col("slug").eqNullSafe(F.col("slot")), "the payload is another slot's")
    checked = every.withColumn("slot", F.when(wrong.isNotNull(), F.raise_error(F.concat_ws(": ", "slot", wrong))).otherwise(F.col("slot")))
    verdict = F.coalesce("disposition", F.lit("nothing"))
    pick = lambda i: F.when(verdict == "gap", NO_TOKENS[i]).when(verdict == "unresolved", NOT_SETTLED[i]).otherwise(NOTHING[i])
    short = canonical_json(payload_sha256=F.col("digest"))
    full = canonical_json(condition_id=F.col("condition_id"), payload_sha256=F.col("digest"), slug=F.col("slot"))
    named = verdict == "nothing"
    excluded = checked.where(verdict != "ok").select(F.when(named, F.col("slot")).otherwise(F.col("market_id")).alias("market_id"), pick(0).alias("reason_code"), pick(1).alias("detail"), F.when(named, short).otherwise(full).alias("evidence_json"))
    return checked.where(verdict == "ok").select("slot", *schemas.table("markets").names), excluded
