"""Decimals, depth levels, JSON and digests as native expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridfold.schemas import LEVELS, PRICE, SIZE


def decimal(text: Column, kind: str) -> Column:
    """The value, or null if it isn't a finite decimal or has more digits than the type keeps."""
    wide = text.try_cast("decimal(38,18)")
    exact = text.try_cast(kind)
    return F.when(wide == exact, exact)


def lossless(value: Column, kind: str) -> Column:
    """Whether a value fits a decimal type as it is: Spark's cast would round it."""
    return F.coalesce(value.try_cast("decimal(38,18)") == value.try_cast(kind), F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def apart(df: DataFrame, beside: Sequence[str] = ()) -> DataFrame:
    """``df`` as it is, with a plan that later expressions only name its columns of: else the optimizer would
    write out wide expressions again wherever their columns are used. beside: plain columns that stay out of the
    row that is made here, so that they aren't copied where nobody asks for them."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in beside])
    return df.select(*beside, F.explode(F.array(row)).alias("gf_row")).select(*beside, "gf_row.*")


def parsed_levels(text: Column, side: str) -> Column:
    """Depth from JSON, either [["p","s"], ...] or [{"price": p, "size": s}, ...]: a struct of levels and error.

    Best price first. Exactly one of the two is null."""
    sign = -1 if side == "bids" else 1
    order = lambda a, b: F.when(a["price"] < b["price"], -sign).when(a["price"] > b["price"], sign).otherwise(0)
    typed = lambda price, size: F.struct(decimal(price, PRICE).alias("price"), decimal(size, SIZE).alias("size"))
    is_pairs = text.rlike(r"^\s*\[\s*(\[|\])")

    def checked(x: Column) -> Column:
        error = (
            F.when(text.isNull(), F.lit(f"no {side} in a snapshot"))
            .when(x["levels"].isNull() | ~text.rlike(r"^\s*\["), F.lit(f"{side} are no JSON array"))
            .when(x["odd"], F.lit(f"a level of {side} is no pair"))
            .when(F.exists(x["levels"], lambda v: v["price"].isNull() | v["size"].isNull()), F.lit("a level is no decimal of this type"))
            .when(F.exists(x["levels"], lambda v: (v["price"] < 0) | (v["price"] > 1) | (v["size"] < 0)), F.lit("a level is beyond its bounds"))
            .when(F.exists(x["levels"], lambda v: v["size"] == 0), F.lit("a snapshot has a level of size 0"))
            .when(F.size(F.array_distinct(F.transform(x["levels"], lambda v: v["price"]))) != F.size(x["levels"]), F.lit("a snapshot has a price twice"))
        )
        return let(error, lambda e: F.struct(F.when(e.isNull(), F.array_sort(x["levels"], order)).cast(LEVELS).alias("levels"), e.alias("error")))

    of_pairs = let(
        F.from_json(text, "array<array<string>>"),
        lambda raw: F.struct(F.transform(raw, lambda v: typed(F.get(v, 0), F.get(v, 1))).alias("levels"), F.coalesce(F.exists(raw, lambda v: F.size(v) != 2), F.lit(False)).alias("odd")),
    )
    of_things = F.struct(F.transform(F.from_json(text, "array<struct<price:string,size:string>>"), lambda v: typed(v["price"], v["size"])).alias("levels"), F.lit(False).alias("odd"))
    return let(F.when(is_pairs, of_pairs).otherwise(of_things), checked)


def levels(text: Column, side: str) -> tuple[Column, Column]:
    """The two parts of ``parsed_levels``."""
    both = parsed_levels(text, side)
    return both["levels"], both["error"]


def canonical_json(**fields: Column) -> Column:
    """A JSON object with sorted keys and no spaces; nulls stay."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def json_list(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def content_name_of(partition: str, filename: str, digest: str) -> str:
    """The name that a partition's file is published under: ``BTC--1h--2026-05-01--<digest>--markets.parquet``."""
    return "--".join((partition.replace("/", "--"), digest, filename))


def content_name(partition: Column, filename: Column, digest: Column) -> Column:
    """``content_name_of`` of columns."""
    return F.concat_ws("--", F.replace(partition, F.lit("/"), F.lit("--")), digest, filename)


def digest_of(name: Column) -> Column:
    """The digest in a published name, the last part but one; null if there is none."""
    found = F.regexp_extract(name, r"^.*--([0-9a-f]{64})--(?:(?!--).)*$", 1)
    return F.when(found != "", found)


def decimals_as_text(value: Column, kind: T.DataType) -> Column:
    """A value with every decimal in it, at any depth, spelled out."""
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: decimals_as_text(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[decimals_as_text(value[f.name], f.dataType).alias(f.name) for f in kind]))
    return value
