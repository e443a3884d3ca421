"""Text and JSON expressions of the evidence side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(c: Column) -> Column:
    """Lower case, without white space of any kind at both ends."""
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def collapsed(c: Column) -> Column:
    """Lower case, runs of white space as one space."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def stratum(c: Column) -> Column:
    """What follows the last colon; without one: unspecified."""
    return F.when(F.contains(c, F.lit(":")), F.element_at(F.split(c, ":"), -1)).otherwise(F.lit("unspecified"))


def parsed_utc(c: Column) -> Column:
    """ISO 8601 with a zone; null where none is given."""
    return F.when(F.regexp_like(c, F.lit(r"(Z|[+-]\d\d:?\d\d)$")), F.try_to_timestamp(c))


def is_sha256(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit("^[0-9a-f]{64}$")), F.lit(False))


def points(response_bytes: Column, unit: int = 100_000, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.ceil(response_bytes / unit)).cast("bigint")


def json_shape(c: Column) -> Column:
    """Schema of a JSON text as DDL, for shape fingerprints."""
    return F.sha2(F.schema_of_variant(F.try_parse_json(c)).cast("binary"), 256)


def provider_entities(payload: Column) -> Column:
    """Entity ids listed in a payload under any of the usual names, in order, without repeats."""
    item = "array<struct<entity_id:string,entityId:string,id:string,rank:int>>"
    shape = f"struct<entities:{item},items:{item},data:{item}>"
    p = F.from_json(payload, shape)
    rows = F.coalesce(p["entities"], p["items"], p["data"], F.array())
    return F.array_distinct(F.filter(F.transform(rows, lambda x: F.coalesce(x["entity_id"], x["entityId"], x["id"])), lambda x: x.isNotNull()))
