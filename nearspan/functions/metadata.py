"""Metadata JSON as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_MAP = "map<string,string>"
VARIANT_MAP = "map<string,variant>"


def empty_map() -> Column:
    return F.create_map().cast(TEXT_MAP)


def parse_metadata(json: Column) -> Column:
    """JSON object text to a map of texts; anything else gives an empty map."""
    return F.coalesce(F.from_json(json, TEXT_MAP), empty_map())


def parse_metadata_typed(json: Column) -> Column:
    """JSON object text to a map of variants, which keep their JSON types; anything else gives an empty map."""
    return F.coalesce(F.from_json(json, VARIANT_MAP), F.from_json(F.lit("{}"), VARIANT_MAP))


def read_key(json: Column, key: str) -> Column:
    """Text of a key; a dot walks into nested objects; JSON null and absent are both NULL."""
    return F.get_json_object(json, f"$.{key}")


def extract_key(json: Column, key: str, dtype: T.DataType) -> Column:
    """Typed value of a top-level key; a value that does not fit the type gives NULL."""
    return F.try_variant_get(F.try_parse_json(json), f"$['{key}']", dtype.simpleString())


def without_keys(json: Column, typed: Mapping[str, T.DataType]) -> Column:
    """The JSON object without the keys whose values fit their types; all other values keep their JSON type.

    A value that does not fit stays, so that it is not lost and a check of the rows can find it.
    """
    whole = F.from_json(json, "map<string,variant>")
    gone = [
        F.when(extract_key(json, name, dtype).isNotNull() | read_key(json, name).isNull(), F.lit(name))
        for name, dtype in typed.items()
    ]
    rest = F.map_filter(whole, lambda k, v: ~F.coalesce(F.array_contains(F.array(*gone), k), F.lit(False)))
    return F.coalesce(F.to_json(rest), F.lit("{}"))


def overlay(base: Column, values: dict[str, Column]) -> Column:
    """Map ``base`` with the non-null values put over it; a NULL value leaves ``base`` as it is."""
    return _put_over(base, {name: value.cast("string") for name, value in values.items()})


def overlay_typed(base: Column, values: dict[str, tuple[Column, T.DataType]]) -> Column:
    """The same for a map of variants; each value is given with its type and keeps it.  A JSON null stays."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return _put_over(
        base,
        {
            name: F.to_variant_object(value) if isinstance(dtype, nested) else value.cast("variant")
            for name, (value, dtype) in values.items()
        },
    )


def _put_over(base: Column, values: dict[str, Column]) -> Column:
    if not values:
        return base
    pairs = F.map_from_arrays(F.array(*[F.lit(name) for name in values]), F.array(*values.values()))
    present = F.map_filter(pairs, lambda k, v: v.isNotNull())
    kept = F.map_filter(base, lambda k, v: ~F.coalesce(F.map_contains_key(present, k), F.lit(False)))
    return F.map_concat(kept, present)


def public_keys(metadata: Column) -> Column:
    """Without the keys that start with an underscore."""
    return F.map_filter(metadata, lambda k, v: ~F.startswith(k, F.lit("_")))
