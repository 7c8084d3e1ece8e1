"""Schemas: from an example record, and conforming rows to them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDENING = {("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double"), ("smallint", "bigint"), ("smallint", "int")}


def type_of_example(value: Any) -> T.DataType:
    """Spark type of an example value; dicts become structs with sorted fields."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, Mapping):
        return T.StructType([T.StructField(k, type_of_example(value[k]), True) for k in sorted(value)])
    if isinstance(value, (list, tuple)):
        kinds = {type_of_example(v).simpleString() for v in value}
        if len(kinds) != 1:
            raise ValueError("an example list needs values of exactly one type")
        return T.ArrayType(type_of_example(value[0]), True)
    raise TypeError(f"no Spark type for example value {value!r}")


def schema_from_example(record: Mapping[str, Any]) -> T.StructType:
    return type_of_example(record)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _conformed(value: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """A value as the wanted type, field by field inside structs and element by element inside arrays."""
    if have.simpleString() == "void":
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        types = {f.name: f.dataType for f in have}
        fields = [
            (_conformed(value.getField(f.name), types[f.name], f.dataType, f"{name}.{f.name}") if f.name in types
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        if have.elementType.simpleString() == want.elementType.simpleString():
            return value.cast(want)
        return F.transform(value, lambda v: _conformed(v, have.elementType, want.elementType, name + "[]")).cast(want)
    got, asked = have.simpleString(), want.simpleString()
    if got == asked or (got, asked) in WIDENING:
        return value.cast(want)
    raise TypeError(f"column {name}: {got} does not conform to {asked}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, also inside structs and arrays: missing ones null, extra ones dropped.

    Integers widen to doubles; every other change of type is an error at planning time.
    """
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def parse_json(text: Column, schema: T.StructType, strict: bool = False) -> Column:
    """JSON text as a struct; strict mode raises on malformed rows."""
    return F.from_json(text, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def payload_field(properties: Column, key: str) -> Column:
    """One payload key as text."""
    return F.get_json_object(properties, f"$['properties']['{key}']")
