"""JSON text <-> columns. Each JSON column is parsed once into a typed struct."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_scalar(col: Column, path: str) -> Column:
    """Scalar at ``path``; NULL for objects, arrays and text that is not JSON."""
    value = F.get_json_object(col, path)
    nested = F.json_object_keys(value).isNotNull() | F.json_array_length(value).isNotNull()
    # The JSON checks are evaluated only for the few values that open like an object or array.
    return F.when(value.rlike(r"^\s*[\[{]") & nested, F.lit(None).cast("string")).otherwise(value)


def is_json_array(col: Column) -> Column:
    return F.ltrim(col).startswith("[")


def json_list(col: Column, item: T.DataType) -> Column:
    """A JSON array as typed items; NULL unless the text is an array.

    The guard matters: parsing an object as an array of structs gives one all-NULL item.
    """
    return F.when(is_json_array(col), F.from_json(col, T.ArrayType(item)))


def json_items(col: Column, item: T.DataType, field: str = "items") -> Column:
    """Items of ``{field: [..]}`` or of a bare array, whichever the text holds."""
    wrapper = T.StructType([T.StructField(field, T.ArrayType(item))])
    return F.when(is_json_array(col), F.from_json(col, T.ArrayType(item))).otherwise(
        F.from_json(col, wrapper)[field]
    )


def json_texts(col: Column) -> Column:
    """Elements of a JSON array, each kept as JSON text."""
    return json_list(col, T.StringType())


def nested_to_json(df: DataFrame) -> DataFrame:
    """Every struct, array or map column as JSON text, scalars untouched."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        [
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else f.name
            for f in df.schema.fields
        ]
    )


def json_or_empty(col: Column, empty: str) -> Column:
    """A nested value as JSON text, ``{}`` or ``[]`` where it is missing."""
    return F.coalesce(F.to_json(col), F.lit(empty))


def shaped(df: DataFrame, columns: Sequence[str], nested: Mapping[str, str]) -> DataFrame:
    """Exactly ``columns``, in order. Those in ``nested`` become JSON text, the given empty value where
    they are missing, unless they were landed as text; an absent plain column is NULL."""
    present = set(df.columns)

    def field(name: str) -> Column:
        if name not in present:
            return F.lit(nested.get(name)).cast("string").alias(name)
        value = F.col(name)
        if name in nested and df.schema[name].dataType == T.StringType():
            value = F.coalesce(value, F.lit(nested[name]))
        elif name in nested:
            value = json_or_empty(value, nested[name])
        return value.alias(name)

    return df.select([field(c) for c in columns])


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; missing stays NULL."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
