"""JSON text out of columns and columns out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _no_nan(value: Column, kind: DataType | None) -> Column:
    if kind is not None and kind.typeName() in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value


def json_object(
    fields: dict[str, Column],
    types: dict[str, DataType] | None = None,
    spaced: bool = False,
) -> Column:
    """One JSON object per row: keys in the given order, nulls written, text not escaped
    to ASCII.

    Columns listed in ``types`` as floating point have NaN written as null. The compact
    form is the default; ``spaced`` puts a blank after each comma and colon.
    """
    types = types or {}
    values = {key: _no_nan(value, types.get(key)) for key, value in fields.items()}
    keep_nulls = {"ignoreNullFields": "false"}
    if not spaced:
        return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), keep_nulls)
    members = []
    for key, value in values.items():
        boxed = F.to_json(F.array(value), keep_nulls)
        bare = F.substring(boxed, F.lit(2), F.length(boxed) - 2)
        label = F.to_json(F.array(F.lit(key)))
        label = F.substring(label, F.lit(2), F.length(label) - 2)
        members.append(F.concat(label, F.lit(": "), bare))
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def json_value(text: Column, key: str) -> Column:
    """The value at a top-level key, as text; null where the key is absent."""
    return F.get_json_object(text, f"$.{key}")
