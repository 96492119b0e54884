"""JSON held in a text column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.shapes import LABEL_MISSING
from siltstone.functions.text import as_col


def _text_schema(paths: list[list[str]]) -> T.StructType:
    """The smallest schema that holds the paths, all leaves as text."""
    heads: dict[str, list[list[str]]] = {}
    for path in paths:
        heads.setdefault(path[0], []).append(path[1:])
    fields = []
    for head, tails in heads.items():
        nested = [t for t in tails if t]
        kind = _text_schema(nested) if nested else T.StringType()
        fields.append(T.StructField(head, kind))
    return T.StructType(fields)


def json_fields(df: DataFrame, column: str, paths: Mapping[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Project dotted paths of a JSON text column to text columns, parsing each document once.

    JSON null, an absent key and an absent parent all give NULL. The parse sits in a generator,
    which Spark neither merges into later projections nor copies into filters pushed below them;
    as a plain projection it would be run again for every field such a filter names. An explicit
    parse mode keeps Spark from pruning each field access to a parser of its own.
    """
    split = {name: path.split(".") for name, path in paths.items()}
    schema = _text_schema(list(split.values()))
    heads = [f"__doc_{f.name}" for f in schema.fields]
    doc = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    parsed = df.select(*keep, F.inline(F.array(doc)).alias(*heads))
    leaves = [
        F.col(".".join([f"`__doc_{path[0]}`", *(f"`{p}`" for p in path[1:])])).alias(name)
        for name, path in split.items()
    ]
    return parsed.select(*keep, *leaves)


def json_keys(column: Column | str) -> Column:
    """Sorted top-level keys of an object, NULL for anything that is no object."""
    return F.array_sort(F.json_object_keys(as_col(column)))


def json_shape(column: Column | str) -> Column:
    """``null/missing``, ``object with keys: a, b`` or ``scalar (type)`` for a JSON text."""
    text = F.trim(as_col(column))
    head = F.substring(text, 1, 1)
    scalar = (
        F.when(head == '"', "str")
        .when(head == "[", "list")
        .when(text.isin("true", "false"), "bool")
        .when(text.rlike("[.eE]"), "float")
        .otherwise("int")
    )
    return (
        F.when(text.isNull() | (text == "null"), LABEL_MISSING)
        .when(head == "{", F.concat(F.lit("object with keys: "), F.array_join(json_keys(text), ", ")))
        .otherwise(F.concat(F.lit("scalar ("), scalar, F.lit(")")))
    )
