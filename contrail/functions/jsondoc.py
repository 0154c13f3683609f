"""JSON documents as VARIANT: one parse a document, typed fields from it.

``document`` parses the text; a text that is null or no JSON gives null. ``field`` takes a value by
its path as a type; an absent value, a JSON null and a value that does not convert are null.
``fields`` explodes the members of an object, each as text, and gives no row for anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document(text: str | Column) -> Column:
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def field(doc: str | Column, path: str, type_: str = "string") -> Column:
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, f"$.{path}", type_)


def fields(df: DataFrame, doc: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row a member of the object in the variant column ``doc``: all other columns, key and value."""
    kept = [c for c in df.columns if c != doc]
    obj = F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.col(doc))
    out = df.select(*kept, F.explode(obj.cast("map<string,variant>")).alias(key, "_v"))
    return out.select(*kept, key, F.try_variant_get("_v", "$", "string").alias(value))
