"""XML documents in text columns, written and read by a declared schema.

``to_document`` writes a struct as one element a field under a root element, escaping what XML
reserves; null fields are left out, as ``xmlforest`` does, and empty ones stay as empty elements.
``from_document`` reads all fields of the schema in one parse. An absent element is null, an empty
string element is an empty string, and blanks at the ends of a value stay. A text that is null or
no XML document, or in which an element does not have its type, gives a struct of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_document(root: str, fields: Column) -> Column:
    text = F.to_xml(fields, {"rowTag": root, "declaration": "", "indent": "", "dateFormat": "yyyy-MM-dd"})
    return F.regexp_replace(text, r"\n\z", "")


def from_document(text: str | Column, root: str, schema: str) -> Column:
    document = F.col(text) if isinstance(text, str) else text
    return F.from_xml(F.coalesce(document, F.lit("")), schema, {"rowTag": root, "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"})
