"""JSON text cells and the arrays inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unwrap_cell(cell: Column) -> Column:
    """Undo the second quoting of a list cell: ``"[..\\"..]"`` -> ``[..".. ]``."""
    quoted = cell.startswith('"[') & cell.endswith(']"')
    inner = F.replace(
        F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('\\"'), F.lit('"')
    )
    return F.when(quoted, inner).otherwise(cell)


def parse_cell(cell: Column) -> Column:
    """The cell as a variant; NULL when it is no JSON."""
    return F.try_parse_json(unwrap_cell(cell))


def parse_list(cell: Column, array_type: str) -> Column:
    """The cell as a typed array.

    A cell that is no list is NULL. Inside a list a bad element, or a bad field
    of an element, is NULL by itself and the rest stands.
    """
    return F.try_variant_get(parse_cell(cell), "$", array_type)


def json_text(value: Column) -> Column:
    """A nested value as JSON text with its NULL fields written out."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def join_texts(texts: Column, separator: str = ", ") -> Column:
    """Texts of an array in one line; NULL for an empty or missing array."""
    return F.when(F.size(texts) > 0, F.array_join(texts, separator))


def compact(values: Column) -> Column:
    """The non-empty elements of an array as texts."""
    texts = F.transform(values, lambda v: v.cast("string"))
    return F.filter(texts, lambda t: t.isNotNull() & (t != ""))


def _true(value: Column) -> Column:
    """Whether a JSON value counts as something: not null, "", 0, false, [] or {}."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    text = F.try_variant_get(value, "$", "string")
    return F.when(kind == "VOID", False).when(kind == "STRING", text != "").when(kind == "BOOLEAN", text == "true").when(
        kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}")).otherwise(number != 0)


def compact_item(item: Column) -> Column:
    """Texts held by a JSON item: the values of an object, the elements of a
    list, or the scalar itself; empty ones left out."""
    value = F.try_parse_json(item)
    elements = F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"),
        F.map_values(F.try_variant_get(value, "$", "map<string,variant>")),
        F.when(value.isNotNull(), F.array(value)),
    )
    kept = F.filter(elements, lambda v: F.coalesce(v.isNotNull() & _true(v), F.lit(False)))
    return F.coalesce(F.transform(kept, lambda v: F.try_variant_get(v, "$", "string")), compact(F.array(item)))
