"""JSON path access on JSON text columns (``->`` / ``->>`` equivalents)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jget(c: Column, path: str) -> Column:
    """Text at a JSON path (``$.a.b[1]``); objects come back as JSON text, JSON null as NULL."""
    return F.get_json_object(c, path)


def json_unwrap(c: Column) -> Column:
    """Accept an object stored as JSON or as a JSON string holding JSON.

    ``{"a":1}`` -> ``{"a":1}``;  ``"{\\"a\\":1}"`` -> ``{"a":1}``;  ``''`` / ``null`` / bad text -> NULL
    (the same as an empty object for every path read afterwards).
    """
    return F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")


def json_object_only(c: Column) -> Column:
    """Keep the value only if it is a JSON object, else ``{}``."""
    inner = json_unwrap(c)
    return F.when(F.ltrim(inner).startswith("{") & F.json_object_keys(inner).isNotNull(), inner).otherwise(F.lit("{}"))


def top_level_value_by_name(c: Column, *needles: str) -> Column:
    """First top-level non-empty text field whose name contains every needle (case-insensitive)."""
    entries = F.map_entries(F.from_json(c, "map<string,string>"))

    def keep(e):
        k = F.lower(e["key"])
        ok = e["value"] != ""
        for n in needles:
            ok = ok & k.contains(n.lower())
        return ok
    return F.get(F.filter(entries, keep), 0)["value"]


def parse_object(c: Column, schema: str) -> Column:
    """Parse a JSON object once into a struct of the listed fields (all text).

    Field text equals what ``get_json_object`` returns for ``$.<field>`` (strings
    unescaped, numbers normalised, objects as JSON text, JSON null as NULL), but
    the document is parsed once instead of once per field.
    """
    return F.from_json(c, schema)


def unwrap_text(c: Column) -> Column:
    """Like :func:`json_unwrap`: text that already is an object is used as is (no extra parse);
    anything else goes through a one-field wrapper, which unescapes a JSON string holding JSON."""
    wrapped = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string")["v"]
    return F.when(F.ltrim(c).startswith("{"), c).otherwise(wrapped)


def point_coordinates(point_json: Column) -> Column:
    """``$.coordinates`` of a GeoJSON point given as JSON text, as an array of texts."""
    return F.from_json(point_json, "coordinates array<string>")["coordinates"]
