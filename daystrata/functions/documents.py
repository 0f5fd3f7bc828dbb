"""Reading values out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

REPLY_TYPE = "array<struct<title:string,artist:string,reason:string>>"


def stripped(text: Column) -> Column:
    """Text without white space at either end; ``trim`` would leave line breaks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def json_scalar(document: Column, path: str) -> Column:
    """Scalar at ``path`` as text; NULL when missing, JSON null, or an object or array."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), path, "variant"))
    nested = F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))
    return F.when(~nested, F.get_json_object(document, path))


def json_array(document: Column, element: str = "string") -> Column:
    """Root array; NULL when the root is anything else (a lone object is not wrapped)."""
    is_array = document.rlike(r"^\s*\[")
    return F.when(is_array, F.from_json(document, f"array<{element}>"))


def is_json(document: Column) -> Column:
    """Whether the text is one JSON value.  A repeated key is no fault; the last of equal keys counts where it is read."""
    alone = F.from_json(F.concat(F.lit("["), document, F.lit("\n]")), "array<string>", {"allowSingleQuotes": "false"})
    return F.coalesce(F.size(alone) == 1, F.lit(False))


def canonical_json(document: Column) -> Column:
    """One-line JSON with sorted keys; equal content gives equal text."""
    return F.to_json(F.try_parse_json(document))


# What counts as empty, compared as JSON text of the value.
_EMPTY_TEXT = ("null", "[]", "{}", '""', '"null"', "false")


def valid_payload(document: Column) -> Column:
    """Keep a list with at least one element, or an object with at least one non-empty value.

    NULL, numeric zero in any spelling, ``false``, empty text, the text "null" and empty containers are
    empty.  Any other kind of document, or bad JSON, is rejected.  The document is parsed once: the value stands in an
    array of one element, which both tests read.
    """

    def filled(value: Column) -> Column:
        text = F.coalesce(F.to_json(value), F.lit("null"))
        zero = F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False)) & ~text.startswith('"')
        return ~text.isin(*_EMPTY_TEXT) & ~zero

    def content(root: Column) -> Column:
        kind = F.schema_of_variant(root)
        return F.coalesce(
            F.when(kind.startswith("ARRAY"), F.size(F.try_variant_get(root, "$", "array<variant>")) > 0)
            .when(kind.startswith("OBJECT"), F.exists(F.map_values(F.try_variant_get(root, "$", "map<string,variant>")), filled)),
            F.lit(False),
        )

    return F.exists(F.array(F.try_parse_json(document)), content)


def unfenced(reply: Column) -> Column:
    """Text inside the first code fence (a ``json`` fence wins over a bare one), else the text itself."""
    def inside(opening: str) -> Column:
        after = F.element_at(F.split(reply, opening, 2), 2)
        return stripped(F.element_at(F.split(after, "```", 2), 1))

    return (
        F.when(reply.contains("```json"), inside("```json"))
        .when(reply.contains("```"), inside("```"))
        .otherwise(stripped(reply))
    )


def reply_rows(reply: Column) -> Column:
    """Array of (title, artist, reason).  An empty reply or bad JSON becomes one explaining row."""
    def problem(title: str, reason: str) -> Column:
        row = F.struct(F.lit(title).alias("title"), F.lit("N/A").alias("artist"), F.lit(reason).alias("reason"))
        return F.array(row)

    body = unfenced(reply)
    parsed = F.when(F.try_parse_json(body).isNotNull() & body.startswith("["), F.from_json(body, REPLY_TYPE))
    return F.when(
        F.coalesce(stripped(reply), F.lit("")) == "", problem("Error", "No response")
    ).otherwise(F.coalesce(parsed, problem("Parsing Error", "Could not parse response")))


def lookup(mapping: dict[str, object], key: Column, default) -> Column:
    """Value of a small fixed mapping, or the default for an unknown or NULL key."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))
