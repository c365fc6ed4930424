"""JSON text: paths, updates, typed building."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlark.functions.numbers import finite, is_blank, to_double, to_long
from flowlark.functions.times import to_time


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bracket_path(path: str) -> str:
    """Dotted path as a bracketed JSON path, so ``$`` in names is literal."""
    return "$" + "".join(f"['{step}']" for step in path.split("."))


def json_extract(c: str | Column, path: str) -> Column:
    """JSON text at a dotted path through objects; the text ``null`` if absent.

    Text that is no JSON gives SQL null.
    """
    doc = F.try_parse_json(_col(c))
    found = F.to_json(F.try_variant_get(doc, bracket_path(path), "variant"))
    return F.when(doc.isNotNull(), F.coalesce(found, F.lit("null")))


def json_update(c: str | Column, path: str, value: Column) -> tuple[Column, Column]:
    """Replace an existing primitive at a dotted path; returns (text, changed).

    A missing path, an object, an array or a JSON null is left alone.
    """
    text = _col(c)
    steps = path.split(".")
    levels = [text]
    for step in steps[:-1]:
        levels.append(F.get_json_object(levels[-1], bracket_path(step)))
    leaf = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(text), bracket_path(path), "variant")
    )
    changed = F.coalesce(~leaf.rlike(r"^(OBJECT|ARRAY|VOID)"), F.lit(False))
    fresh = _json_value(value)
    for level, step in zip(reversed(levels), reversed(steps)):
        fresh = _put(level, step, fresh)
    return F.when(changed, fresh).otherwise(text), changed


def _put(doc: Column, name: str, value: Column) -> Column:
    """Object text with one existing member replaced, members in their order.

    The object is parsed once, before the pass over its members.
    """

    def rebuild(parts: Column) -> Column:
        members = F.transform(
            F.json_object_keys(doc),
            lambda k: F.concat(
                json_string(k),
                F.lit(":"),
                F.when(k == name, value).otherwise(
                    F.coalesce(F.to_json(F.try_element_at(parts, k)), F.lit("null"))
                ),
            ),
        )
        return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))

    parsed = F.array(F.from_json(doc, "map<string,variant>"))
    return F.element_at(F.transform(parsed, rebuild), 1)


def json_string(c: Column) -> Column:
    """Quoted and escaped JSON string."""
    return F.btrim(F.to_json(F.array(c)), F.lit("[]"))  # the quotes stand inside


def _json_value(c: Column) -> Column:
    wrapped = F.to_json(F.array(c))
    return F.coalesce(F.substring(wrapped, F.lit(2), F.length(wrapped) - 2), F.lit("null"))


def coerce_json(c: str | Column) -> tuple[Column, Column]:
    """JSON text of an untyped string and whether it was bad JSON.

    Blank gives null. Text in braces or brackets is taken as JSON, then whole
    numbers (up to 64 bits), then other finite numbers, else a string.
    """
    text = F.trim(_col(c))
    nested = text.rlike(r"(?s)^(\{.*\}|\[.*\])$")
    parsed = F.try_parse_json(text).isNotNull()
    value = (
        F.when(is_blank(text), F.lit(None).cast("string"))
        .when(nested, F.when(parsed, text))
        .otherwise(
            F.coalesce(
                to_long(text).cast("string"), finite(to_double(text)).cast("string"), json_string(text)
            )
        )
    )
    return value, F.coalesce(nested & ~parsed, F.lit(False))


def extended_id(c: str | Column) -> Column:
    """Hex text of an ``{"$oid": ...}`` value."""
    return F.get_json_object(_col(c), bracket_path("$oid"))


def extended_date(c: str | Column) -> Column:
    """Timestamp of a ``{"$date": millis}`` value."""
    return to_time(to_long(F.get_json_object(_col(c), bracket_path("$date"))))


def extended_text(c: str | Column) -> Column:
    """Query value as text: object ids as hex, dates as ISO, else unquoted."""
    text = _col(c)
    date = F.date_format(extended_date(text), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.coalesce(extended_id(text), date, F.regexp_replace(text, '"', ""))


# --- templates -----------------------------------------------------------------

TOKEN = re.compile(r"\{\{\s*(.*?)\s*\}\}")


def text_template(template: str, columns: list[str]) -> Column:
    """Text with each ``{{ name }}`` replaced by that column, or ``null``.

    The template is cut into pieces once; inserted text is never read again.
    """
    pieces: list[Column] = []
    at = 0
    for token in TOKEN.finditer(template):
        pieces.append(F.lit(template[at : token.start()]))
        name = token.group(1)
        value = F.col(f"`{name}`").cast("string") if name in columns else F.lit(None)
        pieces.append(F.coalesce(value, F.lit("null")))
        at = token.end()
    pieces.append(F.lit(template[at:]))
    return F.concat(*pieces)


def json_template(template: str, columns: list[str]) -> tuple[Column, list[tuple[str, Column, Column]]]:
    """Compile a JSON template with ``{{ name:type }}`` leaves.

    Returns the JSON text column and, per typed leaf, (path, raw value, bad
    flag). Objects are walked; arrays and other leaves are kept as they are.
    """
    checks: list[tuple[str, Column, Column]] = []

    def build(node, path: str) -> Column:
        if isinstance(node, dict):
            members = [
                F.concat(F.lit(json.dumps(k, ensure_ascii=False) + ":"), build(v, f"{path}.{k}"))
                for k, v in node.items()
            ]
            joined = F.concat_ws(",", *members) if members else F.lit("")
            return F.concat(F.lit("{"), joined, F.lit("}"))
        if isinstance(node, str) and node.strip().startswith("{{"):
            name, _, kind = node.strip()[2:-2].strip().partition(":")
            name = name.strip()
            raw = F.col(f"`{name}`").cast("string") if name in columns else F.lit(None).cast("string")
            value, bad = _typed(raw, kind.strip())
            if bad is not None:
                checks.append((path, raw, bad))
            return F.coalesce(value, F.lit("null"))
        return F.lit(json.dumps(node, ensure_ascii=False, separators=(",", ":")))

    return build(json.loads(template), "$"), checks


def _typed(raw: Column, kind: str) -> tuple[Column, Column | None]:
    given = raw.isNotNull() & (raw != "")
    if kind.startswith("bool"):
        return F.when(given, (F.lower(raw) == "true").cast("string")), None
    if kind.startswith("int"):
        value = to_long(raw)
        return value.cast("string"), given & value.isNull()
    if kind.startswith("float"):
        value = finite(to_double(raw))
        return value.cast("string"), given & value.isNull()
    if kind.startswith("json"):
        parsed = F.try_parse_json(raw)
        return F.when(given & parsed.isNotNull(), raw), given & parsed.isNull()
    return F.when(given, json_string(raw)), None
