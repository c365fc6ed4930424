"""Tag text such as ``host=a,region=b`` to a map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_tags(c: str | Column, strict: bool = True) -> Column:
    """Map of the tags in a text; the last of equal keys wins.

    ``strict``: every comma-separated piece must be exactly one ``key=value``,
    or the whole map is null. Null text gives an empty map. Otherwise quoted
    fields may hold commas, a piece is cut at its first ``=`` and pieces
    without a key or a value are left out.
    """
    text = F.col(c) if isinstance(c, str) else c
    parsed = _strict(text) if strict else _quoted(text)
    tidy = text.rlike(_CLEAN) & ~text.rlike(_REPEATED)
    return F.when(text.isNull(), _empty()).when(tidy, _plain(text)).otherwise(parsed)


# Shapes of tag text that need no list work.
_CLEAN = r"^[^=,\s\"]+=[^=,\s\"]+(,[^=,\s\"]+=[^=,\s\"]+)*$"
_PAIRS = r"^[^=,]*=[^=,]+(,[^=,]*=[^=,]+)*$"
_FULL_PAIRS = r"^[^=,]+=[^=,]+(,[^=,]+=[^=,]+)*$"
_REPEATED = r"(?:^|,)([^=,]*)=[^,]*,(?:.*,)?\1="


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"\s*([=,])\s*", "$1")


def _plain(pairs: Column) -> Column:
    return F.str_to_map(pairs, F.lit(","), F.lit("="))


def _strict(text: Column) -> Column:
    # Trailing separators do not open a new piece, on either level.
    clean = F.regexp_replace(F.regexp_replace(text, r",+$", ""), r"=+(?=,|$)", "")
    valid = clean.rlike(_PAIRS)
    pairs = _trimmed(clean)
    entries = F.transform(
        F.split(pairs, ",", -1),
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"), F.substring_index(p, "=", -1).alias("value")
        ),
    )
    once = ~pairs.rlike(_REPEATED)
    return F.when(valid & once, _plain(pairs)).when(valid, _last_wins(entries))


def _quoted(text: Column) -> Column:
    pairs = _trimmed(text)
    simple = ~text.contains('"') & pairs.rlike(_FULL_PAIRS) & ~pairs.rlike(_REPEATED)
    fields = F.regexp_extract_all(text, F.lit(r'((?:"[^"]*"|[^,"]|"(?=[^"]*$))+)'), F.lit(1))
    bare = F.transform(fields, lambda f: F.regexp_replace(F.trim(f), r'^"([^"]*)"$', "$1"))
    entries = F.transform(
        F.filter(bare, lambda f: F.instr(f, "=") > 0),
        lambda f: F.struct(
            F.trim(F.substring(f, F.lit(1), F.instr(f, "=") - 1)).alias("key"),
            F.trim(F.substring(f, F.instr(f, "=") + 1, F.length(f))).alias("value"),
        ),
    )
    kept = F.filter(entries, lambda e: (e["key"] != "") & (e["value"] != ""))
    return F.when(simple, _plain(pairs)).otherwise(_last_wins(kept))


def _empty() -> Column:
    return F.create_map().cast("map<string,string>")


def _last_wins(entries: Column) -> Column:
    """Map from entries, keeping the last value of a repeated key."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(
        keys,
        F.transform(
            keys,
            lambda k: F.element_at(
                F.transform(F.filter(entries, lambda e: e["key"] == k), lambda e: e["value"]), -1
            ),
        ),
    )
