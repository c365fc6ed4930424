"""Per-record projections: hashes, JSON bodies, templates, field maps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlark.functions import json as fj
from flowlark.functions.ids import md5_text, object_id
from flowlark.functions.numbers import double_of, finite
from flowlark.operators.routing import REL

JSON_TYPE = "application/json"  # fixed value


def md5_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """MD5 of each expression; a null in any gives ``failure`` and no hash."""
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in exprs.values()])
    hashed = {name: F.when(complete, md5_text(c)) for name, c in exprs.items()}
    rel = F.when(complete, "success").otherwise("failure")
    return df.withColumns({**hashed, REL: rel})


def to_json_content(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JSON object of the listed columns as ``content``; blanks are left out.

    Text is coerced (nested JSON, whole number, number, else string); bad
    nested JSON sends the record to ``failure``.
    """
    members, bad = [], []
    for name in columns:
        kind = df.schema[name].dataType.typeName()
        if kind == "string":
            value, broken = fj.coerce_json(name)
            bad.append(broken)
        else:
            wrapped = F.to_json(F.array(F.col(f"`{name}`")))
            inner = F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
            value = F.when(F.col(f"`{name}`").isNotNull(), inner)
        members.append(F.concat(F.lit(f"{_quoted(name)}:"), value))
    filled = F.filter(F.array(*members), lambda m: m.isNotNull()) if members else None
    body = F.array_join(filled, ",") if members else F.lit("")
    broken = reduce(lambda a, b: a | b, bad, F.lit(False))
    return df.withColumns(
        {
            "content": F.when(~broken, F.concat(F.lit("{"), body, F.lit("}"))),
            "mime_type": F.when(~broken, F.lit(JSON_TYPE)),
            REL: F.when(broken, "failure").otherwise("success"),
        }
    )


def _quoted(name: str) -> str:
    import json

    return json.dumps(name, ensure_ascii=False)


def render_template(df: DataFrame, template: str, into: str = "content") -> DataFrame:
    """Text template with ``{{ column }}`` tokens, as one native expression."""
    return df.withColumn(into, fj.text_template(template, df.columns))


def create_content(spark: SparkSession, template: str, into: str = "content") -> DataFrame:
    """A new record from a template, for when there is no input record."""
    return spark.range(1).select(fj.text_template(template, []).alias(into))


def render_json(df: DataFrame, template: str, into: str = "content") -> DataFrame:
    """JSON template with ``{{ column:type }}`` leaves.

    A value that does not fit its type sends the record to ``failure`` with
    the path, the value and a message.
    """
    text, checks = fj.json_template(template, df.columns)
    none = F.lit(None).cast("string")
    bad = [flag for _, _, flag in checks]
    key, value = none, none
    for path, raw, flag in reversed(checks):
        key = F.when(flag, path).otherwise(key)
        value = F.when(flag, raw).otherwise(value)
    failed = F.coalesce(reduce(lambda a, b: a | b, bad, F.lit(False)), F.lit(False))
    return df.withColumns(
        {
            into: F.when(~failed, text),
            "json_error_key": key,
            "json_error_value": value,
            "json_error_message": F.when(failed, F.concat(F.lit("cannot convert: "), value)),
            REL: F.when(failed, "failure").otherwise("success"),
        }
    )


def with_json_value(df: DataFrame, column: str, path: str, into: str) -> DataFrame:
    return df.withColumn(into, fj.json_extract(column, path))


def with_json_update(df: DataFrame, column: str, path: str, value: Column) -> DataFrame:
    """Replace a primitive inside JSON text; ``updated`` tells whether."""
    text, changed = fj.json_update(column, path, value)
    return df.withColumns({column: text, "updated": changed})


def with_object_id(
    df: DataFrame, name: str, seed: Column | None = None, salt: str | None = None
) -> DataFrame:
    return df.withColumn(name, object_id(seed, salt))


def field_map(df: DataFrame, exprs: dict[str, Column]) -> Column:
    """Map of the expressions that are finite numbers; others are left out."""
    pairs = [x for name, c in exprs.items() for x in (F.lit(name), finite(double_of(df, c)))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
