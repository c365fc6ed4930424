"""Hashes and object ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlark.functions.numbers import to_long

ID_PATTERN = r"^[0-9a-fA-F]{24}$"  # fixed value: form of an object id


def md5_text(c: Column) -> Column:
    """Lower-case hex MD5 of the UTF-8 text of a value."""
    return F.md5(c.cast("string"))


def object_id(seed: Column | None = None, salt: str | None = None) -> Column:
    """24 hex digits: 8 of seconds, then 16 that differ per row and run.

    A seed in epoch milliseconds sets the time part; a seed that is an id
    already is kept; any other or no seed takes the current time. The row part
    mixes a per-run salt with a 64-bit row number, so it does not run out.
    """
    salt = salt or uuid.uuid4().hex
    text = seed.cast("string") if seed is not None else F.lit(None).cast("string")
    keep = text.rlike(ID_PATTERN)
    millis = F.when(~keep, to_long(text))
    below = F.pmod(millis, F.lit(1000).cast("bigint"))
    seconds = F.coalesce(
        F.call_function("div", millis - below, F.lit(1000)), F.unix_timestamp(F.current_timestamp())
    )
    row = F.monotonically_increasing_id().cast("string")
    tail = F.substring(F.md5(F.concat(F.lit(salt), row)), 1, 16)
    head = F.right(F.lpad(F.lower(F.hex(seconds)), 16, "0"), F.lit(8))
    return F.when(F.coalesce(keep, F.lit(False)), F.lower(text)).otherwise(F.concat(head, tail))
