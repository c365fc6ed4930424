"""WARC archives without repeated payloads, written and read by Spark alone.

1. *Headers*: id, address, length and digests of every page; no payload is shuffled.
2. *Resolution*: headers meet by payload digest (SHA-1 and SHA-256, so that a forged
   SHA-1 joins nothing). The page with the largest id is the response, all others become
   revisits, and each is joined to its response.
3. *Archives*: responses are written straight from the scan of the pages, revisits from
   their headers, all with fresh record headers. The pages that must not be written again
   are known by a bitmap of their hashes, joined like a small table; only pages that hit
   it are compared exactly, by hash columns alone.

A record is one row of Spark's text format, whose line separator is the end of a record;
so writing is committed by task and survives lost executors. The first header of a record
names its archive by a number drawn for this archive. Together with the version line it
makes a border that no payload contains, by which Spark can also split and read an archive
of any size, one record a row. The border leaves out the end of the record before: payloads
may end in the same characters, and a separator that can begin twice at once is missed where
a read buffer ends between. Lengths and digests are checked on reading; a record that does
not keep them raises.

Defined results: a null payload is empty, and empty payloads are equal to each other; a
payload shorter than ``least`` bytes is always a response; null ids are smallest; of rows
equal in id and payload, one is the response, the others revisit it; a null address
leaves the header out, control characters and blanks in it are percent-encoded; an empty
table gives an archive with its description alone. The columns are taken by name and
renamed, so other names do not matter.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlark.llm.common import join_small
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

END = "\r\n"
GAP = END + END
VERSION = "WARC/1.1"
ARCHIVE = "Archive-ID"  # the first header of each record, an extension
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value: digits of base32 in order.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Bits of the bitmap per page in it, and of a whole bitmap at most (64 MB).
BITS_EACH, MOST_BITS = 16, 1 << 29
BUCKET_BITS = 32_768  # bits of a row of Spark's bitmap functions


# --- columns ------------------------------------------------------------------------------


def base32(hexed: Column) -> Column:
    """Base32 of a SHA-1 in hexadecimal digits: 20 bits make four characters."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), digits, BASE32)


def _urn(*parts: Column) -> Column:
    """A record id that its parts decide."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _address(uri: Column) -> Column:
    """An address that stays inside its header line."""
    odd = r"[\x00-\x20\x7F]"
    coded = F.transform(
        F.split(uri, ""),
        lambda c: F.when(c.rlike(odd), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c),
    )
    return F.when(uri.rlike(odd), F.array_join(coded, "")).otherwise(uri)


def _lines(fields: dict[str, Column | str]) -> Column:
    """Header lines; null values leave theirs out."""
    lines = [F.concat(F.lit(f"{n}: "), v if isinstance(v, Column) else F.lit(v)) for n, v in fields.items()]
    return F.concat_ws(END, *lines)


def _field(head: Column, name: str) -> Column:
    """Value of a header line, null where there is none."""
    line = rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$"
    return F.when(head.rlike(line), F.regexp_extract(head, line, 1))


# --- resolution ---------------------------------------------------------------------------


def payload_headers(pages: DataFrame, key: str, uri: str, payload: str) -> DataFrame:
    """Rows (id, uri, bytes, sha1, sha256), the payload's digests in hexadecimal digits."""
    body = F.coalesce(F.col(_quoted(payload)), F.lit(""))
    return pages.select(
        F.col(_quoted(key)).alias("id"), F.col(_quoted(uri)).alias("uri"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha1(body).alias("sha1"), F.sha2(body, 256).alias("sha256"),
    )


def resolve_revisits(headers: DataFrame, least: int = 0) -> tuple[DataFrame, DataFrame]:
    """The headers, numbered, of pages that revisit another one, and of those they revisit.

    Revisits have the columns ``to_*`` of their response too. The largest (id, number) of
    a digest is found by partial aggregates; the join splits a hot digest.
    """
    numbered = materialize(headers.withColumn("number", F.monotonically_increasing_id()))
    mine = [F.col(c).alias(f"to_{c}") for c in ("id", "number", "uri")]
    groups = (
        numbered.filter(F.col("bytes") >= least)
        .groupBy("sha256", "sha1")
        .agg(F.max(F.struct("id", "number", "uri")).alias("top"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("sha256").alias("to_sha256"), F.col("sha1").alias("to_sha1"), "top.*")
        .select("to_sha256", "to_sha1", *mine)
    )
    groups = materialize(groups)
    joined = join_hot(numbered, groups, {"sha256": "to_sha256", "sha1": "to_sha1"}, "inner")
    return materialize(joined.filter("number <> to_number")), groups


def _page_key(*columns: Column) -> Column:
    """128 bits of id, address and payload digest, nulls unlike anything else."""
    return F.md5(F.concat_ws("\n", *[F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]))


def _bitmap(keys: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Bits of all keys as rows (bucket, bits), of at most MOST_BITS, and their number."""
    size = min(max(rows * BITS_EACH // BUCKET_BITS + 1, 1) * BUCKET_BITS, MOST_BITS)
    at = keys.select((F.pmod(F.xxhash64("key"), F.lit(size)) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
    return materialize(parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))), size


def _hit(pages: DataFrame, bitmap: DataFrame, size: int) -> DataFrame:
    """Add ``hit``: whether the bit of ``key`` is set."""
    at = F.pmod(F.xxhash64("key"), F.lit(size))
    spot = pages.withColumns(
        {"_at": F.bitmap_bucket_number(at + 1), "_bit": F.bitmap_bit_position(at + 1)}
    )
    found = spot.join(F.broadcast(bitmap), F.col("_at") == F.col("bucket"), "left")  # MOST_BITS
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(_bit % 8 as int)")
    hit = F.coalesce(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return found.withColumn("hit", hit).drop("_at", "_bit", "bucket", "bits")


def original_pages(pages: DataFrame, revisits: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (id, uri, sha1, sha256, payload) of the pages to be written as responses.

    ``pages`` has the columns of ``payload_headers`` and ``payload``. Pages that miss the
    bitmap of all revisits pass straight on. For the others, ids and digests decide: a
    page that no revisit equals, or that is a response beside revisits equal to it, is
    written once.
    """
    columns = ["id", "uri", "sha1", "sha256", "payload"]
    keyed = pages.withColumn("key", _page_key(F.col("id"), F.col("uri"), F.col("sha256")))
    again = revisits.select(_page_key(F.col("id"), F.col("uri"), F.col("sha256")).alias("key"))
    rows = revisits.count()
    if not rows:
        return keyed.select(columns)
    marked = _hit(keyed, *_bitmap(again, rows))
    tops = groups.select(_page_key(F.col("to_id"), F.col("to_uri"), F.col("to_sha256")).alias("key"))
    buried = again.distinct().join(tops, "key", "left_anti")
    wanted = marked.filter("hit").select("key").distinct().join(buried, "key", "left_anti")
    wanted = materialize(wanted)
    rest = join_small(marked.filter("hit"), wanted, ["key"], "inner")
    once = rest.groupBy("key").agg(F.any_value(F.struct(*columns)).alias("page")).select("page.*")
    return marked.filter(~F.col("hit")).select(columns).unionAll(once.select(columns))


# --- archives -----------------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    least: int = 0,
    date: datetime | None = None,
) -> str:
    """Write a record per page below ``path``; returns the archive's number."""
    archive = str(uuid.uuid4())
    at = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    name = F.lit(archive)
    headers = payload_headers(pages, key, uri, payload)
    revisits, groups = resolve_revisits(headers, least)
    body = F.coalesce(F.col(_quoted(payload)), F.lit(""))
    whole = pages.select(
        F.col(_quoted(key)).alias("id"), F.col(_quoted(uri)).alias("uri"), F.sha1(body).alias("sha1"),
        F.sha2(body, 256).alias("sha256"), body.alias("payload"),
    )

    def record(kind: str, fields: dict, block: Column) -> Column:
        lines = _lines(
            {
                ARCHIVE: archive,
                "WARC-Type": kind,
                "WARC-Date": at,
                "WARC-Warcinfo-ID": f"<urn:uuid:{archive}>",
                **fields,
                "Content-Length": F.octet_length(block).cast("string"),
            }
        )
        return F.concat(F.lit(VERSION + END), lines, F.lit(GAP), block).alias("value")

    def http(size: Column) -> Column:
        lines = _lines({"Content-Type": "text/html; charset=utf-8", "Content-Length": size.cast("string")})
        return F.concat(F.lit("HTTP/1.1 200 OK" + END), lines, F.lit(GAP))

    def page(key: Column, uri: Column, sha1: Column) -> dict:
        return {
            "WARC-Target-URI": _address(uri),
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), base32(sha1)),
            "Content-Type": "application/http; msgtype=response",
            "Page-ID": key.cast("string"),
        }

    own, there = [F.col(c) for c in ("id", "uri", "sha1")], [F.col("to_id"), F.col("to_uri"), F.col("sha1")]
    responses = original_pages(whole, revisits, groups).select(
        record(
            "response",
            {"WARC-Record-ID": _urn(name, *own, F.col("sha256")), **page(*own)},
            F.concat(http(F.octet_length("payload")), F.col("payload")),
        )
    )
    again = revisits.select(
        record(
            "revisit",
            {
                "WARC-Record-ID": _urn(name, F.lit("revisit"), F.col("number")),
                **page(*own),
                "WARC-Profile": PROFILE,
                "WARC-Refers-To": _urn(name, *there, F.col("sha256")),
                "WARC-Refers-To-Target-URI": _address(F.col("to_uri")),
                "WARC-Refers-To-Date": at,
            },
            http(F.col("bytes")),
        )
    )
    spark = pages.sparkSession
    about = F.lit("format: WARC File Format 1.1" + END)
    description = spark.range(1).select(
        F.concat(
            F.lit(VERSION + END),
            _lines({ARCHIVE: archive, "WARC-Type": "warcinfo", "WARC-Date": at, "WARC-Record-ID": f"<urn:uuid:{archive}>",
                    "Content-Type": "application/warc-fields", "Content-Length": F.octet_length(about).cast("string")}),
            F.lit(GAP), about,
        ).alias("value")
    )
    written = responses.unionAll(again).unionAll(description)
    written.write.option("lineSep", GAP).text(path)
    return archive


def read_archives(spark: SparkSession, path: str, archive: str | None = None) -> DataFrame:
    """Rows (type, record_id, uri, page_id, refers_to_id, bytes, digest, payload) of all records.

    ``archive`` is the number that ``write_archives`` returned. Without it records are
    split at the version line alone, which fits archives of other writers too; there, a
    payload that contains this border raises. Of revisits, which have no payload, length
    and digest are those of the payload they refer to.
    """
    border = VERSION + END + (f"{ARCHIVE}: {archive}{END}" if archive else "")
    raw = spark.read.option("lineSep", border).text(path).filter("value <> ''")  # before the first one
    cut = raw.withColumn("head", F.substring_index("value", GAP, 1))
    declared = _field(F.col("head"), "Content-Length").cast("long")
    rest = F.expr("substring(cast(value as binary), octet_length(head) + 5)")
    cut = cut.select("head", declared.alias("size"), rest.alias("rest"))
    whole = F.octet_length("rest") == F.col("size") + len(GAP)
    wrong = F.raise_error(F.concat(F.lit("a record does not have its length: "), F.col("head")))
    block = F.when(whole, F.expr("substring(rest, 1, cast(size as int))")).otherwise(wrong.cast("binary"))
    cut = cut.select("head", block.alias("block"))
    text = F.col("block").cast("string")
    page = F.lower(_field(F.col("head"), "Content-Type")).startswith("application/http")
    cut = cut.withColumn("http", F.when(page, F.substring_index(text, GAP, 1)))
    kind = _field(F.col("head"), "WARC-Type")
    payload = F.when(
        kind == "response",
        F.when(page, F.expr("substring(block, octet_length(http) + 5)")).otherwise(F.col("block")),
    )
    cut = cut.withColumns({"type": kind, "payload": payload})
    cut = cut.withColumn("told", F.regexp_extract(_field(F.col("head"), "WARC-Payload-Digest"), "(?i)^sha1:(.*)$", 1))
    found = base32(F.sha1("payload"))
    digest = F.when(F.col("payload").isNull() | found.eqNullSafe(F.col("told")), F.col("told")).otherwise(
        F.raise_error(F.concat(F.lit("a payload does not have its digest: "), F.col("head")))
    )
    return cut.select(
        "type", _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Target-URI").alias("uri"),
        _field(F.col("head"), "Page-ID").alias("page_id"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to_id"),
        F.coalesce(F.octet_length("payload").cast("long"), _field(F.col("http"), "Content-Length").cast("long")).alias("bytes"),
        digest.alias("digest"), "payload",
    )


def joined_revisits(records: DataFrame) -> DataFrame:
    """Page records with ``refers_to``, the page id of the response that a revisit names.

    Only ids are joined; many revisits of one response are split at run time.
    """
    pages = records.filter(F.col("type").isin("response", "revisit"))
    responses = pages.filter("type = 'response'").select(
        F.col("record_id").alias("_at"), F.col("page_id").alias("refers_to")
    )
    return join_hot(pages, responses, {"refers_to_id": "_at"}, "left")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
