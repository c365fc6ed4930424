"""File, listing and page queries."""

from __future__ import annotations

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from flowlark.operators import listing
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, table
from flowlark.session import scratch_path
from flowlark.sources import files, pages
from flowlark.streaming.run import drain

_SPLIT_SQL = """
with l as (select doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) as lines from documents),
b as (select doc_id, lines[2] as header, lines[3:] as body from l where len(lines) > 2),
s as (select doc_id, header, body, unnest(range(0, (len(body) + 4) // 5)) as split from b)
select {columns}, split::int as split, md5(header || chr(10) ||
  array_to_string(body[split * 5 + 1 : split * 5 + 5], chr(10))) as hash from s
"""


@query("file_splits", _SPLIT_SQL.format(columns="doc_id"))
def file_splits(spark, sf):
    """Documents as line files: one line skipped, one header, five per split."""
    docs = table(spark, sf, "documents")
    out = files.text_splits(docs, "text", skip=1, header=True, per_split=5, keep=["doc_id"])
    return out.select("doc_id", "split", F.md5("content").alias("hash"))


@query(
    "file_splits_in_place",
    """with d as (select doc_id // 200 as b, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
       l as (select b, doc_id, unnest(range(len(lines))) as i, unnest(lines) as line from d),
       n as (select b, line, row_number() over (partition by b order by doc_id, i) - 1 as n from l),
       s as (select b, (n - 2) // 7 as split, string_agg(line, chr(10) order by n) as body from n where n >= 2 group by 1, 2)
       select s.b::varchar as part, split::int as split, md5(n.line || chr(10) || body) as hash
       from s join n on n.b = s.b and n.n = 1""",
)
def file_splits_in_place(spark, sf):
    """Files of 200 documents each, cut in place: one line skipped, one header, seven per split."""
    out = scratch_path(spark, "splits")
    docs = table(spark, sf, "documents").select(
        F.call_function("div", F.col("doc_id"), F.lit(200)).alias("part"), "doc_id",
        F.coalesce("text", F.lit("")).alias("value"),
    )
    # A file is a part of bounded size, in one task and in order.
    dealt = docs.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value")
    dealt.write.partitionBy("part").text(out)
    splits = files.file_splits(spark, out, skip=1, header=True, per_split=7)
    part = F.regexp_extract("file", r"/part=(-?\d+)/", 1)
    return splits.select(part.alias("part"), "split", F.md5("content").alias("hash"))


@query(
    "file_lines",
    """select doc_id, len(string_split(text, chr(10)))::bigint as lines,
         sum(strlen(line) * line_no)::bigint as place from (
         select doc_id, text, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as line_no from documents)
       group by 1, 2""",
)
def file_lines(spark, sf):
    """Documents written as text files, read back as numbered lines.

    Each document follows a line with its id, so that the numbers inside it can
    be checked: the lines of a document and the sum of their bytes times place.
    """
    out = scratch_path(spark, "lines")
    head = F.concat(F.lit("\x01"), F.col("doc_id").cast("string"))
    text = F.concat_ws("\n", head, "text").alias("value")
    table(spark, sf, "documents").select(text).write.text(out)
    lines = files.numbered_lines(spark, out)
    heads = Window.partitionBy("file").orderBy("line")
    doc = F.when(F.col("value").startswith("\x01"), F.substring("value", 2, 20).cast("long"))
    lines = lines.withColumn("doc_id", doc).withColumn("at", F.when(F.col("doc_id").isNotNull(), F.col("line")))
    lines = lines.withColumns({c: F.last(c, ignorenulls=True).over(heads) for c in ("doc_id", "at")})
    inside = lines.filter(F.col("line") > F.col("at"))
    place = F.octet_length("value") * (F.col("line") - F.col("at") - 1)
    return inside.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(place).cast("long").alias("place")
    )


@query(
    "list_keys",
    """select url from pages where starts_with(url, 'http') and url > 'http:' and url < 'https:'
       order by url limit 100""",
)
def list_keys(spark, sf):
    keys = table(spark, sf, "pages").select("url")
    page, _ = listing.list_keys(keys, "http", ":", "s:", limit=100, key="url")
    return page


@query(
    "list_keys_all",
    """select url, ((row_number() over (order by url) - 1) // 100)::bigint as page from pages
       where starts_with(url, 'http') and url > 'http'""",
)
def list_keys_all(spark, sf):
    """The page that each key is on."""
    keys = table(spark, sf, "pages").select("url")
    return listing.all_pages(keys, "http", limit=100, key="url")


@query(
    "page_snapshots",
    """select page_id, case when contains(html, '<article') then 'success' else 'failure' end as _rel
       from pages""",
)
def page_snapshots(spark, sf):
    out = pages.page_snapshots(table(spark, sf, "pages"), "css", "article")
    return out.select("page_id", REL)


@query(
    "page_link_hosts",
    """select regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) as host, sum(len(regexp_extract_all(
         regexp_replace(html, '<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'gs'),
         '<a\\s[^>]*href=')))::bigint as links
       from pages group by 1 having links > 0""",
)
def page_link_hosts(spark, sf):
    """Links per host over all pages, from the rewritten text."""
    shots = pages.page_snapshots(table(spark, sf, "pages"), "xpath", "//a")
    links = pages.page_links(shots, "page_id", "url")
    host = F.parse_url(F.col("url"), F.lit("HOST"))
    return links.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("links"))


@query(
    "file_completion",
    """select event_type, count(*) as read, case when event_type < (select max(event_type) from events)
         then count(*) else 0 end as archived from events group by 1""",
)
def file_completion(spark, sf):
    """A stream over one file per event type, in order; files move once the next one is read."""
    source, done = scratch_path(spark, "completion"), scratch_path(spark, "archive")
    events = table(spark, sf, "events").select("event_id", "event_type")
    types = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]  # a few
    for kind in types:
        events.filter(F.col("event_type") == kind).coalesce(1).write.mode("append").parquet(source)
    cleaners = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(cleaners, None)
    spark.conf.set(cleaners, "0")  # files move before the next micro-batch begins
    try:
        sdf = files.read_stream_files(
            spark, source, events.schema, completion="archive", archive_dir=done, max_files=1
        )
        read = drain(sdf, "completion")
    finally:
        spark.conf.unset(cleaners) if before is None else spark.conf.set(cleaners, before)
    moved = spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(done)
    counts = moved.groupBy(F.col("event_type").alias("moved")).agg(F.count(F.lit(1)).alias("archived"))
    seen = read.groupBy("event_type").agg(F.count(F.lit(1)).alias("read"))
    joined = seen.join(counts, F.col("event_type") == F.col("moved"), "left")
    return joined.select("event_type", "read", F.coalesce("archived", F.lit(0)).alias("archived"))


@query("discard", """select 0::bigint as kept, count(*) as seen from events""")
def discard(spark, sf):
    """Rows that the null sink has taken, counted on their way into it, and those it has not."""
    events = table(spark, sf, "events")
    seen = Observation()
    files.discard(events.observe(seen, F.count(F.lit(1)).alias("seen")))
    taken = F.lit(seen.get["seen"]).cast("long")
    return events.agg((F.count(F.lit(1)) - taken).alias("kept"), F.max(taken).alias("seen"))
