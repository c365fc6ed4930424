"""Small fixtures with known answers."""

import json

import pytest
from pyspark.sql import functions as F

from flowlark.functions import json as fj
from flowlark.functions import numbers
from flowlark.functions.ids import object_id
from flowlark.functions.tags import parse_tags
from flowlark.functions.times import to_time
from flowlark.operators import bulk, dedupe, documents, metrics, points, project, routing, stats, windows
from flowlark.operators.listing import ListingState, all_pages, list_keys, load_state, save_state
from flowlark.operators.routing import REL


def rels(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns, REL).collect())


# --- statistics -------------------------------------------------------------------


def test_moments(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "x string")
    row = stats.moments(df, "x").first()
    assert (row["key"], row["count"], row["sum"], row["min"], row["max"]) == ("", 20, 190, 0, 19)
    assert row["mean"] == 9.5


@pytest.mark.parametrize("text", [None, "nan", "", "1d", "Infinity"])
def test_moments_without_numbers(spark, text):
    df = spark.createDataFrame([(text,)] * 3, "x string")
    assert stats.moments(df, "x").count() == 0


def test_single_value_has_no_deviation(spark):
    df = spark.createDataFrame([("-3",)], "x string")
    row = stats.moments(df, "x").first()
    assert (row["stddev"], row["max"]) == (0.0, -3.0)


def test_bytes(spark):
    df = spark.createDataFrame([("é",)] * 20, "content string")
    row = stats.bytes_stats(df, "content").first()
    assert (row["count"], row["sum"], row["units"]) == (20, 40.0, "Bytes")


def test_latency_with_and_without_key(spark):
    rows = [("foobar", "1000")] * 10 + [(None, "2000")] * 10 + [("foobar", "soon")]
    df = spark.createDataFrame(rows, "k string, t string")
    out = stats.latency_stats(df, "t", F.timestamp_millis(F.lit(3500)), "k")
    got = {r["key"]: (r["count"], r["mean"], r["units"]) for r in out.collect()}
    assert got == {"": (10, 1.5, "Seconds"), "foobar": (10, 2.5, "Seconds")}


def test_volume(spark):
    df = spark.createDataFrame([("a",)] * 20, "content string")
    assert stats.volume_stats(df).first().asDict() == {"key": "", "count": 20, "sum": 20}


def test_statistics_beside_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "key string, v double")
    with pytest.raises(ValueError):
        stats.with_stats(df, "v", "key")
    out = stats.with_stats(df, "v", "key", prefix="stat_").collect()
    got = sorted((r["key"] or "-", r["v"], r["stat_key"], r["stat_mean"]) for r in out)
    assert got == [("-", 5.0, "", 5.0), ("a", 1.0, "a", 2.0), ("a", 3.0, "a", 2.0)]
    assert {r["x_sum"] for r in stats.with_stats(df, "v", prefix="x_").collect()} == {9.0}


def test_merged_states_equal_direct_moments(spark):
    rows = [(1e9 + (i * 37 % 101) / 7, i % 3, i % 50) for i in range(1000)]
    df = spark.createDataFrame(rows, "v double, k int, part int")
    fine = stats.moment_state(df, "v", {"k": F.col("k"), "part": F.col("part")})
    merged = stats.finish_moments(stats.merge_moments(fine, {"k": F.col("k")}))
    direct = {r["key"]: r for r in stats.moments(df, "v", "k").collect()}
    for row in merged.collect():
        want = direct[str(row["k"])]
        assert row["count"] == want["count"]
        assert row["stddev"] == pytest.approx(want["stddev"], rel=1e-6)
        assert row["mean"] == pytest.approx(want["mean"])


# --- windows ----------------------------------------------------------------------


def seconds(spark, rows):
    df = spark.createDataFrame(rows, "id long, s long, foobar string")
    return df.withColumns({"ts": F.timestamp_seconds("s"), "k": F.lit("x")})


def test_anchored_window_closes_once(spark):
    df = seconds(spark, [(i, 0, "2") for i in range(5)] + [(5, 9, "2")])
    out = windows.anchored_tumbling(df, "foobar", "ts", "2 seconds", ["k"], ["id"])
    closed = out.filter(F.col(REL) == "elapsed").collect()
    assert [(r["window_sum"], r["window_count"]) for r in closed] == [(10.0, 5)]
    assert out.filter(F.col(REL) == "success").count() == 6


def test_anchored_windows_in_a_row(spark):
    rows = [(0, 0, "2"), (1, 9, "2"), (2, 9, "2"), (3, 20, "1"), (4, 20, "foo")]
    out = windows.anchored_tumbling(
        seconds(spark, rows), "foobar", "ts", "2 seconds", ["k"], ["id"]
    )
    closed = out.filter(F.col(REL) == "elapsed").orderBy("id").collect()
    assert [(r["window_sum"], r["window_count"]) for r in closed] == [(2.0, 1), (4.0, 2)]
    assert [r["id"] for r in out.filter(F.col(REL) == "failure").collect()] == [4]


def test_running_window_skips_bad_values(spark):
    rows = [(0, 0, "1"), (1, 1, "foo"), (2, 1, "2"), (3, 3, "4")]
    out = windows.running_tumbling(
        seconds(spark, rows), "foobar", "ts", "2 seconds", ["k"], ["id"]
    ).orderBy("id")
    got = [(r[REL], r["window_sum"], r["window_count"]) for r in out.collect()]
    assert got == [
        ("success", 1.0, 1), ("failure", None, None), ("success", 3.0, 2), ("success", 4.0, 1)
    ]


def test_batch_completion(spark):
    rows = [(i, "a", "3") for i in range(3)] + [(3, "b", "5"), (4, "b", "5")]
    rows += [(5, "c", "NaN"), (6, None, "2")]
    df = spark.createDataFrame(rows, "seq long, id string, n string")
    out = windows.batch_wait(df, "id", "n", ["seq"])
    counts = {r[REL]: r["count"] for r in out.groupBy(REL).count().collect()}
    assert counts == {"original": 7, "batch-completed": 1, "failure": 2}
    assert [tuple(r) for r in windows.batch_pending(df, "id", "n").collect()] == [("b", 5, 2)]


def test_release(spark):
    df = spark.createDataFrame([(1, 0, 1000), (2, 0, 5000)], "id long, s long, d long")
    out = windows.release_ready(
        df, F.timestamp_seconds("s"), "d", F.timestamp_seconds(F.lit(1))
    )
    assert rels(out, "id") == [(1, "success"), (2, "held")]


# --- keys --------------------------------------------------------------------------


def test_duplicates_and_blank_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, " "), (4, None), (5, "b")], "id long, k string")
    want = [(1, "non-duplicate"), (2, "duplicate"), (3, "failure"), (4, "failure"), (5, "non-duplicate")]
    assert rels(dedupe.identify_duplicates(df, "k", ["id"]), "id") == want


def test_key_set(spark):
    seen = spark.createDataFrame([("a",)], "k string")
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "id long, k string")
    flagged = dedupe.add_if_absent(keys, seen, "k", ["id"])
    assert {r["id"]: r["added"] for r in flagged.collect()} == {1: False, 2: True, 3: False, 4: True}
    after = dedupe.updated_set(seen, flagged, "k")
    assert sorted(r["k"] for r in after.collect()) == ["a", "b", "c"]
    left = dedupe.remove_keys(after, keys.filter("id = 2"), "k")
    assert sorted(r["k"] for r in left.collect()) == ["a", "c"]
    assert dedupe.remove_all(after).count() == 0 and dedupe.remove_all(after).columns == ["k"]
    held = dedupe.contains(keys, left, "k")
    assert {r["id"]: r["contained"] for r in held.collect()} == {1: True, 2: False, 3: False, 4: True}


# --- routing --------------------------------------------------------------------------


def test_bit_masks(spark):
    df = spark.createDataFrame([("44",), ("0",), ("",), (None,), ("x",)], "foo string")
    masks = {"a": 0b000100, "b": 0b010000, "c": 0b100000}
    out = routing.route_bitmask(df, "foo", masks)
    got = sorted((r["foo"] or "", r[REL]) for r in out.collect())
    assert got == [("", "failure"), ("", "failure"), ("0", "unmatched"), ("44", "a"), ("44", "c"), ("x", "failure")]
    flipped = routing.route_bitmask(df.filter("foo = '44'"), "foo", masks, flip=True)
    assert {(r[REL], r["routed_value"]) for r in flipped.collect()} == {("a", 8), ("c", 8)}
    zero = routing.route_bitmask(df.filter("foo = '0'"), "foo", {"any": 0})
    assert [r[REL] for r in zero.collect()] == ["any"]


@pytest.mark.parametrize(
    "rows, percent, a", [(10, 50, 10), (70, 30, 30), (110, 25, 35), (170, 70, 140), (9, -10, 0), (9, 100, 9)]
)

def test_split(spark, rows, percent, a):
    out = routing.split_percent(spark.range(rows), percent, ["id"])
    assert out.filter(F.col(REL) == "a").count() == a
    assert out.count() == rows


def test_retry(spark):
    df = spark.createDataFrame([(None,), ("1",), ("2",), ("3",)], "retry_counter string")
    n = F.col("retry_counter")
    out = routing.retry_gate(df, n < 3, n + 1, on_exceeded={"why": F.lit("enough")})
    got = sorted((r["retry_counter"], r[REL], r["why"], r["not_before"] is not None) for r in out.collect())
    assert got == [
        (1, "retry", None, True),
        (2, "retry", None, True),
        (3, "conditional-violated", "enough", False),
        (3, "retry", None, True),
    ]


def test_named(spark):
    assert routing.csv_names("a, b, , , b ,   ,   cat, ") == ["a", "b", "cat"]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert routing.select_named(df, None, ["name", "id"]).count() == 2
    assert routing.select_named(df, " , ", ["name", "id"]).count() == 0
    assert [r["id"] for r in routing.select_named(df, "2", ["name", "id"]).collect()] == [2]


def test_empty_content(spark):
    df = spark.createDataFrame([(1, ""), (2, "x")], "id long, c string")
    assert rels(routing.route_empty(df, "c"), "id") == [(1, "reject"), (2, "success")]
    assert rels(routing.route_empty(df, "c", False), "id") == [(1, "success"), (2, "success")]


# --- projections ------------------------------------------------------------------------


def test_md5(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    out = project.md5_columns(df, {"hx": F.col("x"), "hy": F.col("y")}).collect()
    assert out[0]["hx"] == "0cc175b9c0f1b6a831c399e269772661" and out[0][REL] == "success"
    assert (out[1]["hx"], out[1][REL]) == (None, "failure")


def test_attributes_to_json(spark):
    row = ('{"a":1}', "[1, 2]", "text", "1", "3.14", "", "3000000000", "NaN")
    names = ["Vision", "Array", "String", "Integer", "Double", "empty", "Big", "Nan"]
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    out = project.to_json_content(df, names).first()
    assert json.loads(out["content"]) == {
        "Vision": {"a": 1}, "Array": [1, 2], "String": "text", "Integer": 1, "Double": 3.14,
        "Big": 3000000000, "Nan": "NaN",
    }
    assert project.to_json_content(df, []).first()["content"] == "{}"
    bad = spark.createDataFrame([("{oops}",)], "Vision string")
    assert project.to_json_content(bad, ["Vision"]).first()[REL] == "failure"


def test_text_template(spark):
    df = spark.createDataFrame([("¿Qué?", "{{ b }}", 'q"q')], "a string, b string, c string")
    out = project.render_template(df, "{{a}} {{ b }}{{ c }} {{gone}} {x}").first()
    assert out["content"] == '¿Qué? {{ b }}q"q null {x}'
    assert project.create_content(spark, "new {{ a }}").first()["content"] == "new null"


def test_json_template(spark):
    template = json.dumps(
        {
            "pi": "{{ pi:float }}", "time": "{{time:int}}", "ok": "{{ ok:bool }}", "raw": "{{raw:json}}",
            "user": {"name": "{{ name }}"}, "list": ["{{ name }}"], "n": 1, "none": None,
        }
    )
    schema = "pi string, time string, ok string, raw string, name string"
    good = ("3.14", "1234567890123", "true", '{"k":[1]}', 'O"Neil')
    df = spark.createDataFrame([good, ("x", "1", None, "", ""), ("1", "2.5", "no", "{", "a")], schema)
    rows = project.render_json(df, template).collect()
    assert json.loads(rows[0]["content"]) == {
        "pi": 3.14, "time": 1234567890123, "ok": True, "raw": {"k": [1]},
        "user": {"name": 'O"Neil'}, "list": ["{{ name }}"], "n": 1, "none": None,
    }
    assert (rows[1][REL], rows[1]["json_error_key"], rows[1]["json_error_value"]) == ("failure", "$.pi", "x")
    assert (rows[2][REL], rows[2]["json_error_key"]) == ("failure", "$.time")
    one = project.render_json(df.limit(2), '{"a": "{{ok:bool}}", "b": "{{gone}}"}').collect()
    assert json.loads(one[1]["content"]) == {"a": None, "b": None}


def test_json_paths(spark):
    df = spark.createDataFrame([('{"a": {"b": "x", "o": {}}, "n": null}',)], "t string")

    def update(path):
        text, changed = fj.json_update("t", path, F.lit("new"))
        row = df.select(text.alias("t"), changed.alias("c")).first()
        return json.loads(row["t"]), row["c"]

    assert update("a.b") == ({"a": {"b": "new", "o": {}}, "n": None}, True)
    for path in ("a.o", "a.zzz", "n", "zzz.b"):
        assert update(path) == ({"a": {"b": "x", "o": {}}, "n": None}, False)
    got = df.select(fj.json_extract("t", "a.b").alias("x"), fj.json_extract("t", "a.q").alias("y")).first()
    assert tuple(got) == ('"x"', "null")


def test_object_ids(spark):
    ids = spark.range(2000).select(object_id().alias("o"))
    assert ids.distinct().count() == 2000
    held = "5A" * 12
    row = spark.range(1).select(
        object_id(F.lit("1500000000123")).alias("t"), object_id(F.lit(held)).alias("i")
    ).first()
    assert row["t"][:8] == f"{1500000000:08x}" and row["i"] == held.lower()


@pytest.mark.parametrize(
    "text, strict, quoted",
    [
        ("a=1, b = 2", {"a": "1", "b": "2"}, {"a": "1", "b": "2"}),
        ("a=1,b", None, {"a": "1"}),
        ("a=1,a=2", {"a": "2"}, {"a": "2"}),
        ("a=b=c", None, {"a": "b=c"}),
        ("a=1,,", {"a": "1"}, {"a": "1"}),
        ('"foo=hello, world", bar=hello', None, {"foo": "hello, world", "bar": "hello"}),
        ("  =", None, {}),
        ("", None, {}),
        (None, {}, {}),
        ("a=1, =2, c=", None, {"a": "1"}),
        ("x=1,y=2,x=3,y=4", {"x": "3", "y": "4"}, {"x": "3", "y": "4"}),
        ("ab=1,b=2", {"ab": "1", "b": "2"}, {"ab": "1", "b": "2"}),
    ],
)
def test_tags(spark, text, strict, quoted):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(parse_tags("t").alias("s"), parse_tags("t", False).alias("q")).first()
    assert (row["s"], row["q"]) == (strict, quoted)


def test_field_map(spark):
    df = spark.createDataFrame([("1.5", "x", None)], "a string, b string, c string")
    fields = project.field_map(df, {k: F.col(k) for k in "abc"})
    assert df.select(fields.alias("f")).first()["f"] == {"a": 1.5}


def test_numbers(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0)], "free double, total double")
    used = [r[0] for r in df.select(numbers.used_percent("free", "total")).collect()]
    assert used == [75.0, None]
    state = df.select(numbers.state_percent(F.lit(0.299)), numbers.state_percent(F.lit(None).cast("double")))
    assert tuple(state.first()) == (29.0, 0.0)
    assert df.select(numbers.ordinal(F.lit("b"), ["a", "b"])).first()[0] == 1.0


@pytest.mark.parametrize(
    "value, unit, text",
    [
        (1500000000123456789, "NANOSECONDS", "2017-07-14 02:40:00.123456"),
        (1500000000123456, "MICROSECONDS", "2017-07-14 02:40:00.123456"),
        (1500000000123, "milliseconds", "2017-07-14 02:40:00.123"),
        (1500000000, "SECONDS", "2017-07-14 02:40:00"),
        (25000000, "MINUTES", "2017-07-14 02:40:00"),
        (-1, "NANOSECONDS", "1969-12-31 23:59:59.999999"),
        (500000, "HOURS", "2027-01-15 08:00:00"),
        (2**62, "SECONDS", None),
    ],
)
def test_time_units(spark, value, unit, text):
    got = spark.range(1).select(to_time(F.lit(value), unit).cast("string")).first()[0]
    assert got == text


# --- documents ------------------------------------------------------------------------------


def insert_case(spark):
    docs = spark.createDataFrame([], "k string")
    rows = [(1, "a", "{}"), (2, "b", "{}"), (3, "a", "{}"), (4, "c", "{}")]
    return docs, spark.createDataFrame(rows, "seq long, k string, payload string")


@pytest.mark.parametrize("ordered, size, failed", [(False, 50, {3}), (True, 50, {3, 4}), (True, 1, {3})])
def test_insert(spark, ordered, size, failed):
    docs, rows = insert_case(spark)
    out = documents.insert(docs, rows, "k", ["seq"], ordered=ordered, batch_size=size)
    assert {r["seq"] for r in out.collect() if r[REL] == "failure"} == failed
    assert {r["seq"] for r in out.collect() if r["error_code"] == 11000} == {3}


def test_insert_bad_payload(spark):
    docs = spark.createDataFrame([("a",)], "k string")
    rows = spark.createDataFrame([(1, "b", "bad payload"), (2, "b", "{}"), (3, "a", "{}")], "seq long, k string, payload string")
    out = documents.insert(docs, rows, "k", ["seq"], payload="payload")
    assert rels(out, "seq") == [(1, "failure"), (2, "success"), (3, "failure")]


def test_find_by_array_element_and_noresult(spark):
    docs = spark.createDataFrame([("d1", ["1", "2"]), ("d2", ["2", "2"])], "d string, criteria array<string>")
    asks = spark.createDataFrame([("2",), ("9",)], "c string")
    out = documents.find(asks, docs, {"c": "criteria"}, project=["d"])
    got = sorted((r["c"], r["d"] or "", r[REL]) for r in out.collect())
    assert got == [("2", "d1", "success"), ("2", "d2", "success"), ("9", "", "noresult")]
    assert docs.filter(documents.doc_eq(docs, "criteria", "1")).count() == 1
    assert docs.filter(documents.doc_eq(docs, "d", "d2")).count() == 1


def updates_case(spark):
    docs = spark.createDataFrame([("a", 1, ["x"]), ("b", 2, None)], "k string, v int, tags array<string>")
    ups = spark.createDataFrame(
        [(1, "a", 5, "y"), (2, "a", None, "x"), (3, "z", 7, "q"), (4, None, 1, "n"), (5, "b", 9, "t"), (6, "b", 8, "t")],
        "seq long, k string, v int, tag string",
    )
    return docs, ups


def test_updates(spark):
    docs, ups = updates_case(spark)

    def after(sets, **kw):
        out = documents.update_many(docs, ups, {"k": "k"}, sets, ["seq"], **kw)
        return {r["k"]: r for r in out.collect()}

    got = after({"v": "v"})
    assert {k: r["v"] for k, r in got.items()} == {"a": 5, "b": 8}
    got = after({"v": "v"}, upsert=True)
    assert {k: r["v"] for k, r in got.items()} == {"a": 5, "b": 8, "z": 7}
    got = after({"v": "v"}, op=documents.UNSET)
    assert {k: r["v"] for k, r in got.items()} == {"a": None, "b": None}
    got = after({"tags": "tag"}, op=documents.ADD_TO_SET)
    assert got["a"]["tags"] == ["x", "y"] and got["b"]["tags"] == ["t"]
    got = after({"tags": "tag"}, op=documents.PUSH)
    assert got["a"]["tags"] == ["x", "y", "x"] and got["b"]["tags"] == ["t", "t"]
    routed = documents.route_updates(ups, ["k"], ["v"])
    assert [r["seq"] for r in routed.filter(F.col(REL) == "failure").collect()] == [2, 4]


def test_delete_matches_null(spark):
    docs = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    asks = spark.createDataFrame([(None,), ("b",)], "q string")
    assert [r["k"] for r in documents.delete_many(docs, asks, {"k": "q"}).collect()] == ["a"]


def test_pipeline_stages(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, [])], "id long, tags array<string>")
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    d = documents
    out = d.aggregate(
        docs,
        [
            d.unwind("tags"), d.lookup(names, "tags", "code", "inner"),
            d.add_fields(twice=F.col("id") * 2), d.group(["name"], n=F.count("id"), s=F.sum("twice")),
            d.sort(F.desc("n")), d.skip(0), d.limit(1),
        ],
    )
    assert [tuple(r) for r in out.collect()] == [("B", 2, 6)]
    assert d.aggregate(docs, [d.match(F.col("id") > 1), d.count()]).first()["count"] == 2
    assert d.aggregate(docs, [d.project("id")]).columns == ["id"]


def test_expire_and_violations(spark):
    docs = spark.createDataFrame([(1, 100), (2, 200), (3, None)], "id long, s long").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    left = documents.expire(docs, "ts", 50, F.timestamp_seconds(F.lit(200)))
    assert sorted(r["id"] for r in left.collect()) == [2, 3]
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in documents.violations(twice, ["k"]).collect()] == [("a", 2)]


# --- bulk ------------------------------------------------------------------------------------


def test_bulk_lines(spark):
    rows = [
        (1, "i", "INDEX", None, "{\n}"), (2, "i", "update", "7", "{}"), (3, "i", "delete", "7", "{}"),
        (4, "", "index", "7", "{}"), (5, "i", "merge", "7", "{}"), (6, "i", "upsert", None, "{}"),
        (7, "i", None, "1", "{}"),
    ]
    df = spark.createDataFrame(rows, "seq long, index string, op string, doc_id string, content string")
    df = df.withColumns({"type": F.lit("t"), "script": F.lit('{"source":\n"s"}')})
    routed = bulk.validate_actions(df)
    assert {r["seq"] for r in routed.collect() if r[REL] == "failure"} == {4, 5, 6, 7}
    good = routed.filter(F.col(REL) == "success")

    def lines(**kw):
        return {r["seq"]: r["lines"].split("\n") for r in bulk.bulk_lines(good, **kw).collect()}

    plain = lines()
    assert [json.loads(x) for x in plain[1]] == [{"index": {"_index": "i", "_type": "t"}}, {}]
    assert json.loads(plain[2][1]) == {"doc": {}, "doc_as_upsert": False}
    assert [json.loads(x) for x in plain[3]] == [{"delete": {"_index": "i", "_type": "t", "_id": "7"}}]
    assert json.loads(lines(upsert_option=bulk.DOC_AS_UPSERT)[2][1])["doc_as_upsert"] is True
    assert json.loads(lines(script="script")[2][1]) == {"script": {"source": "s"}, "upsert": {}}
    scripted = lines(script="script", upsert_option=bulk.SCRIPTED_UPSERT)[2][1]
    assert json.loads(scripted) == {"script": {"source": "s"}, "upsert": {}, "scripted_upsert": True}


def test_bulk_without_type_or_content(spark):
    rows = [(1, "index", None, None, "{}"), (2, "update", "t", "7", None), (3, "delete", None, "7", None)]
    df = spark.createDataFrame(rows, "seq long, op string, type string, doc_id string, content string")
    df = df.withColumn("index", F.lit("i"))
    routed = bulk.validate_actions(df, content="content")
    assert {r["seq"] for r in routed.collect() if r[REL] == "failure"} == {2}
    lines = {r["seq"]: r["lines"] for r in bulk.bulk_lines(routed).collect()}
    assert lines[1].split("\n") == ['{"index":{"_index":"i"}}', "{}"]
    assert lines[2] is None and lines[3] == '{"delete":{"_index":"i","_id":"7"}}'


def test_bulk_apply_keeps_new_documents(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    rows = [(1, "INDEX", None, 7), (2, "merge", "a", 9), (3, "update", "b", 5), (4, "merge", None, 1), (5, "index", None, 8)]
    actions = spark.createDataFrame(rows, "seq int, op string, id string, v int")
    new = F.concat(F.lit("new-"), F.col("seq"))
    out = bulk.apply_bulk(base, actions, "id", ["v"], ["seq"], new_id=new)
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 5), ("new-1", 7), ("new-5", 8)]


def test_numbers_beyond_doubles_stay_valid(spark):
    df = spark.createDataFrame([("1e400", "m\nx"), ("2.5", "m")], "v string, name string")
    fields = df.select(project.field_map(df, {"v": F.col("v"), "w": F.lit(float("nan"))}).alias("f")).collect()
    assert [r["f"] for r in fields] == [{}, {"v": 2.5}]
    out = points.to_points(df, F.col("name"), F.lit(None).cast("string"), {"f": F.lit(1)}, ts=F.lit(1))
    assert [r[REL] for r in out.collect()] == ["failure", "success"]
    value, bad = fj.coerce_json("v")
    assert [tuple(r) for r in df.select(value, bad).collect()] == [('"1e400"', False), ("2.5", False)]


def test_bulk_response(spark):
    asked = spark.createDataFrame([(b, p) for b in range(5) for p in range(2)], "batch int, position int")
    item = [(201, None), (400, "no")]
    answers = spark.createDataFrame(
        [(0, 503, False, []), (1, 404, True, item), (2, 200, True, item), (3, 200, False, item), (4, 302, False, [])],
        "batch int, status int, errors boolean, items array<struct<status int, reason string>>",
    )
    out = bulk.route_bulk_response(asked, answers)
    got = {(r["batch"], r["position"]): r[REL] for r in out.collect()}
    assert [got[b, 0] for b in range(5)] == ["retry", "failure", "success", "success", "failure"]
    assert [got[b, 1] for b in range(5)] == ["retry", "failure", "failure", "success", "failure"]
    assert [r["error_reason"] for r in out.collect() if r["error_reason"]] == ["no"]


# --- points and metrics -------------------------------------------------------------------------


def test_points_and_lines(spark):
    rows = [(1, "a b=x y", "1"), (2, "bad", "1"), (3, None, "n/a"), (4, None, "2")]
    df = spark.createDataFrame(rows, "id long, tags string, v string")
    out = points.to_points(
        df, F.lit("my point"), F.col("tags"), {"f": F.col("v")}, ts=F.lit(1500000000123), keep=["id"]
    )
    assert rels(out, "id") == [(1, "success"), (2, "failure"), (3, "failure"), (4, "success")]
    lines = [r[0] for r in out.filter(F.col(REL) == "success").orderBy("id").select(points.line_text()).collect()]
    assert lines == [
        r"my\ point,a\ b=x\ y f=1.0 1500000000123000000", r"my\ point f=2.0 1500000000123000000"
    ]


def test_series_guard_and_packets(spark):
    df = spark.range(25).select(
        F.lit("m").alias("measurement"),
        F.create_map(F.lit("t"), (F.col("id") % 2).cast("string")).alias("tags"),
        F.create_map(F.lit("f"), F.col("id").cast("double")).alias("fields"),
        F.timestamp_seconds("id").alias("time"),
    )
    with pytest.raises(ValueError):
        points.series_query(df, "m")
    raw = points.series_query(df, "m", group_tags=["t"])
    packets = points.series_packets(raw, "m", ["tag_t"], ["time", "values"], rows=5)
    sizes = {(r["tags"]["t"], r["packet"]): len(r["values"]) for r in packets.collect()}
    one = packets.first()
    assert (one["measurement"], one["columns"], one["precision"]) == ("m", ["time", "values"], "MILLISECONDS")
    assert sizes == {("0", 0): 5, ("0", 1): 5, ("0", 2): 3, ("1", 0): 5, ("1", 1): 5, ("1", 2): 2}
    total = points.series_query(df, "m", where=F.lit(True), aggs={"s": F.sum(points.field("f"))})
    assert total.first()["s"] == 300.0


def test_status_entities(spark):
    group = {f: float(i) for i, f in enumerate(metrics.ENTITY_FIELDS["process_group"])}
    df = spark.createDataFrame([{**group, "processGroupName": "root", "id": "1"}])
    memory = spark.createDataFrame([(1.0, 4.0)], "free double, total double").withColumn(
        "usedPercent", numbers.used_percent("free", "total")
    )
    both = metrics.union_points(
        metrics.status_to_points(df, "process_group"), metrics.status_to_points(memory, "memory")
    )
    got = {r["measurement"]: r for r in both.collect()}
    assert got["process_group"]["fields"] == group
    assert got["process_group"]["tags"] == {"processGroupName": "root", "id": "1"}
    assert got["memory"]["fields"] == {"free": 1.0, "total": 4.0, "usedPercent": 75.0}


def test_tree_cycle_is_an_error(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string")
    with pytest.raises(ValueError):
        metrics.flatten_tree(nodes, edges, nodes.limit(1))


def test_gc_and_states(spark):
    df = spark.createDataFrame([("G1 Young Gen", 3, 40)], "n string, runs long, ms long")
    assert {tuple(r) for r in metrics.flatten_gc(df, "n", "runs", "ms").collect()} == {
        ("jvm.gc.runs.G1YoungGen", 3.0), ("jvm.gc.time.G1YoungGen", 40.0)
    }
    states = spark.createDataFrame([("RUNNABLE", 0.456), ("NEW", 0.1), ("BLOCKED", None)], "s string, v double")
    assert {tuple(r) for r in metrics.normalize_states(states, "s", "v").collect()} == {
        ("jvm.thread_states.runnable", 45.0), ("jvm.thread_states.blocked", 0.0)
    }


def test_snapshot_parts(spark):
    df = spark.range(5).select(F.lit("g").alias("g"), "id")
    out = metrics.snapshot_json(df, ["g"], ["id"], ["id"], part_rows=2).orderBy("part").collect()
    assert [json.loads(r["snapshot"])["members"] for r in out] == [
        [{"id": 0}, {"id": 1}], [{"id": 2}, {"id": 3}], [{"id": 4}]
    ]


# --- listing ---------------------------------------------------------------------------------------


def test_listing_pages(spark, tmp_path):
    keys = [f"one/abc/0{i}/{c}" for i in range(1, 4) for c in "AB"] + ["one/é", "two/x"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    state, seen = None, []
    while state is None or not state.complete:
        page, state = list_keys(df, "one/abc/", "01/A", "03/B", state=state, limit=2)
        seen.append([r["key"] for r in page.orderBy("key").collect()])
    assert seen[0] == ["one/abc/01/B", "one/abc/02/A"]
    assert sum(seen, []) == ["one/abc/01/B", "one/abc/02/A", "one/abc/02/B", "one/abc/03/A"]
    assert state.processed == 4
    page, same = list_keys(df, "one/abc/", "01/A", "03/B", state=state, limit=2)
    assert page.count() == 0 and same == state
    page, other = list_keys(df, "two/", state=state)
    assert page.count() == 1 and other.processed == 1
    save_state(spark, state, str(tmp_path / "state"))
    assert load_state(spark, str(tmp_path / "state")) == state
    assert isinstance(state, ListingState)
    pages = {r["key"]: r["page"] for r in all_pages(df, "one/abc/", limit=4).collect()}
    assert pages["one/abc/02/B"] == 0 and pages["one/abc/03/A"] == 1


def test_points_without_measurement_and_with_fixed_now(spark):
    df = spark.createDataFrame([(1, "m"), (2, None), (3, ""), (4, "n")], "id long, name string")
    at = F.timestamp_micros(F.lit(1_500_000_000_123_456))
    out = points.to_points(df, F.col("name"), F.lit("a=b"), {"v": F.lit(3.0)}, now=at, keep=["id"])
    assert rels(out, "id") == [(1, "success"), (2, "failure"), (3, "failure"), (4, "success")]
    lines = out.filter(F.col(REL) == "success").orderBy("id").select(points.line_text()).collect()
    assert [r[0] for r in lines] == [f"{m},a=b v=3.0 1500000000123456000" for m in "mn"]


def test_index_with_empty_id_is_a_document_of_its_own(spark):
    base = spark.createDataFrame([("a", 1)], "id string, v int")
    rows = [(1, "index", "", 7), (2, "update", "", 9), (3, "index", None, 8), (4, "upsert", "", 5), (5, "index", "b", 2)]
    actions = spark.createDataFrame(rows, "seq int, op string, id string, v int")
    new = F.concat(F.lit("new-"), F.col("seq"))
    out = bulk.apply_bulk(base, actions, "id", ["v"], ["seq"], new_id=new)
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 2), ("new-1", 7), ("new-3", 8)]


def test_names_given_twice_in_metrics(spark):
    df = spark.createDataFrame([("n1", 2.0)], "place string, load double")
    made = metrics.status_to_points(
        df, "load", ["place"], ["load"], {"place": F.lit("all"), "zone": F.lit("z")}, F.timestamp_seconds(F.lit(0))
    )
    assert made.first()["tags"] == {"place": "all", "zone": "z"}
    data = metrics.metric_datums(df, "place", ["load"], {metrics.LOCATION: F.lit("x"), "zone": F.lit("z")})
    assert data.first()["dimensions"] == {metrics.LOCATION: "n1", "zone": "z"}


# --- trees -----------------------------------------------------------------------------------------


def all_ways(edges, roots):
    below = {}
    for a, b in edges:
        below.setdefault(a, []).append(b)
    out, todo = [], [[r] for r in roots]
    while todo:
        way = todo.pop()
        out.append((way[-1], len(way) - 1, tuple(way)))
        todo += [[*way, child] for child in below.get(way[-1], [])]
    return sorted(out)


def ways_of(spark, edges, roots, count):
    nodes = spark.range(count).select("id", F.lit(1.0).alias("m"))
    table = spark.createDataFrame(edges, "parent long, child long")
    return metrics.flatten_tree(nodes, table, spark.createDataFrame([(r,) for r in roots], "id long"))


def test_deep_tree_takes_logarithmic_rounds(spark, monkeypatch):
    written = []
    keep = metrics.materialize
    monkeypatch.setattr(metrics, "materialize", lambda df: written.append(1) or keep(df))
    flat = ways_of(spark, [(i, i + 1) for i in range(1000)], [0], 1001)
    assert len(written) <= 12
    got = sorted(flat.select("id", "depth", F.element_at("path", 1), F.size("path")).collect())
    assert got == [(i, i, 0, i + 1) for i in range(1001)]


@pytest.mark.parametrize("seed", range(3))
def test_trees_with_several_parents_and_nested_roots(spark, seed):
    rnd = __import__("random").Random(seed)
    edges = [(rnd.randint(max(0, i - 6), i - 1), i) for i in range(1, 60)]
    edges += [(rnd.randint(0, i - 1), i) for i in rnd.sample(range(1, 60), 8)]
    roots = [0, 5, 17]
    edges += [(60, 61), (61, 62), (62, 61), (63, 63)]  # circles that no root leads to
    flat = ways_of(spark, edges, roots, 64)
    assert sorted((r["id"], r["depth"], tuple(r["path"])) for r in flat.collect()) == all_ways(edges, roots)


@pytest.mark.parametrize("back", [(9, 9), (9, 3), (9, 0)])
def test_circles_below_a_root_are_errors(spark, back):
    with pytest.raises(ValueError):
        ways_of(spark, [(i, i + 1) for i in range(9)] + [back], [0], 10)
