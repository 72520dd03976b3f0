from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions import (
    day_hour, format_ms, ip_to_long, local_date, not_equal, parse_delimited, parse_json, poison_guard,
    quarantine_poison, split_delimited, split_json, strip_ws, tokenize, window_label,
)
from streamlytics.functions import udfs
from streamlytics.operators import connect_flat_map, connect_map, union_all


def words(df):
    return [r.word for r in df.collect()]


def test_tokenize_normalises_and_drops_trailing_empties(lines):
    assert words(tokenize(lines("A, b ,,C,,"))) == ["a", "b", "", "c"]
    assert words(tokenize(lines(",a"))) == ["", "a"]
    assert words(tokenize(lines("x\t,\n Y"))) == ["x", "y"]


def test_tokenize_edge_lines(lines):
    assert words(tokenize(lines(",,,"))) == []
    assert words(tokenize(lines(""))) == [""]
    assert words(tokenize(lines(None))) == []
    assert words(tokenize(lines("a,,"), drop_trailing_empty=False)) == ["a", "", ""]
    assert words(tokenize(lines("a,,b"), drop_empty=True)) == ["a", "b"]
    assert words(tokenize(lines("A,b"), normalise=False)) == ["A", "b"]


def test_tokenize_separator_is_literal(lines):
    assert words(tokenize(lines("a.b|c"), ".")) == ["a", "b|c"]
    assert words(tokenize(lines("a||b||||"), "||")) == ["a", "b"]
    assert words(tokenize(lines("||||"), "||")) == []


def test_strip_ws_takes_control_characters(lines):
    assert lines("\t\r\n a b \x0b").select(strip_ws(F.col("value"))).first()[0] == "a b"


def test_parse_delimited(lines):
    good = parse_delimited(lines(" 1000 ,\t www.x.com\r,\t5.5 \r", "2,a,1,extra"), schemas.ACCESS)
    assert rows(good) == [(1000, "www.x.com", 5.5), (2, "a", 1.0)]
    assert good.schema["time"].dataType.typeName() == "long"


@pytest.mark.parametrize("line", ["x,a,1", "1,a", "1,a,b", "", None])
def test_parse_delimited_fails_on_bad_line(lines, line):
    df = parse_delimited(lines("1,a,2", line), schemas.ACCESS)
    with pytest.raises(Exception, match="cannot parse line"):
        # Neither a pruned column nor a filter on top may hide the failure.
        df.filter("time is not null").select("domain").collect()


def test_split_delimited_keeps_rejects(lines):
    good, bad = split_delimited(lines("1,a,2", "x,a,1", "1", None), schemas.ACCESS)
    assert rows(good) == [(1, "a", 2.0)]
    assert sorted(r.value or "" for r in bad.collect()) == ["", "1", "x,a,1"]


def event(**values):
    return json.dumps(values)


def test_parse_json_good_and_bad_rows(lines):
    text = [
        event(device="a", event="startup", nu=1, time=5, product={"category": "c", "name": "n"}),
        event(device="b", time="7"),                      # quoted number, missing int
        event(device="c", nu="x"),                        # wrong type
        "not json", "", None, "null", "[1]", '{"device":"d"} tail', '{"device":"d"}{"device":"e"}', '{"device":"d"} x }', '{"device":',
        event(device="e", nu=2.7),                        # fraction is cut
        event(device="f", product=None, event=None),
    ]
    good, bad = split_json(lines(*text), schemas.APP_EVENT, defaults=schemas.APP_EVENT_DEFAULTS)
    got = {r.device: r for r in good.collect()}
    assert set(got) == {"a", "b", "e", "f"}
    assert (got["a"].nu, got["a"].time, got["a"].product.name) == (1, 5, "n")
    assert (got["b"].nu, got["b"].nu2, got["b"].time, got["b"].product) == (0, 0, 7, None)
    assert got["e"].nu == 2 and got["f"].event is None
    assert good.schema["nu"].dataType.typeName() == "integer"
    assert bad.count() == len(text) - 4


def test_json_is_parsed_once(lines, capsys):
    parse_json(lines("{}"), schemas.SHOPPING).filter("behavior = 'pv' and user_id > 1").explain()
    assert capsys.readouterr().out.count("from_json") == 2  # the record, and the mark that nothing follows it


def test_calendar_keys(spark):
    # 2024-01-31 16:00 UTC is the start of 1 February in Shanghai.
    df = spark.createDataFrame([(1706716800000,), (1706716799999,)], "time bigint")
    assert rows(df.select(local_date("time").cast("string"))) == [("2024-01-31",), ("2024-02-01",)]
    assert rows(day_hour(df), "day", "hour") == [("20240131", "15"), ("20240131", "16")]
    assert rows(day_hour(df, zone="Asia/Shanghai"), "day", "hour") == [("20240131", "23"), ("20240201", "00")]
    label = df.select(window_label(F.lit(0), F.lit(5000), F.lit("a"), F.lit(3))).first()[0]
    assert label == "[1970-01-01 00:00:00==>1970-01-01 00:00:05], a==>3"
    assert df.select(format_ms(F.lit(0), "yyyy")).first()[0] == "1970"


def test_not_equal_passes_null(lines):
    assert rows(lines("startup", "x", None).filter(not_equal("value", "startup"))) == [("x",), (None,)] or \
        rows(lines("startup", "x", None).filter(not_equal("value", "startup"))) == [(None,), ("x",)]


def test_poison(lines):
    clean, poison = quarantine_poison(lines("ab", "axxb", None), "xx")
    assert {r.value for r in clean.collect()} == {"ab", None}
    assert rows(poison) == [("axxb",)]
    assert poison_guard(lines("ab", None), "xx").count() == 2
    with pytest.raises(Exception, match="poison record"):
        poison_guard(lines("ab", "axxb"), "xx").filter("value <> 'axxb'").count()


@pytest.mark.parametrize("ip, number", [
    ("0.0.0.1", 1), ("10.1.2.3", 167838211), ("255.255.255.255", 4294967295), ("256.0.0.1", None), ("1.2.3", None),
    ("a.b.c.d", None), ("", None), (None, None), ("1.2.3.4.5", None),
])
def test_ip_to_long(lines, ip, number):
    assert lines(ip).select(ip_to_long("value")).first()[0] == number


def test_ip_parser_in_sql(spark, lines):
    ranges = spark.createDataFrame([(10, 20, "P", "C"), (30, 40, "Q", None)], schemas.IP_RANGE)
    udfs.register_ip_parser(spark, ranges)
    lines("0.0.0.10", "0.0.0.20", "0.0.0.21", "0.0.0.31", "0.0.0.9", "junk", None).createOrReplaceTempView("ips")
    got = {r.value: r.place for r in spark.sql("select value, ip_parser(value) as place from ips").collect()}
    assert got == {"0.0.0.10": "P-C", "0.0.0.20": "P-C", "0.0.0.21": "---", "0.0.0.31": "Q--", "0.0.0.9": "---",
                   "junk": "---", None: "---"}
    overlapping = spark.createDataFrame([(0, 100, "P", "C"), (50, 60, "Q", "D")], schemas.IP_RANGE)
    udfs.register_ip_parser(spark, overlapping, "place_of")
    assert [r[0] for r in spark.sql(
        "select place_of(ip) from values ('0.0.0.55'), ('0.0.0.80'), ('0.0.0.101') as t(ip)").collect()] == ["Q-D", "P-C", "---"]


def test_lifecycle_runs_once_per_task(spark, tmp_path):
    log = str(tmp_path)

    def setup():
        import uuid

        open(f"{log}/open-{uuid.uuid4()}", "w").close()
        return 10

    def teardown(handle):
        import uuid

        open(f"{log}/close-{uuid.uuid4()}", "w").close()

    out = udfs.map_with_lifecycle(
        spark.range(0, 100, 1, 3), "id bigint", lambda h, b: b.assign(id=b["id"] * h), setup, teardown)
    assert out.agg(F.sum("id")).first()[0] == 49500
    names = [p.name for p in tmp_path.iterdir()]
    assert sum(n.startswith("open") for n in names) == 3 == sum(n.startswith("close") for n in names)


def test_split_words_table_function(spark):
    udfs.register_split_words(spark)
    got = spark.sql("select word from values ('a,b,,'), (',,'), ('') t(v), lateral split_words(v, ',')")
    assert sorted(r.word for r in got.collect()) == ["", "a", "b"]


def test_row_counter(spark):
    df, seen = udfs.counted(spark.range(42))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows_passed"] == 42


def test_union_is_a_bag(lines):
    one = lines("a", "b")
    assert rows(union_all(one, one)) == [("a",), ("a",), ("b",), ("b",)]


def test_connect_map_and_flat_map(spark, lines):
    numbers = spark.createDataFrame([(1,), (2,)], "n int")
    both = connect_map(lines("ab"), numbers, [F.upper("value").alias("v")], [(F.col("n") * 10).cast("string").alias("v")])
    assert rows(both) == [("10",), ("20",), ("AB",)]
    flat = connect_flat_map(lines("a b c", "d e f"), lines("1,2,3", "4,5,6"))
    assert sorted(words(flat)) == list("123456abcdef")
