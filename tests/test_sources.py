from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import schemas, sources
from streamlytics.session import shared_dir, shared_root
from streamlytics.sources.jdbc import table_options
from streamlytics.sources.settings import parse_settings

PROPERTIES = """
# comment
group.id=user_behavior
bootstrap.servers=broker:9092
kafka.input.topics=t1,t2
is.from.begining=true
checkpoint.interval=7000
checkpoint.path=file:///opt/state
"""


def test_settings_map_to_reader_options(tmp_path, spark):
    path = tmp_path / "job.properties"
    path.write_text(PROPERTIES)
    job = sources.load_settings(str(path))
    assert job.reader_options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "t1,t2", "startingTimestamp": "0"}
    assert job.trigger == {"processingTime": "7000 milliseconds"}
    assert job.checkpoint(spark, "pv") == "file:///opt/state/pv"
    assert job.get("group.id") == "user_behavior" and job.get("nope", "x") == "x"


def test_settings_defaults(spark):
    job = parse_settings("bootstrap.servers=b\nkafka.input.topics=t")
    assert job.reader_options["startingOffsets"] == "earliest"
    assert "startingTimestamp" not in job.reader_options
    assert job.trigger == {"processingTime": "5000 milliseconds"}
    assert (job.get("group.id"), job.get("enable.auto.commit")) == ("test1", "false")
    assert job.checkpoint(spark, "q") == job.checkpoint(spark, "q") == f"{shared_root(spark)}/jobs/q"


@pytest.mark.parametrize("text", ["bootstrap.servers=b", "kafka.input.topics=t", ""])
def test_required_settings(text):
    with pytest.raises(KeyError, match="missing required"):
        parse_settings(text)


def test_kafka_rows_are_decoded(spark):
    row = (None, bytearray("héllo".encode()), "t", 0, 5, None, 0)
    df = spark.createDataFrame([row], schemas.KAFKA_ROW)
    assert rows(sources.kafka_records(df)) == [("t_0_5", "héllo")]
    assert rows(sources.kafka_lines(df)) == [("héllo",)]


def test_text_and_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,2.5\n2,y,3\n")
    assert rows(sources.text_lines(spark, str(tmp_path))) == [("1,x,2.5",), ("2,y,3",)]
    df = sources.csv_view(spark, str(tmp_path), schemas.ACCESS, "csv_access")
    assert rows(df) == [(1, "x", 2.5), (2, "y", 3.0)]
    assert spark.sql("select sum(traffic) from csv_access").first()[0] == 5.5
    assert sources.text_lines(spark, str(tmp_path), stream=True, max_files=1).isStreaming


def test_elements_and_sequence(spark):
    assert rows(sources.elements(spark, [(1, "a", 2)], "id int, name string, age int")) == [(1, "a", 2)]
    numbers = sources.number_sequence(spark, 1, 10, 5)
    assert numbers.rdd.getNumPartitions() == 5
    assert [r.id for r in numbers.filter("id >= 5").collect()] == [5, 6, 7, 8, 9, 10]
    assert [r[0] for r in sources.elements(spark, [(1,), (2,), (3,)], "x int").select(F.col("x") * 2).collect()] == [2, 4, 6]


def test_generated_access_rows_repeat(spark):
    one, two = (rows(sources.access_rows(spark, 500, ["x.org", "y.org"], 77, 20.0, tasks=3)) for _ in range(2))
    assert one == two and len(one) == 500
    assert {d for _, d, _ in one} == {"x.org", "y.org"}
    assert all(t == 77 and 20 <= traffic < 21 for t, _, traffic in one)


def test_generator_stream(spark):
    df = sources.access_stream(spark, ["x.org", "y.org"], 77, 20.0, tasks=3)
    assert df.isStreaming and df.columns == ["time", "domain", "traffic"]
    query = df.writeStream.format("memory").queryName("generated").trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(40):
            query.awaitTermination(0.5)
            if spark.table("generated").count() >= 12:
                break
    finally:
        query.stop()
    assert spark.table("generated").filter("traffic between 20 and 21").count() >= 12


def test_jdbc_options():
    assert table_options("student") == {"dbtable": "student", "fetchsize": "10000"}
    split = table_options("student", "id", (0, 900), 3)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "900", "3")
    with pytest.raises(ValueError):
        table_options("student", "id")


def test_shared_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{root}/x/")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_package_code_travels_by_value():
    from pyspark import cloudpickle

    assert "streamlytics" in cloudpickle.list_registry_pickle_by_value()
