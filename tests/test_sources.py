import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from salesboard.session import fresh_dir
from salesboard.sources import topic as T
from salesboard.streaming import feeder as FD
from salesboard.streaming.feeder import log_slice, with_line_ordinal


def test_line_ordinals_follow_read_order(spark):
    path = fresh_dir(spark, "t-text")
    spark.range(0, 1000, numPartitions=1).select(F.format_string("line %04d", "id").alias("value")) \
        .write.text(path)
    lines = spark.read.text(path)
    got = with_line_ordinal(lines).collect()
    assert sorted(r.ordinal for r in got) == list(range(1000))
    assert all(r.value == f"line {r.ordinal:04d}" for r in got)
    sl = log_slice(with_line_ordinal(lines), 10, 5).orderBy("ordinal").collect()
    assert [r.value for r in sl] == [f"line {i:04d}" for i in range(10, 15)]


@pytest.mark.parametrize("block", [900, 1 << 20])
def test_line_ordinals_over_files_of_unlike_sizes(spark, tmp_path, block):
    from salesboard.session import conf_override
    want = []
    for name, n in (("a.log", 2), ("b.log", 1000), ("c.log", 0), ("d.log", 40)):
        lines = [f"{name} {k}" for k in range(n)]
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
        want += lines
    with conf_override(spark, {"spark.sql.files.maxPartitionBytes": str(block)}):
        got = with_line_ordinal(spark.read.text(str(tmp_path))).orderBy("ordinal").collect()
    assert [(r.ordinal, r.value) for r in got] == list(enumerate(want))


def test_start_offsets(spark):
    led = spark.createDataFrame([("b", 1, 7), ("a", 10, 5), ("a", 2, 3)],
                                "topic string, partition int, next_offset long")
    assert T.start_offsets(led).first()[0] == '{"a":{"2":3,"10":5},"b":{"1":7}}'
    empty = spark.createDataFrame([], "topic string, partition int, next_offset long")
    assert T.starting_offsets_option(empty) == "earliest"


def test_latest_offsets_last_write_wins(spark):
    led = spark.createDataFrame([("a", 0, 5, 0), ("a", 0, 9, 1), ("a", 1, 4, 0)],
                                "topic string, partition int, next_offset long, batch_id long")
    got = {(r.topic, r.partition): r.next_offset for r in T.latest_offsets(led).collect()}
    assert got == {("a", 0): 9, ("a", 1): 4}


def test_topic_reader_needs_the_connector(spark):
    # the Kafka connector jar is not bundled; the reader is built but cannot resolve
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        T.read_topic(spark, "localhost:9", "sales")


def test_files_of_an_arrival_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(FD, "FILE_ROWS", 500)
    monkeypatch.setattr(FD, "FILE_LEAST_ROWS", 50)
    root = fresh_dir(spark, "t-files")
    log = spark.range(0, 4000, numPartitions=3).select(F.col("id").alias("ordinal"), F.concat(F.lit("line "), "id").alias("value"))
    feeder = FD.Feeder(spark, log, f"{root}/staging", f"{root}/source", 2)
    assert feeder.files == 4                                      # 2,000 rows an arrival
    for k in (0, 1):
        feeder.publish(k)
        parts = [r["count"] for r in spark.read.parquet(feeder.source).groupBy(F.input_file_name()).count().collect()]
        assert len(parts) == 4 * (k + 1) and max(parts) <= 600
    assert sorted(r.value for r in spark.read.parquet(feeder.source).collect()) == sorted(f"line {i}" for i in range(4000))


@pytest.mark.parametrize("sizes, files", [([], 2), ([1, 1], 2), ([60_000, 40_000], 2), ([150_001, 150_000], 4), ([10**6, 3], 2), ([10**6, 7_000], 7)])
def test_a_sparse_arrival_fills_all_its_files(sizes, files):
    assert FD.arrival_files(sizes, 2) == files
