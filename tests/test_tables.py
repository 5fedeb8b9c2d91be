import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from topictally.operators import newest
from topictally.session import Folder
from topictally.sources import TopicSettings, batch_writer, read_table
from topictally.sources.codecs import schema_text

UPDATES = "key string, value bigint, batch bigint, offset bigint"


def test_the_last_value_of_a_key_holds(spark):
    rows = [("a", 1, 0, 5), ("a", 3, 2, 1), ("a", 2, 1, 9), ("b", 7, 0, 0), (None, 1, 0, 0), (None, 4, 3, 0)]
    got = newest(spark.createDataFrame(rows, UPDATES).repartition(3))
    assert rows_of(got, "key", "value") == sorted([("a", 3), ("b", 7), (None, 4)], key=repr)
    by_offset = newest(spark.createDataFrame(rows, UPDATES), order=["offset", "batch"])
    assert rows_of(by_offset, "key", "value") == sorted([("a", 2), ("b", 7), (None, 4)], key=repr)


def test_a_null_removes_its_key_until_a_value_comes(spark):
    rows = [("a", 1, 0, 0), ("a", None, 1, 0), ("b", 1, 0, 0), ("b", None, 1, 0), ("b", 5, 2, 0), ("c", None, 0, 0)]
    updates = spark.createDataFrame(rows, UPDATES)
    assert rows_of(newest(updates), "key", "value") == [("b", 5)]
    assert rows_of(newest(updates, keep_removed=True), "key", "value") == [("a", None), ("b", 5), ("c", None)]
    assert newest(updates.limit(0)).collect() == []


@pytest.mark.parametrize("encoded", [False, True])
def test_an_update_topic_is_a_table(spark, tmp_path, encoded):
    """A batch that is written again replaces itself, as after a restart."""
    settings = TopicSettings(root=str(tmp_path), encoded=encoded)
    write = batch_writer("t", settings)
    for batch_id, rows in [(0, [("a", 1), ("b", 1)]), (1, [("a", 2)]), (1, [("a", 2)]), (2, [("b", None), ("c", 9)])]:
        write(spark.createDataFrame(rows, "key string, value bigint"), batch_id)
    table = read_table(spark, "t", settings, "string", "bigint")
    assert rows_of(table, "key", "value") == [("a", 2), ("c", 9)]


def test_updates_of_one_key_meet_as_one_row_a_task(spark):
    updates = spark.range(0, 10_000, numPartitions=4).select(
        F.lit("hot").alias("key"), F.col("id").alias("value"), (F.col("id") % 100).alias("batch")
    )
    got = newest(updates)
    assert rows_of(got, "key", "value") == [("hot", 9999)]
    assert "partial_max" in got._jdf.queryExecution().executedPlan().toString()


def test_schemas_may_lie_in_files(spark, tmp_path):
    Folder(spark, str(tmp_path)).write_text("view.avsc", '{"type": "record"}')
    assert schema_text(spark, f"{tmp_path}/view.avsc") == '{"type": "record"}'
    assert schema_text(spark, ' {"type": "long"}') == ' {"type": "long"}'
    with pytest.raises(FileNotFoundError):
        schema_text(spark, f"{tmp_path}/none.avsc")
