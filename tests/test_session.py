import pytest
from pyspark.sql import functions as F

from topictally.functions.windows import instant
from topictally.session import scratch_folder, shared_folder


class Settings(dict):
    """The part of a session that names its settings."""

    @property
    def conf(self):
        return self


def test_the_shared_folder_is_the_one_the_cluster_names():
    named = Settings({"spark.checkpoint.dir": "hdfs://shared/x/", "spark.master": "yarn"})
    assert shared_folder(named) == "hdfs://shared/x"


def test_scratch_folders_are_new_and_there(spark):
    first, second = scratch_folder(spark, "run"), scratch_folder(spark, "run")
    assert first != second and first.startswith(f"{shared_folder(spark)}/run-")
    assert spark.read.schema("a int").parquet(first).isEmpty()


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(Settings({"spark.master": "yarn"}))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tehran", "Europe/Berlin"])
def test_zone_less_timestamps_are_utc(spark, zone):
    times = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00.5' AS t UNION ALL SELECT NULL")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = times.select(F.unix_millis(instant(times, "t")).alias("m")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r["m"] for r in got} == {1_711_852_200_500, None}
