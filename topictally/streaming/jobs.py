"""Named streaming jobs (STR-4, STR-5)."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topictally.session import ROCKSDB_PROVIDER, shared_folder

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
RESTART_CONF = "spark.sql.streaming.stopActiveRunOnRestart"
PARTITIONS_CONF = "spark.sql.shuffle.partitions"

_STARTING = Lock()


class Job:
    """A streaming job: its name and the folder that keeps its progress and state.

    The folder defaults to one of the job's name below the shared folder, so a job started again
    goes on where it stopped. Two running jobs cannot share a name or a folder.

    ``partitions`` is the number of parts the job's state is kept in, the session's number of shuffle
    partitions if not given. The first start settles it for good.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        checkpoint_dir: str | None = None,
        partitions: int | None = None,
    ):
        self.spark = spark
        self.name = name
        self.partitions = partitions
        self.checkpoint_dir = checkpoint_dir or f"{shared_folder(spark)}/jobs/{name}"

    @property
    def state_dir(self) -> str:
        """Folder for state the job keeps itself, next to Spark's checkpoint."""
        return f"{self.checkpoint_dir}/job-state"

    def state(self, operator: int = 0) -> DataFrame:
        """The state of one of the job's operators as it last was, by Spark's state data source.

        Operators are numbered from the source. One row per key, with the structs ``key`` and ``value`` and the
        number of the state's part, ``partition_id``; for checks, and for taking counts over into another job.
        The job may run meanwhile, and no part of the state passes the driver.
        """
        reader = self.spark.read.format("statestore").option("operatorId", operator)
        return reader.load(self.checkpoint_dir)

    def start(self, writer: DataStreamWriter, available_now: bool = False) -> StreamingQuery:
        """Start the job; ``available_now`` makes it end once all present input is read."""
        writer = writer.queryName(self.name).option("checkpointLocation", self.checkpoint_dir)
        if available_now:
            writer = writer.trigger(availableNow=True)
        # A query takes over the session's settings when it starts; one job starts at a time.
        with _STARTING:
            self.spark.conf.set(PROVIDER_CONF, ROCKSDB_PROVIDER)
            # By default Spark would stop the first of two queries on one checkpoint. Refuse instead.
            self.spark.conf.set(RESTART_CONF, "false")
            session_partitions = self.spark.conf.get(PARTITIONS_CONF)
            self.spark.conf.set(PARTITIONS_CONF, str(self.partitions or session_partitions))
            try:
                return writer.start()
            finally:
                self.spark.conf.set(PARTITIONS_CONF, session_partitions)

    def run(
        self,
        writer: DataStreamWriter,
        available_now: bool = False,
        seconds: float | None = None,
    ) -> StreamingQuery:
        """Run to the end of the present input, for some seconds, or until stopped."""
        query = self.start(writer, available_now)
        if available_now or seconds is None:
            query.awaitTermination()
        else:
            try:
                query.awaitTermination(seconds)
            finally:
                query.stop()
        return query
