"""Rows that one micro-batch leaves for the next, as a log of layers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from topictally.session import Folder

#: Layers a bucket may have before its newest ones are merged.
LAYERS = 8

Merge = Callable[[DataFrame], DataFrame]


class CarriedLog:
    """State of a job that keeps it itself: each micro-batch appends a layer of what changed.

    Rows are dealt to buckets by a hash of ``keys``. ``merge`` turns any rows into those that say the same,
    such as sums per key or the last rows of a key; it must not matter how rows are grouped before. So a batch
    writes no more than its own rows, and reads only the buckets they fall into.

    A bucket with more than ``layers`` layers gets its newest ones merged, and older ones with them as long
    as they are not more than twice as large. A row is thus rewritten a logarithmic number of times.

    A list per micro-batch names the layers of each bucket. Batch ``n`` reads the list of ``n - 1`` and only adds
    files, so it can be run again. Layers are deleted once neither of the two newest lists names them.

    ``parts`` is the number of buckets, by default that of shuffle partitions; the first batch settles it.
    Rows to append should come grouped by the keys: then each bucket is one file.
    """

    def __init__(
        self,
        folder: str,
        schema: StructType,
        keys: Sequence[str],
        merge: Merge,
        parts: int | None = None,
        layers: int = LAYERS,
    ):
        self.folder = folder
        self.schema = schema
        self.keys = list(keys)
        self.merge = merge
        self.parts = parts
        self.layers = layers

    def at(self, spark: SparkSession, batch_id: int) -> CarriedState:
        """The state that batch ``batch_id`` finds and adds to."""
        return CarriedState(self, spark, batch_id)


class CarriedState:
    """A log as one micro-batch sees it."""

    def __init__(self, log: CarriedLog, spark: SparkSession, batch_id: int):
        self.log = log
        self.spark = spark
        self.batch_id = batch_id
        self.files = Folder(spark, log.folder)
        found = self._list(batch_id - 1) if batch_id else None
        if batch_id and found is None:
            raise RuntimeError(f"{log.folder} has no list of batch {batch_id - 1}")
        parts = log.parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = found or {"parts": parts, "facts": {}, "chains": {}}
        self.parts: int = found["parts"]
        self.facts: dict = found["facts"]
        #: Name and bytes of each bucket's layers, oldest first.
        self.chains = {int(b): [tuple(x) for x in c] for b, c in found["chains"].items()}
        self.added: dict[int, tuple[str, int]] = {}

    def _list(self, batch_id: int) -> dict | None:
        text = self.files.read_text(f"lists/{batch_id}")
        return None if text is None else json.loads(text)

    def bucket(self) -> Column:
        # The hash that Spark deals rows by, so rows grouped by the keys already lie by bucket.
        return F.pmod(F.hash(*self.log.keys), F.lit(self.parts))

    def _write(self, rows: DataFrame, name: str) -> dict[int, tuple[str, int]]:
        placed = rows.select(*self.log.schema.names, self.bucket().alias("bucket"))
        writer = placed.write.mode("overwrite").partitionBy("bucket")
        writer.parquet(f"{self.log.folder}/layer={name}")
        sizes = self.files.sizes(f"layer={name}")
        return {int(d.removeprefix("bucket=")): (name, n) for d, n in sizes.items() if d.startswith("bucket=")}

    def _read(self, chains: dict[int, Iterable[tuple[str, int]]]) -> DataFrame:
        """The rows of some layers of some buckets, not merged."""
        buckets_of: dict[str, list[int]] = {}
        for bucket, chain in chains.items():
            for name, _ in chain:
                buckets_of.setdefault(name, []).append(bucket)
        if not buckets_of:
            return self.spark.createDataFrame([], self.log.schema)
        extra = [StructField("layer", StringType()), StructField("bucket", IntegerType())]
        reader = self.spark.read.schema(StructType([*self.log.schema, *extra]))
        paths = [f"{self.log.folder}/layer={name}" for name in sorted(buckets_of)]
        table = reader.option("basePath", self.log.folder).parquet(*paths)
        wanted = F.lit(False)
        for name, buckets in buckets_of.items():
            wanted = wanted | ((F.col("layer") == name) & F.col("bucket").isin(buckets))
        return table.filter(wanted).drop("layer", "bucket")

    def append(self, rows: DataFrame, **facts: Column) -> dict:
        """Write this batch's layer. Its rows are computed once; ``facts`` are aggregates over them."""
        seen = Observation()
        if facts:
            rows = rows.observe(seen, *(fact.alias(name) for name, fact in facts.items()))
        self.added = self._write(rows, str(self.batch_id))
        return seen.get if facts and self.added else dict.fromkeys(facts)

    def replace(self, rows: DataFrame) -> None:
        """Write this batch's layer anew, from rows that may be made of the present one."""
        first = f"layer={self.batch_id}"
        self.added = self._write(rows, f"{self.batch_id}-replaced")
        self.files.delete(first)

    def new(self) -> DataFrame:
        """The rows appended."""
        return self._read({b: [layer] for b, layer in self.added.items()})

    def before(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """What earlier batches left, not merged, in some buckets: by default those of the rows appended."""
        buckets = self.added if buckets is None else buckets
        return self._read({b: self.chains.get(b, []) for b in buckets})

    def commit(self, facts: dict | None = None, keep: Column | None = None) -> None:
        """Make the layer part of the state. ``keep`` says which rows merging need not drop."""
        for bucket, layer in self.added.items():
            self.chains.setdefault(bucket, []).append(layer)
        due = {b: n for b, chain in self.chains.items() if (n := self._due(chain))}
        if due:
            rows = self._read({b: self.chains[b][-n:] for b, n in due.items()})
            merged = self.log.merge(rows if keep is None else rows.filter(keep))
            written = self._write(merged, f"{self.batch_id}-merged")
            for bucket, count in due.items():
                del self.chains[bucket][-count:]
                if bucket in written:
                    self.chains[bucket].append(written[bucket])
        told = {"parts": self.parts, "facts": self.facts | (facts or {}), "chains": self.chains}
        last, older = self._list(self.batch_id - 1), self._list(self.batch_id - 2)
        self.files.write_text(f"lists/{self.batch_id}", json.dumps(told))
        unused = {name for name, _ in self.added.values()} | _names(older or {})
        for name in unused - _names(last or {}) - _names(told):
            self.files.delete(f"layer={name}")
        self.files.delete(f"lists/{self.batch_id - 2}")

    def _due(self, chain: list[tuple[str, int]]) -> int:
        """So many of a bucket's newest layers are to be merged now."""
        if len(chain) <= self.log.layers:
            return 0
        count, size = 1, chain[-1][1]
        while count < len(chain):
            older = chain[-count - 1][1]
            if count >= self.log.layers // 2 and older > 2 * size:
                break
            count, size = count + 1, size + older
        return count


def _names(told: dict) -> set[str]:
    return {name for chain in told.get("chains", {}).values() for name, _ in chain}
