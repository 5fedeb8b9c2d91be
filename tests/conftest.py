import os
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from topictally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="2",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        # Small batches, so that functions that work batch by batch see more than one.
        spark__sql__execution__arrow__maxRecordsPerBatch="7",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def by_value(request):
    """Executors cannot import test modules; send what is defined in them by value."""
    cloudpickle.register_pickle_by_value(request.module)


class FileTopic:
    """A folder that streams read one file per micro-batch, in the order of writing."""

    def __init__(self, folder: Path, schema: pa.Schema):
        self.folder = folder
        self.schema = schema
        self.files = 0
        folder.mkdir()

    def add(self, rows: list[dict]) -> None:
        path = self.folder / f"{self.files:05d}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, schema=self.schema), path)
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1


@pytest.fixture
def file_topic(tmp_path):
    def make(schema: pa.Schema, name: str = "topic") -> FileTopic:
        return FileTopic(tmp_path / name, schema)

    return make


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
