"""The log that micro-batches leave their state in."""

import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from topictally.streaming.carried import CarriedLog

SCHEMA = StructType([StructField("key", StringType()), StructField("n", LongType())])


def totals(rows):
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def log_of(folder, **settings):
    return CarriedLog(str(folder), SCHEMA, ["key"], totals, **settings)


def add(spark, log, batch_id, counts, keep=None):
    state = log.at(spark, batch_id)
    rows = spark.createDataFrame(list(counts.items()), SCHEMA)
    state.append(totals(rows))
    state.commit(keep=keep)
    return state


def held(spark, log, batch_id):
    state = log.at(spark, batch_id)
    return dict(rows_of(totals(state.before(range(state.parts))), "key", "n"))


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file())


@pytest.mark.parametrize("layers", [1, 3, 8])
def test_the_state_is_all_batches_together(spark, tmp_path, layers):
    random.seed(2)
    log, expected = log_of(tmp_path, parts=3, layers=layers), Counter()
    for batch_id in range(9):
        counts = {k: random.randrange(9) + 1 for k in random.sample([None, *"abcdefg"], 3)}
        state = add(spark, log, batch_id, counts)
        expected.update(counts)
        assert held(spark, log, batch_id + 1) == expected
        assert all(len(c) <= layers + 1 for c in state.chains.values())
    # What no list names any more is gone.
    named = {name for c in log.at(spark, 9).chains.values() for name, _ in c}
    named |= {name for c in log.at(spark, 8).chains.values() for name, _ in c}
    assert {p.name.removeprefix("layer=") for p in tmp_path.glob("layer=*")} == named


def test_a_batch_that_runs_again_finds_what_it_found(spark, tmp_path):
    log = log_of(tmp_path, parts=2, layers=1)
    for batch_id in range(5):
        for _ in range(2):
            add(spark, log, batch_id, {"a": 1, "b": batch_id})
        # A batch may also stop after its layer was written.
        log.at(spark, batch_id).append(totals(spark.createDataFrame([("a", 1), ("b", batch_id)], SCHEMA)))
        add(spark, log, batch_id, {"a": 1, "b": batch_id})
    assert held(spark, log, 5) == {"a": 5, "b": 10}


def test_bytes_written_grow_with_changed_keys(spark, tmp_path):
    log = log_of(tmp_path, parts=4)
    old = spark.range(100_000).selectExpr("CAST(id AS string) AS key", "id AS n")
    first = log.at(spark, 0)
    first.append(totals(old))
    first.commit()
    whole = size(tmp_path)
    written = []
    for batch_id in range(1, 13):
        before = {p for p in tmp_path.rglob("*") if p.is_file()}
        add(spark, log, batch_id, {str(i): 1 for i in range(batch_id, batch_id + 10)})
        written.append(sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file() and p not in before))
    assert max(written) < whole / 20
    state = log.at(spark, 13)
    assert rows_of(totals(state.before(range(4))).filter("key = '12'"), "key", "n") == [("12", 12 + 10)]


def test_only_buckets_of_new_rows_are_read(spark, tmp_path):
    log = log_of(tmp_path, parts=16)
    add(spark, log, 0, {str(i): i for i in range(200)})
    state = log.at(spark, 1)
    state.append(totals(spark.createDataFrame([("7", 1)], SCHEMA)))
    assert len(state.added) == 1
    read = state.before()
    assert 0 < read.count() < 50
    assert rows_of(totals(read.unionByName(state.new())).filter("key = '7'"), "key", "n") == [("7", 8)]


def test_rows_that_need_not_be_kept_go_when_layers_are_merged(spark, tmp_path):
    log = log_of(tmp_path, parts=1, layers=2)
    for batch_id in range(4):
        add(spark, log, batch_id, {"old": 1, "new": 1}, keep=F.col("key") != "old")
    assert held(spark, log, 4).get("old", 0) < 3
    assert held(spark, log, 4)["new"] == 4


def test_a_missing_list_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError):
        log_of(tmp_path).at(spark, 3)


def test_facts_of_a_batch(spark, tmp_path):
    log = log_of(tmp_path, parts=2)
    state = log.at(spark, 0)
    rows = spark.createDataFrame([("a", 4), ("b", 9)], SCHEMA)
    assert state.append(totals(rows), most=F.max("n")) == {"most": 9}
    state.commit({"most": 9})
    state = log.at(spark, 1)
    assert state.facts == {"most": 9}
    assert state.append(totals(rows.filter("false")), most=F.max("n")) == {"most": None}
    state.commit()
    assert log.at(spark, 2).facts == {"most": 9}
