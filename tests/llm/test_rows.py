from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topictally.llm import exact_dedup, jaccard_join, packing, rows, secrets


def test_scans_are_numbered_in_place_and_others_written(spark, tmp_path):
    table = str(tmp_path / "table")
    spark.range(100).withColumn("text", F.col("id").cast("string")).repartition(5).write.parquet(table)
    scan = spark.read.parquet(table).select("id", "text").filter("id > 9")
    in_place = rows.numbered(scan, str(tmp_path / "a"))
    assert not Path(tmp_path / "a").exists()
    first = {r["id"]: r["_row"] for r in in_place.select("id", "_row").collect()}
    again = {r["id"]: r["_row"] for r in in_place.withColumn("n", F.length("text")).collect()}
    assert first == again and len(set(first.values())) == 90
    shuffled = rows.numbered(scan.repartition(3), str(tmp_path / "b"))
    assert Path(tmp_path / "b").exists()
    assert shuffled.select("_row").distinct().count() == 90


def test_without(spark, tmp_path):
    table, dropped = str(tmp_path / "table"), str(tmp_path / "dropped")
    spark.range(30).write.parquet(table)
    numbered = rows.numbered(spark.read.parquet(table), str(tmp_path / "a"))
    numbered.filter("id % 3 = 0").select("_row").write.parquet(dropped)
    left = rows.without(numbered, spark.read.parquet(dropped))
    assert left.columns == ["id"] and {r["id"] for r in left.collect()} == {i for i in range(30) if i % 3}


def test_numbers_do_not_depend_on_how_a_scan_is_split(spark, tmp_path):
    table = str(tmp_path / "a table%20é")
    wide = spark.range(60_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    wide.repartition(3).write.parquet(table)
    scan = spark.read.parquet(table)
    counted = rows.numbered(scan.filter("id > 9"), str(tmp_path / "a"))
    name, found = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    try:
        for size in ("300k", "100m"):
            spark.conf.set(name, size)
            again = counted.select("id", "_row")
            found.append((again.rdd.getNumPartitions(), {r["id"]: r["_row"] for r in again.collect()}))
    finally:
        spark.conf.set(name, before)
    assert found[0][0] != found[1][0]
    assert found[0][1] == found[1][1] and len(set(found[0][1].values())) == 59_990


def test_what_has_no_lasting_address_is_written(spark, tmp_path):
    table = str(tmp_path / "table")
    spark.range(50).write.parquet(table)
    spark.range(50).write.json(str(tmp_path / "json"))
    once = spark.read.parquet(table)
    for place, docs in {
        "twice": spark.read.parquet(table, table),
        "drawn": once.withColumn("drawn", F.rand()),
        "json": spark.read.json(str(tmp_path / "json")),
    }.items():
        counted = rows.numbered(docs, str(tmp_path / f"numbered-{place}"))
        assert Path(tmp_path / f"numbered-{place}").exists()
        assert counted.select("_row").distinct().count() == docs.count()


AWKWARD = ("_row", "_FILE", "_place", "_start", "_blob", "_spans", "_clean", "_item", "_row_of_table")


@pytest.mark.parametrize("written", [False, True])
def test_columns_named_like_helpers_come_back(spark, tmp_path, written):
    texts = ["a b c d e f", "a b c d e f", "token = abcdefgh12345678 is a secret", "x", None]
    told = [(i, t, *(f"{n} {i}" for n in AWKWARD)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(told, ["doc_id", "text", *AWKWARD])
    if written:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    operators = {
        exact_dedup.drop_exact_copies: {0, 2, 3, 4},
        jaccard_join.drop_near_copies: {0, 2, 3, 4},
        lambda d: secrets.redact_documents(d, str(tmp_path / "ledger")): set(range(5)),
    }
    for operator, kept in operators.items():
        out = operator(docs)
        assert out.columns == docs.columns
        found = {r["doc_id"]: r for r in out.collect()}
        assert set(found) == kept
        assert all(r[n] == f"{n} {i}" for i, r in found.items() for n in AWKWARD)
    pieces = docs.withColumn("length", F.lit(3))
    out = packing.pack(pieces, 10)
    assert out.columns == [*pieces.columns, "sequence_id", "offset"]
    assert all(r[n] == f"{n} {r['doc_id']}" for r in out.collect() for n in AWKWARD)
