"""Stored tables: whole or no change, pruned upserts, incremental rebuilds, erasure that reaches the files."""

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import privacy, snapshots

DDL = "k string, v int, day string"


def make(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def folders(spark, path):
    return snapshots.manifest(spark, path).folders


def test_upsert_reads_and_writes_only_what_it_must(spark, tmp_path, rows, plan):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, make(spark, [("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3"), ("n", 4, None)]), path, ["k"], "day")
    old = folders(spark, path)
    version = snapshots.upsert(spark, make(spark, [("a", 9, "d4"), ("e", 5, "d2")]), path, ["k"], "day", sort=["k"],
                               removed=make(spark, [("n", 0, "")]))
    assert version == 2
    assert rows(snapshots.read(spark, path)) == [("a", 9, "d4"), ("b", 2, "d2"), ("c", 3, "d3"), ("e", 5, "d2")]
    assert rows(snapshots.read(spark, path, 1)) == sorted([("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3"), ("n", 4, None)], key=repr)
    new = folders(spark, path)
    assert new["day=d3"] == old["day=d3"] and set(new) == {"day=d2", "day=d3", "day=d4"}
    assert "PartitionFilters: [isnotnull(day#" in plan(snapshots.only(snapshots.read(spark, path), "day", ["d2"]))
    wanted = make(spark, [("b", 0, ""), ("zz", 0, "")])
    assert "PartitionFilters: [bucket#" in plan(
        spark.read.parquet(f"{path}/index").filter(F.col("bucket").isin([1, 2])))
    assert rows(snapshots.partitions_of(spark, wanted, path, ["k"])) == [("d2",)]
    assert rows(snapshots.changed(spark, path, 1)) == sorted(
        [("d1", True), ("d2", False), ("d4", False), (None, True)], key=repr)


def test_a_run_that_dies_before_the_swap_changes_nothing(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, make(spark, [("a", 1, "d1"), ("b", 2, "d2")]), path, ["k"], "day")
    swap = snapshots._swap

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "_swap", killed)
    with pytest.raises(KeyboardInterrupt):
        snapshots.upsert(spark, make(spark, [("a", 7, "d2"), ("x", 7, "d9")]), path, ["k"], "day")
    assert rows(snapshots.read(spark, path)) == [("a", 1, "d1"), ("b", 2, "d2")]
    monkeypatch.setattr(snapshots, "_swap", swap)
    snapshots.upsert(spark, make(spark, [("a", 7, "d2"), ("x", 7, "d9")]), path, ["k"], "day")
    assert rows(snapshots.read(spark, path)) == [("a", 7, "d2"), ("b", 2, "d2"), ("x", 7, "d9")]
    assert snapshots.vacuum(spark, path, keep=1) == 4  # of the dead run d2 and d9, of the first d1 and d2
    assert rows(snapshots.read(spark, path)) == [("a", 7, "d2"), ("b", 2, "d2"), ("x", 7, "d9")]
    assert snapshots.versions(spark, path) == [2]


def test_two_writers_of_one_version(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    snapshots.publish(spark, make(spark, [("a", 1, "d1")]), path, "day")
    first = snapshots.manifest(spark, path)
    with pytest.raises(snapshots.Conflict):
        snapshots._swap(spark, path, first)
    assert rows(snapshots.read(spark, path)) == [("a", 1, "d1")]


def test_columns_that_come_later(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, make(spark, [("a", 1, "d1"), ("b", 1, "d2")]), path, ["k"], "day")
    snapshots.upsert(spark, make(spark, [("c", 2, "d1", "x")], DDL + ", w string"), path, ["k"], "day")
    assert rows(snapshots.read(spark, path), "k", "v", "day", "w") == [("a", 1, "d1", None), ("b", 1, "d2", None), ("c", 2, "d1", "x")]
    empty = str(tmp_path / "e")
    snapshots.publish(spark, make(spark, []), empty, "day")
    assert snapshots.read(spark, empty).count() == 0 and snapshots.read(spark, empty).columns == ["k", "v", "day"]


def test_refresh_rebuilds_changed_days_only(spark, tmp_path, rows):
    source, target, seen = str(tmp_path / "s"), str(tmp_path / "t"), []

    def build(part):
        seen.append({r["day"] for r in part.select("day").distinct().collect()})
        return part.groupBy("day").agg(F.sum("v").alias("total"))

    snapshots.upsert(spark, make(spark, [("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3")]), source, ["k"], "day")
    assert snapshots.refresh(spark, source, target, "day", build) == ["d1", "d2", "d3"]
    assert snapshots.refresh(spark, source, target, "day", build) == []
    snapshots.upsert(spark, make(spark, [("b", 5, "d1")]), source, ["k"], "day")
    assert snapshots.refresh(spark, source, target, "day", build) == ["d1", "d2"]
    assert seen[1] == {"d1"} and rows(snapshots.read(spark, target), "day", "total") == [("d1", 6), ("d3", 3)]


def test_erasure_reaches_the_files(spark, tmp_path, rows):
    ddl = "user_id string, email_hashed string, v int, day string"
    requests = spark.createDataFrame([("u1",), ("nobody",)], "user_id string")
    people = make(spark, [("u1", "h1", 1, "d1"), ("u2", "h2", 2, "d1"), ("u3", "h3", 3, "d2"), (None, "h4", 4, "d3")], ddl)
    path = str(tmp_path / "t")
    snapshots.publish(spark, people, path, "day")
    snapshots.remember_subjects(people, path, "day")
    before = folders(spark, path)

    def change(part):
        return privacy.erase({"t": part}, requests, "salt", "2024-01-01")[0]["t"]

    assert snapshots.erase(spark, path, requests, change, "day") == 1
    snapshots.vacuum(spark, path, keep=1)
    got = snapshots.read(spark, path)
    assert got.filter("user_id = 'u1' or email_hashed = 'h1'").isEmpty() and got.count() == 4
    assert folders(spark, path)["day=d2"] == before["day=d2"] and folders(spark, path)["day=d1"] != before["day=d1"]
    raw = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/data")
    assert raw.filter("user_id = 'u1'").isEmpty()
    assert snapshots.erase(spark, path, spark.createDataFrame([("nobody",)], "user_id string"), change, "day") == 0
