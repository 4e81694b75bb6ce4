"""Partitioned tables that change whole or not at all, with a key index and a record of what changed.

A table is a folder with three parts:

* `data/snapshot=<id>/<partition>=<value>/`: files, written once and never changed;
* `manifests/<version>.json`: which snapshot holds each partition, and the columns of the table. A version exists once
  its manifest has been renamed into place, so a run that dies before leaves the table as it was, and readers of the
  version before keep it until `vacuum`. Two writers of one version cannot both win the rename;
* `index/bucket=<hash>/`: for each key the partitions that ever held it. It may name too many, never too few.

An upsert asks the index which partitions hold the incoming keys, so no history is read to find them; it then reads and
writes only these. What it reads and what it writes are different folders, so nothing is checkpointed in between. The
manifest holds the columns, so no reader merges the footers of files. The driver handles one row per partition folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators.tables import check_unique, merged, spread
from bazaarlake.session import checkpointed, released

BUCKETS = 64
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer published the version first."""


@dataclass
class Manifest:
    version: int
    partition: str
    schema: T.StructType
    folders: dict[str, str]  # partition folder, such as `event_date=2024-01-01`, to snapshot id
    source: dict[str, int] = field(default_factory=dict)  # versions of the tables that this one was built from


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    target, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/manifests") if n[0] != "_" and n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The newest manifest, or that of a version; None for a table that does not exist."""
    known = versions(spark, path)
    if not known:
        return None
    chosen = known[-1] if version is None else version
    target, fs = _fs(spark, f"{path}/manifests/{chosen:012d}.json")
    stream = fs.open(target)
    try:
        raw = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Manifest(chosen, raw["partition"], T.StructType.fromJson(raw["schema"]), raw["folders"], raw["source"])


def _swap(spark: SparkSession, path: str, made: Manifest) -> None:
    """Make a version visible: its manifest is written aside and renamed, which happens whole or not at all."""
    aside, fs = _fs(spark, f"{path}/manifests/_{uuid.uuid4().hex}")
    body = {"partition": made.partition, "schema": made.schema.jsonValue(), "folders": made.folders, "source": made.source}
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(body).encode()))
    finally:
        stream.close()
    final, _ = _fs(spark, f"{path}/manifests/{made.version:012d}.json")
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise Conflict(f"version {made.version} of {path} exists")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the table; columns that came later are NULL in older files."""
    known = manifest(spark, path, version)
    if known is None:
        raise FileNotFoundError(path)
    if not known.folders:
        return spark.createDataFrame([], known.schema)
    folders = [f"{path}/data/snapshot={s}/{f}" for f, s in sorted(known.folders.items())]
    columns = T.StructType([*known.schema.fields, T.StructField("snapshot", T.StringType())])
    rows = spark.read.schema(columns).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*known.schema.fieldNames())


def folder_of(values: list, partition: str) -> list[str]:
    return [f"{partition}={_NULL if v is None else v}" for v in values]


def publish(spark: SparkSession, rows: DataFrame, path: str, partition: str, replace: list | None = None,
            sort: list[str] | None = None, source: dict[str, int] | None = None, expected: int | None = None) -> int:
    """Write `rows` as new files and make them visible as the next version; returns it.

    `replace` lists the partition values whose old rows go, besides those of `rows`; None replaces the whole table.
    `rows` may read the table itself. With `expected`, the newest version must be that one (0: no table yet): what the
    caller has read decides the rows, so a version that came in between is a `Conflict`.
    """
    before = manifest(spark, path)
    if expected is not None and expected != (before.version if before else 0):
        raise Conflict(f"{path} is no longer at version {expected}")
    snapshot = uuid.uuid4().hex
    with released(spark):
        spread(rows, partition, sort).write.partitionBy(partition).parquet(f"{path}/data/snapshot={snapshot}")
    fresh = {n: snapshot for n in _names(spark, f"{path}/data/snapshot={snapshot}") if "=" in n}
    kept = {} if before is None or replace is None else {
        f: s for f, s in before.folders.items() if f not in folder_of(replace, partition)}
    schema = rows.schema
    if before is not None and replace is not None:
        names = rows.columns
        schema = T.StructType([*before.schema.fields, *[f for f in schema.fields if f.name not in before.schema.fieldNames()]]) \
            if names != before.schema.fieldNames() else before.schema
    version = before.version + 1 if before else 1
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    _swap(spark, path, Manifest(version, partition, loose, {**kept, **fresh}, source or {}))
    return version


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _remember(rows: DataFrame, path: str, keys: list[str], partition: str) -> None:
    with released(rows.sparkSession):
        rows.select(*keys, F.col(partition).alias("_in"), _bucket(keys).alias("bucket")).distinct().repartition(
            "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/index")


def partitions_of(spark: SparkSession, wanted: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """(_in): partition values that may hold a key of `wanted`, from the buckets of the index that its keys fall into."""
    numbers = [r[0] for r in wanted.select(_bucket(keys).alias("b")).distinct().collect()]  # at most BUCKETS
    index = spark.read.parquet(f"{path}/index").filter(F.col("bucket").isin(numbers))
    return index.join(wanted.select(*keys).distinct(), keys, "left_semi").select("_in").distinct()


def upsert(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str], partition: str,
           sort: list[str] | None = None, removed: DataFrame | None = None, expected: int | None = None) -> int:
    """Insert or update by key; rows whose key is in `removed` go. Returns the new version; `expected` as in `publish`.

    Only partitions that the index names for these keys, and those of incoming rows, are read and written. A row whose
    partition value changed leaves its old partition. A key has at most one row in `incoming`; the two sets of keys must
    not overlap.
    """
    incoming = checkpointed(incoming)
    check_unique(incoming, keys)
    _remember(incoming, path, keys, partition)  # too many entries are harmless, so the index may be ahead of the table
    if manifest(spark, path) is None:
        return publish(spark, incoming, path, partition, sort=sort, expected=expected)
    changed = incoming.select(*keys)
    if removed is not None:
        removed = checkpointed(removed.select(*keys).distinct())
        changed = changed.union(removed)
    held = partitions_of(spark, changed, path, keys)
    touched = [r[0] for r in held.union(incoming.select(partition)).distinct().collect()]
    stay = only(read(spark, path), partition, touched)
    if removed is not None:
        stay = stay.join(removed, keys, "left_anti")
    return publish(spark, merged(stay, incoming, keys), path, partition, touched, sort, expected=expected)


def only(rows: DataFrame, partition: str, values: list) -> DataFrame:
    """Rows of some partitions, as a filter that prunes folders."""
    some = F.col(partition).isin([v for v in values if v is not None])
    return rows.filter(some | F.col(partition).isNull() if None in values else some)


def changed(spark: SparkSession, path: str, since: int | None) -> DataFrame:
    """(value, gone): partitions whose files differ between version `since` (None: an empty table) and the newest one."""
    now = manifest(spark, path)
    before = {} if since is None else manifest(spark, path, since).folders
    names = sorted(f for f in {*before, *now.folders} if before.get(f) != now.folders.get(f))
    kind = now.schema[now.partition].dataType
    values = [(f.split("=", 1)[1], f not in now.folders) for f in names]
    rows = spark.createDataFrame([(None if v == _NULL else v, gone) for v, gone in values], "value string, gone boolean")
    return rows.select(F.col("value").cast(kind).alias("value"), "gone")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the older manifests and every partition folder that none of the last `keep` versions uses.

    Returns how many folders went. A run that is still writing is not seen; run it when none is.
    """
    known = versions(spark, path)
    used = {(s, f) for v in known[-keep:] for f, s in manifest(spark, path, v).folders.items()}
    for version in known[:-keep]:
        target, fs = _fs(spark, f"{path}/manifests/{version:012d}.json")
        fs.delete(target, False)
    gone = 0
    for name in _names(spark, f"{path}/data"):
        snapshot = name.removeprefix("snapshot=")
        unused = [f for f in _names(spark, f"{path}/data/{name}") if "=" in f and (snapshot, f) not in used]
        for folder in unused:
            target, fs = _fs(spark, f"{path}/data/{name}/{folder}")
            fs.delete(target, True)
        if not any(s == snapshot for s, _ in used):
            target, fs = _fs(spark, f"{path}/data/{name}")
            fs.delete(target, True)
        gone += len(unused)
    return gone


def refresh(spark: SparkSession, source: str, target: str, partition: str, build, sort: list[str] | None = None) -> list:
    """Rebuild the partitions of `target` whose rows in `source` changed since the version it was built from.

    `build` makes the target's rows from the source's rows of these partitions. Both tables are partitioned by the same
    column. The version that was read is published with the result, so a run that dies in between is simply repeated.
    """
    now, built = manifest(spark, source), manifest(spark, target)
    since = None if built is None else built.source.get("version")
    values = [r["value"] for r in changed(spark, source, since).collect()]
    if values or built is None:
        rows = build(only(read(spark, source, now.version), partition, values))
        publish(spark, rows, target, partition, None if built is None else values, sort, {"version": now.version})
    return values


def erase(spark: SparkSession, path: str, requests: DataFrame, change, partition: str) -> int:
    """Replace the users of `requests` (user_id) in a stored table: only partitions that hold one of them are rewritten.

    `change` maps rows to their erased form. The table keeps a subject index (`upsert` or `remember_subjects`), so the
    partitions are found without reading the table. Older versions still show the users until `vacuum`. Returns the
    number of partitions rewritten.
    """
    values = [r[0] for r in partitions_of(spark, requests, f"{path}/subjects", ["user_id"]).collect()]
    if values:
        publish(spark, change(only(read(spark, path), partition, values)), path, partition, values)
    return len(values)


def remember_subjects(rows: DataFrame, path: str, partition: str) -> None:
    """Put the users of `rows` into the subject index of a table."""
    _remember(rows.select("user_id", partition).filter(F.col("user_id").isNotNull()), f"{path}/subjects", ["user_id"], partition)
