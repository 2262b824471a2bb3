"""Daily tables published together: readers see all tables and days of a version, or none of them.

Every write goes to a folder of its own, ``<root>/<table>/write=<id>/year=.../month=.../day=...``. A version is one small file,
``<root>/versions/<number>.json``, that says for each table and day which write holds it. It is renamed into place after all
tables are written, so a writer that dies on the way leaves the old version as it was, and files that nobody reads. A reader
holds the folders of the version it began with until ``expire`` removes that version.

The version file has one entry per table and day, whatever the size of the tables. Its rename must refuse an existing target
in one step, as on HDFS; object stores that cannot do that allow one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.sources.files import DAY_COLUMNS, file_system, hadoop_path
from tidemark.streaming.daily import day_folder

#: Table -> {"schema": JSON of the data columns, "days": {ISO day: id of the write that holds it}}
Manifest = dict[str, dict]

VERSIONS, WRITE = "versions", "write"


def version_file(root: str, version: int) -> str:
    return f"{root}/{VERSIONS}/{version:08d}.json"


def list_versions(spark: SparkSession, root: str) -> list[int]:
    found = file_system(spark, root).globStatus(hadoop_path(spark, f"{root}/{VERSIONS}/[0-9]*.json")) or []
    return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found)


def read_manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    return json.loads(spark.read.text(version_file(root, version), wholetext=True).first()[0])


def commit(spark: SparkSession, root: str, version: int, manifest: Manifest) -> bool:
    """Put a version in place. False if another writer has that number already; nothing is changed then."""
    system = file_system(spark, root)
    draft = hadoop_path(spark, f"{root}/{VERSIONS}/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(hadoop_path(spark, version_file(root, version))), options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def write_table(df: DataFrame, folder: str, write: str) -> list[str]:
    """Write the days of a table under a fresh folder; the ISO days that have rows."""
    path = f"{folder}/{WRITE}={write}"
    spark = df.sparkSession
    df.hint("rebalance", *[F.col(c) for c in DAY_COLUMNS]).write.mode("error").partitionBy(*DAY_COLUMNS).parquet(path)
    found = file_system(spark, path).globStatus(hadoop_path(spark, f"{path}/year=*/month=*/day=*")) or []
    parts = [[p.split("=")[1] for p in status.getPath().toString().split("/")[-3:]] for status in found]
    return sorted("-".join(p) for p in parts)


def merged_schema(name: str, old: StructType | None, new: StructType) -> StructType:
    """Columns of old and new days; a column may come or stay away, but not change its type."""
    fields = {f.name: f for f in (old or StructType())}
    for field in new:
        known = fields.setdefault(field.name, StructField(field.name, field.dataType))
        if known.dataType != field.dataType:
            raise ValueError(f"{name}.{field.name} is {known.dataType.simpleString()}, not {field.dataType.simpleString()}")
    return StructType([StructField(f.name, f.dataType) for f in fields.values()])


def publish(tables: dict[str, DataFrame], root: str, days: Iterable[date] | None = None) -> int:
    """Replace days of several tables at once; the number of the new version.

    Each table carries the day columns as text. Replaced are the days that occur in it, or the given ``days``, also by nothing;
    rows of other days are then an error. Days and tables that are not named stay as they are. If another writer publishes in
    between, the same files are set on top of that version.
    """
    spark = next(iter(tables.values())).sparkSession
    named = None if days is None else {d.isoformat() for d in days}
    write = uuid.uuid4().hex
    written = {name: write_table(df, f"{root}/{name}", write) for name, df in tables.items()}
    if named is not None and (other := {d for found in written.values() for d in found} - named):
        raise ValueError(f"rows of days that were not named: {sorted(other)}")
    while True:
        last = max(list_versions(spark, root), default=0)
        manifest = read_manifest(spark, root, last) if last else {}
        for name, df in tables.items():
            entry = manifest.get(name, {"schema": None, "days": {}})
            old = StructType.fromJson(entry["schema"]) if entry["schema"] else None
            data = StructType([f for f in df.schema if f.name not in DAY_COLUMNS])
            kept = {d: w for d, w in entry["days"].items() if d not in (named or written[name])}
            manifest[name] = {
                "schema": merged_schema(name, old, data).jsonValue(),
                "days": kept | dict.fromkeys(written[name], write),
            }
        if commit(spark, root, last + 1, manifest):
            return last + 1


def day_paths(root: str, name: str, entry: dict) -> list[str]:
    return [day_folder(f"{root}/{name}/{WRITE}={write}", date.fromisoformat(d)) for d, write in sorted(entry["days"].items())]


def read_version(
    spark: SparkSession, root: str, version: int | None = None, days: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """All tables of one version, the newest unless given, with their day columns as text. Only folders of the version, or of
    its given ISO ``days``, are listed; a filter on the day columns prunes them."""
    wanted = None if days is None else set(days)
    version = version or max(list_versions(spark, root), default=0)
    if not version:
        raise FileNotFoundError(f"nothing is published in {root}")
    out = {}
    for name, entry in read_manifest(spark, root, version).items():
        data = StructType.fromJson(entry["schema"])
        schema = StructType([*data, *[StructField(c, StringType()) for c in (*DAY_COLUMNS, WRITE)]])
        held = {d: write for d, write in entry["days"].items() if wanted is None or d in wanted}
        paths = day_paths(root, name, {"days": held})
        reader = spark.read.schema(schema).option("basePath", f"{root}/{name}")
        found = reader.parquet(*paths) if paths else spark.createDataFrame([], schema)
        out[name] = found.select(*[F.col(f"`{f.name}`") for f in data], *DAY_COLUMNS)
    return out


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, and the day folders that only those had. The versions removed.

    A version goes before its files, so whatever stops this leaves no version without files. Files of writers that died are in
    no version and stay: a running writer's files look the same.
    """
    if keep < 1:
        raise ValueError("one version has to stay")
    versions = list_versions(spark, root)
    gone = versions[:-keep]
    system = file_system(spark, root)

    def folders(of: list[int]) -> set[str]:
        manifests = [read_manifest(spark, root, v) for v in of]
        return {path for m in manifests for name, entry in m.items() for path in day_paths(root, name, entry)}

    unused = folders(gone) - folders(versions[-keep:])
    for version in gone:
        system.delete(hadoop_path(spark, version_file(root, version)), False)
    for path in sorted(unused):
        system.delete(hadoop_path(spark, path), True)
    return gone
