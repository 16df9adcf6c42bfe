"""Stage tables and exports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables below ``spark.checkpoint.dir``.

    The folder is removed when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{base.rstrip('/')}/staywise-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write the frame once to the shared folder and continue from the written table.

    Cuts the lineage, so that values assigned by position (slices, salts) stay as they
    are however often a later stage is retried.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def export(df: DataFrame, path: str, fmt: str = "parquet", key: str | None = None) -> None:
    """Replace the export at ``path``; CSV carries a header line.

    With a ``key``, Parquet files are sorted by it and carry Bloom filters of it, so that a lookup
    of a few keys skips most files by their footers. That adds no shuffle.

    The new files are written beside the old ones and take their place when all are there, so
    a write that fails leaves the old export as it was.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown export format {fmt}")
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = path.rstrip("/")
    fresh, former = f"{path}.new-{mark}", f"{path}.old-{mark}"
    files, place = _file_system(spark, path)
    new, old = (_file_system(spark, p)[1] for p in (fresh, former))
    if key and fmt == "parquet":
        df = df.sortWithinPartitions(key)
    out = df.write.option("header", True)
    if key:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
    try:
        out.csv(fresh) if fmt == "csv" else out.parquet(fresh)
        if files.exists(place):
            files.rename(place, old)
        files.rename(new, place)
    finally:
        if files.exists(place):
            files.delete(new, True)
            files.delete(old, True)
        elif files.exists(old):
            files.rename(old, place)


# ---- versions: what a reader sees changes only by a commit -------------------------------

_COMMIT = "commit-"


def committed(spark: SparkSession, folder: str) -> tuple[str, str] | None:
    """Path of the version committed last and the run that wrote it; None before the first commit."""
    found = _commits(spark, folder)
    if not found:
        return None
    version, run = spark.read.schema("version string, run string").json(found[-1]).first()
    return f"{folder.rstrip('/')}/{version}", run


def _commits(spark: SparkSession, folder: str) -> list[str]:
    files, place = _file_system(spark, f"{folder.rstrip('/')}/{_COMMIT}*")
    return sorted(str(f.getPath()) for f in files.globStatus(place) or [])


def commit(spark: SparkSession, folder: str, write: Callable[[str], None], run: str = "") -> str:
    """Let ``write`` fill a new version folder, then make it the current one; gives its path.

    A commit is a small file with the next number, written under another name and renamed once
    complete. Whatever fails before that leaves the former version current. The version before the
    new one is kept for readers that have begun; older ones are removed.
    """
    folder = folder.rstrip("/")
    before = _commits(spark, folder)
    version = f"v-{uuid.uuid4().hex}"
    write(f"{folder}/{version}")
    number = int(before[-1].rpartition("-")[2]) + 1 if before else 1
    files, draft = _file_system(spark, f"{folder}/_draft-{version}")
    line = json.dumps({"version": version, "run": run}).encode()
    stream = files.create(draft)
    stream.write(bytearray(line), 0, len(line))
    stream.close()
    if not files.rename(draft, _file_system(spark, f"{folder}/{_COMMIT}{number:012d}")[1]):
        raise RuntimeError(f"{folder}: another writer committed version {number}")
    kept = {version, *(spark.read.schema("version string").json(before[-1]).first() if before else ())}
    for found in files.globStatus(_file_system(spark, f"{folder}/v-*")[1]) or []:
        if found.getPath().getName() not in kept:
            files.delete(found.getPath(), True)
    for old in before[:-1]:
        files.delete(_file_system(spark, old)[1], False)
    return f"{folder}/{version}"


def replace_stage(df: DataFrame, path: str, cluster_by: str | None = None, run: str = "") -> DataFrame:
    """Materialise a pipeline stage as a new version and read it back.

    A stage that the same ``run`` has committed before is read instead of written again, so a
    run that is started anew goes on behind its last stage. Sorting inside the partitions by the
    entity key keeps row groups selective for key lookups; it adds no shuffle.
    """
    spark = df.sparkSession
    done = committed(spark, path) if run else None
    if done and done[1] == run:
        return spark.read.parquet(done[0])
    if cluster_by:
        df = df.sortWithinPartitions(cluster_by)
    return spark.read.parquet(commit(spark, path, df.write.parquet, run))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The version of a stage that was committed last."""
    done = committed(spark, path)
    if done is None:
        raise FileNotFoundError(f"{path}: no version was committed")
    return spark.read.parquet(done[0])


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
