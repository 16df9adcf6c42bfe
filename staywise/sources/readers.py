"""Loading raw tables, change points and feature exports."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from staywise.sources.schemas import CHANGE_POINTS, RAW_TABLES

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its own file system (local, HDFS or object store)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(jvm_path)


def first_existing(spark: SparkSession, folder: str, names: tuple[str, ...]) -> str | None:
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        if path_exists(spark, path):
            return path
    return None


def usable_key(column: str = "msno") -> Column:
    return F.col(column).isNotNull() & (F.trim(F.col(column)) != "")


#: Why a line is left out, in the order they are tested.
REASONS = ("fields", "type", "key")
_LINE = "_corrupt_record"


def _typed(name: str, kind: T.DataType) -> str:
    """The text as a value of the kind; whole numbers may be written with a fraction of zero."""
    text = kind.simpleString()
    if not isinstance(kind, T.IntegralType):
        return f"try_cast({name} AS {text})"
    number = f"try_cast({name} AS DOUBLE)"
    return f"coalesce(try_cast({name} AS {text}), if({number} = floor({number}), try_cast({number} AS {text}), NULL))"


def graded_csv(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Typed CSV scan with ``reason`` and ``line`` of lines that are not to be used, else NULL.

    ``fields``: another number of fields than the header; ``type``: a value of the wrong type;
    ``key``: a null or blank key. Columns are found by header name; those missing in the file
    are NULL, further ones are ignored. All schema columns are tested, so the reason does not
    depend on the columns a query happens to read.
    """
    header = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _LINE)])
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    lines = spark.read.schema(text).options(**options).csv(path)
    present = {f.name: f.dataType for f in schema.fields if f.name in header}
    typed = {name: _typed(name, kind) for name, kind in present.items()}
    wrong = [f"({n} IS NOT NULL AND {typed[n]} IS NULL)" for n, k in present.items() if not isinstance(k, T.StringType)]
    blank = f"trim(coalesce({key}, '')) = ''" if key else "false"
    reason = f"CASE WHEN {_LINE} IS NOT NULL THEN 'fields' WHEN {' OR '.join(wrong) or 'false'} THEN 'type' WHEN {blank} THEN 'key' END"
    line = f"coalesce({_LINE}, to_csv(struct({', '.join(header)})))"
    values = [f"{typed.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {f.name}" for f in schema.fields]
    return lines.selectExpr(*values, f"{reason} AS reason", f"if({reason} IS NULL, NULL, {line}) AS line")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines of a CSV file that have as many fields as the header and values of the right types."""
    return graded_csv(spark, path, schema).filter("reason IS NULL").select(*schema.names)


def graded_table(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    """``graded_csv`` of a raw table's first existing file; None (and a warning) without one."""
    spec = RAW_TABLES[table]
    path = first_existing(spark, folder, spec.files)
    if path is None:
        log.warning("no file for %s in %s, skipped", table, folder)
        return None
    return graded_csv(spark, path, spec.schema, "msno")


def load_table(spark: SparkSession, folder: str, table: str, seen: Observation | None = None) -> DataFrame | None:
    """One raw table without unusable lines; None (and a warning) when no file exists.

    ``seen`` holds ``lines`` and the number of lines left out for each reason once an action has
    run, counted in the same pass.
    """
    graded = graded_table(spark, folder, table)
    if graded is None:
        return None
    if seen is not None:
        counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
        graded = graded.observe(seen, F.count(F.lit(1)).alias("lines"), *counts)
    return graded.filter("reason IS NULL").select(*RAW_TABLES[table].schema.names)


def line_report(graded: DataFrame) -> DataFrame:
    """Lines by ``reason``; the usable ones count as ``used``."""
    return graded.groupBy(F.coalesce("reason", F.lit("used")).alias("reason")).agg(F.count("*").alias("lines"))


def quarantine(graded: DataFrame) -> DataFrame:
    """The unusable lines as they were, with their reason, for an export of their own."""
    return graded.filter("reason IS NOT NULL").select("reason", "line")


def load_raw_tables(spark: SparkSession, core_dir: str, saas_dir: str) -> dict[str, DataFrame]:
    """All raw tables found; the four product tables may live in a folder of their own."""
    core = ("raw_members", "raw_train", "raw_transactions", "raw_user_logs")
    found = {}
    for table in RAW_TABLES:
        frame = load_table(spark, core_dir if table in core else saas_dir, table)
        if frame is not None:
            found[table] = frame
    return found


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], RAW_TABLES[table].schema)


def read_export(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A table written by ``export``; CSV needs its schema, Parquet carries it."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path}: run the pipeline that exports it first")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.parquet(path)


def load_change_points(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """Exported change points, or an empty typed frame when there is no export yet."""
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], CHANGE_POINTS)
    return read_export(spark, path, fmt, CHANGE_POINTS)


def load_features(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> tuple[DataFrame, Observation]:
    """Feature export for scoring without unusable keys.

    The observation holds ``rows_read`` and ``rows_dropped`` once an action has run, so
    the report costs no pass of its own.
    """
    seen = Observation("feature_load")
    rows = read_export(spark, path, fmt, schema).observe(
        seen,
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(usable_key(), None).otherwise(1)).alias("rows_dropped"),
    )
    return rows.filter(usable_key()), seen


# Samples up to this size are merged in one task.
MERGED_SAMPLE = 100_000


def sample_users(users: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` users (all when there are fewer), drawn by the hash of their key.

    The same users on every run. Small samples are a top-n on the hash. Of larger ones counts per
    leading 16 bits of the hash tell where the sample ends: all rows before that range are taken
    where they are, only those of the range are ordered.
    """
    draw = F.xxhash64(F.col("msno"), F.lit(seed))
    if n <= MERGED_SAMPLE:
        return users.orderBy(draw, "msno").limit(n)
    span = F.shiftright(draw, 48)
    counts = users.groupBy(span.alias("span")).count().collect()  # 65,536 rows at most
    taken = 0
    for at, rows in sorted(map(tuple, counts)):
        if taken + rows > n:
            last = users.filter(span == at).orderBy(draw, "msno").limit(n - taken)
            return users.filter(span < at).unionByName(last)
        taken += rows
    return users


def sample_user_share(users: DataFrame, draw: Column, buckets: int, keep: int) -> DataFrame:
    """Users whose draw falls into the first ``keep`` of ``buckets``: no shuffle at all."""
    return users.filter(F.pmod(draw, F.lit(buckets)) < keep)


def rows_of_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of the wanted users; Spark picks broadcast or shuffle by the measured size."""
    return rows.join(users.select("msno"), "msno", "left_semi")


# Most keys that are handed to the readers as a list; more of them are joined.
LISTED_KEYS = 1_000


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: str = "msno") -> DataFrame:
    """Rows with one of the keys.

    Few keys are a filter that Parquet readers check against statistics and Bloom filters, so
    only the files and pages that may hold them are read. Many are a semi-join.
    """
    wanted = keys.select(key).distinct()
    listed = [r[0] for r in wanted.limit(LISTED_KEYS + 1).collect()]
    if len(listed) > LISTED_KEYS:
        return rows.join(wanted, key, "left_semi")
    return rows.filter(F.col(key).isin([k for k in listed if k is not None]))


def run_sql(spark: SparkSession, sql: str, args: dict | list | None = None, **frames) -> DataFrame:
    """Ad-hoc SQL with bound parameters; frames passed by name are usable as ``{name}``."""
    return spark.sql(sql, args=args, **frames)
