"""Helpers shared by the operators: tables, words, written intermediate results."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a class of a Java pattern.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null for a null text."""
    return F.array_remove(F.split(text, SPACES), "")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``.

    Hadoop removes it when the application ends. A session without the setting (a test)
    gets the checkpoint folder of its context, or one of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        base = f"file://{tempfile.mkdtemp(prefix='staywise-')}"
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-tables"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(frame: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Cuts the lineage: a lost executor costs a read of the table, nothing is computed twice,
    and the planner knows the true size.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def byte_strings(column) -> list[bytes | None]:
    """The values of an Arrow string column as UTF-8 bytes, without decoding them."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.view(kind).to_pylist()


def id_sets(column) -> list[np.ndarray]:
    """Views of an Arrow binary column of 32-bit integers, without copying it."""
    sets = []
    for chunk in column.chunks:
        _, offsets, data = chunk.buffers()
        places = np.frombuffer(offsets, np.int32, len(chunk) + 1, 4 * chunk.offset) // 4
        values = np.frombuffer(data, np.int32) if data is not None and data.size else np.zeros(0, np.int32)
        sets += [values[a:b] for a, b in zip(places, places[1:], strict=False)]
    return sets


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """Column names like these that no column of the table begins with."""
    mark = "_"
    while any(c.lower().startswith(mark) for c in frame.columns):
        mark += "_"
    return [mark + name for name in names]


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: 0 marks the held-out rows."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def labelled_sample(documents: DataFrame, labels: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents, chosen by a hash of the id.

    Only the sample's ids are broadcast, so the bound on ``rows`` bounds the broadcast. A
    label given several times counts by its largest value; null ids or labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in columns])
    known = known.dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    names = [F.col(c).alias(f"label_{c}") for c in columns]
    known = known.select(F.col("doc_id").alias("label_id"), *names)
    kept = documents.select(F.col("doc_id").alias("label_id"), F.coalesce("text", F.lit("")).alias("text"))
    return kept.join(F.broadcast(known), "label_id")


class WordIds:
    """Feature ids of single words, remembered for as many words as fit the bound.

    ``of_word`` gives the same number of ids for each word; ``rows`` maps a list of words to
    a matrix of ids with a row per word. The memory is emptied when it is full, so results
    do not depend on it.
    """

    def __init__(self, of_word, width: int, bound: int = 400_000) -> None:
        self.of_word, self.width, self.bound = of_word, width, bound
        self.place: dict = {}
        self.ids = np.zeros((1024, width), np.int64)

    def rows(self, found: list) -> np.ndarray:
        new = set(found).difference(self.place)
        if len(self.place) + len(new) > self.bound and self.place:
            self.place.clear()
            new = set(found)
        if new:
            begin, end = len(self.place), len(self.place) + len(new)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros((max(end, 2 * len(self.ids)) - len(self.ids), self.width), np.int64)])
            self.ids[begin:end] = np.array([self.of_word(w) for w in new], np.int64)
            self.place.update(zip(new, range(begin, end), strict=True))
        return self.ids[np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))]
