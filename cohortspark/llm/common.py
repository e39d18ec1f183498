"""What the operators share: shipping code to workers, tables in the shared folder, Arrow helpers."""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# workers need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

#: white space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset (tests, single machine) a folder in the warehouse serves.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no more than its tasks.

    ``keep`` writes a frame and reads it back without its lineage; ``drop`` removes a table that
    nothing needs any more; ``release`` lets Spark remove the shuffle files of finished stages.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def keep_by(self, df: DataFrame, key: str) -> DataFrame:
        """Like ``keep``, in buckets of ``key``: joins on it leave this table where it is."""
        self.count += 1
        name = f"scratch_{uuid.uuid4().hex}"
        n = parallelism(self.spark)
        path = f"{self.folder}/{self.count}"
        df.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(name)
        out = self.spark.table(name)
        out._scratch_path, out._scratch_table = path, name
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if name := getattr(df, "_scratch_table", None):
                self.spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns of these names (compared without case)."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def unique_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def appended(
    df: DataFrame, text: str, fields: Sequence[tuple[str, T.DataType]], make: Callable, piece_bytes: int = 1 << 23
) -> DataFrame:
    """``df`` with columns computed from one text column, row by row, in Arrow batches.

    ``make()`` is called once in a task and gives a function from a list of texts (None for null)
    to one list or Arrow array for each field. Batches are cut so that a call sees about
    ``piece_bytes`` characters of text, or one row. The columns of ``df`` stay as they are, but one
    that has the name of a result gives way to it.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(t) for _, t in fields]
    names = [n for n, _ in fields]
    df = without(df, names)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            for piece in pieces(batch, at, piece_bytes):
                got = call(piece.column(at).to_pylist())
                made = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(got, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], [*piece.schema.names, *names])

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, at: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes in column ``at`` each, or one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch and the n + 1 offsets of its rows; null counts as empty."""
    import pyarrow.compute as pc

    whole = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(whole) + 1, whole.offset * 8)
    first = int(offsets[0])
    size = int(offsets[-1]) - first
    data = np.frombuffer(data, np.uint8, size, first) if size else np.zeros(0, np.uint8)
    return data, offsets - first


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of ``x`` evenly (fixed public constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_order(*columns) -> F.Column:
    """A repeatable even order of rows, in [0, 1)."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).cast("double")
