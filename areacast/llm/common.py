"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.session import fresh_path


def id_bucket(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def in_bucket(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether `id_bucket` has the remainder; false for a null id."""
    return F.coalesce(id_bucket(doc_id, modulus) == remainder, F.lit(False))


#: Folders that this package made below the shared folder, by application.
_MADE: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, noted for `remove_made`."""
    path = fresh_path(spark, name)
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes Parquet below the shared folder and rereads it."""
    path = new_folder(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def remove_made(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Removes the folders this application made from number ``since`` on, but
    for those whose last part begins with one of ``keep``. Results that read them
    cannot be read again."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    context, left = spark.sparkContext, []
    for path in made[since:]:
        if path.rsplit("/", 1)[-1].startswith(keep or ("/",)):
            left.append(path)
            continue
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    made[since:] = left


class Intermediates:
    """What is written within goes when the block ends, by an error too; folders
    of the names in ``keep`` stay if it ends without one."""

    def __init__(self, spark: SparkSession, *keep: str):
        self.spark, self.keep = spark, keep

    def __enter__(self) -> Intermediates:
        self.since = len(_MADE.setdefault(self.spark.sparkContext.applicationId, []))
        return self

    def __exit__(self, kind, *_) -> None:
        remove_made(self.spark, self.since, self.keep if kind is None else ())


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver does. On a cluster
    without a common installation, pass the package by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_apart(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names, in any case, renamed; and the
    columns that select them under their own names again, in order."""
    taken, renamed = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.lower() in names:
            new = f"_own_{c}"
            while new.lower() in taken:
                new = f"_{new}"
            taken.add(new.lower())
            renamed[c] = new
    return docs.withColumnsRenamed(renamed), [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that a piece holds at most ``most`` bytes of
    ``text``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
