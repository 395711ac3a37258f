"""Helpers the corpus operators share: words, tables in the shared folder, column names."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import fresh_dir

#: A word of every contract: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` parts at exactly ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; ``bytes.lower`` touches ASCII letters only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


#: Words whose hashes a worker remembers.
KEPT_HASHES = 200_000


class _Hashes(dict):
    """64-bit hashes of words, remembered; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    if len(_hashes) > KEPT_HASHES:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, ws), np.uint64, len(ws))


def crc(data: bytes) -> int:
    """Unsigned CRC-32."""
    return zlib.crc32(data) & 0xFFFFFFFF


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Removes the files of a table that ``saved`` wrote, once what was made of it is saved itself."""
    spark = df.sparkSession
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, own: Iterable[str]) -> list[str]:
    """Input columns that do not clash with the operator's own; on a clash the operator's column wins."""
    taken = {x.lower() for x in own}
    return [x for x in df.columns if x.lower() not in taken]


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows per Arrow batch, so that a batch of very long texts stays small beside an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
