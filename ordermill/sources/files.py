"""Batch readers: newline JSON, landing files, manifests, feeds, cart dumps, JDBC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import LANDING, PRODUCTS_JSON


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Message text per non-blank line, kept as it is."""
    return spark.read.text(path).where(F.trim("value") != "")


def read_landing_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below ``root``, whatever its ``yyyy/mm/dd`` folders.

    The folders are no partition columns: the date is a column of the files.
    """
    return (
        spark.read.schema(LANDING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
    )


def read_landing_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Exactly the given landing files."""
    return spark.read.schema(LANDING).parquet(*paths)


MANIFEST_DOCUMENT = (
    "dataset string, schema_version string, files array<struct<path:string, rows:bigint, "
    "size_bytes:bigint, schema_hash:string, min_event_date:string, max_event_date:string, "
    "created_at:string>>"
)


def read_manifest_documents(spark: SparkSession, root: str) -> DataFrame:
    """File entries of all ``_manifest.json`` documents below ``root``.

    File sources skip names that start with an underscore, so the documents (one
    per day) are found through the Hadoop file system; only their names are on
    the driver. Their content is read by the tasks.
    """
    paths = spark.createDataFrame([(p,) for p in _find(spark, root, "_manifest.json")], "path string")
    spread = paths.repartition(max(1, min(256, paths.count() // 16 + 1)), "path")
    texts = spread.mapInPandas(_read_small_files, "path string, text string")
    return texts.select(F.from_json("text", MANIFEST_DOCUMENT).alias("d")).selectExpr("inline(d.files)")


def _read_small_files(batches):
    from pyarrow import fs

    for batch in batches:
        texts = []
        for path in batch["path"]:
            source, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            with source.open_input_stream(inner) as stream:
                texts.append(stream.read().decode("utf-8"))
        yield batch.assign(text=texts)


def _find(spark: SparkSession, root: str, name: str) -> list[str]:
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = [], fs.listFiles(base, True)
    while files.hasNext():
        path = files.next().getPath()
        if path.getName() == name:
            found.append(path.toString())
    return found


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """(path, size_bytes, modified_at) of the files below ``root``, listed by Spark.

    Only file metadata is read: the ``content`` column is pruned.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    )


def read_products_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per product of a product document."""
    documents = spark.read.schema(PRODUCTS_JSON).option("multiLine", "true").json(path)
    return documents.select(F.explode("products").alias("p")).select("p.*")


PRODUCTS_CSV = (
    "_id string, title string, description string, price string, category string, imageUrls string"
)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product feed rows. Columns are matched by header name, as text."""
    frame = (
        spark.read.option("header", "true")
        .option("multiLine", "true")
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    wanted = [part.split()[0] for part in PRODUCTS_CSV.split(",")]
    return frame.select(
        *(F.col(c) if c in frame.columns else F.lit(None).cast("string").alias(c) for c in wanted)
    )


def read_fx_rates(spark: SparkSession, path: str) -> DataFrame:
    """(currency_code, rate) of a rate document; rates stay text until used."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>"))).select(
        F.col("key").alias("currency_code"), F.col("value").alias("rate")
    )


def read_cart_dump(spark: SparkSession, path: str) -> DataFrame:
    """Cart store dump: (key, value) with the cart as bytes."""
    return spark.read.schema("key string, value binary").parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: str, upper: str, partitions: int, **options: str) -> DataFrame:
    """A table of another database, read in parallel ranges of one column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=str(partitions),
            pushDownAggregate="true",
            **options,
        )
        .load()
    )
