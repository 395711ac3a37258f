"""Nearest products to query vectors, exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import fresh_dir

# Vectors and queries that meet in one task.
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8_192, 256


def centroids(vectors: DataFrame, by: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group: (query_id, query). Folded per position map-side."""
    parts = vectors.select(by, F.posexplode(vector).alias("pos", "x"))
    means = parts.groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One entry per dimension: bounded by the vector length.
    return means.groupBy(F.col(by).cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias("query")
    )


def _usable(column: Column) -> Column:
    """Vectors with a direction: not NULL, no NULL or non-finite entry, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return column.isNotNull() & ~F.exists(column, bad) & F.exists(column, lambda x: x != 0)


def _best(k: int):
    """The k best rows of one block of vectors for each query of one block."""

    def best(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        rows, asked = (np.stack(f["vector"].to_numpy()).astype(np.float64) for f in (vectors, queries))
        scores = (asked / np.linalg.norm(asked, axis=1, keepdims=True)) @ (rows / np.linalg.norm(rows, axis=1, keepdims=True)).T
        vec_ids = vectors["vec_id"].to_numpy()
        # By score, then by the smaller id: the order of the result.
        order = np.lexsort((np.broadcast_to(vec_ids, scores.shape), -scores), axis=1)[:, :k]
        return pd.DataFrame({
            "query_id": np.repeat(queries["query_id"].to_numpy(), order.shape[1]),
            "vec_id": vec_ids[order].reshape(-1),
            "score": np.take_along_axis(scores, order, axis=1).reshape(-1),
        })

    return best


def nearest(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, vec_id, score, rank): the k rows of highest cosine similarity.

    Blocks of queries meet blocks of vectors, each pair in one task, in one job; a task
    returns its own k best per query. Both blocks have a bounded size whatever the tables'
    sizes. Vectors and queries without a direction (NULL, zero, not finite) take no
    part. Ties go to the smaller id.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")).where(_usable(F.col("vector")))
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("query").alias("vector")).where(_usable(F.col("vector")))
    sizes = rows.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / ROWS_PER_BLOCK)).alias("row_blocks")).join(
        F.broadcast(asked.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK)).alias("query_blocks"))), F.lit(True)
    )
    sizes = F.broadcast(sizes)  # exactly one row
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    left = rows.join(sizes, F.lit(True)).select("vec_id", "vector", block("vec_id", "row_blocks").alias("r"), upto("query_blocks").alias("q"))
    right = asked.join(sizes, F.lit(True)).select("query_id", "vector", block("query_id", "query_blocks").alias("q"), upto("row_blocks").alias("r"))
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInPandas(_best(k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# --- with an index ---------------------------------------------------------------

#: Cells of an index; their centres are the vectors of the first hashes, a bounded sample.
CELLS = 1024
#: Vectors whose distances to all centres a task holds at once.
ROWS_PER_STEP = 512
#: Distances are compared with this much to spare, far above the rounding of unit vectors.
SPARE = 1e-6


def _units(vectors: pd.Series) -> np.ndarray:
    rows = np.stack(vectors.to_numpy()).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _distances(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Between unit vectors, by their cosine."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ centres.T)))


def _assigned(frame: pd.DataFrame, centres: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows with the cell of their nearest centre, a bounded number against all centres at once."""
    for start in range(0, len(frame), ROWS_PER_STEP):
        part = frame.iloc[start : start + ROWS_PER_STEP]
        apart = _distances(_units(part["vector"]), centres)
        cell = apart.argmin(axis=1)
        yield part.assign(cell=cell, apart=apart[np.arange(len(cell)), cell])


@dataclass(frozen=True)
class Index:
    """Vectors in cells around centres, for exact nearest neighbours by cosine.

    Every usable vector belongs to the cell of its nearest centre. A cell knows how many vectors it has and how near and
    how far from its centre they lie; by the triangle inequality a query may leave out cells that cannot hold
    one of its k best. What the driver and every task hold of it is bounded by ``CELLS``.
    """

    rows: DataFrame  # vec_id, vector, cell
    centres: np.ndarray
    counts: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def build(cls, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cells: int = CELLS) -> Index:
        """The index of a table, written to the shared folder; vectors without a direction take no part."""
        spark = vectors.sparkSession
        rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(_usable(F.col("vector")))
        wanted = min(cells, math.ceil(math.sqrt(rows.count())))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).toPandas()
        centres = _units(sample["vector"]) if wanted else np.zeros((0, 0))

        def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield from _assigned(frame, centres)

        path = fresh_dir(spark, "vector-index")
        placed = rows.mapInPandas(assign, "vec_id bigint, vector array<double>, cell bigint, apart double")
        placed.write.parquet(path)
        placed = spark.read.schema(placed.schema).parquet(path)
        found = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("apart").alias("least"), F.max("apart").alias("most")).toPandas()
        counts, least, most = np.zeros(wanted, np.int64), np.zeros(wanted), np.zeros(wanted)
        at = found["cell"].to_numpy(np.int64)
        counts[at], least[at], most[at] = found["n"], found["least"], found["most"]
        return cls(placed.drop("apart"), centres, counts, least, most)

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, vec_id, score, rank, compared): the same rows as the function ``nearest`` gives.

        Each query first meets its nearest cells, enough to hold k vectors. The k-th best score there bounds how
        far the others may lie, and the query meets every cell that reaches nearer than that. ``compared`` is the number of
        vectors it was compared with. Cells and the queries that ask for one are dealt in blocks of bounded
        size, so a cell that holds a third of the table is many tasks' work.
        """
        spark = queries.sparkSession
        asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("query").cast("array<double>").alias("vector")).where(_usable(F.col("vector")))
        asked = asked.withColumn("reach", F.lit(None).cast("double"))
        if not len(self.centres):
            return spark.createDataFrame([], "query_id bigint, vec_id bigint, score double, rank int, compared bigint")
        first = self._met(asked, k)
        last = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")) == k
        reach = first.withColumn("_last", last).where("_last").select("query_id", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("reach"))
        # Queries with fewer than k vectors in all the table have met them all.
        second = self._met(asked.drop("reach").join(reach, "query_id"), k)
        both = first.unionByName(second)
        of_query = Window.partitionBy("query_id")
        ranked = both.withColumns({
            "rank": F.row_number().over(of_query.orderBy(F.desc("score"), "vec_id")),
            "compared": F.sum("cell_rows").over(of_query),
        })
        return ranked.where(F.col("rank") <= k).select("query_id", "vec_id", "score", "rank", "compared")

    def _met(self, asked: DataFrame, k: int) -> DataFrame:
        """The k best rows of each block that a query meets; ``cell_rows`` counts the block's rows once."""
        spark = asked.sparkSession
        path = fresh_dir(spark, "vector-asks")
        self._cells(asked, k).write.parquet(path)
        asks = spark.read.schema("query_id bigint, vector array<double>, cell bigint").parquet(path)
        # One row per cell, so a bounded table.
        sizes = asks.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).alias("query_blocks"))
        counts = spark.createDataFrame([(c, -(-int(n) // ROWS_PER_BLOCK)) for c, n in enumerate(self.counts) if n], "cell bigint, row_blocks bigint")
        sizes = F.broadcast(sizes.join(F.broadcast(counts), "cell"))
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
        left = self.rows.join(sizes, "cell").select("cell", "vec_id", "vector", block("vec_id", "row_blocks").alias("r"), upto("query_blocks").alias("q"))
        right = asks.join(sizes, "cell").select("cell", "query_id", "vector", block("query_id", "query_blocks").alias("q"), upto("row_blocks").alias("r"))
        path = fresh_dir(spark, "vector-met")
        met = left.groupBy("cell", "r", "q").cogroup(right.groupBy("cell", "r", "q")).applyInPandas(_counted(k), "query_id bigint, vec_id bigint, score double, cell_rows bigint")
        met.write.parquet(path)
        return spark.read.schema(met.schema).parquet(path)

    def _cells(self, asked: DataFrame, k: int) -> DataFrame:
        """A row per query and cell: the first cells where ``reach`` is null, else those left that reach so near."""
        centres, counts, least, most = self.centres, self.counts, self.least, self.most

        def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for start in range(0, len(frame), QUERIES_PER_BLOCK):
                    part = frame.iloc[start : start + QUERIES_PER_BLOCK]
                    apart = _distances(_units(part["vector"]), centres)
                    near = np.where(counts > 0, apart, np.inf)
                    order = np.argsort(near, axis=1, kind="stable")
                    before = np.cumsum(counts[order], axis=1) - counts[order]
                    first = np.zeros(apart.shape, bool)
                    np.put_along_axis(first, order, before < k, axis=1)
                    reach = part["reach"].to_numpy(np.float64)[:, None]
                    bound = np.maximum(apart - most, least - apart)
                    wanted = np.where(np.isnan(reach), first, ~first & (bound <= reach + SPARE)) & (counts > 0)
                    query, cell = np.nonzero(wanted)
                    yield pd.DataFrame({"query_id": part["query_id"].to_numpy()[query], "vector": part["vector"].to_numpy()[query], "cell": cell})

        return asked.mapInPandas(choose, "query_id bigint, vector array<double>, cell bigint")


def _counted(k: int):
    best = _best(k)

    def counted(_: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = best(vectors, queries)
        # The first row of each query stands for the whole block.
        return found.assign(cell_rows=np.where(found["query_id"].duplicated(), 0, len(vectors)))

    return counted
