"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of its projections on random directions and sorts the vectors
of a label by these signs in a row, the first direction foremost. Similar vectors agree in long prefixes and come to stand
near each other; everyone is compared with the WINDOW next ones. The pairs that reach the cosine, of all
passes together, connect vectors to groups; inside a group, block against block, every pair is compared
once more, so that dense groups larger than a window keep their links.

How often similar vectors meet depends on the size and shape of a label. So pairs are planted that lie exactly at
the limit, in every label that a window does not span; as long as fewer than MEET of a label's pairs have met, it
gets another turn of passes with twice the comparisons. Where a turn would cost as much as all pairs of the
label, its blocks are compared with each other instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import modest_batches, quoted, saved
from ordermill.llm.components import components, contracted
from ordermill.llm.hamming import Forest

COSINE = 0.93
PASSES = 24
#: Following neighbours that a vector is compared with in one pass.
WINDOW = 64
#: Vectors of a block; its neighbours' window is added to it.
BLOCK = 1024
SEED = 7
#: Pairs planted per label, an eighth of its vectors at most, and the share of them that has to meet.
PLANTED, MEET = 500, 0.99


def directions(passes: int, dims: int, turn: int = 0) -> np.ndarray:
    """(passes, 63, dims) random directions, the same in every task."""
    return np.random.default_rng(SEED + turn).standard_normal((passes, 63, dims))


def sort_keys(units: np.ndarray, passes: int = PASSES, turn: int = 0) -> np.ndarray:
    """(vectors, passes) keys: the signs of 63 projections, the first direction in the highest bit."""
    powers = np.int64(1) << np.arange(62, -1, -1, dtype=np.int64)
    return np.stack([(units @ d.T >= 0) @ powers for d in directions(passes, units.shape[1], turn)], axis=1)


def _units(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def _padded(column: pd.Series) -> np.ndarray:
    """Vectors of one block; shorter ones, whose labels differ anyway, end in zeros."""
    rows = [np.frombuffer(x, np.float64) for x in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision; null for those that can't be compared."""
    for batch in batches:
        out = []
        for values in batch.column(2).to_pylist():
            unit = None
            if values and None not in values:
                v = np.array(values, np.float64)
                top = np.abs(v).max()
                if np.isfinite(v).all() and top > 0:
                    v = v / top  # neither overflows nor vanishes when squared
                    unit = (v / math.sqrt(float(v @ v)) + 0.0).tobytes()
            out.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "unit"])


def _window_links(cosine: float, window: int):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", ignore_index=True)
        nodes, labels, ranks = rows["node"].to_numpy(), rows["label"].to_numpy(), rows["rank"].to_numpy()
        units = _padded(rows["unit"])
        forest = Forest()
        for i in range(0, len(rows), 128):
            part = slice(i, min(i + 128, len(rows)))
            near = slice(i, min(i + 128 + window, len(rows)))
            gap = ranks[near][None, :] - ranks[part][:, None]
            hit = (gap > 0) & (gap <= window) & (labels[near][None, :] == labels[part][:, None])
            hit &= units[part] @ units[near].T >= cosine
            a, b = np.nonzero(hit)
            for x, y in zip(nodes[part][a].tolist(), nodes[near][b].tolist()):
                forest.join(x, y)
        # Every vector is tied once, to the smallest one it is linked with in the block.
        ends = [(forest.root(x), x) for x in list(forest)]
        left, right = zip(*[(a, b) for a, b in ends if a != b]) if len(ends) else ((), ())
        return pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})

    return links


def _block_links(cosine: float):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        """Ties of one block, or of two with each other."""
        units, nodes, side = _padded(rows["unit"]), rows["node"].to_numpy(), rows["side"].to_numpy()
        own, other = side == 0, side == side.max()
        forest = Forest()
        for i in range(0, int(own.sum()), 128):
            a, b = np.nonzero(units[own][i : i + 128] @ units[other].T >= cosine)
            for x, y in zip(nodes[own][i + a].tolist(), nodes[other][b].tolist()):
                forest.join(x, y)
        ends = [(root, x) for root, x in ((forest.root(x), x) for x in list(forest)) if root != x]
        return pd.DataFrame(ends, columns=["a", "b"]).astype(np.int64)

    return links


def _blocks_paired(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` (component, block, ...) once for each block that theirs meets, with ``task`` and ``side``.

    ``blocks`` has the components c with their number of blocks n.
    """
    one = blocks.select("c", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block1"))
    meets = one.withColumn("block2", F.explode(F.sequence(F.col("block1"), F.col("n") - 1))).withColumn("task", F.xxhash64("c", "block1", "block2"))
    sides = meets.select("c", "task", F.col("block1").alias("b"), F.lit(0).alias("side")).unionByName(
        meets.where("block1 < block2").select("c", "task", F.col("block2").alias("b"), F.lit(1).alias("side"))
    )
    return rows.join(sides, (F.col("component") == F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")


def _planted(cosine: float):
    """Both ends of a pair at exactly ``cosine`` for every vector: half of them in a random direction, half towards another vector."""

    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces, nodes, units, out, last = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), [], None
            for k, unit in enumerate(units):
                u = np.frombuffer(unit, np.float64)
                other = np.frombuffer(last, np.float64) if k % 2 and spaces[k] == spaces[k - 1] else np.random.default_rng(nodes[k] & 0xFFFFFFFF).standard_normal(len(u))
                side = other - (other @ u) * u
                size = math.sqrt(float(side @ side))
                out.append((cosine * u + math.sqrt(1 - cosine * cosine) * side / size if size > 1e-9 else u).tobytes())
                last = unit
            for ends in (units, out):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ends, pa.binary())], names=["space", "pair", "unit"])

    return planted


def _pass_keys(passes: int, turn: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per vector and pass: space, node, pair, key."""
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(3).to_pylist()])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                keys = sort_keys(_units(part.column(3)), passes, turn)
                for k in range(passes):
                    number = pa.array(np.full(len(keys), k, np.int32))
                    yield pa.RecordBatch.from_arrays([number, part.column(0), pa.array(keys[:, k]), part.column(1), part.column(2)], names=["pass", "space", "key", "node", "pair"])

    return keyed


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places in the partition's order; planted vectors take none and stand at the next one's."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        real = np.asarray(batch.column("pair").is_null())
        place = at + np.cumsum(real) - real
        at += int(real.sum())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in ("pass", "space", "node", "pair")), pa.array(np.full(len(real), part, np.int32)), pa.array(place.astype(np.int64))],
            names=["pass", "space", "node", "pair", "part", "place"],
        )


def _turn(entrants: DataFrame, passes: int, window: int, turn: int) -> DataFrame:
    """(pass, space, node, pair, rank) of all vectors in the orders of one turn of passes."""
    order = ["pass", "space", "key", "node"]
    keys = entrants.select("space", "node", "pair", "unit").mapInArrow(_pass_keys(passes, turn), "pass int, space string, key bigint, node bigint, pair bigint")
    places = saved(keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_numbered, "pass int, space string, node bigint, pair bigint, part int, place bigint"), "places")
    parts = places.groupBy(F.col("part").alias("p")).agg(F.count_if(F.col("pair").isNull()).alias("n"))
    offsets = parts.select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return places.join(F.broadcast(offsets), F.col("part") == F.col("p")).select("pass", "space", "node", "pair", (F.col("before") + F.col("place")).alias("rank"))


def linked_pairs(classes: DataFrame, *, cosine: float, passes: int, window: int) -> DataFrame:
    """(a, b) ties of classes (node, space, unit): turns of passes, each with twice the comparisons of the one
    before, for the spaces whose planted pairs have not met yet; then block against block.
    """
    sizes = saved(classes.groupBy("space").agg(F.count("*").alias("n")), "spaces")
    share = F.least(F.lit(PLANTED) / F.col("n"), F.lit(1 / 8))
    drawn = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1 << 30)) < share * (1 << 30)
    chosen = classes.join(sizes.where(F.col("n") > window + 1), "space").where(drawn).select("space", "node", "unit")
    plants = saved(chosen.repartition("space").sortWithinPartitions("space", "node").mapInArrow(_planted(cosine), "space string, pair bigint, unit binary"), "planted")
    wanted = plants.groupBy("space").agg(F.count_distinct("pair").alias("pairs"))
    real = classes.select("space", "node", F.lit(None).cast("bigint").alias("pair"), "unit")
    both = real.unionByName(plants.select("space", F.col("pair").alias("node"), "pair", "unit"))
    found, met, spent, turn, left = [], None, 0, 0, sizes
    while True:
        entrants = both if turn == 0 else both.join(left.select("space"), "space", "left_semi")
        ranked = _turn(entrants, passes, window, turn)
        block = F.floor(F.col("rank") / BLOCK)
        # The first rows of a block also close the window of the block before.
        two = F.when(F.col("rank") % BLOCK < window, F.array(block, block - 1)).otherwise(F.array(block))
        dealt = ranked.where("pair is null").select("space", "node", "rank", F.explode(two).alias("block")).where("block >= 0").join(classes.select("node", "unit"), "node")
        links = dealt.select("block", F.col("space").alias("label"), "node", "rank", "unit").groupBy("block").applyInPandas(_window_links(cosine, window), "a bigint, b bigint")
        found.append(saved(contracted(links), "vector-pairs"))
        near = ranked.where("pair is not null").groupBy("pass", "space", "pair").agg((F.max("rank") - F.min("rank")).alias("gap")).where(F.col("gap") <= window).select("space", "pair")
        met = saved((near if met is None else near.unionByName(met)).distinct(), "met")
        shares = left.join(wanted, "space").join(met.groupBy("space").agg(F.count("*").alias("met")), "space", "left")
        left = saved(shares.where(F.coalesce("met", F.lit(0)) < MEET * F.col("pairs")).select("space", "n"), "spaces")
        if not left.take(1):
            break
        spent, turn = spent + passes * window, turn + 1
        window, passes = (2 * window, passes) if 2 * window <= BLOCK else (window, 2 * passes)
        whole = left.where(F.col("n") <= 2 * (spent + passes * window))
        if whole.take(1):
            blocks = whole.select(F.col("space").alias("c"), F.ceil(F.col("n") / BLOCK).alias("n"))
            rows = classes.join(blocks, F.col("space") == F.col("c")).select("node", "unit", F.col("space").alias("component"), F.pmod(F.xxhash64("node"), F.col("n")).alias("block"))
            exact = _blocks_paired(rows, blocks).groupBy("task").applyInPandas(_block_links(cosine), "a bigint, b bigint")
            found.append(saved(contracted(exact), "vector-pairs"))
            left = saved(left.where(F.col("n") > 2 * (spent + passes * window)), "spaces")
            if not left.take(1):
                break
    pairs = found[0]
    for part in found[1:]:
        pairs = pairs.unionByName(part)
    return pairs if len(found) == 1 else saved(contracted(pairs), "vector-pairs")


def _group_counts(cosine: float):
    def counts(rows: pd.DataFrame) -> pd.DataFrame:
        """Links of each vector of side 0 with those of the task's group; copies count as often as they occur."""
        out = []
        for _, part in rows.groupby("component", sort=False):
            units = np.stack([np.frombuffer(x, np.float64) for x in part["unit"]])
            side = part["side"].to_numpy()
            own, other = (side == 0), (side == (1 if (side == 1).any() else 0))
            nodes = part["node"].to_numpy()
            hit = (units[own] @ units[other].T >= cosine) & (nodes[own][:, None] != nodes[other][None, :])
            out.append(pd.DataFrame({"node": nodes[own], "links": hit @ part["copies"].to_numpy()[other]}))
            if (side == 1).any():
                out.append(pd.DataFrame({"node": nodes[other], "links": hit.T @ part["copies"].to_numpy()[own]}))
        return pd.concat(out, ignore_index=True)

    return counts


def link_groups(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW) -> DataFrame:
    """One row per vector: id, n_links (other rows linked directly), component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without label,
    link with nothing and are their own component. Equal vectors of a label are one class, linked with
    each other; vectors of different lengths don't compare. A null id takes the component of its links
    and is kept. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    modest_batches(spark, 4000)
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("string").alias("label"), quoted(vector_col).cast("array<double>").alias("vector"))
    units = saved(rows.mapInArrow(_cleaned, "id bigint, label string, unit binary"), "units")
    usable = units.where("unit is not null and label is not null")
    node = F.xxhash64("label", "unit")
    classes = saved(
        usable.withColumn("node", node).groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit")),
        "vector-classes",
    )

    # Vectors of different lengths are spaces of their own.
    spaces = classes.select("node", F.concat((F.octet_length("unit") / 8).cast("int").cast("string"), F.lit(":"), "label").alias("space"), "unit")
    found = saved(components(linked_pairs(spaces, cosine=cosine, passes=passes, window=window)), "vector-groups")

    sizes = found.groupBy(F.col("component").alias("c")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    grouped = saved(
        found.join(sizes, F.col("component") == F.col("c")).join(classes.select("node", "unit", "copies"), "node")
        .select("node", "component", "blocks", "unit", "copies", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")),
        "vector-members",
    )
    schema = "node bigint, links bigint"
    tasks = max(1, -(-grouped.count() // BLOCK))
    whole = grouped.where("blocks = 1").select("component", "node", "unit", "copies", F.lit(0).alias("side"), F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("task"))
    large = _blocks_paired(grouped.where("blocks > 1"), sizes.where("blocks > 1").select("c", F.col("blocks").alias("n")))
    compared = whole.unionByName(large.select("component", "node", "unit", "copies", "side", "task"))
    links = compared.groupBy("task").applyInPandas(_group_counts(cosine), schema).groupBy(F.col("node").alias("n1")).agg(F.sum("links").alias("links"))
    least = found.join(classes.select("node", "least"), "node").groupBy(F.col("component").alias("c1")).agg(F.min("least").alias("component_id"))
    named = saved(
        classes.select("node", "least", "copies").join(found.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left")
        .join(least, F.col("component") == F.col("c1"), "left")
        .join(links, F.col("node") == F.col("n1"), "left")
        .select(F.col("node").alias("n3"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")),
        "vector-named",
    )
    return (
        units.withColumn("node", F.when(F.col("unit").isNotNull() & F.col("label").isNotNull(), node))
        .join(named, F.col("node") == F.col("n3"), "left")
        .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )


def op10(vectors: DataFrame) -> DataFrame:
    return link_groups(vectors).withColumnRenamed("id", "vec_id")


#: Every pair of a label; where a window spans a label the passes find exactly these.
ORACLE = rf"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r AS (SELECT vec_id AS node, vec_id AS low FROM embeddings UNION SELECT l.a, r.low FROM l JOIN r ON l.b = r.node)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, min(r.low) AS component_id, e.vec_id = min(r.low) AS kept
FROM embeddings e JOIN r ON r.node = e.vec_id GROUP BY e.vec_id
"""
