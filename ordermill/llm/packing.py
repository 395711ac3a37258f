"""Best-fit packing with certified bin counts.

Documents become pieces of at most CAPACITY tokens. The pieces are dealt by length, one to each in turn, over
groups of a bounded size; each group packs its pieces best-fit decreasing and keeps its full sequences. The pieces
of the loose ones, of all groups, make a common pool, which is dealt and packed anew. Dual feasible functions
give a lower bound of the sequences that the whole pool needs; once its loose sequences meet the bound, or all of
it was packed in one group, it is finished. A round that would take more sequences than there are is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import crc, modest_batches, quoted, saved
from ordermill.llm.tokens import tokenizer, vocabulary_path

CAPACITY = 4096
#: Pieces of a group, and the sequences that its tokens fill at least: short pieces come in larger groups.
GROUP, FILLED = 2048, 16
ROUNDS = 8
#: A sequence with more free tokens than this share of the capacity is loose.
LOOSE = 0.002
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every text's ids with the end id, cut only where longer than ``capacity``; a row per piece.

    Null texts count as empty: the end id alone. Rows that repeat give pieces of their own. With
    ``with_ids`` a column ``ids`` holds the piece's ids.
    """
    modest_batches(docs.sparkSession)
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            out: list[tuple] = []
            for number, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1).to_pylist())):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((number, k, at // 4, len(part) // 4, crc(part), *([np.frombuffer(part, "<u4")] if with_ids else [])))
            columns = list(zip(*out)) or [()] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<bigint>" if with_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs, by two families of dual feasible functions.

    One counts pieces above capacity - t whole and leaves out those below t, for every t up to half the
    capacity; the other rounds to multiples of capacity / k. Sums of either over the capacity bound the count.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity) if len(lengths) else 0


def bound_of_counts(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """The same from the number of pieces of every length up to the capacity."""
    sizes = np.arange(capacity + 1)
    below = np.concatenate([[0], np.cumsum(counts * sizes)])
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    t = np.arange(capacity // 2 + 1)
    whole = above[capacity - t + 1]
    best = int(np.max(-(-(whole * capacity + below[capacity - t + 1] - below[t]) // capacity)))
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        # k * u(x) in units where a sequence holds capacity * k.
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, int(-(-(counts @ value) // (capacity * k))))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin of each piece, its offset there, used tokens of each bin)."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, []
    for k, length in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                mask &= ~(1 << room)
        else:
            room, bin_ = capacity, len(used)
            used.append(0)
        bins[k], offsets[k] = bin_, used[bin_]
        used[bin_] += length
        if room > length:
            open_bins[room - length].append(bin_)
            mask |= 1 << (room - length)
    return bins, offsets, np.array(used, np.int64)


def _dealt(rows: DataFrame, groups: int, turn: int) -> DataFrame:
    """``rows`` with ``group``: in order of length one to each group in turn, so that all groups look alike."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng((turn, TaskContext.get().partitionId()))
        at = int(rng.integers(groups))
        for batch in batches:
            yield batch.append_column("group", pa.array((np.arange(at, at + batch.num_rows) % groups).astype(np.int64)))
            at += batch.num_rows

    ordered = rows.select(*PIECES_AND_ROW).repartitionByRange("length", "row").sortWithinPartitions("length", "row")
    return ordered.mapInArrow(deal, PIECES + ", row bigint, group bigint")


PACKED = PIECES + ", row bigint, bin bigint, offset bigint, settled boolean"


def _pack_group(capacity: int, loose: float):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True], kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, used = best_fit(lengths, capacity)
        full = capacity - used <= int(capacity * loose)
        rows["bin"], rows["offset"] = bins + (int(key[0]) << 24), offsets
        rows["settled"] = full[bins]
        return rows.drop(columns="group")

    return pack


def pack(rows: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS, loose: float = LOOSE) -> DataFrame:
    """Pieces (see ``pieces``) with sequence_id, offset and round, into as few sequences as it can.

    Pieces of exactly the capacity are sequences of their own. Offsets have no gaps. A round costs a
    sort of the lengths of what is still loose; the number of groups comes from the rows and their tokens, and
    equal lengths or ids heat no group. An empty table gives an empty table.
    """
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = rows.where(F.col("length") >= capacity).select(
        *[x for x in rows.columns if x != "row"], (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("round")
    )
    names = [x for x in whole.columns if x not in ("sequence_id", "offset", "round")]
    done, loosely = [whole], None
    left = rows.where(F.col("length") < capacity)
    size = left.agg(F.count("*").alias("pieces"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
    for k in range(1, rounds + 1):
        if not size["pieces"]:
            break
        groups = min(-(-size["pieces"] // group), -(-size["tokens"] // (FILLED * capacity)))
        packed = saved(_dealt(left, groups, k).groupBy("group").applyInPandas(_pack_group(capacity, loose), PACKED), f"packed-{k}")
        # Every sequence has one piece at offset 0.
        first, still = F.col("offset") == 0, ~F.col("settled")
        sums = packed.agg(
            F.count_if(first).alias("bins"), F.count_if(first & still).alias("loose"), F.count_if(still).alias("pieces"), F.coalesce(F.sum(F.when(still, F.col("length"))), F.lit(0)).alias("tokens")
        ).first()
        if loosely is None or sums["bins"] <= bins:
            named = packed.select(*names, (F.col("bin") + F.lit(k << 56)).alias("sequence_id"), "offset", F.lit(k).alias("round"), "settled")
            done.append(named.where("settled").drop("settled"))
            loosely, left, size, bins = named.where("not settled").drop("settled"), packed.where("not settled"), sums, sums["loose"]
            counts = np.zeros(capacity + 1, np.int64)
            for r in left.groupBy("length").count().collect():  # fewer than the capacity
                counts[r["length"]] = r["count"]
            bound = bound_of_counts(counts, capacity)
        if groups == 1 or bins <= bound:
            break
    if loosely is not None:
        done.append(loosely)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


PIECES_AND_ROW = ("doc_id", "piece", "start", "length", "ids_crc32", "row")


def sequences(packed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """The packed sequences as ids: (sequence_id, ids); ``with_ids`` are the pieces with their ids.

    A sequence gathers at most the capacity in tokens, so no group is large.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    joined = packed.dropDuplicates(["sequence_id", "offset"]).join(with_ids.dropDuplicates(key).select(*key, "ids"), key)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def op3(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
