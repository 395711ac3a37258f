"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature holds eight bits of one minimum per slot over its shingles. Two documents of similarity
s differ in about (1 - s) of the slots; a pair within the setting's distance is a candidate. By the
pigeonhole principle such a pair has a chunk of the signature with at most distance // chunks errors (here
one), so each document enters, for every chunk, all keys of that chunk with one slot left out: every pair
within the distance meets under some key, whatever the data.

Equal shingle sets are one class first, so copies never meet as pairs. Inside a bucket a member is
compared with leaders until the bucket is connected as its pairs within the distance connect it, without
listing them. The ties give candidate groups that no candidate pair crosses. In a group
documents are compared on their full shingle sets, block against block of bounded size, and only links
that join something new come out: a group gives at most a forest of links per pair of blocks, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import lower_words, modest_batches, quoted, saved, word_hashes
from ordermill.llm.components import components, contracted



@dataclass(frozen=True)
class Setting:
    """Words of a shingle, links from 100 * intersection >= percent * union, the signature's chunks."""

    shingle: int
    percent: int
    chunk: int
    chunks: int

    @property
    def slots(self) -> int:
        return self.chunk * self.chunks

    @property
    def distance(self) -> int:
        """Differing slots up to which some chunk has one error at most."""
        return 2 * self.chunks - 1


#: At similarity 0.85, 66 slots differ in 9.9 places on average, 2.9 standard deviation; 21 is four above. By the
#: binomial tail one link in 6 700 right at the limit lies beyond it.
THREE_WORDS = Setting(3, 85, 6, 11)
#: At similarity 0.8, 70 slots differ in 13.9 places on average, 3.3 standard deviation; 27 is four above; beyond
#: it lies one link in 11 000.
FIVE_WORDS = Setting(5, 80, 5, 14)
MOST_SLOTS = 128
#: Documents of a block in the comparison of full sets.
BLOCK = 256
#: Rows of a small table that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000
#: Buckets larger than this are not gathered in one task but split, see ``candidate_ties``.
LARGE_BUCKET = 50_000

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(0, 1 << 63, MOST_SLOTS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, MOST_SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; all words as one where they are fewer."""
    h = word_hashes(lower_words(text))
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    width = min(size, len(h))
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = _mixed(out * M1 + h[k : k + n] + M3)
    return np.unique(out)


def signature(h: np.ndarray, slots: int) -> np.ndarray:
    best = np.full(slots, np.uint64(0xFFFFFFFFFFFFFFFF))
    factors, shifts = FACTORS[:slots], SHIFTS[:slots]
    for i in range(0, len(h), 1024):
        np.minimum(best, (h[i : i + 1024, None] * factors + shifts).min(axis=0), out=best)
    return (_mixed(best) >> np.uint64(56)).astype(np.uint8)


def _identity(sets: list[np.ndarray], salt: np.uint64) -> np.ndarray:
    """64 bits per set that do not depend on its order."""
    return np.array([_mixed(s ^ salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)


SKETCH = "id bigint, row bigint, n_shingles bigint, set1 bigint, set2 bigint, signature binary"


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(quoted(id_col).cast("string"), quoted(text_col))


def sketch(docs: DataFrame, setting: Setting, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, hash of id and text, number of shingles, 128 bits for the set, signature (null without words)."""
    modest_batches(docs.sparkSession)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, setting.shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "row": batch.column(1), "n_shingles": np.array([len(s) for s in sets], np.int64), "set1": _identity(sets, np.uint64(0)), "set2": _identity(sets, M3),
                "signature": pa.array([signature(s, setting.slots).tobytes() if len(s) else None for s in sets], pa.binary()),
            })

    return docs.select(quoted(id_col).cast("long").alias("id"), _row_key(id_col, text_col).alias("row"), quoted(text_col).alias("text")).mapInArrow(sketched, SKETCH)


def chunk_keys(signatures: np.ndarray, setting: Setting) -> np.ndarray:
    """(documents, slots) keys: every chunk with each of its slots left out.

    Neighbouring slots of a chunk share the upper half of their keys, made from the slots that neither
    leaves out: dealt by it, buckets that hold the same documents mostly meet in one task.
    """
    parts = signatures.reshape(len(signatures), setting.chunks, setting.chunk).astype(np.uint64)
    values = parts << (np.arange(setting.chunk, dtype=np.uint64) * np.uint64(8))
    whole = values.sum(axis=2, dtype=np.uint64)[:, :, None]
    pairs = np.arange(setting.chunk) // 2
    paired = np.stack([values[:, :, pairs == p].sum(axis=2, dtype=np.uint64) for p in pairs], axis=2)
    number = np.arange(setting.slots, dtype=np.uint64).reshape(setting.chunks, setting.chunk)
    first = np.arange(setting.chunks, dtype=np.uint64)[:, None] * np.uint64(setting.chunk) + (pairs * 2).astype(np.uint64)
    shift, low = np.uint64(8 * setting.chunk), np.uint64(32)
    shared, own = _mixed((whole - paired + (first << shift)) * M1), _mixed((whole - values + (number << shift)) * M3)
    return ((shared >> low) << low | own >> low).reshape(len(signatures), -1).view(np.int64)


def _signatures(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _probes(setting: Setting):
    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = np.repeat(batch.column(0).to_numpy(), setting.slots)
                yield pa.RecordBatch.from_pydict({"key": chunk_keys(_signatures(batch.column(1)), setting).reshape(-1), "id": ids})

    return probes


class Forest(dict):
    """Union-find over whatever joins."""

    def __missing__(self, x: int) -> int:
        self[x] = x
        return x

    def root(self, x: int) -> int:
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)
        return a != b


def _any_near(some: np.ndarray, others: np.ndarray, distance: int) -> np.ndarray:
    """Which of ``some`` lie within the distance of any of ``others``."""
    out = np.zeros(len(some), bool)
    step = max(1, 20_000_000 // max(1, others.size))
    for i in range(0, len(some), step):
        out[i : i + step] = ((some[i : i + step, None] != others).sum(axis=2) <= distance).any(axis=1)
    return out


def ties(ids: np.ndarray, signatures: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Leader and member pairs of one bucket that connect exactly what pairs within the distance connect.

    What lies within the distance of a leader leaves with it. Of the rest only what lies within twice
    the distance can be near one of those that leave (triangle inequality), and is compared with them.
    """
    out = []
    while len(ids) > 1:
        far = (signatures[1:] != signatures[0]).sum(axis=1)
        ball = far <= distance
        tied = ball.copy()
        ring = np.flatnonzero((far > distance) & (far <= 2 * distance))
        if len(ring) and ball.any():
            tied[ring] = _any_near(signatures[1:][ring], signatures[1:][ball], distance)
        out += [(int(ids[0]), int(b)) for b in ids[1:][tied]]
        ids, signatures = ids[1:][~ball], signatures[1:][~ball]
    return out


def _bucket_ties(distance: int):
    """Buckets arrive sorted by key; the last of a batch waits for the next batch.

    A task ties every node once, to the smallest node it is connected with in the task's
    buckets. Tasks that see the same group mostly name the same node, so what they give
    together grows with the nodes and not with the buckets they share.
    """

    def tied_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def tie(keys: np.ndarray, ids: np.ndarray, sigs: np.ndarray) -> None:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            two = starts[ends - starts == 2]
            near = two[(sigs[two] != sigs[two + 1]).sum(axis=1) <= distance]
            for a, b in zip(ids[near].tolist(), ids[near + 1].tolist()):
                forest.join(a, b)
            for a, b in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                for pair in ties(ids[a:b], sigs[a:b], distance):
                    forest.join(*pair)

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), _signatures(batch.column(2))))
            if held[0][0][0] == held[-1][0][-1]:
                continue
            keys, ids, sigs = (np.concatenate(x) for x in zip(*held))
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
            tie(keys[:cut], ids[:cut], sigs[:cut])
            held = [(keys[cut:], ids[cut:], sigs[cut:])]
        if held:
            tie(*(np.concatenate(x) for x in zip(*held)))
        ends = [(forest.root(x), x) for x in list(forest)]
        ends = [(a, b) for a, b in ends if a != b]
        for i in range(0, len(ends), 50_000):
            left, right = zip(*ends[i : i + 50_000])
            yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return tied_buckets


@F.arrow_udf(T.IntegerType())
def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array((_signatures(a) != _signatures(b)).sum(axis=1), pa.int32())


def _parted(setting: Setting, turn: int):
    """Keys of a bucket's parts: the bucket's with each chunk key of the slots in another order.

    A pair within the distance meets in some part again (see ``chunk_keys``). Every turn deals the slots
    to chunks anew, so that what agreed by chance in one does not in the next.
    """
    order = np.random.default_rng(turn).permutation(setting.slots)

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = np.repeat(batch.column(0).to_numpy(), setting.slots).view(np.uint64)
                keys = chunk_keys(_signatures(batch.column(2))[:, order], setting).reshape(-1).view(np.uint64)
                ids = np.repeat(batch.column(1).to_numpy(), setting.slots)
                yield pa.RecordBatch.from_pydict({"key": _mixed(_mixed(whole * M1) ^ keys).view(np.int64), "id": ids})

    return parted


def _met(probes: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, signature) of the keys that hold two ids or more. Keys are counted on the map side first."""
    several = probes.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least != most").select("key")
    return saved(probes.join(several, "key", "left_semi").join(classes.select("id", "signature"), "id").select("key", "id", "signature"), "buckets")


def candidate_ties(classes: DataFrame, setting: Setting) -> DataFrame:
    """(a, b) pairs of class ids; any two classes within the distance are connected through them.

    A bucket too large for one task gives up the ball of a leader if that holds half of it; what lies within
    twice the distance is then tied unseen, which makes candidate groups larger and loses no pair. Any other
    large bucket is split by further slots (see ``_parted``). Only large buckets take part in a turn.
    """
    met = _met(classes.select("id", "signature").mapInArrow(_probes(setting), "key bigint, id bigint"), classes)
    small, found, turn = [], [], 0
    while True:
        sizes = saved(met.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LARGE_BUCKET), "large-buckets")
        if not sizes.take(1):
            small.append(met)
            break
        small.append(met.join(sizes, "key", "left_anti"))
        turn += 1
        large = met.join(sizes, "key")
        leaders = large.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "signature")).alias("leader"))
        led = large.join(leaders, "key").withColumn("far", _distance("signature", "leader.signature"))
        seen = saved(led.select("key", "id", "signature", "n", F.col("leader.id").alias("leader"), "far"), "balls")
        near = F.col("far") <= setting.distance
        balls = seen.groupBy("key", "n").agg(F.count_if(near).alias("ball")).where("2 * ball >= n").select(F.col("key").alias("led"))
        judged = seen.join(balls, F.col("key") == F.col("led"), "left")
        found.append(judged.where((F.col("led").isNotNull()) & (F.col("far") <= 2 * setting.distance) & (F.col("id") != F.col("leader"))).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct())
        rest = judged.where(F.col("led").isNotNull() & ~near).select("key", "id", "signature")
        parts = judged.where("led is null").select("key", "id", "signature").mapInArrow(_parted(setting, turn), "key bigint, id bigint")
        met = saved(rest.unionByName(_met(parts, classes)), "buckets")
    buckets = small[0]
    for part in small[1:]:
        buckets = buckets.unionByName(part)
    out = buckets.repartition(F.shiftright("key", 32)).sortWithinPartitions("key", "id").mapInArrow(_bucket_ties(setting.distance), "a bigint, b bigint")
    for part in found:
        out = out.unionByName(part)
    return contracted(out)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs; shingles of one set alone are left out, the others go in slices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    use = counts[place] > 1
    owner, place = owner[use], number[place[use]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(values) else 0, 4096):
        now = (place >= start) & (place < start + 4096)
        table = np.zeros((len(sets), min(4096, int(number[-1]) + 1 - start)), np.float32)
        table[owner[now], place[now] - start] = 1
        out += table @ table.T
    return out


def spanning_links(sets: list[np.ndarray], percent: int, cross: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the sets' components, by exact comparison of full sets.

    ``cross`` marks the sides; with it only pairs of different sides are compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    possible = np.triu(100 * small >= percent * large, 1)
    if cross is not None:
        possible &= cross[:, None] != cross[None, :]
    left, right = np.nonzero(possible)
    forest, out = Forest(), []
    if len(left) > 64:
        both = np.rint(_shared(sets)).astype(np.int64)[left, right]
        hit = 100 * both >= percent * (sizes[left] + sizes[right] - both)
        return [(int(a), int(b)) for a, b in zip(left[hit], right[hit]) if forest.join(int(a), int(b))]
    for a, b in zip(left.tolist(), right.tolist()):
        if forest.root(a) != forest.root(b):
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (sizes[a] + sizes[b] - both) and forest.join(a, b):
                out.append((a, b))
    return out


def _group_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of one task's documents: whole small groups, or the two blocks of one pair of blocks."""
    out: list[tuple[int, int]] = []
    for _, part in rows.groupby("sc", sort=False):
        ids, sides = part["id"].to_numpy(), part["side"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
        cross = sides if len(set(sides)) > 1 else None
        out += [(int(ids[a]), int(ids[b])) for a, b in spanning_links(sets, percent, cross)]
    left, right = zip(*out) if out else ((), ())
    return pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})


def _full_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, size) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": _identity(found, np.uint64(0)), "shingles": pa.array([s.tobytes() for s in found], pa.binary())})

    return sets


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A saved table of ids, broadcast below BROADCAST_ROWS rows; larger ones are shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def confirmed_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links on full sets inside candidate groups (node, component), never all pairs of a group.

    Groups up to BLOCK documents go whole, many to a task. Larger ones are first held against their
    smallest id; whoever links to it needs no comparison with others who do. Then block meets block, but
    for blocks that all linked to it.
    """
    sizes = groups.groupBy("component").count()
    placed = saved(groups.join(sizes, "component").select(F.col("component").alias("sc"), F.col("node").alias("id"), "count").join(sets, "id"), "candidates")
    small = placed.where(F.col("count").between(2, BLOCK))
    tasks = max(1, -(-small.count() // BLOCK))
    whole = small.select("sc", "id", "shingles", F.lit(0).alias("side"), F.pmod(F.xxhash64("sc"), F.lit(tasks)).alias("task"))
    links = whole.groupBy("task").applyInPandas(lambda rows: _group_links(rows, percent), "a bigint, b bigint")

    large = placed.where(F.col("count") > BLOCK)
    if not large.take(1):
        return links
    first = large.where("id = sc").select("sc", F.col("shingles").alias("first"))
    near = saved(large.join(first, "sc").mapInArrow(_against_first(percent), "sc bigint, id bigint, shingles binary, pure boolean"), "against-first")
    star = near.where("pure and id != sc").select(F.col("sc").alias("a"), F.col("id").alias("b"))
    counts = near.groupBy("sc", "pure").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocked = near.join(counts, ["sc", "pure"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    one = counts.select("sc", F.col("pure").alias("pure1"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block1"))
    two = counts.select(F.col("sc").alias("sc2"), F.col("pure").alias("pure2"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block2"))
    # The first block is never pure: pure blocks only meet the others.
    pairs = one.where("not pure1").join(two, (F.col("sc") == F.col("sc2")) & (F.col("pure2") | (F.col("block1") <= F.col("block2"))))
    pairs = pairs.withColumn("task", F.xxhash64("sc", "block1", "pure2", "block2"))
    sides = saved(
        pairs.select("sc", "task", F.col("pure1").alias("pure"), F.col("block1").alias("block"), F.lit(0).alias("side")).unionByName(
            pairs.where("pure2 or block1 != block2").select("sc", "task", F.col("pure2").alias("pure"), F.col("block2").alias("block"), F.lit(1).alias("side"))
        ),
        "block-pairs",
    )
    met = blocked.join(sides, ["sc", "pure", "block"]).select("sc", "id", "shingles", "side", "task")
    cross = met.groupBy("task").applyInPandas(lambda rows: _group_links(rows, percent), "a bigint, b bigint")
    return links.unionByName(star).unionByName(cross)


def _against_first(percent: int):
    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            pure = []
            for own, first in zip(column["shingles"].to_pylist(), column["first"].to_pylist()):
                a, b = np.frombuffer(own, np.uint64), np.frombuffer(first, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                pure.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_pydict({"sc": column["sc"], "id": column["id"], "shingles": column["shingles"], "pure": pa.array(pure, pa.bool_())})

    return against


def near_duplicates(docs: DataFrame, setting: Setting = FIVE_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, row (hash of id and text), n_shingles, class, component_id, kept.

    ``class`` is the same for all texts that links connect, null for texts without words; component_id is
    the smallest id among them. Links are confirmed on full shingle sets. Null and empty texts link with
    nothing and are their own component. Rows that repeat an id are told apart by their texts. A row
    without id takes the smallest id it links with, if any, and is kept. An empty table gives no rows.
    """
    rows = saved(sketch(docs, setting, id_col=id_col, text_col=text_col), "sketches")
    key = ["n_shingles", "set1", "set2"]
    grouped = rows.where("n_shingles > 0").groupBy(*key)
    classes = saved(grouped.agg(F.min("id").alias("least"), F.min("row").alias("row"), F.first("signature").alias("signature")), "classes")
    # From here on a class goes by the first half of its set's identity.
    near = saved(components(candidate_ties(classes.select(F.col("set1").alias("id"), "signature"), setting)), "groups")
    wanted = broadcast_if_small(saved(classes.join(near, F.col("set1") == F.col("node"), "left_semi").select(F.col("row").alias("_row")), "wanted"))
    texts = docs.select(quoted(text_col).alias("text"), _row_key(id_col, text_col).alias("row")).join(wanted, F.col("row") == F.col("_row"), "left_semi")
    sets = texts.select("text").mapInArrow(_full_sets(setting.shingle), "id bigint, shingles binary").dropDuplicates(["id"])
    found = saved(components(saved(confirmed_links(near, sets, setting.percent), "confirmed")), "linked")
    joined = classes.join(found, F.col("set1") == F.col("node"), "left").withColumn("class", F.coalesce("component", "set1"))
    ids = joined.groupBy("class").agg(F.min("least").alias("component_id"))
    named = saved(joined.join(ids.withColumnRenamed("class", "c"), F.col("class") == F.col("c")).select(*[F.col(x).alias(f"_{x}") for x in key], "class", "component_id"), "named")
    same = [F.col(x) == F.col(f"_{x}") for x in key]
    return (
        rows.join(named, same[0] & same[1] & same[2], "left")
        .select("id", "row", "n_shingles", "class", F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )


def distinct_documents(docs: DataFrame, setting: Setting = FIVE_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest id stays, of equal rows one.

    Documents without words all stay. Columns keep their names and order.
    """
    found = saved(near_duplicates(docs, setting, id_col=id_col, text_col=text_col), "duplicates")
    rows = found.where("class is not null").groupBy("class", "row").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("place"), F.count("*").alias("copies"))
    least = rows.groupBy(F.col("class").alias("c")).agg(F.min("place").alias("least"))
    fates = rows.join(least, F.col("class") == F.col("c")).select("row", (F.col("row") == F.col("least.row")).alias("stays"), "copies").where("not stays or copies > 1")
    fates = broadcast_if_small(saved(fates.groupBy(F.col("row").alias("_row")).agg(F.bool_or("stays").alias("_stays")), "fates"))
    marked = docs.withColumn("_key", _row_key(id_col, text_col)).join(fates, F.col("_key") == F.col("_row"), "left")
    single = marked.where(F.col("_row").isNull()).select(*map(quoted, docs.columns))
    repeated = marked.where("_stays").dropDuplicates(["_key"]).select(*map(quoted, docs.columns))
    return single.unionByName(repeated)


def op4(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, THREE_WORDS).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


#: Every pair of documents that share a shingle; nothing of the signatures.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 2 THEN [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT l.a, r.low FROM l JOIN r ON l.b = r.node)
SELECT node AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(low) AS component_id, node = min(low) AS kept
FROM r LEFT JOIN n ON n.doc_id = node GROUP BY node
"""
