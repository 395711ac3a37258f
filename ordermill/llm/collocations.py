"""Phrase collocations by top-order marginalisation.

Every word starts one window: itself and the words that follow it in its piece, five at most, padded with
empty strings. Only these longest windows are counted; one ROLLUP over their columns sums them to the counts of
all shorter prefixes, so a phrase's count is the sum of the windows that begin with it, and no n-gram list per
length is ever made.

Most windows of a large corpus are found once. A phrase that reaches the limit has prefixes that reach it, so
one earlier pass counts all prefixes into hashed counters (they stop at the limit), and a window is padded from
the first prefix on whose counter stays below. Counters only ever overstate, so nothing that reaches the limit
is lost, and every count that comes out is exact, however full the counters are; where they are full, windows
merely stay long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import quoted, saved
from ordermill.llm.hamming import broadcast_if_small

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"
#: Least and most counters as powers of two: 16 to 128 MB in a counting task, 2 to 16 MB of bits sent to all.
#: Between them there is a counter for every so many characters; counters travel in so many parts.
LEAST_BITS, MOST_BITS = 24, 27
CHARACTERS = 80
PARTS = 1024
#: Words that a task counts together before it hands rows on.
CHUNK_WORDS = 250_000

#: A byte that no UTF-8 text holds stands for the end of a piece.
BREAK = b"\xff"
_PIECES = bytes(255 if x in b".,;:!?\n\x0b\x0c\r" else x + 32 if 65 <= x <= 90 else x for x in range(256))
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, with BREAK between pieces and at the end; ``split`` only meets spaces and tabs here."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_PIECES)
    return [*raw.replace(BREAK, b" \xff ").split(), BREAK]


class _Numbers(dict):
    """Numbers in order of first sight; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Chunk:
    """Some documents as arrays: word numbers, language numbers, and hashes of each word with its language."""

    def __init__(self, docs: list[tuple[str, list[bytes]]]):
        names, numbers = {}, _Numbers({BREAK: 0})
        langs = np.array([names.setdefault(lang, len(names)) for lang, _ in docs], np.int64)
        self.ids = np.concatenate([np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)) for _, ws in docs])
        self.langs = np.repeat(langs, [len(ws) for _, ws in docs])
        self.names, self.words = list(names), list(numbers)
        tint = np.array([xxhash.xxh3_64_intdigest(x) for x in self.names], np.uint64)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in self.words], np.uint64)[self.ids] ^ tint[self.langs]
        self.inside = self.ids > 0

    def prefixes(self, longest: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``longest`` words: the counter of the prefix at every place, and whether it stays in its piece."""
        whole, now = self.inside, self.hashes * M1
        yield _counter(now, bits), whole
        for k in range(1, min(longest, len(now))):
            now = (now[:-1] ^ (now[:-1] >> np.uint64(29))) * M2 + self.hashes[k:]
            whole = whole[:-1] & self.inside[k:]
            yield _counter(now, bits), whole


def _counter(x: np.ndarray, bits: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M1
    return ((x ^ (x >> np.uint64(31))) * M2 >> np.uint64(64 - bits)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    docs, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs.append((lang, tokens(text)))
            size += len(docs[-1][1])
            if size >= CHUNK_WORDS:
                yield Chunk(docs)
                docs, size = [], 0
    if docs:
        yield Chunk(docs)


def _counted(least: int, longest: int, bits: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint8)
        for chunk in _chunks(batches):
            seen = np.concatenate([places[whole] for places, whole in chunk.prefixes(longest, bits)])
            places, counts = np.unique(seen, return_counts=True)
            counters[places] = np.minimum(counters[places] + np.minimum(counts, least), least)
        pack = zstandard.ZstdCompressor(level=1)
        parts = counters.reshape(PARTS, -1)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_pydict({"part": pa.array(used, pa.int32()), "counts": pa.array([pack.compress(parts[k].tobytes()) for k in used], pa.binary())})

    return counted


def _summed(least: int):
    """Parts arrive sorted; one sum is held at a time."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, at, total = zstandard.ZstdDecompressor(), None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": pa.array([at], pa.int32()), "bits": pa.array([np.packbits(total >= least).tobytes()], pa.binary())})

        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != at:
                    if at is not None:
                        yield row()
                    at, total = part, np.uint16(0)
                total = np.minimum(total + np.frombuffer(unpack.decompress(raw), np.uint8), least)
        if at is not None:
            yield row()

    return summed


def counter_bits(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.length("text")).alias("size")).first()["size"] or 0
    return min(MOST_BITS, max(LEAST_BITS, (size // CHARACTERS).bit_length()))


def frequent_bits(texts: DataFrame, least: int, longest: int, bits: int) -> np.ndarray:
    """One bit per counter, set where it reaches ``least`` over all texts."""
    parts = texts.mapInArrow(_counted(least, longest, bits), "part int, counts binary").repartition("part").sortWithinPartitions("part")
    out = np.zeros((PARTS, (1 << bits) // PARTS // 8), np.uint8)
    for row in parts.mapInArrow(_summed(least), "part int, bits binary").toLocalIterator():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _windows(sent, longest: int, bits: int):
    """Distinct padded windows of a chunk with their counts."""

    def reaches(counters: np.ndarray) -> np.ndarray:
        return sent.value[counters >> 3] >> (7 - (counters & 7)).astype(np.uint8) & 1 > 0

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            columns, alive = [], np.ones(len(chunk.ids), bool)
            for k, (places, whole) in enumerate(chunk.prefixes(longest, bits)):
                alive = alive[: len(whole)] & whole
                alive[alive] = reaches(places[alive])
                columns.append(np.zeros(len(chunk.ids), np.int64))
                columns[k][: len(alive)] = np.where(alive, chunk.ids[k:], 0)
            columns += [np.zeros(len(chunk.ids), np.int64)] * (longest - len(columns))
            size = len(chunk.words)
            rows = np.flatnonzero(chunk.inside)
            key = chunk.langs[rows] * size + columns[0][rows]
            first, counts = [], []
            for k in range(1, longest + 1):
                ends = columns[k][rows] == 0 if k < longest else np.ones(len(rows), bool)
                _, at, count = np.unique(key[ends], return_index=True, return_counts=True)
                first.append(rows[ends][at])
                counts.append(count)
                rows, key = rows[~ends], key[~ends]
                if not len(rows):
                    break
                key = np.unique(key, return_inverse=True)[1] * size + columns[k][rows]
            first, counts = np.concatenate(first), np.concatenate(counts)
            words = pa.array([b"", *chunk.words[1:]], pa.binary()).view(pa.string())
            names = pa.array(chunk.names, pa.string())
            for i in range(0, len(first), 50_000):
                at = first[i : i + 50_000]
                yield pa.RecordBatch.from_pydict(
                    {"lang": names.take(pa.array(chunk.langs[at]))}
                    | {f"w{k + 1}": words.take(pa.array(column[at])) for k, column in enumerate(columns)}
                    | {"n": pa.array(counts[i : i + 50_000], pa.int64())}
                )

    return windows


def phrase_counts(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, f): f is exact for all phrases of at most ``longest`` words found ``least`` times or
    more; the row with words 0 and an empty phrase holds the number of all words of the language."""
    if not 1 <= least <= 255:
        raise ValueError("least must lie between 1 and 255")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), quoted(text_col).alias("text"))
    bits = counter_bits(texts)
    sent = spark.sparkContext.broadcast(frequent_bits(texts, least, longest, bits))
    columns = [f"w{k}" for k in range(1, longest + 1)]
    windows = texts.mapInArrow(_windows(sent, longest, bits), ", ".join(["lang string", *(f"{c} string" for c in columns), "n bigint"]))
    counted = windows.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("id"))
    # Of level k the last k ids are set: prefixes of longest - k words. A prefix that ends in padding is no phrase.
    words = F.lit(longest) - F.bit_count("id")
    last = reduce(lambda rest, k: F.when(F.col("words") == k, F.col(f"w{k}")).otherwise(rest), range(1, longest + 1), F.lit("-"))
    levels = summed.withColumn("words", words).where("words >= 0")
    return levels.where((last != "") & ((F.col("words") == 0) | (F.col("f") >= least))).select("lang", F.col("words").cast("int").alias("words"), F.concat_ws(" ", *columns).alias("phrase"), "f")


def _part(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("ws", start, size), " ")


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate's score is the least over its cuts of floor(1000 * a * n / (l * r)), computed in decimals of 38
    digits; the earliest such cut gives l and r. Candidates inside a longer candidate that is found as often are
    left out. A null language counts as ``und``; null, empty and white texts give no words; repeated rows
    count each; other columns are not looked at; an empty table gives no rows.
    """
    counts = saved(phrase_counts(docs, least=least, longest=longest, text_col=text_col, lang_col=lang_col), "phrases")
    parts = counts.where("words > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    found = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("ws"))

    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("head"), _part(F.col("cut") + 1, F.size("ws") - F.col("cut")).alias("tail"))
    for end, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.withColumnRenamed("f", count), (F.col("lang") == F.col("of")) & (F.col(end) == F.col("part"))).drop("of", "part")
    totals = counts.where("words = 0").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    scored = cuts.join(broadcast_if_small(totals), F.col("lang") == F.col("of")).drop("of")
    scored = scored.withColumn("above", F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("n")).withColumn("below", _whole("l") * _whole("r"))
    scored = scored.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    spans = F.expr("flatten(transform(sequence(2, size(ws) - 1), s -> transform(sequence(1, size(ws) - s + 1), i -> array_join(slice(ws, i, s), ' '))))")
    inner = found.where(F.size("ws") > 2).select(F.col("lang").alias("of"), "a", F.explode(spans).alias("part"))
    inner = inner.groupBy("of", "part").agg(F.max("a").alias("longer"))
    free = best.join(inner, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")) & (F.col("longer") >= F.col("a")), "left_anti")

    rows = free.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(docs: DataFrame) -> DataFrame:
    return collocations(docs)


#: Every phrase of one to five words listed and counted; no windows, no counters.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS ws FROM d),
g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p), range(1, 6) t(k)
  WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n.n,
         (1000::HUGEINT * c.a * n.n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1 : ], ' ')
  JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i : i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, ws, k, a, s, unnest(range(1, k - s + 2)) AS i FROM c, range(2, 5) t(s) WHERE s < k) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM kept)
WHERE rank <= 2000
"""
