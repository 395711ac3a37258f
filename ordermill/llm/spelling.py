"""Spelling variants grouped by PartEnum signatures.

A word's letters, counted, are a binary vector: (letter, k) is set where the letter occurs k times or more.
Words that differ by one inserted, deleted or replaced letter have vectors within Hamming distance two: one bit
apart after an insertion, two after a replacement, where both words are of one length. Anagrams share a vector,
so vectors, not words, are matched.

The letters are dealt over parts. A pair of one length that differs in two bits agrees on all parts but two, a
pair of neighbouring lengths that differs in one bit on all but one; a vector's signatures are its projections
with each two (each one) parts left out, together with the length, so every pair shares one exactly. The
signatures are equi-joined by sorting; vectors that share one are verified bit by bit.

A verified pair says which letter one vector has over the other. Words of a vector then only try that letter: with
it deleted they must equal a word, with it blanked they must equal another word's blank at the same place. Both
are equi-joins, so no pairs of anagrams are made.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import quoted, saved

#: A typing slip is planted where this number divides the checksum of id and run.
SLIP = 97
SHORTEST = 5
LEAST = 3
#: Parts of the letters where two and where one are left out.
PAIR_PARTS, ONE_PARTS = 8, 5
#: Distinct words that a task counts together before it hands rows on.
KEPT_WORDS = 400_000
#: Pairs of vectors that a task compares at a time.
SLICE = 100_000

#: Runs of letters up to U+00FF in Latin-1 bytes; all else, "?" for other code points included, parts them.
_RUNS = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 0xC0 else 32 for x in range(256))
#: The letters that occur in words, and their places in a vector.
LETTERS = np.array([x for x in range(256) if 97 <= x <= 122 or x >= 0xC0], np.uint8)
PLACE = np.zeros(256, np.int64)
PLACE[LETTERS] = np.arange(len(LETTERS))


def slipped(run: bytes, start: int) -> bytes:
    """A run (Latin-1) as its document spells it; ``start`` is the checksum of what stands before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        items = list(counts.items())
        for i in range(0, len(items), 50_000):
            found, n = zip(*items[i : i + 50_000])
            yield pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in found], pa.string()), "n": pa.array(n, pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            start = zlib.crc32(f"{doc_id or ''}:".encode())
            for run, n in Counter(text.encode("latin-1", "replace").translate(_RUNS).split()).items():
                word = slipped(run, start)
                if len(word) >= SHORTEST:
                    counts[word] += n
            if len(counts) > KEPT_WORDS:
                yield from rows()
                counts.clear()
    yield from rows()


def vocabulary(docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): all words found ``least`` times or more, as their documents spell them."""
    texts = docs.select(quoted(id_col).cast("string").alias("id"), quoted(text_col).alias("text"))
    return texts.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def vectors(bags: list[str]) -> np.ndarray:
    """How often each letter occurs in each bag of letters."""
    raw = [b.encode("latin-1") for b in bags]
    owner = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
    at = owner * len(LETTERS) + PLACE[np.frombuffer(b"".join(raw), np.uint8)]
    return np.bincount(at, minlength=len(raw) * len(LETTERS)).reshape(len(raw), -1).astype(np.int32)


def _parts(parts: int) -> np.ndarray:
    """Letters are dealt in turn from the commonest in prose on, so that parts are about as full."""
    common = [PLACE[ord(x)] for x in "etaoinsrhldcumfpgwybvkxjqz"]
    order = [*common, *(p for p in range(len(LETTERS)) if p not in set(common))]
    out = np.zeros(len(LETTERS), np.int64)
    out[order] = np.arange(len(LETTERS)) % parts
    return out


_random = np.random.default_rng(20240611)
_FACTORS = _random.integers(0, 1 << 63, len(LETTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KIND = _random.integers(0, 1 << 63, PAIR_PARTS * PAIR_PARTS + ONE_PARTS, dtype=np.uint64)
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M2
    return x ^ (x >> np.uint64(29))


def signatures(counts: np.ndarray) -> np.ndarray:
    """(bags, signatures): the pairs of parts left out at a bag's own length, then each single part left out, once
    with the own length (the shorter of a pair) and once with the length below (the longer)."""
    length = counts.sum(axis=1).astype(np.uint64)
    out = []

    def projected(parts: int) -> list[np.ndarray]:
        # A part's counts as one number; sums of them are the projections.
        part = _parts(parts)
        values = _mixed(counts.astype(np.uint64) * _FACTORS + _FACTORS) * (counts > 0)
        return [values[:, part == p].sum(axis=1, dtype=np.uint64) for p in range(parts)]

    values = projected(PAIR_PARTS)
    whole = sum(values)
    for k, (a, b) in enumerate(combinations(range(PAIR_PARTS), 2)):
        out.append(_mixed(whole - values[a] - values[b] + _KIND[k] + length * M1))
    values = projected(ONE_PARTS)
    whole = sum(values)
    for size in (length, length - np.uint64(1)):
        out += [_mixed(whole - values[a] + _KIND[PAIR_PARTS * PAIR_PARTS + a] + size * M1) for a in range(ONE_PARTS)]
    return np.stack(out, axis=1).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 5_000):
            part = batch.slice(i, 5_000)
            keys = signatures(vectors(part.column(0).to_pylist()))
            at = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
            yield pa.RecordBatch.from_pydict({"key": keys.reshape(-1), "bag": part.column(0).take(at)})


def spare_letters(keys: np.ndarray, bags: list[str]) -> set[tuple[str, int, bool]]:
    """(bag, letter's place, blanked) for every pair of one signature that one edit could join; ``keys`` are sorted.

    Of two bags one bit apart the longer is named with the letter it has more (to delete); of two bags of one
    length two bits apart both are, each with its own letter (to blank). Pairs are made a slice at a time.
    """
    counts = vectors(bags)
    length = counts.sum(axis=1)
    used = np.flatnonzero(counts.any(axis=0))
    counts = counts[:, used].astype(np.int16 if counts.max(initial=0) < 1 << 14 else np.int32)
    ends = np.searchsorted(keys, keys, side="right")
    later = ends - np.arange(len(keys)) - 1
    rows = np.flatnonzero(later)
    total = np.cumsum(later[rows])
    found: set[tuple[str, int, bool]] = set()
    start = 0
    while start < len(rows):
        stop = max(start + 1, int(np.searchsorted(total, total[start] - later[rows[start]] + SLICE, side="right")))
        left = np.repeat(rows[start:stop], later[rows[start:stop]])
        first = np.cumsum(later[rows[start:stop]]) - later[rows[start:stop]]
        right = left + 1 + np.arange(len(left)) - np.repeat(first, later[rows[start:stop]])
        start = stop
        gap = counts[left] - counts[right]
        apart = np.abs(gap).sum(axis=1)
        blank = length[left] == length[right]
        hit = (apart == 1) | ((apart == 2) & blank)
        gap, blank, left, right = gap[hit], blank[hit], left[hit], right[hit]
        for sign, bag in ((gap, left), (-gap, right)):
            place = sign.argmax(axis=1)
            more = sign[np.arange(len(sign)), place] > 0
            codes = np.unique((bag[more] * len(LETTERS) + used[place[more]]) * 2 + blank[more])
            found.update((bags[c // 2 // len(LETTERS)], c // 2 % len(LETTERS), c % 2 > 0) for c in codes.tolist())
    return found


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures arrive sorted; the last of a batch waits for the next batch."""
    out: set[tuple[str, int, bool]] = set()
    held_keys, held_bags = np.zeros(0, np.int64), []

    def rows() -> Iterator[pa.RecordBatch]:
        items = list(out)
        out.clear()
        for i in range(0, len(items), 50_000):
            bag, place, blank = zip(*items[i : i + 50_000])
            letters = [chr(LETTERS[p]) for p in place]
            yield pa.RecordBatch.from_pydict({"bag": pa.array(bag, pa.string()), "letter": pa.array(letters, pa.string()), "blank": pa.array(blank, pa.bool_())})

    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        bags = held_bags + batch.column(1).to_pylist()
        other = np.flatnonzero(keys != keys[-1]) if len(keys) else []
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            out |= spare_letters(keys[:cut], bags[:cut])
        held_keys, held_bags = keys[cut:], bags[cut:]
        if len(out) > KEPT_WORDS:
            yield from rows()
    if len(held_keys):
        out |= spare_letters(held_keys, held_bags)
    yield from rows()


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word with the letter deleted or blanked, at each of its places; equal deletions once."""
    for batch in batches:
        column = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)}
        words, ns, blanks, keys = [], [], [], []
        for word, n, letter, blank in zip(column["word"], column["n"], column["letter"], column["blank"]):
            tries = [word[:i] + "_" * blank + word[i + 1 :] for i, x in enumerate(word) if x == letter]
            tries = tries if blank else dict.fromkeys(tries)
            for key in tries:
                words.append(word)
                ns.append(n)
                blanks.append(blank)
                keys.append(key)
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(ns, pa.int64()), "blank": pa.array(blanks, pa.bool_()), "key": pa.array(keys, pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): how many words of the table lie one edit away, and the commonest of them
    (ties: the smallest). ``words`` has distinct words and their counts; words without near words have no row."""
    bag = F.array_join(F.array_sort(F.split("word", "")), "")
    bags = words.select("word", "n", bag.alias("bag"))
    signed = bags.select("bag").distinct().mapInArrow(_signed, "key bigint, bag string")
    pairs = signed.repartition("key").sortWithinPartitions("key").mapInArrow(_verified, "bag string, letter string, blank boolean")
    spare = saved(pairs.distinct(), "spare-letters")
    named = bags.join(spare.withColumnRenamed("bag", "of"), F.col("bag") == F.col("of")).select("word", "n", "letter", "blank")
    tries = saved(named.mapInArrow(_tries, "word string, n bigint, blank boolean, key string"), "tries")

    # Words with one blank in common: the commonest is everyone's best but its own, whose best is the second.
    order = Window.partitionBy("key").orderBy(F.desc("n"), "word")
    met = tries.where("blank").select("key", "word", "n", F.count("*").over(Window.partitionBy("key")).alias("size"), F.row_number().over(order).alias("place"), F.lead(F.struct("n", "word")).over(order).alias("next"), F.first(F.struct("n", "word")).over(order).alias("top"))
    replaced = met.where("size > 1").select("word", "n", (F.col("size") - 1).alias("n_near"), F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top")).alias("best"))

    shorter = words.select(F.col("word").alias("short"), F.col("n").alias("short_n"))
    cut = tries.where("not blank").join(shorter, F.col("key") == F.col("short"))
    ends = F.array(F.struct("word", "n", F.struct(F.col("short_n").alias("n"), F.col("short").alias("word")).alias("best")), F.struct(F.col("short").alias("word"), F.col("short_n").alias("n"), F.struct("n", "word").alias("best")))
    cut = cut.select(F.explode(ends).alias("end")).select("end.word", "end.n", F.lit(1).cast("long").alias("n_near"), "end.best")

    best = F.min(F.struct((-F.col("best.n")).alias("less"), F.col("best.word").alias("word")))
    grouped = replaced.unionByName(cut).groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return grouped.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached by following ``form`` in (word, form), which must not run in circles.

    Each round doubles the steps, so rounds grow with the logarithm of the longest way.
    """
    steps = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = steps.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        moved = saved(steps.join(beyond, F.col("root") == F.col("at"), "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if not moved.where("moved").take(1):
            return steps


def variants(docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: form, root, n, n_near, form_n.

    A word's form is its commonest near word if that is found twice as often or more; counts double on the way
    to the root, so the way ends. Null and empty texts have no words, a null id counts as empty text, repeated
    rows count each, other columns are not looked at, and an empty table gives no rows. Groups of one
    signature, one blank or one word's neighbours are bounded by the letters, not by the table.
    """
    words = saved(vocabulary(docs, least=least, id_col=id_col, text_col=text_col), "words")
    near = saved(near_words(words).withColumnRenamed("word", "near").drop("n"), "near-words")
    joined = words.join(near, F.col("word") == F.col("near"), "left")
    wins = F.col("form_n") >= 2 * F.col("n")
    formed = saved(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(wins, F.col("form")).alias("form"), F.when(wins, F.col("form_n")).alias("form_n")), "forms")
    last = roots(formed.where("form is not null").select("word", "form")).withColumnRenamed("word", "at")
    return formed.join(last, F.col("word") == F.col("at"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(docs: DataFrame) -> DataFrame:
    return variants(docs)
