"""Hierarchical Pitman-Yor language model.

A context's restaurant serves the words that follow it. Contexts are the previous word, hashed to CONTEXTS
restaurants; all of them share one parent, the restaurant of words without context, whose base is uniform
over the V known words and one unknown. A customer who opens a table in a context is a customer of the
parent. Gibbs sweeps seat the customers of each (context, word) anew, given the parent's probabilities and
the tables of the whole restaurant; scores use the discounts and back-off masses averaged over the sweeps
after the first.

The work is dealt by word: a bucket holds a range of word hashes with all their contexts, so that a word's
seats in every context and in the parent lie in one row of a table, and sweeps over rows need no shuffle. Only
the restaurants' totals, CONTEXTS numbers, are shared between sweeps. Tokens meet the model in the same
buckets: a chunk of documents sends each bucket its tokens and receives sums per document. Neighbouring buckets
form a band, at most BANDS however many buckets there are; a task goes through a band bucket by bucket and answers a
chunk once, so answers grow with the documents alone. Bands with many tokens are copied, and chunks spread over the copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import fold, forget, lower_words, modest_batches, quoted, saved, word_hashes
from ordermill.session import bounded_batches

#: Restaurants that contexts are hashed to; 16 bits beside 48 bits of the word in a key.
CONTEXTS = 1 << 16
SWEEPS, BURN_IN = 4, 1
#: Strengths of the contexts and of the parent; discounts are estimated from the counts of counts.
STRENGTH, PARENT_STRENGTH = 1.0, 1.0
#: Text bytes of a bucket on average, tokens of a chunk, fewest buckets, chunk blocks merged at once.
BUCKET_BYTES, CHUNK_TOKENS, LEAST_BUCKETS, FAN_IN = 24_000_000, 3_000_000, 16, 64
#: Entries merged at once beside those that are merged already, documents of a chunk.
MERGED_AT_ONCE, CHUNK_DOCS = 2_000_000, 50_000
#: Bands of buckets; training tokens and documents from which a band is copied for scoring.
BANDS, HOT_TOKENS, HOT_DOCS = 16, 64_000_000, 2_000_000
END, START = np.uint64(0x5AFE_E4D0_F7E8_7001), np.uint64(0x0B57_A127_0F7E_8702)
LOW = np.uint64(CONTEXTS - 1)
SHIFT = np.uint64(16)


def token_keys(text: str | None) -> np.ndarray:
    """A key per token, the end included: 48 bits of the word, 16 of the word before."""
    h = word_hashes(lower_words(text))
    word, before = np.append(h, END), np.insert(h, 0, START)
    return (word >> SHIFT) << SHIFT | (before & LOW)


def _pack(x: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _edges(buckets: int) -> np.ndarray:
    """First key of every bucket but the first."""
    return np.array([(k << 48) // buckets << 16 for k in range(1, buckets)], np.uint64)


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], (np.add.reduceat(counts, starts) if len(starts) else counts)


def _count_blocks(buckets: int):
    edges = _edges(buckets)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = chunk = 0
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = [0, *np.searchsorted(keys, edges), len(keys)]
            rows = [(b, a, z) for b, (a, z) in enumerate(zip(cuts, cuts[1:])) if a < z]
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array([b for b, _, _ in rows], pa.int64()), "chunk": pa.array([(part << 24) + chunk] * len(rows), pa.int64()),
                "keys": pa.array([_pack_sorted(keys[a:z]) for _, a, z in rows], pa.binary()),
                "counts": pa.array([_pack(counts[a:z].astype(np.int64)) for _, a, z in rows], pa.binary()),
            })

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(token_keys(text))
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    yield flush()
                    held, size, chunk = [], 0, chunk + 1
        if held:
            yield flush()

    return blocks


BLOCKS = "bucket bigint, chunk bigint, keys binary, counts binary"


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The blocks added up, a few at a time, so that memory goes with the distinct keys and not with the blocks."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    size = 0
    for more, times in zip(rows["keys"], rows["counts"]):
        keys.append(_unpack_sorted(more))
        counts.append(_unpack(times, np.int64))
        size += len(keys[-1])
        if size >= max(MERGED_AT_ONCE, len(keys[0])):
            merged = _counted(np.concatenate(keys), np.concatenate(counts))
            keys, counts, size = [merged[0]], [merged[1]], 0
    return (keys[0], counts[0]) if len(keys) == 1 else _counted(np.concatenate(keys), np.concatenate(counts))


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys, counts = _merged(rows)
    return pd.DataFrame({"bucket": [key[0]], "chunk": [key[1]], "keys": [_pack_sorted(keys)], "counts": [_pack(counts)]})


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row: a batch of states or blocks is not copied as a whole."""
    return (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows))


STATE = (
    "bucket bigint, keys binary, counts binary, tables binary, tables_sum binary, parent binary, parent_sum binary, n_tokens bigint,"
    " n_words bigint, ones bigint, twos bigint, customers bigint, parent_tables bigint, parent_ones bigint, parent_twos bigint, by_context binary"
)


def _words(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word's run, number of each key's word)."""
    word = keys >> SHIFT
    new = np.append(True, word[1:] != word[:-1]) if len(word) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


def _state_row(bucket, keys, counts, tables, tables_sum, parent, parent_sum, starts, weights) -> dict:
    customers = np.add.reduceat(tables, starts) if len(starts) else tables
    return {
        "bucket": bucket, "keys": keys if isinstance(keys, bytes) else _pack_sorted(keys), "counts": _pack(counts), "tables": _pack(tables), "tables_sum": _pack(tables_sum),
        "parent": _pack(parent), "parent_sum": _pack(parent_sum), "n_tokens": int(counts.sum()), "n_words": len(starts),
        "ones": int((counts == 1).sum()), "twos": int((counts == 2).sum()), "customers": int(customers.sum()), "parent_tables": int(parent.sum()),
        "parent_ones": int((customers == 1).sum()), "parent_twos": int((customers == 2).sum()), "by_context": _pack(weights),
    }


def _first_state(rows: pd.DataFrame) -> pd.DataFrame:
    """A table for every (context, word), and one in the parent for every word; ``by_context`` has the customers."""
    keys, counts = _merged(rows)
    starts, _ = _words(keys)
    ones, parent = np.ones(len(keys), np.int64), np.ones(len(starts), np.int64)
    customers = np.bincount((keys & LOW).astype(np.int64), counts, CONTEXTS).astype(np.int64)
    row = _state_row(int(rows["bucket"].iloc[0]), keys, counts, ones, np.zeros(len(keys), np.int64), parent, np.zeros(len(starts), np.int64), starts, customers)
    return pd.DataFrame([row])


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating each dish's customers one by one in a restaurant with ``mass`` for a new table of it.

    The first 64 customers are seated singly; after them the new tables of a stretch of a quarter more
    customers are drawn at once, at the rate of its beginning, so that frequent words cost little more.
    """
    tables = np.ones(len(customers), np.int64)
    which = np.flatnonzero(customers > 1)
    which = which[np.argsort(-customers[which], kind="stable")]
    left, own, now = customers[which], mass[which], np.ones(len(which))
    for seated in range(1, 64):
        n = int(np.searchsorted(-left, -seated, side="left"))  # those with more customers than are seated
        if not n:
            break
        now[:n] += rng.random(n) * (own[:n] + seated - discount * now[:n]) < own[:n]
    seated = 64
    while (n := int(np.searchsorted(-left, -seated, side="left"))) > 0:
        to = np.minimum(left[:n], seated + seated // 4)
        floor = own[:n] - discount * now[:n]
        now[:n] += np.minimum(rng.poisson(own[:n] * np.log((floor + to) / (floor + seated))), to - seated)
        seated += seated // 4
    tables[which] = now.astype(np.int64)
    return tables


def _sweep(sweep: int, totals: dict, by_context: np.ndarray):
    """New seats in every row, given all restaurants' tables at the end of the sweep before."""

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for old in _rows(batch):
                rng = np.random.default_rng((sweep, old["bucket"]))
                keys, counts, tables = _unpack_sorted(old["keys"]), _unpack(old["counts"], np.int64), _unpack(old["tables"], np.int64)
                parent = _unpack(old["parent"], np.int64)
                starts, number = _words(keys)
                context = (keys & LOW).astype(np.int64)
                base = _parent(np.add.reduceat(tables, starts), parent, totals)
                mass = (STRENGTH + totals["discount"] * by_context[context]) * base[number]
                tables = seat(counts, mass, totals["discount"], rng)
                customers = np.add.reduceat(tables, starts)
                parent_mass = np.full(len(starts), (PARENT_STRENGTH + totals["parent_discount"] * totals["parent_tables"]) / (totals["n_words"] + 1))
                parent = seat(customers, parent_mass, totals["parent_discount"], rng)
                keep = sweep > BURN_IN
                sums = _unpack(old["tables_sum"], np.int64) + tables * keep, _unpack(old["parent_sum"], np.int64) + parent * keep
                row = _state_row(old["bucket"], old["keys"], counts, tables, sums[0], parent, sums[1], starts, np.bincount(context, tables, CONTEXTS).astype(np.int64))
                yield pa.RecordBatch.from_pylist([row], batch.schema)

    return swept


def _parent(customers: np.ndarray, tables: np.ndarray, totals: dict) -> np.ndarray:
    """Predictive probabilities of the parent for words with these customers and tables."""
    d, below = totals["parent_discount"], PARENT_STRENGTH + totals["customers"]
    return (customers - d * tables) / below + (PARENT_STRENGTH + d * totals["parent_tables"]) / below / (totals["n_words"] + 1)


def _context_sums(state: DataFrame) -> np.ndarray:
    """The vectors of all rows added up in tasks; at most 32 vectors come to the driver."""

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"total": [_pack(sum(_unpack(x, np.int64) for x in rows["by_context"]))]})

    rows = state.select(F.pmod("bucket", F.lit(32)).alias("k"), "by_context").groupBy("k").applyInPandas(added, "total binary").collect()
    return reduce(np.add, (_unpack(r.total, np.int64) for r in rows), np.zeros(CONTEXTS, np.int64))


NUMBERS = ("n_tokens", "n_words", "ones", "twos", "customers", "parent_tables", "parent_ones", "parent_twos")


def _totals(state: DataFrame) -> dict:
    row = state.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in NUMBERS]).first().asDict()
    for name, ones, twos in (("discount", "ones", "twos"), ("parent_discount", "parent_ones", "parent_twos")):
        row[name] = min(0.95, max(0.05, row[ones] / max(1, row[ones] + 2 * row[twos])))
    return row


class Model:
    """The table of buckets, the totals and the restaurants' customers and average tables."""

    def __init__(self, state: DataFrame, buckets: int, totals: dict, customers: np.ndarray, tables: np.ndarray, samples: int):
        self.state, self.buckets, self.totals, self.customers, self.tables, self.samples = state, buckets, totals, customers, tables, samples


def train(texts: DataFrame, buckets: int, *, sweeps: int = SWEEPS) -> Model:
    """The model of the column ``text``; no text at all gives a model that knows no word."""
    modest_batches(texts.sparkSession)
    with bounded_batches(texts.sparkSession):
        return _trained(texts, buckets, sweeps)


def _trained(texts: DataFrame, buckets: int, sweeps: int) -> Model:
    blocks = texts.select("text").mapInArrow(_count_blocks(buckets), BLOCKS)
    blocks = saved(blocks, "ngram-blocks")
    while (most := blocks.agg(F.count_distinct("chunk").alias("n")).first().n) > FAN_IN:
        # Chunks are numbered with gaps: dealt by hash, every round leaves one in FAN_IN.
        group = F.pmod(F.xxhash64("chunk"), F.lit(-(-most // FAN_IN)))
        merged = saved(blocks.groupBy("bucket", group.alias("group")).applyInPandas(_merge, BLOCKS), "ngram-blocks")
        forget(blocks)
        blocks = merged
    state = saved(blocks.groupBy("bucket").applyInPandas(_first_state, STATE), "seats-0")
    forget(blocks)
    totals = _totals(state)
    customers = _context_sums(state)
    by_context, mean, averaged = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS), dict.fromkeys(NUMBERS, 0.0)
    for k in range(1, sweeps + 1):
        if k == 1:
            by_context = np.minimum(customers, totals["ones"] / max(1, totals["n_tokens"]) * customers)
        before, state = state, saved(state.mapInArrow(_sweep(k, totals, by_context), STATE), f"seats-{k}")
        forget(before)
        totals = _totals(state)
        by_context = _context_sums(state)
        if k > BURN_IN:
            mean += by_context / (sweeps - BURN_IN)
            averaged = {x: averaged[x] + totals[x] / (sweeps - BURN_IN) for x in NUMBERS}
    return Model(state, buckets, totals | averaged | {"n_tokens": totals["n_tokens"], "n_words": totals["n_words"]}, customers, mean, sweeps - BURN_IN)


#: Blocks of tokens (``data`` has each token's document) and, as chunk -1, the buckets of the model (its counts).
PARTS = "band bigint, copy bigint, bucket bigint, chunk bigint, keys binary, data binary, tables_sum binary, parent_sum binary, n_docs bigint"


def _token_blocks(buckets: int, copies: list[int]):
    edges = _edges(buckets)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        ids: list = []
        out: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in held])
            keys, docs = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint32), lengths)
            order = np.argsort(keys, kind="stable")
            keys, docs = keys[order], docs[order]
            cuts = [0, *np.searchsorted(keys, edges), len(keys)]
            rows = [(b, a, z) for b, (a, z) in enumerate(zip(cuts, cuts[1:])) if a < z]
            bands = [_band(b, buckets) for b, _, _ in rows]
            name = (part << 24) + chunk
            about = pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "held_out": pa.array(out, pa.bool_()), "n_tokens": lengths})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, about.schema) as writer:
                writer.write_batch(about)
            none = pa.nulls(len(rows) + 1, pa.binary())
            return pa.RecordBatch.from_pydict({
                "band": pa.array([-1, *bands], pa.int64()),
                # Parts may have a chunk or two: counted on from part to part, they meet all copies.
                "copy": pa.array([name, *[(part + chunk) % copies[k] for k in bands]], pa.int64()),
                "bucket": pa.array([-1, *[b for b, _, _ in rows]], pa.int64()),
                "chunk": pa.array([name] * (len(rows) + 1), pa.int64()),
                "keys": pa.array([sink.getvalue().to_pybytes(), *[_pack_sorted(keys[a:z]) for _, a, z in rows]], pa.binary()),
                "data": pa.array([b"", *[_pack(docs[a:z]) for _, a, z in rows]], pa.binary()),
                "tables_sum": none, "parent_sum": none,
                "n_docs": pa.array([len(held)] * (len(rows) + 1), pa.int64()),
            })

        for batch in batches:
            for number, outside, text in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                held.append(token_keys(text))
                ids.append(number)
                out.append(outside)
                size += len(held[-1])
                if size >= CHUNK_TOKENS or len(held) >= CHUNK_DOCS:
                    yield flush()
                    held, ids, out, size, chunk = [], [], [], 0, chunk + 1
        if held:
            yield flush()

    return blocks


def _band(bucket, buckets: int):
    """The band of a bucket; of at most BANDS buckets each is one."""
    return bucket * min(BANDS, buckets) // buckets


SUMS = "chunk bigint, band bigint, about binary, score binary, base binary, known binary"


def _band_sums(totals: dict, customers: np.ndarray, tables: np.ndarray, samples: int):
    """Per chunk, each document's sums over a band's tokens. Rows arrive sorted by band, copy, bucket and chunk."""
    d = totals["discount"]
    stay = 1 / (STRENGTH + customers)
    back = (STRENGTH + d * tables) * stay
    below = totals["n_tokens"] + 0.1 * (totals["n_words"] + 1)

    def scorer(own: dict | None):
        if own:
            keys, counts = _unpack_sorted(own["keys"]), _unpack(own["data"], np.int64)
            seats, parent = _unpack(own["tables_sum"], np.int64) / samples, _unpack(own["parent_sum"], np.int64) / samples
        else:
            keys, counts, seats, parent = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        starts, _ = _words(keys)
        words = keys[starts] >> SHIFT
        of_word = np.add.reduceat(counts, starts) if len(starts) else counts
        # One more entry each for what was never seen.
        general = np.append(_parent(np.add.reduceat(seats, starts) if len(starts) else seats, parent, totals), _parent(np.zeros(1), np.zeros(1), totals))
        base = np.log10((np.append(of_word, 0) + 0.1) / below)
        special = np.append(counts - d * seats, 0.0)
        keys_, words_ = np.append(keys, np.uint64(0)), np.append(words, np.uint64(0))

        def sums(block: dict) -> list[np.ndarray]:
            mine, docs = _unpack_sorted(block["keys"]), _unpack(block["data"], np.uint32).astype(np.int64)
            first = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            kinds = mine[first]
            times = np.diff(np.append(first, len(mine)))
            at = np.searchsorted(keys, kinds)
            at[(at == len(keys)) | (keys_[at] != kinds)] = len(keys)
            word = kinds >> SHIFT
            of = np.searchsorted(words, word)
            of[(of == len(words)) | (words_[of] != word)] = len(words)
            context = (kinds & LOW).astype(np.int64)
            score = np.log10(special[at] * stay[context] + back[context] * general[of])
            return [np.bincount(docs, np.repeat(x, times), block["n_docs"]) for x in (score, base[of], (of < len(words)).astype(float))]

        return sums

    def answer(chunk: int, band: int, about: bytes, sums: list[bytes]) -> pa.RecordBatch:
        values = [[chunk], [band], [about], *[[x] for x in sums]]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], [x.split()[0] for x in SUMS.split(", ")])

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, bucket, sums = None, None, None
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in _rows(batch):
                if row["band"] == -1:
                    yield answer(row["chunk"], -1, row["keys"], [b""] * 3)
                    continue
                if (row["band"], row["copy"]) != place:
                    yield from (answer(chunk, place[0], b"", [x.tobytes() for x in own]) for chunk, own in held.items())
                    place, bucket, held = (row["band"], row["copy"]), None, {}
                if row["bucket"] != bucket:
                    bucket, sums = row["bucket"], scorer(row if row["chunk"] == -1 else None)
                if row["chunk"] == -1:
                    continue
                more = sums(row)
                if row["chunk"] in held:
                    for mine, x in zip(held[row["chunk"]], more):
                        mine += x
                else:
                    held[row["chunk"]] = more
        yield from (answer(chunk, place[0], b"", [x.tobytes() for x in own]) for chunk, own in held.items())

    return answers


def _documents(rows: pd.DataFrame) -> pd.DataFrame:
    """A chunk's documents with the sums of all bands, added in the order of the bands."""
    rows = rows.sort_values("band")
    out = pa.ipc.open_stream(rows["about"].iloc[0]).read_pandas()
    for name in ("score", "base", "known"):
        out[name] = sum((np.frombuffer(x, np.float64) for x in rows[name].iloc[1:]), np.zeros(len(out)))
    return out


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Per row of ``docs``: id, held_out, n_tokens, n_known, base_score, score (log10 probabilities).

    Null texts count as empty: the end alone. Rows that repeat are scored each. An empty table gives no rows.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), (fold(id_col, folds) == 0).alias("out"), quoted(text_col).alias("text"))
    band = F.expr(f"bucket * {min(BANDS, model.buckets)} div {model.buckets}")
    tokens = {r.band: r.n for r in model.state.groupBy(band.alias("band")).agg(F.sum("n_tokens").alias("n")).collect()}  # at most BANDS rows
    least = max(1, -(-docs.count() // HOT_DOCS))
    copies = [max(least, -(-tokens.get(k, 0) // HOT_TOKENS)) for k in range(min(BANDS, model.buckets))]
    blocks = rows.mapInArrow(_token_blocks(model.buckets, copies), PARTS)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.element_at(F.array(*map(F.lit, copies)), (band + 1).cast("int")).cast("long") - 1))
    state = model.state.select(
        band.alias("band"), copy.alias("copy"), "bucket", F.lit(-1).cast("long").alias("chunk"), "keys", F.col("counts").alias("data"), "tables_sum", "parent_sum", F.lit(0).cast("long").alias("n_docs")
    )
    dealt = blocks.unionByName(state).repartition("band", "copy").sortWithinPartitions("band", "copy", "bucket", "chunk")
    sums = dealt.mapInArrow(_band_sums(model.totals, model.customers, model.tables, model.samples), SUMS)
    with bounded_batches(docs.sparkSession):
        sums = saved(sums, "document-sums")
    return (
        sums.groupBy("chunk").applyInPandas(_documents, "id bigint, held_out boolean, n_tokens bigint, score double, base double, known double")
        .select("id", "held_out", "n_tokens", F.round("known").cast("long").alias("n_known"), F.col("base").alias("base_score"), "score")
    )


def language_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, sweeps: int = SWEEPS) -> Model:
    """The model of the rows whose id's crc32 modulo ``folds`` is not 0."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(quoted(text_col))), F.lit(0)).alias("n")).first().n
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    return train(docs.where(fold(id_col, folds) != 0).select(quoted(text_col).alias("text")), buckets, sweeps=sweeps)


def op6(docs: DataFrame) -> DataFrame:
    model = language_model(docs)
    return score(docs, model).select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(model.totals["n_tokens"]).cast("long").alias("train_tokens"), "base_score", "score"
    )
