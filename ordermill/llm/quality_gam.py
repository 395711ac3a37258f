"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is binned; shallow trees are boosted on one feature after the other, round after
round, and what they add up to is a lookup table per feature. The pairs whose residuals show most
structure get tables of two features in the same way. A score is a sum of table entries.

The model is fitted on the driver from at most MOST_ROWS labelled texts, of which only the features
leave the tasks; everything else covers all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import fold, modest_batches, quoted, without

#: Bound of the labelled sample; the rows with the smallest hashes of their ids.
MOST_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
PAIRS = 12
ROUNDS, RATE, RIDGE = 200, 0.08, 1.0
THRESHOLD = 0.7

FEATURES = (
    "log_chars", "log_words", "word_chars", "longest_word", "symbols", "shouts", "upper", "digits", "stops", "bars", "other_bytes",
    "entropy", "distinct_words", "top_word", "same_as_before", "distinct_triples", "dup_lines", "line_words", "caps_words", "capital_words",
    "odd_ends", "compression",
)

_BYTES = np.arange(256)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([_class(b"#*$%&<>@^~=+_\\/{}[]"), _class(b"!?"), _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b".,;:"), _class(b"|"), (_BYTES >= 128).astype(float)], axis=1)


def features(text: str | None, press: zstandard.ZstdCompressor) -> list[float]:
    """The numbers of one text, in the order of FEATURES; an empty or null text gives zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    ws = raw.split()
    n, size = len(ws), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts / size
    used = shares[shares > 0]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        math.log1p(size), math.log1p(n), sum(map(len, ws)) / n, math.log1p(max(map(len, ws))),
        *(shares @ _CLASSES).tolist(),
        float(-(used * np.log2(used)).sum()),
        len(set(ws)) / n, max(Counter(ws).values()) / n, sum(map(eq, ws, ws[1:])) / n,
        len(set(zip(ws, ws[1:], ws[2:]))) / max(1, n - 2) if n > 2 else 1.0,
        1 - len(set(lines)) / len(lines), n / len(lines),
        sum(map(bytes.isupper, ws)) / n, sum(map(bytes.istitle, ws)) / n,
        sum(1 for w in ws if w[-1] in b"#*$%&!|") / n,
        size / len(press.compress(raw)),
    ]


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)], axis=1)


def _best_cut(g: np.ndarray, h: np.ndarray) -> int:
    """Where to cut a row of bins in two; 0 if nothing gains."""
    if len(g) < 2:
        return 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + RIDGE) + (g.sum() - a) ** 2 / (h.sum() - b + RIDGE)
    k = int(np.argmax(gain))
    return k + 1 if gain[k] > g.sum() ** 2 / (h.sum() + RIDGE) + 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A tree on ordered bins as the value of each bin."""
    cut = _best_cut(g, h) if depth else 0
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut on one axis and in both halves one on the other; (values, gain)."""
    best, most = None, -1.0
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        cut = _best_cut(a.sum(axis=1), b.sum(axis=1)) or a.shape[0] // 2
        value = np.empty_like(a)
        gain = 0.0
        for part in (slice(0, cut), slice(cut, None)):
            x, y = a[part].sum(axis=0), b[part].sum(axis=0)
            leaf = _tree(x, y, 1)
            value[part] = leaf
            gain += float((leaf * x).sum())
        if gain > most:
            best, most = (value.T if turned else value), gain
    return best, most


@dataclass
class Gam:
    """Lookup tables: a bin per feature, a cell per pair, an intercept."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        if self.pairs:
            bins = _binned(x, self.pair_edges)
            for (a, b), table in zip(self.pairs, self.pair_tables):
                out += table[bins[:, a], bins[:, b]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -35, 35)))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting; without rows, or with one class, the tables stay empty.

    A fifth of the rows is set aside to choose how many rounds the tables keep.
    """
    count = x.shape[1] if x.ndim == 2 else len(FEATURES)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    intercept = math.log(rate / (1 - rate))
    if len(y) < 20 or y.min() == y.max():
        return Gam(intercept, [np.zeros(0)] * count, [np.zeros(1)] * count, [], [], [])
    edges = [_edges(x[:, k], BINS) for k in range(count)]
    pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(count)]
    bins, pair_bins = _binned(x, edges), _binned(x, pair_edges)
    tables = [np.zeros(len(e) + 1) for e in edges]
    train = np.random.default_rng(0).permutation(len(y)) % 5 > 0
    train = train if min(y[~train].sum(), (1 - y[~train]).sum()) >= 5 else np.ones(len(y), bool)
    check = ~train if not train.all() else train

    def boosted(own: list[np.ndarray], columns: list[np.ndarray], grow, logits: np.ndarray) -> np.ndarray:
        """Round after round over all tables; keeps the round that was best on the rows set aside."""
        best, kept, kept_logits, since = math.inf, [t.copy() for t in own], logits.copy(), 0
        for _ in range(ROUNDS):
            for table, column in zip(own, columns):
                p = 1 / (1 + np.exp(-logits))
                g = np.bincount(column[train], (y - p)[train], table.size)
                h = np.bincount(column[train], (p * (1 - p))[train], table.size)
                step = RATE * grow(g, h, table.shape)
                table += step
                logits += step.reshape(-1)[column]
            loss = float(np.mean(np.logaddexp(0, logits[check]) - y[check] * logits[check]))
            if loss < best - 1e-5:
                best, kept, kept_logits, since = loss, [t.copy() for t in own], logits.copy(), 0
            elif (since := since + 1) >= 10:
                break
        for table, good in zip(own, kept):
            table[...] = good
        return kept_logits

    logits = boosted(tables, list(bins.T), lambda g, h, _: _tree(g, h), np.full(len(y), intercept))
    p = 1 / (1 + np.exp(-logits))
    gains = []
    for a in range(count):
        for b in range(a + 1, count):
            shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
            cell = pair_bins[:, a] * shape[1] + pair_bins[:, b]
            g = np.bincount(cell[train], (y - p)[train], shape[0] * shape[1]).reshape(shape)
            h = np.bincount(cell[train], (p * (1 - p))[train], shape[0] * shape[1]).reshape(shape)
            gains.append((_pair_tree(g, h)[1], a, b))
    pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    cells = [pair_bins[:, a] * t.shape[1] + pair_bins[:, b] for (a, b), t in zip(pairs, pair_tables)]
    boosted(pair_tables, cells, lambda g, h, shape: _pair_tree(g.reshape(shape), h.reshape(shape))[0], logits)
    return Gam(intercept, edges, tables, pair_edges, pairs, pair_tables)


def _measured(texts: list[str | None]) -> np.ndarray:
    press = zstandard.ZstdCompressor(level=1)
    return np.array([features(t, press) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _measured(batch.column(2).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(rows), pa.list_(pa.float64()))], names=["id", "label", "x"])


def labelled(labels: DataFrame, column: str, use: Column, most: int, *, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` (id, label) of the usable rows, those with the smallest hashes of their ids.

    Null ids and labels are left out; an id with both labels is no example of either.
    """
    rows = labels.where(use & quoted(id_col).isNotNull() & quoted(column).isNotNull())
    votes = rows.groupBy(quoted(id_col).cast("long").alias("id")).agg(F.min(quoted(column)).alias("label"), F.max(quoted(column)).alias("high"))
    return votes.where("label = high").orderBy(F.xxhash64("id"), "id").limit(most).select("id", F.col("label").cast("double").alias("label"))


def train(docs: DataFrame, labels: DataFrame, use: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_ROWS) -> Gam:
    """The model from labelled rows for which ``use`` (a condition on the id) holds."""
    modest_batches(docs.sparkSession)
    # At most MOST_ROWS pairs of numbers: small enough to broadcast at any size of the tables.
    picked = F.broadcast(labelled(labels, label_col, use, most, id_col=id_col))
    texts = docs.select(quoted(id_col).cast("long").alias("doc"), quoted(text_col).alias("text")).join(picked, F.col("doc") == F.col("id"))
    rows = texts.select("id", "label", "text").mapInArrow(_feature_rows, "id bigint, label double, x array<double>").dropDuplicates(["id"]).collect()
    rows.sort(key=lambda r: r.id)
    return fit(np.array([r.x for r in rows], np.float64).reshape(len(rows), len(FEATURES)), np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Gam, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; null texts are scored as empty.

    An input column named score is replaced; rows that repeat stay.
    """
    from pyspark.sql import types as T

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(_measured(texts.to_pylist())), pa.float64())

    return docs.select(*map(quoted, without(docs, ["score"])), scored(quoted(text_col)).alias("score"))


def good_documents(docs: DataFrame, model: Gam, *, text_col: str = "text", least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, columns as they were."""
    scored = score(docs.withColumns({f"_own{k}": quoted(x) for k, x in enumerate(docs.columns)}), model, text_col=text_col)
    return scored.where(F.col("score") >= least).select(*[F.col(f"_own{k}").alias(x) for k, x in enumerate(docs.columns)])


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold("doc_id", 4) == 2
    return score(docs, train(docs, labels, ~held_out)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
