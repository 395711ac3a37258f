"""Toxicity by weak supervision.

Word beginnings and whole words that stand out in toxic examples form lexicons, one voter each; fixed
patterns are voters too. A generative model takes every vote, and the label itself, as a noisy sign of the
unseen class: it estimates how often each voter speaks in either class and how voters move together, and
counts voters that do as less than one each. Its posteriors are the labels from which a linear classifier
over the single words and patterns learns; that classifier scores all texts.

The fit takes at most MOST_TOXIC and MOST_CLEAN labelled texts, of which only counts and hits leave the
tasks, and keeps at most MOST_TERMS terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import fold, modest_batches, quoted, without
from ordermill.llm.quality_gam import labelled

MOST_TOXIC, MOST_CLEAN, MOST_TERMS = 6_000, 12_000, 3_000
#: Toxic examples that must hold a term, standard deviations above its share of clean ones, log of how many times.
LEAST_SEEN, LEAST_Z, LEAST_ODDS = 3, 3.0, 1.5
SHORTEST, LONGEST = 3, 7
VOTERS = 200
#: Labels are at least so often right; it ties the unseen class to them.
LEAST_RIGHT = 0.95
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")
# Patterns of abuse that need no examples.
PATTERNS = (
    re.compile(r"\byou(?:'re| are|r)?\s+(?:an?\s+|such\s+an?\s+)?(?:idiot|moron|fool|loser|pathetic|stupid|worthless|disgusting|trash|scum)", re.IGNORECASE),
    re.compile(r"\b(?:idiot|moron|imbecile|loser|scum|pathetic|worthless|stupid|disgusting|vermin|filth|trash|clown|dumb|jerk|bastard)s?\b", re.IGNORECASE),
    re.compile(r"\b(?:shut\s+up|go\s+to\s+hell|drop\s+dead|get\s+lost|hate\s+you|kill\s+yourself)\b", re.IGNORECASE),
    re.compile(r"\b[a-z]+[*@#$]{2,}[a-z]*\b", re.IGNORECASE),
    re.compile(r"!{3,}"),
)
PATTERN_HINTS = (("you",), ("idiot", "moron", "imbecile", "loser", "scum", "pathetic", "worthless", "stupid", "disgusting", "vermin", "filth", "trash", "clown", "dumb", "jerk", "bastard"), ("shut", "hell", "dead", "lost", "hate", "kill"), ("*", "@", "#", "$"), ("!!!",))


def terms_of(word: str) -> list[str]:
    """A word's beginnings, and the whole word, marked by its end."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [word + "$"]


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def pattern_hits(text: str | None) -> list[int]:
    low = (text or "").lower()
    return [k for k, (p, hints) in enumerate(zip(PATTERNS, PATTERN_HINTS)) if any(h in low for h in hints) and p.search(text)]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold a term, by label, summed per batch before the shuffle."""
    for batch in batches:
        counts: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = counts[int(label > 0.5)]
            for term in {t for w in text_words(text) for t in terms_of(w)}:
                own[term] = own.get(term, 0) + 1
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(terms, pa.string()), "clean": pa.array([counts[0].get(t, 0) for t in terms], pa.int64()), "toxic": pa.array([counts[1].get(t, 0) for t in terms], pa.int64()),
        })


@dataclass
class Terms:
    """Terms by number, with the words already looked up in this worker."""

    numbers: dict[str, int]
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {"numbers": self.numbers, "seen": {}}

    def hits(self, text: str | None) -> list[int]:
        if len(self.seen) > 500_000:
            self.seen.clear()
        found: set[int] = set()
        for word in text_words(text):
            own = self.seen.get(word)
            if own is None:
                own = self.seen[word] = tuple(self.numbers[t] for t in terms_of(word) if t in self.numbers)
            if own:
                found.update(own)
        return sorted(found)


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the class per row, voters' rates (toxic, clean), voters' weights.

    Expectation maximisation over a class per row with independent voters, the given label being one more
    of them that may err. A silent voter abstains: lexicons of one language say nothing of another's
    texts. Then voters' correlations inside the classes are measured and each voter counts
    for one over its sum of correlations, and the model is fitted once more.
    """
    n, m = votes.shape
    weights = np.ones(m)
    post = np.clip(gold.astype(float), 0.05, 0.95)
    rates = np.zeros((2, m))
    for turn in range(2):
        for _ in range(rounds):
            prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
            rates = np.stack([(post @ votes + 0.5) / (post.sum() + 1), ((1 - post) @ votes + 0.5) / ((1 - post).sum() + 1)])
            right = np.clip([post @ gold / max(post.sum(), 1e-9), (1 - post) @ (1 - gold) / max((1 - post).sum(), 1e-9)], LEAST_RIGHT, 0.999)
            said = np.log(rates[0] / rates[1]) * weights
            logit = np.log(prior / (1 - prior)) + votes @ said
            logit += np.where(gold > 0.5, np.log(right[0] / (1 - right[1])), np.log((1 - right[0]) / right[1]))
            new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            moved, post = float(np.abs(new - post).max()), new
            if moved < 1e-4:
                break
        if turn == 0 and m:
            rest = votes - np.outer(post, rates[0]) - np.outer(1 - post, rates[1])
            scale = np.sqrt((rest**2).sum(axis=0)) + 1e-9
            together = np.abs((rest / scale).T @ (rest / scale))
            weights = 1 / np.where(together > 0.1, together, 0).sum(axis=1).clip(1)
    return post, rates, weights


def linear_fit(rows: list[list[int]], target: np.ndarray, size: int, rounds: int = 400, ridge: float = 2e-5) -> np.ndarray:
    """Logistic weights (the last is the intercept) for binary features on soft labels, by Adam on all rows."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.fromiter((x for r in rows for x in r), np.int64, len(owner))
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if not len(rows):
        return w
    rate = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(rate / (1 - rate))
    for k in range(1, rounds + 1):
        logits = np.bincount(owner, w[place], len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - target) / len(rows)
        g = np.append(np.bincount(place, error[owner], size), error.sum())
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w


@dataclass
class Model:
    terms: Terms
    weights: np.ndarray
    accuracies: dict[str, tuple[float, float, float]]

    def scores(self, texts: list[str | None]) -> list[float]:
        n, out = len(self.terms.numbers), []
        for text in texts:
            hits = self.terms.hits(text) + [n + k for k in pattern_hits(text)]
            out.append(float(1 / (1 + np.exp(-np.clip(self.weights[hits].sum() + self.weights[-1], -35, 35)))))
        return out


def _voters(terms: list[str]) -> dict[str, list[int]]:
    """Lexicons: terms, best first, that share their first letters; the families met first, up to VOTERS."""
    families: dict[str, list[int]] = {}
    for k, term in enumerate(terms):
        root = term[:SHORTEST]
        if root in families or len(families) < VOTERS:
            families.setdefault(root, []).append(k)
    return families


def train(docs: DataFrame, labels: DataFrame, use: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Model:
    """The classifier from labelled rows for which ``use`` (a condition on the id) holds.

    Without toxic or without clean examples no term stands out and only the patterns' weights, all zero, remain.
    """
    modest_batches(docs.sparkSession)
    toxic = labelled(labels, label_col, use & (quoted(label_col) == 1), most_toxic, id_col=id_col)
    clean = labelled(labels, label_col, use & (quoted(label_col) == 0), most_clean, id_col=id_col)
    # Bounded by most_toxic + most_clean pairs of numbers at any size of the tables.
    picked = F.broadcast(toxic.unionByName(clean))
    texts = docs.select(quoted(id_col).cast("long").alias("doc"), quoted(text_col).alias("text")).join(picked, F.col("doc") == F.col("id")).select("id", "label", "text")
    counts = texts.mapInArrow(_term_counts, "term string, clean bigint, toxic bigint").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
    bad, good = sizes.get(1.0, 0), sizes.get(0.0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("clean") + 0.5) / (good + 1.0))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counts.where(F.col("toxic") >= LEAST_SEEN).withColumn("z", z).where((F.col("z") >= LEAST_Z) & (odds >= LEAST_ODDS)).orderBy(F.desc("z"), "term").limit(MOST_TERMS)
    names = [r.term for r in best.collect()] if bad and good else []
    terms = Terms({t: k for k, t in enumerate(names)})

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            found = [terms.hits(t) + [len(names) + k for k in pattern_hits(t)] for t in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["id", "label", "hits"])

    rows = texts.mapInArrow(hit, "id bigint, label double, hits array<int>").dropDuplicates(["id"]).collect()
    rows.sort(key=lambda r: r.id)
    gold = np.array([r.label for r in rows])
    hits = [list(r.hits) for r in rows]
    families = _voters(names)
    voter_of = {k: v for v, members in enumerate(families.values()) for k in members}
    votes = np.zeros((len(rows), len(families) + len(PATTERNS)))
    for i, own in enumerate(hits):
        for k in own:
            if (v := len(families) + k - len(names) if k >= len(names) else voter_of.get(k)) is not None:
                votes[i, v] = 1
    if not len(rows) or gold.min() == gold.max():
        weights = np.zeros(len(names) + len(PATTERNS) + 1)
        rate = (gold.sum() + 0.5) / (len(gold) + 1)
        weights[-1] = np.log(rate / (1 - rate))
        return Model(terms, weights, {})
    post, rates, counted = label_model(votes, gold)
    weights = linear_fit(hits, post, len(names) + len(PATTERNS))
    spoken = [*families, *[p.pattern for p in PATTERNS]]
    return Model(terms, weights, {v: (float(a), float(b), float(c)) for v, a, b, c in zip(spoken, *rates, counted)})


def score(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; null texts are scored as empty.

    An input column named score is replaced; rows that repeat stay.
    """

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()), pa.float64())

    return docs.select(*map(quoted, without(docs, ["score"])), scored(quoted(text_col)).alias("score"))


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold("doc_id", 3) == 1
    return score(docs, train(docs, labels, ~held_out)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
