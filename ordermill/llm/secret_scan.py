"""Secret scans: fixed patterns, and guess costs of the values that stand in a credential's place.

The patterns find assignments, access keys and hex keys. Beside them every value in a credential
context (``pwd=``, ``Bearer``, ``user:value@host``, "the passphrase is") is cut into words, dates,
repeats, walks and brute-force characters so that the product of their guess counts is least; what
still costs ``THRESHOLD`` powers of ten is a secret. Words are a few fixed ones, those of the text
itself and the most frequent of all texts, by their ranks, so that ordinary prose after a colon is cheap. Values
that are known words throughout, joined by hyphens and the like, need ``WORDS_THRESHOLD``.
"""

from __future__ import annotations

import math
import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import modest_batches, quoted, without

KINDS = ("assign", "access", "hex", "guess")
#: Powers of ten of guesses from which a value counts as a secret.
THRESHOLD = 10.0
#: The same for known words in a row: about four words drawn from a list of some thousand.
WORDS_THRESHOLD = 14.0
#: Words of the corpus that have a rank, and documents that a ranked word stands in at least.
RANKED, MIN_DOCS = 50_000, 3
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))

# Fixed patterns of the contract; the flags keep "either case" to ASCII letters.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|(?:api|access|private|signing)[_\ -]?key)
          ["']?(?:\x20*(?:[:=]|=>)\x20*|\x20is:?\x20)["']?
        | bearer\x20+
        )(?P<value>[^\s"'<>;,]+)
        | [a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:(?P<login>[^\s/@]+)(?=@)""",
    re.IGNORECASE | re.ASCII | re.VERBOSE,
)
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
CONTEXT_HINTS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"auth", b"key", b"bearer", b"://")

# Words that head every list of guessed passwords.
COMMON = (
    "password pass admin root user login welcome letmein master monkey dragon qwerty secret token test guest default"
    " changeme example sample hello love god money summer winter spring autumn access shadow sunshine princess"
    " football baseball iloveyou superman batman trustno public private company computer internet server service"
    " system database demo temp value none null true false your here enter insert redacted hidden required optional"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("0134578@$!", "oieastbasi")
PLACE = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")
LONGEST_WORD = 24
#: Guesses per character: letters at the rate of prose, digits, anything else.
LETTER, DIGIT, OTHER = math.log10(6), 1.0, math.log10(33)
#: A mark between two letters, as it joins words.
JOINER, JOINERS = 0.3, frozenset("-_./")
KNOWN = re.compile(r"[^\W\d_]{3,24}")
WORD_ROW = re.compile(r"[^\W\d_]+(?:[-_./][^\W\d_]+)*")


def _char(c: str) -> float:
    return DIGIT if c.isdigit() else LETTER if c.isalpha() else OTHER


def _near(a: str, b: str) -> bool:
    p, q = PLACE.get(a), PLACE.get(b)
    return p is not None and q is not None and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _runs(value: str, goes_on) -> list[int]:
    """For each place the length of the run that starts there, where ``goes_on(i)`` ties i to i + 1."""
    out = [1] * len(value)
    for i in range(len(value) - 2, -1, -1):
        if goes_on(i):
            out[i] = out[i + 1] + 1
    return out


def guess_cost(value: str, ranks: Mapping[str, int] | None = None) -> float:
    """Least log10 of guesses over all segmentations; the time is linear in the value's length.

    Runs (repeats of up to eight characters, keyboard walks, sequences) are taken whole; a change of
    case inside letters makes them brute force at the full alphabet, as in random keys.
    """
    ranks = COMMON_RANKS if ranks is None else ranks
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    same = {p: [0] * (n + 1) for p in range(1, 9)}
    for p, tail in same.items():
        for i in range(n - p - 1, -1, -1):
            tail[i] = tail[i + 1] + 1 if value[i] == value[i + p] else 0
    walk = _runs(low, lambda i: _near(low[i], low[i + 1]))
    up = _runs(value, lambda i: ord(value[i + 1]) - ord(value[i]) == 1)
    down = _runs(value, lambda i: ord(value[i]) - ord(value[i + 1]) == 1)
    mixed = value != low and value != value.upper() and value[1:] != low[1:] or any(map(str.isdigit, value)) and any(map(str.isalpha, value))
    costs = [max(_char(c), math.log10(26)) if mixed and c.isalpha() else _char(c) for c in value]
    best = [0.0] + [math.inf] * n
    for i in range(n):
        here = best[i]
        joins = 0 < i < n - 1 and value[i] in JOINERS and value[i - 1].isalpha() and value[i + 1].isalpha()
        best[i + 1] = min(best[i + 1], here + (JOINER if joins else costs[i]))
        for size in range(3, min(LONGEST_WORD, n - i) + 1):
            for word in (low[i : i + size], plain[i : i + size]):
                rank = ranks.get(word)
                if rank is not None:
                    variants = math.log10(2) * (value[i : i + size] != word)
                    best[i + size] = min(best[i + size], here + math.log10(rank + 1) + variants + 0.3)
        for p, tail in same.items():
            if tail[i] >= max(2, p):
                end = i + p + tail[i]
                best[end] = min(best[end], here + sum(costs[i : i + p]) + math.log10(2 + tail[i] / p))
        for run in (walk[i], up[i], down[i]):
            if run >= 4:
                best[i + run] = min(best[i + run], here + math.log10(len(PLACE)) + math.log10(run) + 0.6)
        if (m := DATE.match(value, i)) is not None:
            best[m.end()] = min(best[m.end()], here + (math.log10(120) if m.end() - i == 4 else math.log10(365 * 120)))
    return best[n]


COMMON_RANKS = {word: k + 1 for k, word in enumerate(COMMON)}


def _ranks(text: str, values: list[str], corpus: Mapping[str, int]) -> Mapping[str, int]:
    """Fixed words, then the text's own by frequency, the values themselves left out, then the corpus's."""
    counted = Counter(KNOWN.findall(text.lower()))
    for value in values:
        counted.subtract(KNOWN.findall(value.lower()))
    own = {w: len(COMMON_RANKS) + k + 1 for k, (w, c) in enumerate(counted.most_common()) if c > 0}
    return ChainMap(COMMON_RANKS, own, corpus)


def _limit(value: str, ranks: Mapping[str, int]) -> float:
    known = WORD_ROW.fullmatch(value) and all(len(w) < 3 or w in ranks for w in re.split(r"[-_./]", value.lower()))
    return WORDS_THRESHOLD if known else THRESHOLD


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, documents) of a partition's texts without their values in credential contexts; parts of bounded size."""
    counted: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counted.update(set(KNOWN.findall(CONTEXT.sub(" ", text).lower())))
            if len(counted) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], names=["word", "documents"])
                counted.clear()
    yield pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], names=["word", "documents"])


def word_ranks(docs: DataFrame, *, text_col: str = "text") -> dict[str, int]:
    """Ranks of the RANKED words of at most 24 letters that stand in most documents, of all texts, MIN_DOCS at least.

    Values in credential contexts don't count, so a password that repeats does not become a word.
    """
    modest_batches(docs.sparkSession)
    words = docs.select(quoted(text_col).alias("text")).mapInArrow(_document_words, "word string, documents bigint")
    counts = words.groupBy("word").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= MIN_DOCS)
    top = counts.orderBy(F.desc("documents"), "word").limit(RANKED).collect()  # at most RANKED words of 24 letters
    return {r["word"]: len(COMMON_RANKS) + k + 1 for k, r in enumerate(top)}


def _covered(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether the spans, sorted by start, together cover all from ``start`` to ``end``."""
    for a, b in spans:
        if a > start:
            break
        start = max(start, b)
    return start >= end


def find(text: str | None, corpus: Mapping[str, int] | None = None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, cost) in code points, by start, then kind; base kinds have no cost.

    A guess span is the value alone; values that base spans cover whole are left to them, others are
    scored from end to end. ``corpus`` has the ranks of the words of all texts.
    """
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    found: list[tuple[str, int, int, float]] = []
    if any(h in low for h in ASSIGN_HINTS):
        found += [("assign", *m.span(), math.nan) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        found += [("access", *m.span(), math.nan) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), math.nan) for m in HEX.finditer(text)]
    if any(h in low for h in CONTEXT_HINTS):
        taken = sorted(x[1:3] for x in found)
        values = [m.span(m.lastgroup) for m in CONTEXT.finditer(text) if len(m[m.lastgroup]) >= 6]
        values = [(a, a + len(text[a:b].rstrip(".)]}!?:"))) for a, b in values]
        free = [s for s in values if not _covered(*s, taken)]
        if free:
            ranks = _ranks(text, [text[a:b] for a, b in free], corpus or {})
            for a, b in free:
                cost = guess_cost(text[a:b], ranks)
                if b - a >= 6 and cost >= _limit(text[a:b], ranks):
                    found.append(("guess", a, b, cost))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SPANS_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("cost", T.DoubleType())]))


def _spans(corpus: Mapping[str, int]):
    def spans(texts: pa.Array) -> pa.Array:
        rows = ([{"kind": k, "start": a, "end": b, "cost": None if c != c else c} for k, a, b, c in find(t, corpus)] for t in texts.to_pylist())
        return pa.array(rows, SPANS)

    return F.arrow_udf(spans, SPANS_TYPE)


def _redacted(corpus: Mapping[str, int]):
    def redacted(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            spans, at, parts = find(text, corpus), 0, []
            for kind, start, end, _ in spans:
                if end <= at:
                    continue
                parts += [text[at:start] if start >= at else "", f"<{kind}>" if start >= at else ""]
                at = end
            out.append("".join([*parts, text[at:]]) if spans else text)
        return pa.array(out, pa.string())

    return F.arrow_udf(redacted, T.StringType())


def scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end, cost), end exclusive, in code points.

    Null and empty texts have no spans. Rows keep their number and order of columns; an input column
    named spans is replaced. An empty table gives an empty table.
    """
    return docs.select(*map(quoted, without(docs, ["spans"])), _spans(word_ranks(docs, text_col=text_col))(quoted(text_col)).alias("spans"))


def redact(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span, overlaps joined, replaced by its kind in angle brackets; n_chars follows.

    Columns keep their names and order; null texts stay null.
    """
    text = docs.withColumn("_redacted", _redacted(word_ranks(docs, text_col=text_col))(quoted(text_col)))
    chars = F.coalesce(F.length("_redacted").cast("long"), quoted(chars_col)) if chars_col in docs.columns else None
    swap = {text_col: F.col("_redacted"), chars_col: chars}
    return text.select(*[swap.get(x, quoted(x)).alias(x) for x in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(F.filter(spans, lambda x: x["kind"] != "guess")).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        count("guess").alias("n_guess"),
        F.array_max(F.transform(spans, lambda x: x["cost"])).alias("most_cost"),
    )
