"""Quality rules by compression bands.

A text is compressed whole, in chunks and in parts a quarter as long as the text, within bounds. Chunks and parts overlap
by half and the last ones end with the text, so that junk is judged alike wherever it stands. Very small outputs mean
repetition, very large ones noise. What is usual depends on the length (a short text has little to repeat), so every
length has its own limits, and a window is held to those of its own length. Limits and the length of the parts
change with the text's length without a jump.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import modest_batches, quoted, words, without

LEVEL = 3
CHUNK = 4096
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
#: Least and most raw bytes per compressed byte at these numbers of bytes; straight lines over the logarithm of the length
#: lie between them. Shorter texts pass: fifty words hardly fit in 256 bytes.
BANDS = ((256, 1.15, 3.0), (512, 1.3, 3.2), (1024, 1.45, 3.6), (2048, 1.5, 4.2), (8192, 1.55, 5.0), (32768, 1.6, 6.5), (131072, 1.6, 8.0))
SHORTEST = BANDS[0][0]
#: A part has this share of the text's bytes, at least ``SHORTEST`` and at most ``PART``.
SHARE, PART = 4, CHUNK // 2
OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "chunk_least", "chunk_most", "base_failed", "kept")
MEASURES = (*OWN[:8], "inside")
KIND = T.StructType([T.StructField(x, T.LongType() if k < 5 else T.DoubleType() if k < 8 else T.BooleanType()) for k, x in enumerate(MEASURES)])
_LENGTHS, _LOW, _HIGH = (np.array(x, float) for x in zip(*BANDS))


def repeated(ws: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(ws) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in ws], np.int64, len(ws))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    _, place, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    hit = counts[place] > 1
    if not hit.any():
        return 0
    covered = np.zeros(len(ws), bool)
    for k in range(3):
        covered[k : k + n] |= hit
    return int(covered.sum())


def dup_lines(text: str) -> int:
    seen: set[str] = set()
    found = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                found += 1
            elif line.strip(SPACE):
                seen.add(line)
    return found


def limits(size: int) -> tuple[float, float]:
    """Least and most raw bytes per compressed byte of ``size`` bytes."""
    at = np.log2(size)
    return float(np.interp(at, np.log2(_LENGTHS), _LOW)), float(np.interp(at, np.log2(_LENGTHS), _HIGH))


def window_ratios(raw: bytes, size: int, press: zstandard.ZstdCompressor) -> list[float]:
    """Raw bytes per compressed byte of windows that overlap by half; the last one ends with ``raw``."""
    starts = [*range(0, len(raw) - size, size // 2), len(raw) - size]
    return [size / len(press.compress(raw[i : i + size])) for i in starts]


def ratios(raw: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float, float, bool]:
    """Raw bytes per compressed byte of the whole, the least and most of the chunks, and whether the whole, its
    chunks and its parts lie within their limits.

    Texts shorter than a chunk have none; the whole's ratio stands for them.
    """
    if not raw:
        return 1.0, 1.0, 1.0, True
    whole = len(raw) / len(press.compress(raw))
    if len(raw) < SHORTEST:
        return whole, whole, whole, True
    chunks = window_ratios(raw, CHUNK, press) if len(raw) >= CHUNK else [whole]
    part = min(PART, max(SHORTEST, len(raw) // SHARE))
    parts = window_ratios(raw, part, press)
    inside = True
    for size, found in ((len(raw), [whole]), (min(CHUNK, len(raw)), chunks), (part, parts)):
        low, high = limits(size)
        inside &= low <= min(found) and max(found) <= high
    return whole, min(chunks), max(chunks), inside


def measure(text: str | None, press: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    ws = words(text)
    return (
        len(ws), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup_lines(text), repeated(ws),
        *ratios(text.encode("utf-8", "surrogatepass"), press),
    )


@F.arrow_udf(KIND)
def _measured(texts: pa.Array) -> pa.Array:
    press = zstandard.ZstdCompressor(level=LEVEL)
    columns = list(zip(*[measure(t, press) for t in texts.to_pylist()])) or [()] * len(MEASURES)
    kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.bool_()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(MEASURES))


def judge(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, the ratios, base_failed and kept.

    Null texts count as empty: no words, so base_failed. Input columns named like the operator's are
    replaced; rows that repeat stay; an empty table gives an empty table.
    """
    modest_batches(docs.sparkSession)
    keep = without(docs, OWN)
    failed = (F.col("_m.n_words") < 50) | (100 * F.col("_m.n_repeat_words") > 50 * F.col("_m.n_words"))
    return docs.select(*map(quoted, keep), _measured(quoted(text_col)).alias("_m")).select(
        *map(quoted, keep), *[F.col(f"_m.{x}") for x in OWN[:8]], failed.alias("base_failed"), (~failed & F.col("_m.inside")).alias("kept")
    )


def op7(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", *OWN[:5], "base_failed", "kept", *OWN[5:8])
