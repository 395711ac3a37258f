"""Token ids by a public tokenizer, word by word.

The tokenizer drops white space and never joins pieces across it, so a text's ids are those of its
words in a row. Each Python worker keeps the ids of the words it has met; only new words reach the
tokenizer. Plain words, with or without closing punctuation, are cut here as the tokenizer's own first steps
cut them, and only its merges run on their letters.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np

from ordermill.llm.common import words

VOCABULARY = "word_bpe_49k.json"
#: The id that ends a document.
END = 1
#: Words kept per worker; on reaching it the cache starts anew.
KEPT_WORDS = 700_000
#: Letters without marks of their own, then ASCII signs; apostrophes may belong to a word's end.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in byte-level pieces: printable ones for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARS = _byte_chars()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer(dict):
    """Words to their ids as little-endian unsigned 32-bit integers; a missing word is encoded and kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._parts: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        m = PLAIN.fullmatch(text)
        if m is None:
            ids = self._encoded(text)
        else:
            letters = m[1].lower()
            ids = self._parts.get(letters)
            if ids is None:
                # One piece, in the form that the model's merges expect.
                piece = letters if letters.isascii() else letters.encode().decode("latin-1").translate(BYTE_CHARS)
                ids = self._parts[letters] = _packed([t.id for t in self._model.tokenize(piece)]).tobytes()
            if m[2]:
                end = self._parts.get(m[2])
                if end is None:
                    end = self._parts[m[2]] = self._encoded(m[2])
                ids += end
        self[word] = ids
        return ids

    def _encoded(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[str | None], end: int | None = END) -> list[bytes]:
        """The ids of each text, ``end`` after them; a null text counts as empty."""
        tail = b"" if end is None else _packed([end]).tobytes()
        out = []
        for text in texts:
            if len(self) > KEPT_WORDS:
                self.clear()
                self._parts.clear()
            out.append(b"".join(map(self.__getitem__, words(text))) + tail)
        return out


def _packed(values: list[int]) -> np.ndarray:
    return np.array(values, "<u4")


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One per worker and vocabulary: its cache outlives a task."""
    return WordTokenizer(path)
