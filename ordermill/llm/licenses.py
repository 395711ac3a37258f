"""Licence scans by a positional rare-token index.

Templates are short well-known notices. The index holds, for each template, postings (template, position) of its
rarest words alone: rarity is counted over all documents of the corpus. A file's licence words are looked up from
the rarest on; every posting that is met votes for a place where the template would start. Places on which enough
different rare words of a template agree, up to a few words put in or left out, are verified: all mandatory key
phrases of the template must stand there word by word. Common words are never looked up.

Plain phrases (``BASE``) are found wherever their words stand consecutively, whatever the index says.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import modest_batches, quoted, without

#: Phrases that carry a label by themselves.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Wording of public licences and their usual notices; key phrases stand between brackets.
TEMPLATES = (
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files the software [to deal in the software without restriction] including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "released [under the mit license]"),
    ("apache-2", "[licensed under the apache license version 2 0] the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the [apache license version 2] 0"),
    ("bsd-2-clause", "[redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [redistributions in binary form must reproduce] the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "[neither the name of] the copyright holder nor the names of its contributors may be used [to endorse or promote products derived from this software without specific prior written permission]"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] as published by the free software foundation [either version 2 of the license] or at your option any later version"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] as published by the free software foundation [either version 3 of the license] or at your option any later version"),
    ("gpl-3", "this work is licensed under the [gnu general public license version 3]"),
    ("gpl-2", "this work is licensed under the [gnu general public license version 2]"),
    ("lgpl-2-1", "this library is free software you can redistribute it and or modify it under the terms of the [gnu lesser general public license] as published by the free software foundation [either version 2 1 of the license] or at your option any later version"),
    ("lgpl-3", "this library is free software you can redistribute it and or modify it under the terms of the [gnu lesser general public license] as published by the free software foundation [either version 3 of the license] or at your option any later version"),
    ("agpl-3", "this program is free software you can redistribute it and or modify it under the terms of the [gnu affero general public license] as published by the free software foundation [either version 3 of the license] or at your option any later version"),
    ("mpl-2", "[this source code form is subject to the terms of the mozilla public license v 2 0] if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "[this is free and unencumbered software released into the public domain] anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib", "[this software is provided as is without any express or implied warranty] in no event will the authors be held liable for any damages arising from the use of this software [permission is granted to anyone to use this software for any purpose]"),
    ("bsl-1", "[boost software license version 1 0] august 17th 2003"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the [eclipse public license 2 0] which is available at"),
    ("cc-by-nc", "licensed under [cc by nc] 4 0"),
    ("cc-by-nc", "this work is licensed under a [creative commons attribution noncommercial] 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a [creative commons attribution sharealike] 4 0 international license"),
    ("cc-by", "this work is licensed under a [creative commons attribution 4 0 international license]"),
    ("cc0", "to the extent possible under law the author has [waived all copyright and related or neighboring rights to this work]"),
)
#: Rarest words of a template that are indexed, besides the rarest of each key phrase.
RARE = 8
#: Share of a template's indexed places that must agree on a start, and words put in or left out between them.
AGREE, SLACK = 0.5, 8
#: Bytes that part words; others stay, A-Z in lower case.
_WORDS = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
OWN = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def license_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    #: Start and words of every mandatory phrase.
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]


def parse_template(label: str, text: str) -> Template:
    words, keys, start = [], [], 0
    for token in text.split():
        if token.startswith("["):
            start = len(words)
        words.append(token.strip("[]").encode())
        if token.endswith("]"):
            keys.append((start, tuple(words[start:])))
    if not keys:
        raise ValueError(f"a template of {label} has no key phrase")
    return Template(label, tuple(words), tuple(keys))


class Index:
    """Postings of the templates' rare words, by the number of documents that hold each word."""

    def __init__(self, templates: tuple[Template, ...], documents: int, holding: dict[bytes, int]):
        self.templates = templates
        self.numbers = {w: k for k, w in enumerate(sorted({w for t in templates for w in t.words}))}
        idf = {w: math.log((documents + 1) / (holding.get(w, 0) + 0.5)) for w in self.numbers}
        self.idf = np.array([max(idf[w], 1e-6) for w in self.numbers])
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.need, self.weights, self.numbered, self.keys = [], [], [], []
        for at, t in enumerate(templates):
            rank = sorted(dict.fromkeys(t.words), key=lambda w: (-idf[w], w))
            rare = set(rank[:RARE]) | {min(words, key=lambda w: (-idf[w], w)) for _, words in t.keys}
            places = [(w, k) for k, w in enumerate(t.words) if w in rare]
            for place, (w, k) in enumerate(places):
                self.postings[self.numbers[w]].append((at, k, place))
            self.need.append(max(1, math.ceil(AGREE * len(places))))
            own = np.array([self.numbers[w] for w in t.words])
            self.numbered.append(own)
            self.keys.append([(start, np.array([self.numbers[w] for w in words]), max(range(len(words)), key=lambda k: (idf[words[k]], -k))) for start, words in t.keys])
            self.weights.append(np.bincount(own, minlength=len(self.numbers)))
        self.rarest_first = sorted(self.postings, key=lambda w: (-self.idf[w], w))

    def starts(self, places: dict[int, np.ndarray]) -> Iterator[tuple[int, int]]:
        """(template, lowest start) where enough different indexed places agree within SLACK words."""
        votes: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for w in self.rarest_first:
            if w in places:
                for template, k, place in self.postings[w]:
                    votes[template].append((places[w] - k, place))
        for template, cast in votes.items():
            if len(cast) < self.need[template]:
                continue
            start = np.concatenate([s for s, _ in cast])
            voter = np.repeat([p for _, p in cast], [len(s) for s, _ in cast])
            order = np.argsort(start, kind="stable")
            start, voter = start[order], voter[order]
            # Every start opens a stretch; which places vote in it shows in the running counts of each place.
            ends = np.searchsorted(start, start + SLACK, side="right")
            agree = np.zeros(len(start), np.int64)
            for _, p in cast:
                run = np.concatenate([[0], np.cumsum(voter == p)])
                agree += run[ends] > run[:-1]
            last = None
            for s in start[agree >= self.need[template]].tolist():
                if s != last:
                    yield template, s
                last = s

    def label(self, ids: np.ndarray) -> tuple[set[str], float]:
        """Labels of the verified templates, and the largest share of a template's weight that lies at one place."""
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return set(), 0.0
        order = known[np.argsort(ids[known], kind="stable")]
        words, first = np.unique(ids[order], return_index=True)
        places = dict(zip(words.tolist(), np.split(order, first[1:])))
        found, score = set(), 0.0
        whole: set[int] = set()
        for template, start in self.starts(places):
            if template in whole:
                continue
            own = self.numbered[template]
            if all(self._stands(ids, places, key, start) for key in self.keys[template]):
                found.add(self.templates[template].label)
                near = ids[max(0, start) : max(0, start + len(own) + SLACK)]
                both = np.minimum(np.bincount(near[near >= 0], minlength=len(self.idf)), self.weights[template]) @ self.idf
                share = float(both / (self.weights[template] @ self.idf))
                score = max(score, min(1.0, share))
                if share >= 1.0 - 1e-12:
                    whole.add(template)
        return found, score

    @staticmethod
    def _stands(ids: np.ndarray, places: dict[int, np.ndarray], key: tuple[int, np.ndarray, int], start: int) -> bool:
        """Whether the phrase stands word by word where the start puts it, up to SLACK words later."""
        at, phrase, rare = key
        hits = places.get(int(phrase[rare]))
        if hits is None:
            return False
        low = start + at + rare
        for hit in hits[np.searchsorted(hits, low - SLACK) : np.searchsorted(hits, low + SLACK, side="right")].tolist():
            first = hit - rare
            if first >= 0 and np.array_equal(ids[first : first + len(phrase)], phrase):
                return True
        return False


def base_places(ws: list[bytes]) -> list[tuple[int, str]]:
    """(word, label) of every place where a base phrase's words stand consecutively."""
    out = []
    joined = b" " + b" ".join(ws) + b" "
    for phrase, label in BASE:
        want, at, words, seen = f" {phrase} ".encode(), -1, 0, 0
        while (at := joined.find(want, at + 1)) >= 0:
            words += joined.count(b" ", seen, at)
            seen = at
            out.append((words, label))
    return out


KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
KIND = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def _held(numbers: dict[bytes, int]):
    """How many documents of a task hold each licence word; -1 counts the documents."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = np.zeros(len(numbers), np.int64), 0
        for batch in batches:
            documents += batch.num_rows
            for text in batch.column(0).to_pylist():
                for w in numbers.keys() & set(license_words(text)):
                    counts[numbers[w]] += 1
        yield pa.RecordBatch.from_pydict({"word": pa.array([-1, *range(len(numbers))], pa.int32()), "n": pa.array([documents, *counts.tolist()], pa.int64())})

    return held


def build_index(docs: DataFrame, *, text_col: str = "text", templates: tuple[Template, ...] | None = None) -> Index:
    """The index with word rarities of the whole corpus; one number per licence word reaches the driver."""
    templates = templates or tuple(parse_template(*t) for t in TEMPLATES)
    words = sorted({w for t in templates for w in t.words})
    counts = docs.select(quoted(text_col).alias("text")).mapInArrow(_held({w: k for k, w in enumerate(words)}), "word int, n bigint")
    n = {row["word"]: row["n"] for row in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return Index(templates, n.get(-1, 0), {w: n.get(k, 0) for k, w in enumerate(words)})


def scan_text(text: str | None, index: Index) -> tuple:
    ws = license_words(text)
    places = base_places(ws)
    base = {label for _, label in places}
    ids = np.fromiter((index.numbers.get(w, -1) for w in ws), np.int64, len(ws))
    found, score = index.label(ids)
    at = [k for k, _ in places]
    return len(ws), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if base else score


def scan(docs: DataFrame, index: Index, *, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score.

    A base phrase scores 1, a verified template the share of its words' weight that lies at its place, a text
    without either 0. Null and empty texts have no words, no places (null first and last) and no labels. Ties do
    not arise, repeated rows stand each for itself; columns that clash with the result's are left out, and an
    empty table gives no rows.
    """

    modest_batches(docs.sparkSession)

    @F.arrow_udf(KIND)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [scan_text(t.as_py(), index) for t in texts]
        columns = list(zip(*rows)) or [()] * len(OWN)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], names=list(OWN))

    kept = [quoted(c) for c in without(docs, OWN)]
    return docs.select(*kept, scanned(quoted(text_col)).alias("_found")).select(*kept, *(F.col(f"_found.{x}") for x in OWN))


def op13(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text"), build_index(docs)).select("doc_id", *OWN)
