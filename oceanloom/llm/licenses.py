"""Operator 10, license scans: a positional rare-token index of licence texts.

Each template is indexed by its rarest words, by their frequency over all
documents: by so many that the others and any one of them together can't make a match.  All indexed words of a file look up
postings (template, position); the postings are intersected by relative position: where two words of a template
agree on where it starts, but for a small drift, the place is compared word by word, weighted by rarity, and the
template's mandatory phrases must stand in it.  Every place that reaches the coverage is found so.  A template of which one word
alone makes up that coverage asks for that word only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.llm import textnum
from oceanloom.llm.common import id_and_text, small_batches

# Phrases that name a licence, and their labels.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Opening or key sentences of public licences: label, text, mandatory phrases.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["except in compliance with the license"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial 4 0"]),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", ["waived all copyright"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

#: At least so many.
INDEXED_PER_TEMPLATE = 3
COVERAGE = 0.8
#: For rounding of sums of weights.
SLACK = 1e-9
DRIFT = 2
#: Places of a template that are compared at once.
PLACES = 4096


def _folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z lowered, and which of them make words: digits, a-z and all beyond 0x7F."""
    cp = textnum.codepoints(text)
    cp = np.where((cp >= 0x41) & (cp <= 0x5A), cp + np.uint32(32), cp)
    return cp, ((cp >= 0x30) & (cp <= 0x39)) | ((cp >= 0x61) & (cp <= 0x7A)) | (cp >= 0x80)


def words(text: str) -> np.ndarray:
    """Hashes of a text's words, in order."""
    return textnum.hashed_runs(*_folded(text))[0]


@dataclass(frozen=True)
class Vocabulary:
    """The licence words, by ascending hash; ``ids`` gives a document's words as numbers of it, -1 for others."""

    hashes: np.ndarray

    def ids(self, document: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, document), len(self.hashes) - 1)
        return np.where(self.hashes[at] == document, at, -1)


def vocabulary(templates: list[tuple[str, str, list[str]]]) -> Vocabulary:
    texts = [t for _, t, _ in templates] + [p for _, _, ps in templates for p in ps] + [p for p, _ in BASE_PHRASES]
    return Vocabulary(np.unique(np.concatenate([words(t) for t in texts])))


def places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of all places where the phrase's words stand one after the other."""
    at = np.flatnonzero(ids[: max(len(ids) - len(phrase) + 1, 0)] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[ids[at + k] == phrase[k]]
    return at


def rarity(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """Inverse document frequency of each licence word over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(known.hashes), np.int64), 0
        for b in batches:
            for text in b.column("text").to_pylist():
                ids = known.ids(words(text))
                total[np.unique(ids[ids >= 0])] += 1
                n += 1
        yield pa.RecordBatch.from_pydict({"w": pa.array([-1, *range(len(total))], pa.int32()), "n": pa.array([n, *total.tolist()], pa.int64())})

    got = {r["w"]: r["n"] for r in docs.mapInArrow(count, "w INT, n BIGINT").groupBy("w").agg(F.sum("n").alias("n")).collect()}
    return np.log1p(got.get(-1, 0) / np.array([max(got.get(k, 0), 0.5) for k in range(len(known.hashes))]))


class Index:
    """Postings of the templates' rarest words."""

    def __init__(self, templates: list[tuple[str, str, list[str]]], known: Vocabulary, idf: np.ndarray):
        self.idf, self.known = idf, known
        self.labels = [label for label, _, _ in templates]
        self.texts = [known.ids(words(t)) for _, t, _ in templates]
        self.phrases = [[known.ids(words(p)) for p in ps] for _, _, ps in templates]
        self.longest = max(map(len, self.texts))
        self.base = [(known.ids(words(p)), label) for p, label in BASE_PHRASES]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.needed: list[int] = []  # of each template, how many of its words must agree on a place
        for t, ids in enumerate(self.texts):
            rest, heaviest, least = idf[ids].sum(), 0.0, (COVERAGE - SLACK) * idf[ids].sum()
            for k, w in enumerate(sorted(set(ids.tolist()), key=lambda w: (-idf[w], w))):
                if k >= INDEXED_PER_TEMPLATE and rest + heaviest < least:
                    break  # a place with at most one of the words indexed so far can't be covered enough
                own = idf[w] * (ids == w).sum()
                rest, heaviest = rest - own, max(heaviest, own)
                for q in np.flatnonzero(ids == w).tolist():
                    self.postings.setdefault(w, []).append((t, q))
            self.needed.append(2 if rest + heaviest < least else 1)
        self.indexed = np.zeros(len(known.hashes) + 1, bool)  # the last entry answers for id -1
        self.indexed[list(self.postings)] = True

    def matches(self, ids: np.ndarray) -> tuple[set[str], float]:
        """Labels of the templates found, and the best coverage of any template proposed."""
        at = np.flatnonzero(self.indexed[ids])
        found: set[str] = set()
        best = 0.0
        if not len(at):
            return found, best
        drift = np.arange(-DRIFT, DRIFT + 1)  # a word may stand as far off its place
        offsets: dict[int, list[np.ndarray]] = {}
        for w in np.unique(ids[at]).tolist():
            where, own = at[ids[at] == w], {}
            for t, q in self.postings[w]:
                own.setdefault(t, []).append((where[:, None] - q + drift).ravel())
            for t, some in own.items():
                offsets.setdefault(t, []).append(np.unique(np.concatenate(some)))  # a word says each place once
        pad = self.longest + 2 * DRIFT
        padded = np.pad(ids, pad, constant_values=-1)
        for t, some in sorted(offsets.items()):
            own = self.texts[t]
            starts, votes = np.unique(np.concatenate(some), return_counts=True)
            starts = starts[votes >= self.needed[t]]
            for k in range(0, len(starts), PLACES):
                part = starts[k : k + PLACES]
                place = part[:, None] + np.arange(pad, pad + len(own))
                hit = np.zeros(place.shape, bool)
                for d in range(-DRIFT, DRIFT + 1):
                    hit |= padded[place + d] == own
                coverage = hit @ self.idf[own] / self.idf[own].sum()
                best = max(best, float(coverage.max()))
                for offset in part[coverage >= COVERAGE].tolist() if self.labels[t] not in found else []:
                    window = ids[max(offset - DRIFT, 0) : offset + len(own) + DRIFT]
                    if all(len(places(window, p)) for p in self.phrases[t]):
                        found.add(self.labels[t])
                        break
        return found, min(best, 1.0)


def scan(docs: DataFrame, templates: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every whole text.

    The score is the rarity-weighted share of a template's words found in place, for the template found best; a base phrase alone
    gives 0.5 at least.  A null or empty text has no words, labels or places, and score 0; repeated rows each have their result.
    """
    small_batches(docs.sparkSession)
    templates = templates or TEMPLATES
    known = vocabulary(templates)
    own = id_and_text(docs)
    idf = rarity(own, known)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, known, idf)
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                ids = known.ids(words(text))
                hits = [(places(ids, phrase), label) for phrase, label in index.base]
                base = {label for at, label in hits if len(at)}
                at = np.concatenate([a for a, _ in hits])
                found, score = index.matches(ids)
                rows.append((len(ids), len(at), int(at.min()) if len(at) else None, int(at.max()) if len(at) else None, ",".join(sorted(base)), ",".join(sorted(base | found)), max(score, 0.5) if base else score))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *names])

    return own.mapInArrow(each, "doc_id BIGINT, n_words BIGINT, n_base BIGINT, first_word BIGINT, last_word BIGINT, base_labels STRING, labels STRING, score DOUBLE")
