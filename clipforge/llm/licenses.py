"""Licence scan by a positional index of rare words.

Templates of licence notices are indexed by their rarest words: a posting is
(template, position in it). A document's words are looked up in the index, and
postings that agree on the place where a template would start are intersected; an
alignment with enough of them is verified against the template's whole text, which
must hold its mandatory key phrase at its place. Rarity (IDF) is counted over all documents.

Documents never meet each other: the only shuffle sums document frequencies of the
fixed licence vocabulary. Words are found by array operations on whole columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import text_bytes
from clipforge.llm.shingles import word_hashes

#: Contract phrases: label by phrase.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices that are looked for: label, notice, mandatory key phrase. Fixed values.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2.0", "apache license version 2.0"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2.0", "mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution license", "creative commons attribution"),
    ("cc-by", "licensed under cc by 4.0", "cc by 4.0"),
    ("cc-by-nc", "licensed under cc by nc 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4.0", "cc by sa"),
    ("cc0", "released under cc0 1.0 universal public domain dedication", "cc0 1.0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
]
#: Rarest words of each template that are indexed, and how many of them must agree.
RARE = 4
AGREE = 2
#: Words of a template that must stand at their places.
MIN_SCORE = 0.6

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
CHUNK = 2 << 20


def _split(phrase: str) -> list[str]:
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", phrase)


class Vocabulary:
    """The words of all phrases and templates, numbered in the order of their hashes."""

    def __init__(self, templates=None, base=None):
        self.templates = TEMPLATES if templates is None else templates
        self.base = BASE if base is None else base
        words = sorted({w for p in [*self.base, *(t[1] for t in self.templates), *(t[2] for t in self.templates)] for w in _split(p)})
        data, offsets = text_bytes(pa.array(words))
        hashes = word_hashes(data, offsets[:-1], offsets[1:])[0]
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = {words[k]: i for i, k in enumerate(order.tolist())}
        self.base_ids = [([self.number[w] for w in _split(p)], label) for p, label in self.base.items()]
        self.template_ids = [(label, [self.number[w] for w in _split(t)], [self.number[w] for w in _split(k)]) for label, t, k in self.templates]

    def find(self, rows: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, n_words, positions, word numbers) with only the words of the vocabulary."""
        data, offsets = text_bytes(rows)
        d = 0
        while d < len(offsets) - 1:
            e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + CHUNK, "right")) - 1)
            part = _LOWER[data[offsets[d]:offsets[e]]]
            cuts = offsets[d:e] - offsets[d]
            inside = _WORD[part]
            starts, stops = inside.copy(), inside.copy()
            starts[1:] &= ~inside[:-1]
            stops[:-1] &= ~inside[1:]
            edge = cuts[(cuts > 0) & (cuts < len(part))]
            starts[edge] = inside[edge]
            stops[edge - 1] = inside[edge - 1]
            s, z = np.flatnonzero(starts), np.flatnonzero(stops) + 1
            at = np.concatenate([np.searchsorted(s, cuts), [len(s)]])
            h = word_hashes(part, s, z)[0]
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hits = np.flatnonzero(self.hashes[place] == h)
            hit_at = np.searchsorted(hits, at)
            for i in range(e - d):
                own = hits[hit_at[i]:hit_at[i + 1]]
                yield d + i, int(at[i + 1] - at[i]), own - at[i], place[own]
            d = e


def _frequencies(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(vocabulary.hashes), np.int64)
        for rows in batches:
            for _, _, _, ids in vocabulary.find(rows.column(0)):
                n += 1
                if len(ids):
                    df[np.unique(ids)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(df)), pa.int32()), pa.array(np.concatenate([[n], df]))], ["word", "n"])
    return run


def _places(pos: np.ndarray, ids: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Positions where the phrase's words stand consecutively."""
    found = pos[ids == phrase[0]]
    for k, w in enumerate(phrase[1:], 1):
        found = found[np.isin(found + k, pos[ids == w])]
    return found


def _align(pos: np.ndarray, ids: np.ndarray, words: list[int], rare: list[int]) -> np.ndarray:
    """Where the template would start by at least ``AGREE`` of its rare words' postings."""
    votes = [np.unique(pos[ids == words[k]] - k) for k in rare]
    at, n = np.unique(np.concatenate(votes), return_counts=True)
    return at[n >= min(AGREE, len(rare))]


def _held(pos: np.ndarray, ids: np.ndarray, starts: np.ndarray, words: list[int]) -> np.ndarray:
    """How many of the words stand at their places, for every start at once: ``pos`` ascends,
    so a place is looked up by binary search."""
    n = np.zeros(len(starts), np.int64)
    for k, w in enumerate(words):
        at = np.minimum(np.searchsorted(pos, starts + k), len(pos) - 1)
        n += (pos[at] == starts + k) & (ids[at] == w)
    return n


def _scan(vocabulary: Vocabulary, rarity: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = []
        for label, words, key in vocabulary.template_ids:
            order = sorted(range(len(words)), key=lambda k, words=words: (-rarity[words[k]], k))
            key_at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
            index.append((label, words, key, key_at, sorted(order[:RARE])))
        for rows in batches:
            out = []
            for _, n, pos, ids in vocabulary.find(rows.column(1)):
                labels, base, first, last, n_base, score = set(), set(), None, None, 0, 0.0
                if len(ids) > 1:
                    present = np.bincount(ids, minlength=len(vocabulary.hashes)) > 0
                    for phrase, label in vocabulary.base_ids:
                        at = _places(pos, ids, phrase) if present[phrase].all() else ()
                        if len(at):
                            base.add(label)
                            n_base += len(at)
                            first = int(at[0]) if first is None else min(first, int(at[0]))
                            last = int(at[-1]) if last is None else max(last, int(at[-1]))
                            score = 1.0
                    for label, words, key, key_at, rare in index:
                        if not present[key].all():
                            continue
                        starts = _align(pos, ids, words, rare)
                        starts = starts[_held(pos, ids, starts + key_at, key) == len(key)]
                        if len(starts):
                            share = float(_held(pos, ids, starts, words).max()) / len(words)
                            if share >= MIN_SCORE:
                                labels.add(label)
                                score = max(score, share)
                out.append((n, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates=None, base=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per document.

    ``score`` is the best share of a template's words found at their places; a base phrase
    is complete (1), no label is 0. Null text has no words. Every row is judged on its own."""
    vocabulary = Vocabulary(templates, base)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = (src.select("text").mapInArrow(_frequencies(vocabulary), "word int, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())  # one row per word of the fixed vocabulary
    df = np.zeros(len(vocabulary.hashes), np.int64)
    total = 0
    for r in rows:
        if r["word"] < 0:
            total = r["n"]
        else:
            df[r["word"]] = r["n"]
    rarity = np.log((1 + total) / (1 + df))
    return src.mapInArrow(_scan(vocabulary, rarity),
                          "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
