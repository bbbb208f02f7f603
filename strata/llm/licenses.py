"""License scan: exact set-similarity join of text blocks with license notices.

A block is a window of words of about a template's length that starts at any of
the template's words; line ends do not count.  Template tokens are ordered by
their corpus frequency, rarest first.  A block that holds a template's share
``t`` of distinct tokens must have one of the rarest ``|T| - ceil(t |T|) + 1``
near (prefix filter), lie in a text of at least ``ceil(t |T|)`` words (length
filter), and have enough template words from its first one on (positional
filter); what is left is counted exactly, and must hold the words that name the
license.  The templates are a short parameter list, so the vocabulary and its
frequencies have a fixed size; the texts are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import ALNUM, Chunk, chunks, ship, words

#: Phrases whose consecutive words mark a license, and its label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Short public notices; label and text.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Words that tell a license from others: a block must hold those of its template's words that are among them.
NAMES = ("mit", "associated", "files", "apache", "file", "gnu", "general", "public", "redistribution", "source", "binary",
         "cc", "creative", "commons", "mozilla")


def tokens_of(text: str) -> np.ndarray:
    """Hashes of the words of ``text`` in order."""
    column = pa.array([text])
    return np.concatenate([words(c, ALNUM, True).hash for c in chunks(column)])


def _locate(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Position of each hash in the sorted vocabulary, -1 where it is none."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def _count(vocabulary):
    def run(batches):
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                w = words(chunk, ALNUM, True)
                at = _locate(vocabulary, w.hash)
                hit = at >= 0
                if hit.any():
                    pairs = np.unique(w.row[hit] * len(vocabulary) + at[hit])
                    total += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary))), pa.array(total)], ["token", "n"])
    return run


class Template:
    """A notice as distinct tokens from the rarest on, with its filters' lengths and the words that its blocks may span.

    ``named`` has the places among ``tokens`` of those that every block must hold.
    """

    def __init__(self, label: str, tokens: np.ndarray, share: float, length: int, named: np.ndarray):
        self.label, self.tokens, self.length, self.named = label, tokens, length, named
        self.need = int(np.ceil(share * len(tokens) - 1e-9))
        self.prefix = len(tokens) - self.need + 1
        self.window = int(np.ceil(length / share - 1e-9))


def prepare(df: DataFrame, text_col: str, templates, share: float, names=NAMES) -> tuple[np.ndarray, list[Template]]:
    """Vocabulary of the templates, and their tokens in order of the rows of ``df`` that hold them."""
    spelled = [(label, tokens_of(text)) for label, text in templates]
    vocabulary = np.unique(np.concatenate([s for _, s in spelled]))
    counts = np.zeros(len(vocabulary), np.int64)
    rows = df.select(F.col(text_col).alias("text")).mapInArrow(_count(vocabulary), "token long, n long").groupBy("token").agg(F.sum("n")).collect()
    for token, n in rows:
        counts[token] = n

    naming = _locate(vocabulary, tokens_of(" ".join(names)))

    def template(label, spell):
        at = np.searchsorted(vocabulary, np.unique(spell))
        at = at[np.lexsort((at, counts[at]))]
        return Template(label, at, share, len(spell), np.flatnonzero(np.isin(at, naming)))
    return vocabulary, [template(*s) for s in spelled]


def _windows(spot: np.ndarray, position: np.ndarray, t: Template) -> list[tuple[int, int, int]]:
    """(first, last, distinct tokens) of the windows that reach the threshold, the best of those that overlap.

    ``spot`` has the places of a template's words (rows lie at least a window apart), ``position`` their tokens.
    """
    n = np.arange(len(spot))
    end = np.searchsorted(spot, spot + t.window, side="left")
    if not (end - n >= t.need).any():
        return []
    order = np.lexsort((n, position))
    same = position[order][1:] == position[order][:-1]
    before = np.full(len(spot), -1)                    # where the same token was last
    before[order[1:][same]] = order[:-1][same]
    # a word is new to the windows that start after its token was last, and not too far before it
    new = np.maximum(np.searchsorted(spot, spot - t.window, side="right"), before + 1)
    count = np.cumsum(np.bincount(new, minlength=len(spot))) - n
    fits = (end - n >= t.need) & (count >= t.need)
    for name in t.named:
        at = np.append(np.flatnonzero(position == name), len(spot))
        fits &= at[np.searchsorted(at, n)] < end
    good = np.flatnonzero(fits)
    member = good[:, None] + np.arange(min(t.window, len(spot)))
    fresh = (member < end[good][:, None]) & (before[np.minimum(member, len(spot) - 1)] < good[:, None])
    last = np.where(fresh, member, -1).max(1, initial=-1)
    taken, out = np.zeros(len(spot), bool), []
    for k in np.lexsort((good, spot[last] - spot[good], -count[good])):
        a, b = int(good[k]), int(last[k])
        if taken[a:b + 1].any():
            continue
        # words that the template repeats, next to the block
        while spot[b] - spot[a] + 1 < t.length and a > 0 and spot[a - 1] == spot[a] - 1 and not taken[a - 1]:
            a -= 1
        while spot[b] - spot[a] + 1 < t.length and b + 1 < len(spot) and spot[b + 1] == spot[b] + 1 and not taken[b + 1]:
            b += 1
        taken[a:b + 1] = True
        out.append((a, b, int(count[good[k]])))
    return sorted(out)


def find_blocks(chunk: Chunk, vocabulary: np.ndarray, templates: list[Template]) -> list[tuple]:
    """(row, line, template, containment, first word, last word) of every block that reaches a template's threshold."""
    w = words(chunk, ALNUM, True)
    at = _locate(vocabulary, w.hash)
    hit = np.flatnonzero(at >= 0)
    if not len(hit):
        return []
    size = np.bincount(w.row, minlength=chunk.rows)
    breaks = np.flatnonzero(chunk.data == 10)
    out = []
    for number, t in enumerate(templates):
        place = np.full(len(vocabulary), -1)
        place[t.tokens] = np.arange(len(t.tokens))
        where = hit[(place[at[hit]] >= 0) & (size[w.row[hit]] >= t.need)]
        position, spot = place[at[where]], where + w.row[where] * t.window
        rare = spot[position < t.prefix]
        near = np.searchsorted(rare, spot - t.window, side="right") < np.searchsorted(rare, spot + t.window, side="left")
        where, position, spot = where[near], position[near], spot[near]
        for first, last, n in _windows(spot, position, t):
            first, last = where[first], where[last]
            row = int(w.row[first])
            offset = int(np.searchsorted(w.row, row))
            line = int(np.searchsorted(breaks, w.start[first]) - np.searchsorted(breaks, chunk.offsets[row]))
            out.append((row, line, number, n / len(t.tokens), int(first) - offset, int(last) - offset))
    return out


def _scan(vocabulary, templates, phrases):
    spelled = [(tokens_of(p), label) for p, label in phrases]

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                w = words(chunk, ALNUM, True)
                n_words = np.bincount(w.row, minlength=chunk.rows)
                places: list[list] = [[] for _ in range(chunk.rows)]
                for spell, label in spelled:
                    k = len(spell)
                    n = len(w.hash) - k + 1
                    if n <= 0:
                        continue
                    fits = w.row[:n] == w.row[k - 1:]
                    for i, h in enumerate(spell):
                        fits &= w.hash[i:i + n] == h
                    for p in np.flatnonzero(fits):
                        places[w.row[p]].append((int(p - np.searchsorted(w.row, w.row[p])), label))
                blocks: list[list] = [[] for _ in range(chunk.rows)]
                for row, line, number, containment, first, last in find_blocks(chunk, vocabulary, templates):
                    blocks[row].append({"line": line, "template": number, "label": templates[number].label, "containment": containment,
                                        "first_word": first, "last_word": last})
                base = [sorted({label for _, label in p}) for p in places]
                both = [sorted({*a, *(x["label"] for x in b)}) for a, b in zip(base, blocks)]
                score = [max([1.0 if p else 0.0, *(x["containment"] for x in b)]) for p, b in zip(places, blocks)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, chunk.rows), pa.array(n_words, pa.int64()), pa.array([len(p) for p in places], pa.int64()),
                    pa.array([min(p)[0] if p else None for p in places], pa.int64()), pa.array([max(p)[0] if p else None for p in places], pa.int64()),
                    pa.array(base, pa.list_(pa.string())), pa.array(both, pa.list_(pa.string())), pa.array(score, pa.float64()),
                    pa.array(blocks, pa.list_(pa.struct([("line", pa.int64()), ("template", pa.int32()), ("label", pa.string()),
                                                         ("containment", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])))],
                    ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"])
    return run


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
                  share: float = 0.8, names=NAMES) -> DataFrame:
    """Places of ``phrases`` and the blocks that hold at least ``share`` of a template's distinct words, its ``names`` among them.

    ``id_col, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score, blocks``: a block spans at
    most ``1 / share`` times the template's words, over any line ends.  ``blocks`` lists those that reach the threshold, of
    overlapping ones the best (line and place of the first word, template, label, containment, last word); ``labels`` are the
    phrases' and the blocks'; ``score`` is 1 with a phrase, else the largest containment, else 0.  Words and lines are
    numbered from 0 in the text.  A null or empty text has no words, null places and empty lists; rows that repeat are scanned alike.
    """
    ship(df.sparkSession)
    vocabulary, prepared = prepare(df, text_col, templates, share, names)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(vocabulary, prepared, phrases),
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
        "score double, blocks array<struct<line:long,template:int,label:string,containment:double,first_word:long,last_word:long>>"
    ).withColumnRenamed("id", id_col)
