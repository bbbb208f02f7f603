"""Language ID by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton.  A
text is parsed against each: every phrase is the longest string from there on
that occurs in the language's sample.  Phrases cost ``log2`` of the sample's
length in bits; the language that needs the fewest bits a byte wins.  Texts
are cut into blocks that are parsed on their own, so that numpy steps through
the automata with thousands of blocks at once and a long text is no chain.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import LOWER_TABLE, chunks, ship

#: Bytes of sample over all languages, and the most for one.
SAMPLE_BYTES, LANGUAGE_BYTES = 160_000, 40_000
#: Bytes of a text that count as one example in a sample.
EXAMPLE_BYTES = 2_000
#: Bytes of a block, and blocks that are parsed at once.
BLOCK, AT_ONCE = 512, 1 << 13
#: How fast the score falls with the bits a byte that a language needs more than the best.
SHARPNESS = 4.0


class Samples(NamedTuple):
    """Learned languages in code-point order and their sample, examples separated by a byte 0."""

    langs: tuple[str, ...]
    texts: tuple[bytes, ...]


def symbols_of(data: np.ndarray) -> np.ndarray:
    """Bytes as symbols: A-Z as a-z, all ASCII but letters as one, bytes of other characters as they are."""
    low = LOWER_TABLE[data]
    return np.where((low >= 0x61) & (low <= 0x7A) | (low >= 0x80), low, 0x20).astype(np.uint8)


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton of ``text``; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Parser(NamedTuple):
    """The automata as one table: class of each byte, next state times two (odd when a phrase ends before the byte), first state of each language."""

    classes: np.ndarray
    table: np.ndarray
    first: np.ndarray
    bits: np.ndarray


@lru_cache(maxsize=2)
def parser(samples: Samples) -> Parser:
    """Where a state has no step for a byte, the phrase ends and the next one starts with that byte."""
    parts = [symbols_of(np.frombuffer(t, np.uint8)).tobytes() for t in samples.texts]
    known = sorted(set(b"".join(parts)))
    classes = np.zeros(256, np.uint8)                  # class 0: bytes that no sample holds
    classes[known] = np.arange(1, len(known) + 1)
    width = len(known) + 1
    tables, first, at = [], [], 0
    for part in parts:
        states = suffix_automaton(part)
        root = np.full(width, 2 * at + 1, np.int32)    # a byte of its own is a phrase; the next one starts anew
        for c, to in states[0].items():
            root[classes[c]] = 2 * (at + to) + 1
        table = np.tile(root, (len(states), 1))
        for s, steps in enumerate(states[1:], 1):      # at the start a phrase begins with any byte
            for c, to in steps.items():
                table[s, classes[c]] = 2 * (at + to)
        tables.append(table)
        first.append(at)
        at += len(states)
    table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
    return Parser(classes, table, np.array(first, np.int64), np.log2(np.array([len(p) for p in parts], float) + 1))


def phrases(p: Parser, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Phrases of each text (rows) against each language (columns); blocks of :data:`BLOCK` bytes are parsed on their own."""
    rows, langs, width = len(offsets) - 1, len(p.first), int(p.classes.max()) + 1
    out = np.zeros((rows, langs), np.int64)
    code = p.classes[symbols_of(data)]
    sizes = np.diff(offsets)
    n_blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(rows), n_blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    start = offsets[owner] + nth * BLOCK
    size = np.minimum(BLOCK, offsets[owner + 1] - start)
    order = np.argsort(-size, kind="stable")
    for a in range(0, len(order), AT_ONCE):
        own = order[a:a + AT_ONCE]
        at, left = start[own], size[own]
        state = np.repeat(p.first[:, None], len(own), axis=1)
        count = np.ones((langs, len(own)), np.int64)   # the last phrase of a block ends with it
        active = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), side="right")
        for i, n in enumerate(active):
            to = p.table[state[:, :n] * width + code[at[:n] + i]]
            if i:                                      # the first byte starts the first phrase, known or not
                count[:, :n] += to & 1
            state[:, :n] = to >> 1
        for j in range(langs):
            out[:, j] += np.bincount(owner[own], weights=count[j], minlength=rows).astype(np.int64)
    return out


def _predict(samples: Samples):
    def run(batches):
        p = parser(samples)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                n = chunk.rows
                letters = batch.column(2).slice(chunk.first, n).to_numpy(zero_copy_only=False).astype(bool)
                if len(samples.langs):
                    found = phrases(p, chunk.data, chunk.offsets)
                    cost = found * p.bits / np.maximum(np.diff(chunk.offsets), 1)[:, None]
                    best = cost.argmin(1)
                    weight = np.exp2(-SHARPNESS * (cost - cost.min(1, keepdims=True)))
                    score = np.where(letters, 1 / weight.sum(1), 0.0)
                    lang = [samples.langs[b] if own else "und" for b, own in zip(best.tolist(), letters.tolist())]
                else:
                    score, lang = np.zeros(n), ["und"] * n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, n), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])
    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text modulo 3 is 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     sample_bytes: int = SAMPLE_BYTES, language_bytes: int = LANGUAGE_BYTES) -> Samples:
    """A sample of the labelled texts of every language outside the held-out part.

    A language has ``language_bytes`` of sample, or an equal part of ``sample_bytes`` if there are many languages (at
    least one byte): different texts by the order of their hash, of each its first :data:`EXAMPLE_BYTES` bytes.  Which
    share of the hashes is drawn follows from an estimated count of each language's different texts, so that little
    more than the sample reaches the driver.  Rows without an id, a language or a letter teach nothing.
    """
    known = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("id").isNotNull() & ~held_out("id") & F.col("lang").isNotNull() & has_letter(F.col("text"))).select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = {r["lang"]: (r["n"], r["size"]) for r in known.groupBy("lang").agg(
        F.approx_count_distinct("h").alias("n"), F.avg(F.least(F.octet_length("text"), F.lit(EXAMPLE_BYTES))).alias("size")).collect()}
    if not sizes:
        return Samples((), ())
    each = max(1, min(language_bytes, sample_bytes // len(sizes)))
    # three times the texts that fill the sample: the count is an estimate and sizes vary
    share = {lang: min(1.0, (3 * each / max(size, 1) + 20) / max(n, 1)) for lang, (n, size) in sizes.items()}
    limits = df.sparkSession.createDataFrame([(lang, int(s * (2**63 - 1)) if s < 1 else 2**63 - 1) for lang, s in share.items()], "lang string, least long")
    drawn = (known.join(F.broadcast(limits), "lang").where(F.col("h").bitwiseAND(F.lit(2**63 - 1)) <= F.col("least"))
             .groupBy("lang", "h").agg(F.min(F.substring("text", 1, EXAMPLE_BYTES)).alias("text")))
    texts: dict[str, list[bytes]] = {lang: [] for lang in sizes}
    for lang, _, text in sorted(tuple(r) for r in drawn.select("lang", F.col("h").bitwiseAND(F.lit(2**63 - 1)), "text").collect()):
        texts[lang].append(text.encode()[:EXAMPLE_BYTES])
    langs = tuple(sorted(texts))
    return Samples(langs, tuple(b"\0".join(texts[lang])[:each] for lang in langs))


def predict_language(df: DataFrame, samples: Samples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` of every row, from its whole text alone.

    ``und`` with score 0 when the text is null or has no letter, or nothing was learned; ties go to the language that
    is first in code-point order.  The score (0 to 1) falls with the bits a byte by which other languages come close;
    with one learned language it is 1.  Rows that repeat are judged alike, an empty table gives no rows.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("letters")).mapInArrow(
        _predict(samples), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
