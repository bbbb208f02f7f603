"""Suffix-array dedup of byte strings.

Candidate segments (see :mod:`strata.llm.repeats`) are cut into phrases after
every 8-byte string whose hash is 0 modulo 64, a rule that looks at those
bytes only, so equal bytes are cut alike.  The linear grouping construction
sorts the suffixes of the phrase sequence; a byte position is ordered by its
bytes up to the next cut and then by the rank of the phrase suffix there.
Windows that are equal stand side by side in that order, where their bytes are
compared by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.repeats import Group, Unit, find_segments, judged_segments, keyed, runs, sequence, cut_found
from strata.llm.text import U, between, ship, sliding

#: A phrase ends after every gram of so many bytes whose hash is 0 modulo CUT_EVERY.
CUT_GRAM, CUT_EVERY = 8, 64


def lyndon_groups(symbols: list[int]) -> tuple[list[list[int]], list[int], list[int]]:
    """Groups of suffixes by their Lyndon prefix in ascending order, group of each suffix, previous smaller suffix.

    Groups start as the suffixes of one symbol and are visited from the largest down.  The previous smaller suffix of
    a member is the nearest to its left that is in a lower group; those suffixes' prefixes end where the member's
    begin, so they move to new groups right above their own, those reached by more members above those by fewer.
    """
    n = len(symbols)
    values = np.asarray(symbols)
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    members: list[list[int]] = [part.tolist() for part in np.split(order, cuts)]
    group = (np.searchsorted(cuts, np.arange(n), side="right"))[np.argsort(order, kind="stable")].tolist()
    above, below = list(range(1, len(members))) + [-1], list(range(-1, len(members) - 1))
    smaller, done, out = [-1] * n, bytearray(n), []
    current = len(members) - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        members[current] = own
        out.append(current)
        for i in own:
            done[i] = 1
        reached, times, last = [], [], -1
        for i in own:                                   # ascending, so the suffixes reached ascend too
            p = i - 1
            while p >= 0 and done[p]:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                if p == last:
                    times[-1] += 1
                else:
                    reached.append(p)
                    times.append(1)
                    last = p
        if reached:
            most = max(times)
            by_times = {1: reached} if most == 1 else {}
            if most > 1:
                for p, t in zip(reached, times):
                    by_times.setdefault(t, []).append(p)
            for t in sorted(by_times, reverse=True):
                made: dict[int, int] = {}
                for p in by_times[t]:
                    old = group[p]
                    new = made.get(old)
                    if new is None:
                        new = made[old] = len(members)
                        members.append([])
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = new
                        below[up] = new
                    group[p] = new
                    members[new].append(p)
        current = below[current]
    return [members[g] for g in reversed(out)], group, smaller


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffixes of ``symbols`` in order; the last symbol must be the smallest and unique.

    The groups are in order; within one, suffixes are emitted in the order of what follows their Lyndon prefix: going
    through the array from its start, each suffix lets the one before it, and along the previous-smaller pointers
    those whose Lyndon prefix ends there too, take the next free place of their group.
    """
    n = len(symbols)
    groups, group, smaller = lyndon_groups(symbols)
    free, place = {}, 0
    for members in groups:
        if members:
            free[group[members[0]]] = place
            place += len(members)
    out, placed = [-1] * n, bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    free[group[n - 1]] += 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = smaller[s]
    return out


def repeated_windows(group: Group, size: int) -> np.ndarray:
    """For every window of the group's segments, whether its bytes occur twice (equal segments count as often as they occur)."""
    chunk = group.chunk
    s = sequence(chunk, "bytes", two=True)
    n = len(chunk.data)
    row = np.repeat(np.arange(chunk.rows), group.windows)
    start = chunk.offsets[row] + np.arange(len(row)) - np.repeat(np.cumsum(group.windows) - group.windows, group.windows)

    first = np.arange(max(n - CUT_GRAM + 1, 0))
    cut = (sliding(s.sums, CUT_GRAM) & U(CUT_EVERY - 1)) == 0
    cut &= s.row[:len(first)] == s.row[CUT_GRAM - 1:CUT_GRAM - 1 + len(first)]
    cuts = first[cut] + CUT_GRAM
    # one phrase sequence: the phrases of each segment, then 1; 0 at the very end
    begins = np.unique(np.concatenate([chunk.offsets[:-1], cuts]))
    begins = begins[begins < n]
    raw = chunk.data.tobytes()
    phrases = [raw[a:b] for a, b in zip(begins, np.append(begins[1:], n))]
    rank = {p: i + 2 for i, p in enumerate(sorted(set(phrases)))}
    place = np.arange(len(begins)) + np.searchsorted(chunk.offsets[1:], begins, side="right")
    symbols = np.ones(len(begins) + chunk.rows + 1, np.int64)
    symbols[place] = [rank[p] for p in phrases]
    symbols[-1] = 0
    order = suffix_array(symbols.tolist())
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))

    at = np.searchsorted(cuts, start + CUT_GRAM, side="left")
    following = np.append(cuts, n + size)[at]
    inside = following <= start + size
    head = np.where(inside, following, start + size)
    next_phrase = np.append(place, len(order) - 1)[np.searchsorted(begins, np.where(inside, following, 0), side="left")]
    tail = np.where(inside & (following < chunk.offsets[row + 1]), ranks[next_phrase], -1)
    order = np.lexsort((tail, between(s.sums, start, head)))
    w1, w2 = (between(x, start, start + size)[order] for x in (s.sums, s.more))
    new = np.ones(len(order), bool)
    new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
    begin = np.flatnonzero(new)
    total = np.add.reduceat(group.n[row[order]], begin) if len(begin) else np.zeros(0, np.int64)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(total > 1, np.diff(np.append(begin, len(order))))
    return out


def judge(size: int):
    def spans(group: Group) -> list:
        inside = repeated_windows(group, size)
        ends = np.cumsum(group.windows)
        return [runs(inside[b - k:b], size) for b, k in zip(ends, group.windows)]
    return spans


def _cut(batches):
    for batch in batches:
        kept, n_bytes, n_removed, n_spans, spans = [], [], [], [], []
        for text, found in zip(batch.column(1), batch.column(2)):
            text, found = text.as_py(), found.as_py()
            raw = (text or "").encode()
            mark = np.zeros(len(raw) + 1, np.int64)
            for part in found or ():
                for a, b in zip(part["spans"][::2], part["spans"][1::2]):
                    mark[part["low"] + a] += 1
                    mark[part["low"] + b] -= 1
            gone = np.cumsum(mark[:-1]) > 0
            kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            own = runs(gone, 1)
            n_bytes.append(len(raw))
            n_removed.append(int(gone.sum()))
            n_spans.append(len(own))
            spans.append([{"start": int(a), "end": int(b)} for a, b in own])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["id", "kept", "n_bytes", "n_removed", "n_spans", "spans"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 400, gram: int = 64, **options) -> DataFrame:
    """Every byte that a ``size``-byte string covers which also starts anywhere else goes, first occurrence included.

    ``id_col, kept (binary: the other bytes), n_bytes, n_removed, n_spans, spans`` (maximal removed runs) per row.  Texts are
    UTF-8 bytes, a null text none; strings never cross rows and are judged on the input.  Texts below ``size`` bytes lose
    nothing.  Rows that repeat are documents of their own, so a repeated row of ``size`` bytes or more loses all of them.
    """
    ship(df.sparkSession)
    unit = Unit("bytes", size, gram)
    docs = keyed(df, id_col, text_col)
    found = find_segments(docs, unit)
    spans = judged_segments(docs, found, unit, judge(size), False, **options)
    gone = found.places.select("id", "h", "s1", "s2", "low").join(spans, ["s1", "s2"]).groupBy("id", "h").agg(
        F.collect_list(F.struct("low", "spans")).alias("found")).withColumnsRenamed({"id": "own_id", "h": "own_h"})
    kind = docs.schema["id"].dataType.simpleString()
    return cut_found(docs, gone, _cut, f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>").withColumnRenamed("id", id_col)
