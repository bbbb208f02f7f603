"""Windows that repeat across a corpus: what suffix-array and suffix-tree dedup share.

Every window of ``size`` units (bytes or words) has an anchor: the leftmost of
its ``gram``-unit strings with the least hash.  Equal windows have equal
anchors at equal places, so all that can be equal meets under one anchor.  The
consecutive windows of one anchor occurrence make a segment; no two windows of
a segment are equal, as their anchor is at different places in them.

Segments are first grouped by hash alone.  An anchor with one segment needs no
text: its windows occur as often as the segment.  Only the segments of anchors
that have several different ones are read again, one occurrence of each, and
compared.  Anchors that occur once never leave the scan, except for the few
that a bit filter lets through, whose width follows the number of the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bits import BitFilter
from strata.llm.text import NON_SPACE, U, Chunk, Sums, Words, between, byte_sums, chunks, mix, rolling, sliding, words
from strata.session import stored

#: Bits of a filter per value, and the widest filter.
BITS_PER_VALUE, MOST_BITS = 16, 28
#: Texts of so many bytes are cut to windows at once (a window of bytes costs some 100 bytes of arrays).
SCAN_BYTES = 1 << 18
#: Segments of about so many bytes are compared at once in a task; an anchor with more is split by its windows.
GROUP_BYTES = 1 << 19


class Unit(NamedTuple):
    """What windows are made of: their number of units, and the length of the anchor strings."""

    kind: str
    size: int
    gram: int


class Sequence(NamedTuple):
    """Units of a chunk: two sums for hashes, row of each unit, byte range of each unit."""

    sums: Sums
    more: Sums | None
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


_SALT = U(0xA0761D6478BD642F)


def sequence(chunk: Chunk, kind: str, two: bool = False) -> Sequence:
    """Units of ``chunk``; the second sums only where ``two`` asks for them."""
    if kind == "bytes":
        n = len(chunk.data)
        at = np.arange(n)
        return Sequence(byte_sums(chunk.data), byte_sums(chunk.data, True) if two else None,
                        np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets)), at, at + 1)
    w: Words = words(chunk, NON_SPACE, False)
    return Sequence(rolling(w.hash), rolling(w.more, True) if two else None, w.row, w.start, w.end)


def sliding_least(values: np.ndarray, m: int) -> np.ndarray:
    """Least of every ``m`` consecutive values."""
    n = len(values) - m + 1
    whole = -(-len(values) // m) * m
    padded = np.full(whole, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, m)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[m - 1:m - 1 + n])


class Segments(NamedTuple):
    """Anchor occurrences of a chunk: anchor hash, its unit, first and last window that it governs."""

    anchor: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def segments(s: Sequence, unit: Unit) -> Segments:
    size, k = unit.size, unit.gram
    n = len(s.row) - size + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Segments(none.view(U), none, none, none)
    h = sliding(s.sums, k)
    least = sliding_least((h & U(0xFFFFFFFF00000000)) | np.arange(len(h)).astype(U), size - k + 1) & U(0xFFFFFFFF)
    window = np.flatnonzero(s.row[:n] == s.row[size - 1:])
    at = least[window].astype(np.int64)
    if not len(at):
        return Segments(none.view(U), none, none, none)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    low = window[new]
    high = window[np.append(np.flatnonzero(new)[1:] - 1, len(window) - 1)]
    # scrambled once more: anchors are the least hashes of their windows, and partitions and filters want even ones
    return Segments(mix(h[at[new]] ^ _SALT), at[new], low, high)


def _anchors(unit: Unit):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(0), SCAN_BYTES):
                token, n = np.unique(segments(sequence(chunk, unit.kind), unit).anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["anchor", "n"])
    return run


def _places(unit: Unit, keep: BitFilter):
    """Segments whose anchor the filter holds: row's columns but the text, anchor, hashes, first window, windows."""
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(batch.num_columns - 1), SCAN_BYTES):
                s = sequence(chunk, unit.kind, two=True)
                found = _own_segments(s, unit, keep)
                if not found:
                    continue
                anchor, s1, s2, low, end = found
                row = s.row[low]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(pa.array(row + chunk.first)) for i in range(batch.num_columns - 1)),
                     *(pa.array(x.view(np.int64)) for x in (anchor, s1, s2)), pa.array(low - np.searchsorted(s.row, row)),
                     pa.array((end - low - unit.size + 1).astype(np.int32))],
                    [*batch.schema.names[:-1], "anchor", "s1", "s2", "low", "windows"])
    return run


def _own_segments(s: Sequence, unit: Unit, keep: BitFilter):
    g = segments(s, unit)
    own = np.flatnonzero(keep.holds(g.anchor))
    if not len(own):
        return None
    anchor, at, low, high = (x[own] for x in g)
    end = high + unit.size
    place = ((high - low).astype(U) << U(32)) | (at - low).astype(U)
    return anchor, mix(between(s.sums, low, end) ^ mix(place)), mix(between(s.more, low, end) + place), low, end


def _contents(unit: Unit, keep: BitFilter, wanted: BitFilter):
    """anchor, s1, s2, content of the segments whose hash the filter ``wanted`` holds, once per chunk."""
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(0), SCAN_BYTES):
                s = sequence(chunk, unit.kind, two=True)
                found = _own_segments(s, unit, keep)
                if not found:
                    continue
                anchor, s1, s2, low, end = found
                _, pick = np.unique(s1, return_index=True)
                pick = pick[wanted.holds(mix(s1[pick] ^ s2[pick]))]
                raw = chunk.data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[pick].view(np.int64)) for x in (anchor, s1, s2)), pa.array([raw[a:b] for a, b in zip(s.start[low[pick]], s.end[end[pick] - 1])], pa.binary())],
                    ["anchor", "s1", "s2", "content"])
    return run


class Found(NamedTuple):
    """Segments of anchors that may occur twice: where they are, the different ones, and the filter of their anchors."""

    places: DataFrame
    distinct: DataFrame
    keep: BitFilter


def find_segments(docs: DataFrame, unit: Unit) -> Found:
    """``places``: id, h, anchor, s1, s2, low, windows.  ``distinct``: anchor, s1, s2, n, first (id, h, low), windows, kinds (segments of the anchor)."""
    shared = stored(docs.select("text").mapInArrow(_anchors(unit), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"),
                    "shared-anchors")
    keep = BitFilter.of(shared, "anchor", BITS_PER_VALUE, MOST_BITS)
    kind = docs.schema["id"].dataType.simpleString()
    places = stored(docs.select("id", "h", "text").mapInArrow(
        _places(unit, keep), f"id {kind}, h long, anchor long, s1 long, s2 long, low long, windows int"), "places")
    each = stored(places.groupBy("anchor", "s1", "s2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "low")).alias("first"), F.first("windows").alias("windows")), "segments")
    kinds = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all")).where("all > 1")
    return Found(places, stored(each.join(kinds.select("anchor", "kinds"), "anchor"), "distinct-segments"), keep)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, h, text``: a document is known by its id and the hash of its text."""
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


class Group(NamedTuple):
    """Different segments that are compared together, in one chunk row each."""

    anchor: np.ndarray
    s1: np.ndarray
    s2: np.ndarray
    n: np.ndarray
    windows: np.ndarray
    first: list
    chunk: Chunk


def _group(rows: list[pa.RecordBatch]) -> Group:
    column = {name: pa.chunked_array([r.column(i) for r in rows]).combine_chunks() for i, name in enumerate(rows[0].schema.names)}
    raw = column["content"].to_pylist()
    chunk = Chunk(0, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    return Group(*(column[c].to_numpy(zero_copy_only=False) for c in ("anchor", "s1", "s2", "n", "windows")), column["first"].to_pylist(), chunk)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    """Rows sorted by anchor, in groups of whole anchors that stay below :data:`GROUP_BYTES` (or have one anchor)."""
    held, size, anchor_rows, anchor_size, last = [], 0, [], 0, None
    for batch in batches:
        anchors = batch.column("anchor").to_numpy(zero_copy_only=False)
        if not len(anchors):
            continue
        cuts = [0, *(np.flatnonzero(anchors[1:] != anchors[:-1]) + 1), len(anchors)]
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("content")).to_numpy(zero_copy_only=False))])
        for a, b in zip(cuts, cuts[1:]):
            if anchors[a] != last:
                if held and size + anchor_size > GROUP_BYTES:
                    yield _group(held)
                    held, size = [], 0
                held, size, anchor_rows, anchor_size, last = held + anchor_rows, size + anchor_size, [], 0, anchors[a]
            anchor_rows.append(batch.slice(a, b - a))
            anchor_size += int(sizes[b] - sizes[a])
    if held and size + anchor_size > GROUP_BYTES:
        yield _group(held)
        held = []
    if held or anchor_rows:
        yield _group(held + anchor_rows)


GROUP_COLUMNS = ["anchor", "s1", "s2", "n", "first", "windows", "content"]
Judge = Callable[[Group], list]


def _judged(judge: Judge):
    """``s1, s2, spans`` of every segment that has removed units: pairs of unit offsets from the segment's start."""
    def run(batches):
        for group in groups(batches):
            spans = judge(group)
            own = np.array([i for i, s in enumerate(spans) if len(s)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.s1[own]), pa.array(group.s2[own]), pa.array([np.ravel(spans[i]) for i in own], pa.list_(pa.int32()))], ["s1", "s2", "spans"])
    return run


def runs(inside: np.ndarray, size: int) -> np.ndarray:
    """Unit ranges that the windows marked in ``inside`` cover, as rows of (start, end)."""
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + size - 1
    if not len(start):
        return np.zeros((0, 2), np.int64)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return np.stack([start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]], axis=1)


def _window_hashes(unit: Unit):
    """Every window of the given segments: its two hashes, its segment and place."""
    def run(batches):
        for batch in batches:
            group = _group([batch])
            row = np.repeat(np.arange(group.chunk.rows), group.windows)
            s = sequence(group.chunk, unit.kind, two=True)
            place = np.arange(len(row)) - np.repeat(np.cumsum(group.windows) - group.windows, group.windows)
            start = np.searchsorted(s.row, np.arange(group.chunk.rows))[row] + place
            for a in range(0, len(row), 1 << 16):
                cut = slice(a, a + (1 << 16))
                w1, w2 = (between(x, start[cut], start[cut] + unit.size).view(np.int64) for x in (s.sums, s.more))
                pick = pa.array(row[cut])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1), pa.array(w2), *(pa.array(x[row[cut]]) for x in (group.s1, group.s2, group.n)), pa.array(place[cut].astype(np.int32)),
                     batch.column("first").take(pick), pa.array(group.windows[row[cut]])], ["w1", "w2", "s1", "s2", "n", "place", "first", "windows"])
    return run


def _covered(size: int):
    def run(batches):
        for batch in batches:
            out = []
            for n, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                inside = np.zeros(n, bool)
                inside[places] = True
                out.append(np.ravel(runs(inside, size)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["s1", "s2", "spans"])
    return run


def judged_segments(docs: DataFrame, found: Found, unit: Unit, judge: Judge, earliest: bool, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``s1, s2, spans``: the units of each different segment that go (of its first occurrence, if ``earliest``).

    The only segment of an anchor goes whole if it occurs twice (its first occurrence stays if ``earliest``).  Anchors
    with up to ``group_bytes`` of different segments are judged in a task; the windows of larger ones are dealt out by
    their own hash and counted by a grouped aggregate, so no anchor is ever one task's whole work.
    """
    whole = F.array(F.lit(0), F.col("windows") + F.lit(unit.size - 1))
    alone = found.distinct.where("kinds = 1").select("s1", "s2", whole.alias("spans"))
    if earliest:
        alone = alone.limit(0)
    several = found.distinct.where("kinds > 1").drop("kinds")
    wanted = BitFilter.of(several.select(F.col("s1").bitwiseXOR(F.col("s2")).alias("key")), "key", BITS_PER_VALUE, MOST_BITS, scramble=True)
    content = docs.select("text").mapInArrow(_contents(unit, found.keep, wanted), "anchor long, s1 long, s2 long, content binary")
    text = content.groupBy("anchor", "s1", "s2").agg(F.first("content").alias("content"))
    distinct = stored(several.join(text, ["anchor", "s1", "s2"]), "different-segments")
    large = stored(distinct.groupBy("anchor").agg(F.sum(F.octet_length("content")).alias("bytes")).where(F.col("bytes") > group_bytes).select("anchor"), "large-anchors")
    if large.limit(1).count():
        usual, rest = distinct.join(large, "anchor", "left_anti"), distinct.join(large, "anchor", "left_semi")
    else:
        usual, rest = distinct, None
    usual = usual.repartition("anchor").sortWithinPartitions("anchor").select(*GROUP_COLUMNS)
    spans = alone.union(usual.mapInArrow(_judged(judge), "s1 long, s2 long, spans array<int>"))
    if rest is None:
        return spans
    first = distinct.schema["first"].dataType.simpleString()
    each = stored(rest.select(*GROUP_COLUMNS).mapInArrow(
        _window_hashes(unit), f"w1 long, w2 long, s1 long, s2 long, n long, place int, first {first}, windows int"), "windows")
    own = F.struct("first.id", "first.h", (F.col("first.low") + F.col("place")).alias("low"))
    total = each.groupBy("w1", "w2").agg(F.sum("n").alias("total"), F.min(own).alias("least")).where("total > 1")
    gone = each.join(stored(total, "repeated-windows"), ["w1", "w2"]).where(own != F.col("least") if earliest else F.lit(True))
    listed = gone.groupBy("s1", "s2").agg(F.first("windows").alias("windows"), F.collect_list("place").alias("places"))
    return spans.union(listed.select("s1", "s2", "windows", "places").mapInArrow(_covered(unit.size), "s1 long, s2 long, spans array<int>"))


def cut_found(docs: DataFrame, gone: DataFrame, cut, shape: str) -> DataFrame:
    """Rows that ``cut`` (over id, text, found) makes of ``docs``; ``gone``: own_id, own_h, found of the texts that lose units.

    Only rows whose text may lose units travel to the join; a bit filter on the texts' hashes tells which.
    """
    gone = stored(gone, "removed")
    bits = BitFilter.of(gone.select("own_h"), "own_h", BITS_PER_VALUE, MOST_BITS)
    some = docs.mapInArrow(bits.rows(1), f"id {docs.schema['id'].dataType.simpleString()}, h long, text string")
    joined = some.join(gone, some.id.eqNullSafe(gone.own_id) & (some.h == gone.own_h), "left").select("id", "text", "found")

    def rest(batches):                                 # filter and cut in one Python worker a task
        for batch in bits.rows(1, False)(batches):
            none = pa.nulls(batch.num_rows, pa.list_(pa.null()))
            yield from cut([pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), none], ["id", "text", "found"])])

    return joined.mapInArrow(cut, shape).union(docs.mapInArrow(rest, shape))
