"""N-gram Jaccard join by T-occurrence search.

Equal shingle sets collapse to one, known by a 128-bit fingerprint.  Sets that
can reach the similarity share a token of their prefixes (tokens in one global
order, frequent ones last).  Within a prefix bucket a count signature, longer
for larger sets, bounds the overlap from above; what passes joins sets to
families, so each set's shingles travel once, to its family.  There a T-occurrence search finds
the sets that share enough shingles: DivideSkip merges the short inverted lists
with a heap and probes the long ones by binary search.  Sets once reached leave
the index, so a family of copies costs about one search each, never its pairs.

A family beyond ``block_tokens`` is searched block against block instead of in
one task; a bucket beyond ``bucket_rows`` is joined as a whole by one star.
Both lose no link.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bits import BitFilter
from strata.llm.graph import connected_components
from strata.llm.text import NON_SPACE, U, Chunk, between, bounds, chunks, grams, mix, rolling, ship, words
from strata.session import stored

#: Least and most slots of the count signature, and the shingles a slot from which there are twice as many slots: slots
#: that most unrelated sets fill to the same count would bound nothing, and sets that share a token by chance made one family.
SLOTS, MOST_SLOTS, PER_SLOT = 128, 1 << 13, 8
#: Frequent tokens that are told apart in the global order.
FREQUENT = 1 << 18
#: Tokens counted at once in a task; a token is reported as frequent from so many documents among them.
COUNT_AT_ONCE, REPORT_FROM = 1 << 20, 4
#: Most that a slot of a signature counts; bits of a filter per value, and the widest filter.
MOST_COUNT, BITS_PER_VALUE, MOST_BITS = 15, 16, 28
#: Bytes of signatures that a batch holds, or that are compared at once.
SIGNATURE_BYTES = 1 << 22


def shingle_sets(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, by row then hash; fewer than ``k`` words are one shingle."""
    w = words(chunk, NON_SPACE, True)
    first, h = grams(w, k)
    row = w.row[first]
    at = bounds(w.row, chunk.rows)
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < k))
    if len(short):
        row = np.concatenate([row, short])
        h = np.concatenate([h, between(rolling(w.hash), at[short], at[short + 1])])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def fingerprints(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums per row that do not depend on order."""
    at = bounds(row, rows)
    out = []
    for salt in (U(0x5851F42D4C957F2D), U(0xD1342543DE82EF95)):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h ^ salt))])
        out.append(mix((sums[at[1:]] - sums[at[:-1]]) ^ np.diff(at).astype(U)))
    return out[0], out[1]


def _frequent(k):
    """(token, documents) of the tokens that many documents of a task hold."""
    def flush(held):
        if held:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= REPORT_FROM
            yield pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(n[many])], ["token", "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                h = shingle_sets(chunk, k)[1]
                held.append(h)
                size += len(h)
                if size >= COUNT_AT_ONCE:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)
    return run


def least_overlap(n, num: int, den: int):
    """Least shingles that a set of ``n`` shares with any set it links to."""
    return -(-num * n // den)


def slots(n: np.ndarray) -> np.ndarray:
    """Slots of the signature of a set of ``n`` shingles: a power of two."""
    wanted = np.maximum(-(-np.asarray(n) // PER_SLOT), SLOTS)
    return np.minimum(1 << np.ceil(np.log2(wanted)).astype(np.int64), MOST_SLOTS)


def signatures(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each row of ``n`` shingles, how many have their hash in each slot, up to MOST_COUNT; two slots a byte."""
    own = slots(n)
    at = np.concatenate([[0], np.cumsum(own)])
    counts = np.bincount(at[row] + (h & (own[row] - 1).astype(U)).astype(np.int64), minlength=at[-1])
    counts = np.minimum(counts, MOST_COUNT).astype(np.uint8)
    packed = counts[::2] << 4 | counts[1::2]
    return [packed[a:b].tobytes() for a, b in zip(at[:-1] // 2, at[1:] // 2)]


class Signatures:
    """Count signatures of some sets, and upper bounds of the shingles that two of them share."""

    def __init__(self, packed: list[bytes], n: np.ndarray):
        self.n, self.slots = n, 2 * np.array([len(x) for x in packed], np.int64)
        self.place, self.counts, self.excess = np.zeros(len(n), np.int64), {}, np.zeros(len(n), np.int64)
        for size in np.unique(self.slots):
            own = np.flatnonzero(self.slots == size)
            raw = np.frombuffer(b"".join(packed[i] for i in own), np.uint8).reshape(len(own), -1)
            counts = np.empty((len(own), size), np.uint8)
            counts[:, ::2], counts[:, 1::2] = raw >> 4, raw & 15
            self.place[own], self.counts[size] = np.arange(len(own)), counts
            self.excess[own] = n[own] - counts.sum(1, dtype=np.int64)

    def bound(self, q: int, others: np.ndarray) -> np.ndarray:
        """For each of ``others``, a number that the shingles it shares with ``q`` cannot exceed."""
        out, fine = np.zeros(len(others), np.int64), self.slots[q]
        mine = self.counts[fine][self.place[q]].astype(np.int64)
        for size in np.unique(self.slots[others]):
            own = np.flatnonzero(self.slots[others] == size)
            coarse = min(size, fine)
            one = mine.reshape(-1, coarse).sum(0)      # slots i, i + coarse, ... are slot i of a signature of ``coarse`` slots
            step = max(1, SIGNATURE_BYTES // int(size))
            for a in range(0, len(own), step):
                part = others[own[a:a + step]]
                counts = self.counts[size][self.place[part]]
                if size > coarse:
                    counts = counts.reshape(len(part), -1, coarse).sum(1, dtype=np.int16)
                out[own[a:a + step]] = np.minimum(counts, one.astype(counts.dtype) if size == fine else one).sum(1, dtype=np.int64)
            # what slots do not count is in slots full on both sides if they are the same ones, else anywhere
            excess = self.excess[others[own]]
            out[own] += np.minimum(excess, self.excess[q]) if size == fine else excess + self.excess[q]
        return out


def _profiles(k, num, den, tokens, ranks, common=None, signed=True):
    """Size, fingerprint, prefix and (if ``signed``) count signature of every row's set.

    Prefixes take tokens in the order of (rank, hash): the frequent ones by their count at the end, before them those
    of the bit filter ``common``, first all others.
    """
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                row, h = shingle_sets(chunk, k)
                f1, f2 = fingerprints(row, h, chunk.rows)
                n = np.bincount(row, minlength=chunk.rows)
                rank = np.zeros(len(h), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                    rank = np.where(tokens[at] == h, ranks[at], 0)
                if common is not None:
                    rank = np.maximum(rank, common.holds(mix(h)))
                signature = signatures(row, h, n) if signed else [b""] * chunk.rows
                ordered = h[np.lexsort((h, rank, row))]
                at = bounds(row, chunk.rows)
                prefix = [ordered[a:a + p].tobytes() for a, p in zip(at, np.where(n > 0, n - least_overlap(n, num, den) + 1, 0))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     pa.array(prefix, pa.binary()), pa.array(signature, pa.binary())],
                    ["doc", "n", "f1", "f2", "prefix", "signature"])
    return run


def _longs(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _prefix_tokens(keep):
    """(token, set) rows of the prefixes; equal sets of a task count once.  ``keep``: bit filter of wanted tokens."""
    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            n, f1, f2 = (_longs(batch.column(i)) for i in (0, 1, 2))
            prefixes, signature = batch.column(3), batch.column(4)
            widest = max(1, pc.max(pc.binary_length(signature)).as_py() or 0) if keep is not None and len(n) else 1
            for lo in range(0, len(n), 512):
                owner, tokens = [], []
                for i in range(lo, min(lo + 512, len(n))):
                    if (f1[i], f2[i]) in seen:
                        continue
                    seen.add((f1[i], f2[i]))
                    own = mix(np.frombuffer(prefixes[i].as_py(), U))   # prefixes hold the least hashes; buckets want even ones
                    if keep is not None:
                        own = own[keep.holds(own)]
                    tokens.append(own)
                    owner.append(np.full(len(own), i))
                if not owner:
                    continue
                token, owner = np.concatenate(tokens).view(np.int64), np.concatenate(owner)
                step = max(1, SIGNATURE_BYTES // widest) if keep is not None else max(1, len(owner))
                for a in range(0, len(owner), step):
                    own = owner[a:a + step]
                    out = [pa.array(token[a:a + step]), pa.array(f1[own]), pa.array(f2[own])]
                    if keep is not None:
                        out += [pa.array(n[own]), signature.take(pa.array(own))]
                    yield pa.RecordBatch.from_arrays(out, ["token", "f1", "f2", "n", "signature"][:len(out)])
    return run


def _rough_tokens(k, num, den, tokens, ranks):
    """(token, set) rows of the first round's prefixes, in one Python worker a task."""
    profiles, prefixes = _profiles(k, num, den, tokens, ranks, signed=False), _prefix_tokens(None)

    def run(batches):
        yield from prefixes(batch.select(["n", "f1", "f2", "prefix", "signature"]) for batch in profiles(batches))
    return run


def _groups(batches, key: int):
    """Rows of equal ``key`` (consecutive over batches) as one table at a time."""
    held = []
    for batch in batches:
        keys = _longs(batch.column(key))
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and _longs(held[0].column(key).slice(0, 1))[0] != keys[a]:
                yield held
                held = []
            held.append(part)
    if held:
        yield held


def _may_link(num, den):
    """Edges (a, b) of a spanning forest of the sets of each bucket whose overlap bound reaches the similarity."""
    def run(batches):
        a_out, b_out = [], []
        for parts in _groups(batches, 0):
            f1 = np.concatenate([_longs(p.column(1)) for p in parts])
            f1, pick = np.unique(f1, return_index=True)
            if len(f1) < 2:
                continue
            n = np.concatenate([_longs(p.column(3)) for p in parts])[pick]
            packed = [x for p in parts for x in p.column(4).to_pylist()]
            signed = Signatures([packed[i] for i in pick], n)
            left = np.arange(len(f1))
            while len(left) > 1:
                queue, left = [left[0]], left[1:]
                root = queue[0]
                while queue and len(left):
                    q = queue.pop()
                    near = num * np.maximum(n[left], n[q]) <= den * np.minimum(n[left], n[q])   # others differ too much in size
                    bound = signed.bound(q, left[near])
                    near[near] = bound * (num + den) >= num * (n[left[near]] + n[q])
                    found = left[near]
                    queue += list(found)
                    left = left[~near]
                    a_out += list(f1[found])
                    b_out += [f1[root]] * len(found)
            if len(a_out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])
                a_out, b_out = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])
    return run


class OccurrenceIndex:
    """Inverted lists of some sets for T-occurrence search; sets can be taken out."""

    #: Weight of a binary probe against a heap step, as in the split into short and long lists.
    PROBE = 0.02

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.lists = owner[np.argsort(ids, kind="stable")]
        self.starts = np.searchsorted(np.sort(ids), np.arange(len(tokens) + 1))
        own = np.diff(self.starts)[ids] > 1            # a token of one set alone finds nothing
        self.tokens = np.split(ids[own], np.cumsum(np.bincount(owner[own], minlength=len(sets)))[:-1])
        self.left = np.ones(len(sets), bool)

    def take(self, i) -> None:
        self.left[i] = False

    def search(self, q: int, num: int, den: int) -> np.ndarray:
        """Sets still in the index whose Jaccard similarity to set ``q`` is at least ``num / den``."""
        least = int(least_overlap(self.sizes[q], num, den))
        none = np.zeros(0, np.int64)
        # the query's lists end to end, without the sets already taken out
        tokens = self.tokens[q]
        lengths = self.starts[tokens + 1] - self.starts[tokens]
        number = np.repeat(np.arange(len(tokens)), lengths)
        member = self.lists[np.arange(len(number)) + np.repeat(self.starts[tokens] - np.cumsum(lengths) + lengths, lengths)]
        own = self.left[member]
        number, member = number[own], member[own]
        lengths = np.bincount(number, minlength=len(tokens))
        full = np.flatnonzero(lengths)
        if len(full) < least:
            return none
        by_length = full[np.argsort(lengths[full], kind="stable")]
        n_long = min(int(least / (self.PROBE * np.log2(lengths[by_length[-1]] + 1) + 1)), least - 1)
        long = np.zeros(len(tokens), bool)
        long[by_length[len(by_length) - n_long:]] = True
        probed = long[number]
        short = np.split(member[~probed], np.cumsum(lengths[full][~long[full]])[:-1])
        held, counts = [], []
        for i, same in groupby(heapq.merge(*(x.tolist() for x in short))):
            n = sum(1 for _ in same)
            if n >= least - n_long:
                held.append(i)
                counts.append(n)
        if not held:
            return none
        held, counts = np.array(held, np.int64), np.array(counts, np.int64)
        # each long list is sorted, and so are all of them with the list's number in front
        span = len(self.sizes)
        keys, starts = number[probed] * span + member[probed], np.flatnonzero(long) * span
        for a in range(0, len(starts), 4096):
            want = starts[a:a + 4096, None] + held
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            counts += (keys[at] == want).sum(0)
        return held[counts * (num + den) >= num * (self.sizes[held] + self.sizes[q])]


def link_sets(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """For each set the first set of its group of linked sets."""
    index, root = OccurrenceIndex(sets), np.arange(len(sets))
    for start in range(len(sets)):
        if not index.left[start]:
            continue
        index.take(start)
        queue = [start]
        while queue:
            found = index.search(queue.pop(), num, den)
            index.take(found)
            root[found] = start
            queue += list(found)
    return root


def _link(num, den):
    """Edges (a, b) between the sets of each family and the first of their group."""
    def run(batches):
        for parts in _groups(batches, 0):
            f1 = np.concatenate([_longs(p.column(1)) for p in parts])
            f1, pick = np.unique(f1, return_index=True)
            raw = [x for p in parts for x in p.column(2).to_pylist()]
            root = link_sets([np.frombuffer(raw[i], U) for i in pick], num, den)
            own = root != np.arange(len(f1))
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array(f1[own]), pa.array(f1[root[own]])], ["a", "b"])
    return run


def _payload(k):
    """Shingles of the chosen rows, checked against the set they stand for."""
    def run(batches):
        for batch in batches:
            want = _longs(batch.column(1))
            for chunk in chunks(batch.column(0)):
                row, h = shingle_sets(chunk, k)
                f1, _ = fingerprints(row, h, chunk.rows)
                at = bounds(row, chunk.rows)
                same = np.flatnonzero(f1.view(np.int64) == want[chunk.first:chunk.first + chunk.rows])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(pa.array(same + chunk.first)) for i in range(1, batch.num_columns)),
                     pa.array([h[at[i]:at[i + 1]].tobytes() for i in same], pa.binary())], [*batch.schema.names[1:], "shingles"])
    return run


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100,
                       bucket_rows: int = 20_000, block_tokens: int = 1_000_000) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row: links are shingle sets of Jaccard similarity ``num / den`` or more.

    Words are runs of anything but ASCII space, A-Z lower-cased; shingles are ``k`` words, a shorter text is one shingle.
    ``component_id`` is the smallest id that links reach; a text without words (null, empty) is linked with nothing and
    has its own id.  Rows with equal sets are linked, rows that repeat too.  A row without an id is linked like any other
    but names no component (null if no row of it has an id).  An empty table gives no rows.  Shingles are 64-bit hashes.
    """
    spark = df.sparkSession
    ship(spark)
    kind = df.schema[id_col].dataType.simpleString()
    # a row is known by a hash of its id and text; rows equal in both are one
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col)).alias("doc"), F.col(text_col).alias("text"))
    frequent = (docs.select("text").mapInArrow(_frequent(k), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
                .orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow())
    tokens, ranks = (frequent.column(i).to_numpy().astype(t) for i, t in ((0, np.int64), (1, np.int64)))
    tokens = tokens.view(U)
    order = np.argsort(tokens)
    tokens, ranks = tokens[order], ranks[order]

    pair = f"struct<id:{kind},doc:long>"
    columns = "n long, f1 long, f2 long, prefix binary, signature binary"

    def shared_tokens(rows: DataFrame, which) -> DataFrame:
        return rows.groupBy("token").agg(F.min(which).alias("low"), F.max(which).alias("high")).where("low <> high").select("token")

    # Words that meet by chance make shared tokens too, more than in proportion to the input.  A first round of prefixes
    # finds shared tokens; the second puts them behind the others, which leaves the buckets to sets that share much.
    # The first round only steers the order, so there 15 bits tell sets apart; they compress to a few bytes a row.
    token_rows = "token long, f1 long, f2 long"
    rough = docs.select("doc", "text").mapInArrow(_rough_tokens(k, num, den, tokens, ranks), token_rows)
    common = BitFilter.of(stored(shared_tokens(rough, F.shiftrightunsigned("f1", 49).cast("short")), "common-tokens"), "token", BITS_PER_VALUE, MOST_BITS)
    profiles = stored(docs.select(F.struct("id", "doc").alias("doc"), "text").mapInArrow(
        _profiles(k, num, den, tokens, ranks, common), f"doc {pair}, {columns}").select("doc.*", "n", "f1", "f2", "prefix", "signature"), "profiles")
    sets = profiles.where("n > 0").select("n", "f1", "f2", "prefix", "signature")
    shared = stored(shared_tokens(sets.mapInArrow(_prefix_tokens(None), token_rows), F.col("f1")), "shared-tokens")
    held = BitFilter.of(shared, "token", BITS_PER_VALUE, MOST_BITS)
    # only tokens that several sets share are described further; tokens that the same sets hold give the same bucket, one of them is enough
    described = sets.mapInArrow(_prefix_tokens(held), "token long, f1 long, f2 long, n long, signature binary").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min("f1").alias("low"), F.max("f1").alias("high"),
        F.sum(F.expr("f2 & 4294967295")).alias("s1"), F.sum(F.expr("shiftrightunsigned(f2, 32)")).alias("s2")).where("low <> high")
    buckets = stored(described.groupBy("n", "low", "high", "s1", "s2").agg(F.min("token").alias("token")).select("token", "n"), "buckets")
    keep = BitFilter.of(buckets, "token", BITS_PER_VALUE, MOST_BITS)
    members = sets.mapInArrow(_prefix_tokens(keep), "token long, f1 long, f2 long, n long, signature binary").join(
        buckets.select("token", F.col("n").alias("rows")), "token")
    usual = members.where(F.col("rows") <= bucket_rows).select("token", "f1", "f2", "n", "signature").repartition("token").sortWithinPartitions("token")
    edges = usual.mapInArrow(_may_link(num, den), "a long, b long")
    large = members.where(F.col("rows") > bucket_rows).select("token", "f1")
    star = large.join(large.groupBy("token").agg(F.min("f1").alias("b")), "token").select(F.col("f1").alias("a"), "b")
    families = stored(connected_components(stored(edges.union(star), "may-link")), "families")

    chosen = (profiles.select("f1", "doc", "n").join(families, profiles.f1 == families.node)
              .groupBy("f1", "component").agg(F.min("doc").alias("doc"), F.first("n").alias("n")))
    chosen = stored(chosen, "members")
    size = chosen.groupBy("component").agg(F.sum("n").alias("tokens"))
    blocks = F.ceil(F.col("tokens") / block_tokens).cast("int")
    placed = chosen.join(size.select("component", blocks.alias("blocks")), "component").withColumn(
        "block", F.pmod(F.xxhash64("f1"), F.col("blocks")).cast("int"))
    # only the texts that stand for a set of a family travel, each once
    wanted = BitFilter.of(chosen, "doc", BITS_PER_VALUE, MOST_BITS)
    texts = docs.select("doc", "text").mapInArrow(wanted.rows(0), "doc long, text string").groupBy("doc").agg(F.first("text").alias("text"))
    shingles = stored(texts.join(placed.select("doc", "f1", "component", "blocks", "block"), "doc")
                      .select("text", "f1", "component", "blocks", "block").mapInArrow(_payload(k), "f1 long, component long, blocks int, block int, shingles binary"),
                      "shingles")
    # block i meets block j in the task of (least, greatest); a family of one block has one task
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    task = F.when(F.col("blocks") == 1, F.col("component")).otherwise(F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")))
    dealt = shingles.select("*", others).select(task.alias("task"), "f1", "shingles").repartition("task").sortWithinPartitions("task")
    links = stored(dealt.mapInArrow(_link(num, den), "a long, b long"), "links")
    split = size.where(blocks > 1).limit(1).count() > 0
    groups = connected_components(links) if split else links.select(F.col("a").alias("node"), F.col("b").alias("component"))

    own = profiles.select("id", F.col("n").alias("n_shingles"), "f1", "f2").join(groups.withColumnRenamed("node", "f1"), "f1", "left").withColumn(
        "label", F.coalesce("component", "f1"))
    own = stored(own.select("id", "n_shingles", "label"), "labels")
    least = stored(own.where("n_shingles > 0").groupBy("label").agg(F.min("id").alias("component_id")), "least-ids")
    return own.join(least, "label", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df``, columns as they are, without those whose id is not the smallest of their component.

    Rows that repeat an id are one document: they stay or go together.  Rows without an id stay, as none can be told to
    stand for them.
    """
    found = similar_components(df, id_col, text_col, **options)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone")).distinct()
    return df.join(gone, df[id_col] == gone["gone"], "left_anti")
