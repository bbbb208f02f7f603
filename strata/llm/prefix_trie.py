"""Prefix trie of conversations as a minimal-perfect-hash node table.

A node is the digest of a conversation's first turns: four polynomials of the
turns' hashes modulo the prime 2**31 - 1, so the digest at any depth follows
from sums over runs of turns, and no conversation has to be in one task.
Conversations are dealt out in shards of bounded size, cut at fixed depths.  A
shard enumerates its distinct digests, gives each the slot of a minimal
perfect hash (checked against the digest that the slot stores), scatters its
conversations' counts into flat arrays and adds them up through an array of
parent slots, deepest level first.  What shards found is added up by digest:
every figure of a node is a sum over conversations or over nodes that exactly
one conversation (the smallest through them) answers for, so a prefix that a
third of all conversations share is one slot in each shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import U, mix, ship
from strata.session import stored

PRIME = (1 << 31) - 1
#: Bases of the four polynomials.
BASES = (1_103_515_245, 1_566_083_941, 668_265_263, 1_812_433_253)
LANES = len(BASES)
#: Turns of a run, depth at which shards are cut, slots of a shard.
RUN, BAND, SHARD = 4096, 1024, 1 << 16
#: A conversation may borrow fewer than this many turns; conversations that share a lender.
BORROWED, FAMILY = 9, 5


def powers(n: int) -> np.ndarray:
    """Powers 0 to ``n`` of the bases, one row per lane."""
    out = np.ones((LANES, n + 1), U)
    for lane, base in enumerate(BASES):
        for i in range(1, n + 1):
            out[lane, i] = int(out[lane, i - 1]) * base % PRIME
    return out


def power(exponent: int) -> np.ndarray:
    return np.array([pow(b, exponent, PRIME) for b in BASES], U)


_POWERS = powers(RUN)


def lanes_of(hashes: list[bytes]) -> np.ndarray:
    """Turn hashes of 16 bytes as one number below the prime per lane."""
    return (np.frombuffer(b"".join(hashes), "<u4").reshape(-1, LANES).T % PRIME).astype(U)


def prefix_sums(lanes: np.ndarray) -> np.ndarray:
    """Polynomial of the first 0 to n turns of a run (at most :data:`RUN` turns), one column each."""
    n = lanes.shape[1]
    out = np.zeros((LANES, n + 1), U)
    np.cumsum(lanes * _POWERS[:, :n] % U(PRIME), axis=1, out=out[:, 1:])
    return out % U(PRIME)


class NodeTable:
    """Slots 0 to n - 1 for n distinct digests by hashing with fall-through levels; every lookup is checked."""

    def __init__(self, depth: np.ndarray, d1: np.ndarray, d2: np.ndarray):
        for salt in range(8):                          # digests that mix to one key are told apart by another salt
            self.salt = U(0x9E3779B97F4A7C15) * U(2 * salt + 1)
            keys, first = np.unique(self._key(depth, d1, d2), return_index=True)
            self._levels(keys)
            slot = self._slots(keys)
            self.depth, self.d1, self.d2 = (np.empty(len(keys), np.int64) for _ in range(3))
            for own, given in ((self.depth, depth), (self.d1, d1), (self.d2, d2)):
                own[slot] = given[first]
            if (self._checked(depth, d1, d2) >= 0).all():
                return
        raise ValueError("digests cannot be told apart")

    def _key(self, depth, d1, d2):
        return mix(mix(mix(d1.view(U) ^ self.salt) + d2.view(U)) ^ depth.view(U))

    def _levels(self, keys: np.ndarray) -> None:
        """Each level sets the bits that one key alone hashes to; the others go on to the next level."""
        self.bits, self.before, left, taken = [], [], keys, 0
        while len(left):
            size = max(2 * len(left), 8)
            at = (mix(left + U(len(self.bits))) % U(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            self.bits.append(alone)
            self.before.append(taken + np.cumsum(alone) - alone)
            taken += int(alone.sum())
            left = left[~alone[at]]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            at = (mix(keys[left] + U(level)) % U(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
        return out

    def _checked(self, depth, d1, d2) -> np.ndarray:
        slot = self._slots(self._key(depth, d1, d2))
        same = (slot >= 0) & (self.depth[slot] == depth) & (self.d1[slot] == d1) & (self.d2[slot] == d2)
        return np.where(same, slot, -1)

    def lookup(self, depth, d1, d2) -> np.ndarray:
        slot = self._checked(depth, d1, d2)
        if (slot < 0).any():
            raise ValueError("a digest is not in the table")
        return slot

    def climb(self, parent: np.ndarray, *sums: np.ndarray, least: np.ndarray | None = None) -> None:
        """Add each slot's ``sums`` to its parent's (and keep the ``least``), from the deepest level up; -1 is no parent."""
        order = np.argsort(-self.depth, kind="stable")
        levels = np.flatnonzero(np.diff(self.depth[order])) + 1
        for level in np.split(order, levels):
            own = level[parent[level] >= 0]
            up = parent[own]
            for values in sums:
                np.add.at(values, up, values[own])
            if least is not None:
                np.minimum.at(least, up, least[own])


def _runs(batches):
    """Consecutive turns of a conversation within a sorted partition, at most :data:`RUN` a row."""
    def flush(conv, seq, hashes, sizes):
        sums = prefix_sums(lanes_of(hashes))
        return (conv, seq, len(hashes), sum(sizes), *(int(x) for x in sums[:, -1]), b"".join(hashes), np.array(sizes, np.int64).tobytes())

    from pyspark import TaskContext
    seq = TaskContext.get().partitionId() << 32
    conv, hashes, sizes, out = None, [], [], []
    for batch in batches:
        for c, h, size in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
            if hashes and (c != conv or len(hashes) == RUN):
                out.append(flush(conv, seq, hashes, sizes))
                hashes, sizes, seq = [], [], seq + 1
                if len(out) >= 512:
                    yield _table(out, RUNS)
                    out = []
            conv = c
            hashes.append(h)
            sizes.append(size)
    if hashes:
        out.append(flush(conv, seq, hashes, sizes))
    yield _table(out, RUNS)


RUNS = "conv long, seq long, n long, size long, s0 long, s1 long, s2 long, s3 long, hashes binary, sizes binary"
PLACED = "conv long, seq long, at long, before long, p0 long, p1 long, p2 long, p3 long"
PIECES = "conv long, family long, band long, start long, before binary, digests binary, sizes binary, ahead long, len long, total long"
PARTIAL = "depth long, d1 long, d2 long, p1 long, p2 long, n long, ends long, conv long, weighted long, size long"
SHARES = "depth long, d1 long, d2 long, leaves long, distinct long"
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[tuple], shape: str) -> pa.RecordBatch:
    fields = [x.split() for x in shape.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, _KINDS[k]) for x, (_, k) in zip(list(zip(*rows)) or [()] * len(fields), fields)], [name for name, _ in fields])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _placed(batches):
    """For runs sorted by conversation and place: turns, bytes and polynomial before each."""
    conv, at, size, sums, out = None, 0, 0, np.zeros(LANES, U), []
    for c, seq, n, own, *s in _rows(batches):
        if c != conv:
            conv, at, size, sums = c, 0, 0, np.zeros(LANES, U)
        out.append((c, seq, at, size, *(int(x) for x in sums)))
        sums = (sums + np.array(s, U) * power(at) % U(PRIME)) % U(PRIME)
        at, size = at + n, size + own
        if len(out) >= 4096:
            yield _table(out, PLACED)
            out = []
    yield _table(out, PLACED)


def _heads(batches):
    """The first turns of a conversation that others may borrow: place, hash, bytes."""
    out = []
    for conv, at, hashes, sizes in _rows(batches):
        sizes = np.frombuffer(sizes, np.int64)
        for i in range(min(len(sizes), BORROWED - 1 - at)):
            out.append((conv, at + i, hashes[16 * i:16 * i + 16], int(sizes[i])))
    yield _table(out, "conv long, place long, hash binary, size long")


def _packed(sums: np.ndarray) -> np.ndarray:
    """Four lanes as two 64-bit digests, one row per column of ``sums``."""
    s = sums.astype(np.int64)
    return np.stack([(s[0] << 31) | s[1], (s[2] << 31) | s[3]], axis=1)


def _rebuilt(band: int):
    """Pieces of the rebuilt conversations, cut at multiples of ``band``: its borrowed turns, or a run of its own."""
    def cut(conv, family, start, sums, sizes, ahead, length, total):
        """``sums``: polynomials before and after each turn; ``ahead``: bytes before the first."""
        digests, n = _packed(sums), len(sizes)
        a = 0
        while a < n or n == 0 and a == 0 and start == 0:
            b = min(n, (start + a) // band * band + band - start)
            yield (conv, family, (start + a) // band, start + a, digests[a].tobytes(), digests[a + 1:b + 1].tobytes(), sizes[a:b].tobytes(),
                   ahead + int(sizes[:a].sum()), length, total)
            a = max(b, 1)

    def run(batches):
        out = []
        for conv, family, borrow, own_n, own_size, lent, mine, at, before, p0, p1, p2, p3, hashes, sizes in _rows(batches):
            lent, mine = lent[:borrow], mine[:borrow]
            lent_sizes = np.array([x["size"] for x in lent], np.int64)
            lent_sums = prefix_sums(lanes_of([x["hash"] for x in lent]))
            m, skipped, skipped_size = len(lent), len(mine), sum(x["size"] for x in mine)
            length, total = m + own_n - skipped, int(lent_sizes.sum()) + own_size - skipped_size
            if not at:                                 # the first run, or none, brings the borrowed turns
                out += cut(conv, family, 0, lent_sums, lent_sizes, 0, length, total)
            if hashes is not None:
                sizes, lanes = np.frombuffer(sizes, np.int64), lanes_of([hashes])
                start = max(skipped - at, 0)           # turns of this run that the borrowed ones replace
                if start < len(sizes):
                    own = prefix_sums(lanes)
                    # sums of the conversation's own turns, then without the replaced ones and moved to their new depth
                    own = (np.array([p0, p1, p2, p3], U)[:, None] + own * power(at)[:, None] % U(PRIME)) % U(PRIME)
                    gone = prefix_sums(lanes_of([x["hash"] for x in mine]))[:, -1:]
                    moved = (own + U(PRIME) - gone) % U(PRIME) * power(m - skipped)[:, None] % U(PRIME)
                    sums = (lent_sums[:, -1:] + moved) % U(PRIME)
                    ahead = int(lent_sizes.sum()) + before - skipped_size + int(sizes[:start].sum())
                    out += cut(conv, family, m + at + start - skipped, sums[:, start:], sizes[start:], ahead, length, total)
            if len(out) >= 512:
                yield _table(out, PIECES)
                out = []
        yield _table(out, PIECES)
    return run


def _shards(batches, most: int):
    """Consecutive pieces of about ``most`` slots, all pieces of a conversation and band together."""
    held, slots = [], 0
    for _, group in groupby(_rows(batches), lambda r: (r[0], r[2])):
        group = list(group)
        held += group
        slots += sum(len(r[6]) for r in group) // 8
        if slots >= most:
            yield held
            held, slots = [], 0
    if held:
        yield held


class Shard:
    """Flat arrays of the turns of some pieces, the node table over them and each slot's parent slot."""

    def __init__(self, pieces: list[tuple], band: int):
        n = [len(p[6]) // 8 for p in pieces]
        self.piece = np.repeat(np.arange(len(pieces)), n)
        within = np.arange(len(self.piece)) - np.repeat(np.cumsum(n) - n, n)
        conv, start, ahead, length, total = (np.array([p[i] for p in pieces], np.int64) for i in (0, 3, 7, 8, 9))
        self.depth = start[self.piece] + within + 1
        digests = np.frombuffer(b"".join(p[5] for p in pieces), np.int64).reshape(-1, 2)
        first = np.frombuffer(b"".join(p[4] for p in pieces), np.int64).reshape(-1, 2)
        before = np.concatenate([np.zeros((1, 2), np.int64), digests])[:-1].copy() if len(digests) else digests
        before[within == 0] = first[self.piece[within == 0]]
        self.digests, self.before = digests, before
        self.size = np.frombuffer(b"".join(p[6] for p in pieces), np.int64)
        self.conv, self.length, self.total = conv[self.piece], length[self.piece], total[self.piece]
        sums = np.cumsum(self.size)
        own = sums - np.concatenate([[0], sums])[np.cumsum(n) - n][self.piece]
        self.cumulative = ahead[self.piece] + own      # bytes up to and with the turn
        # the deepest turn of a conversation in this band: what lies deeper comes in there
        self.deepest = (self.depth == self.length) | (self.depth % band == 0)
        self.turnless = [(p[0], p[8] == 0) for p in pieces if p[3] == 0 and p[8] == 0]
        root = np.array([any(p[3] == 0 for p in pieces)])
        zero = np.zeros(int(root.sum()), np.int64)
        self.table = NodeTable(*(np.concatenate([zero, x]) for x in (self.depth, digests[:, 0], digests[:, 1])))
        self.slot = self.table.lookup(self.depth, digests[:, 0], digests[:, 1])
        self.parent = np.full(len(self.table.depth), -1, np.int64)
        linked = (self.depth - 1) % band != 0          # a band's first level has its parents in other shards
        linked |= self.depth == 1
        self.parent[self.slot[linked]] = self.table.lookup(self.depth[linked] - 1, before[linked, 0], before[linked, 1])
        self.root = int(self.table.lookup(zero, zero, zero)[0]) if root[0] else -1


def _partials(band: int, most: int):
    """Counts of each shard's nodes: members, members that end there, least member, bytes of members from there on."""
    def run(batches):
        for pieces in _shards(batches, most):
            s = Shard(pieces, band)
            slots = len(s.table.depth)
            n, ends, weighted, size = (np.zeros(slots, np.int64) for _ in range(4))
            least = np.full(slots, np.iinfo(np.int64).max)
            parents = np.zeros((slots, 2), np.int64)
            np.add.at(n, s.slot[s.deepest], 1)
            np.add.at(ends, s.slot[s.depth == s.length], 1)
            np.minimum.at(least, s.slot, s.conv)
            np.add.at(weighted, s.slot, s.size)
            np.add.at(weighted, s.slot[s.deepest], (s.total - s.cumulative)[s.deepest])
            size[s.slot], parents[s.slot] = s.size, s.before
            for conv, _ in s.turnless:
                n[s.root] += 1
                ends[s.root] += 1
                least[s.root] = min(least[s.root], conv)
            s.table.climb(s.parent, n, weighted, least=least)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s.table.depth, s.table.d1, s.table.d2, parents[:, 0], parents[:, 1], n, ends, least, weighted, size)],
                                             [x.split()[0] for x in PARTIAL.split(", ")])
    return run


def _owned(band: int, most: int):
    """Leaves and distinct bytes below each shard's nodes, of the nodes that the shard's conversations answer for."""
    def run(batches):
        for rows in _shards(batches, most):
            s = Shard(rows, band)
            first, owned, leaf = (np.array([r[i] for r in rows], np.int64)[s.piece] for i in (10, 11, 12))
            leaves, distinct = (np.zeros(len(s.table.depth), np.int64) for _ in range(2))
            np.add.at(distinct, s.slot, np.where(s.depth >= first, s.size, 0))
            beyond = np.minimum(s.total - s.cumulative, owned)
            np.add.at(distinct, s.slot[s.deepest], beyond[s.deepest])
            np.add.at(leaves, s.slot[s.deepest], leaf[s.deepest])
            s.table.climb(s.parent, leaves, distinct)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s.table.depth, s.table.d1, s.table.d2, leaves, distinct)], [x.split()[0] for x in SHARES.split(", ")])
    return run


def _ends(batches):
    """Node of each conversation's last turn."""
    out = []
    for conv, start, before, digests, length in _rows(batches):
        n = len(digests) // 16
        if start <= length <= start + n and (n or not length):
            last = np.frombuffer(digests[-16:] if length else before, np.int64)
            out.append((length, int(last[0]), int(last[1]), conv))
    yield _table(out, "depth long, d1 long, d2 long, conv long")


def _listed(batches):
    """Consecutive members of a node in a sorted partition as one text, at most some thousand a row."""
    out = []
    for key, group in groupby(_rows(batches), lambda r: r[:3]):
        members = []
        for row in group:
            members.append(row[3])
            if len(members) == RUN:
                out.append((*key, members[0], ",".join(map(str, members))))
                members = []
        if members:
            out.append((*key, members[0], ",".join(map(str, members))))
        if len(out) >= 2048:
            yield _table(out, LISTED)
            out = []
    yield _table(out, LISTED)


LISTED = "depth long, d1 long, d2 long, first long, members string"


def _digested(batches):
    out = []
    for key, group in groupby(_rows(batches), lambda r: r[:3]):
        h, lead = hashlib.sha256(), b""
        for row in group:
            h.update(lead + row[4].encode())
            lead = b","
        out.append((*key, h.hexdigest()))
        if len(out) >= 4096:
            yield _table(out, "depth long, d1 long, d2 long, ends_sha256 string")
            out = []
    yield _table(out, "depth long, d1 long, d2 long, ends_sha256 string")


def borrowed(conv) -> F.Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % BORROWED


def rebuilt_pieces(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, band: int) -> DataFrame:
    """Every rebuilt conversation as rows of :data:`PIECES`; written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("hash"), F.octet_length(text).cast("long").alias("size"),
        F.col(turn_col).alias("turn"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("hash")]
    runs = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, RUNS), "runs")
    light = runs.select("conv", "seq", "n", "size", "s0", "s1", "s2", "s3")
    placed = stored(light.repartition("conv").sortWithinPartitions("conv", "seq").mapInArrow(_placed, PLACED), "placed-runs")
    runs = runs.select("conv", "seq", "hashes", "sizes").join(placed, ["conv", "seq"])
    heads = (runs.where(F.col("at") < BORROWED - 1).select("conv", "at", "hashes", "sizes")
             .mapInArrow(_heads, "conv long, place long, hash binary, size long")
             .groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("place", "hash", "size"))).alias("head")))
    convs = light.groupBy("conv").agg(F.sum("n").alias("own_n"), F.sum("size").alias("own_size")).join(heads, "conv")
    convs = stored(convs.withColumn("family", F.col("conv") - F.col("conv") % FAMILY).withColumn("borrow", borrowed(F.col("conv")).cast("int")), "conversations")
    lenders = convs.select(F.col("conv").alias("family"), F.col("head").alias("lent"))
    known = convs.join(lenders, "family", "left").withColumn("lent", F.coalesce("lent", F.expr("slice(head, 1, 0)")))
    both = known.join(runs, "conv").select("conv", "family", "borrow", "own_n", "own_size", "lent", F.col("head").alias("mine"), "at", "before", "p0", "p1", "p2", "p3",
                                           "hashes", "sizes")
    return stored(both.mapInArrow(_rebuilt(band), PIECES), "pieces")


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                      band: int = BAND, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the root included.

    ``conv_id`` (smallest member), ``depth, parent_conv_id`` (the parent's, null for the root), ``n_convs, n_children,
    n_leaves`` (childless nodes from here down), ``saved_tokens`` (over the nodes from here down: members but one, times
    the bytes of the last text), ``ends_sha256`` (of the ids of the members that end here, ascending, comma-joined).

    A conversation's turns follow by ``turn``, null first, equal ones by the hash of role and text; rows that repeat are
    turns of their own.  It is rebuilt from the first turns of the conversation whose id is its own less the remainder
    by 5 (as many as crc32 of its id modulo 9 says, all if there are fewer, none if that has no rows), then its own after
    as many.  Null roles and texts are empty ones; rows without a conversation are none.  An empty table gives no rows.
    """
    ship(df.sparkSession)
    pieces = rebuilt_pieces(df, conv_col, turn_col, role_col, text_col, band)
    dealt = ["family", "band"]
    sort = ["family", "band", "conv", "start"]
    partial = pieces.repartition(*dealt).sortWithinPartitions(*sort).mapInArrow(_partials(band, shard), PARTIAL)
    key = ["depth", "d1", "d2"]
    nodes = partial.groupBy(*key).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum("n").alias("n_convs"), F.sum("ends").alias("ends"),
                                      F.min("conv").alias("conv_id"), F.sum("weighted").alias("weighted"), F.max("size").alias("size"),
                                      F.max(F.struct("p1", "p2", "size")).alias("most"), F.min(F.struct("p1", "p2", "size")).alias("least"))
    same = F.assert_true(F.col("most") == F.col("least"), F.lit("two prefixes have one digest"))
    nodes = stored(nodes.withColumn("checked", same).drop("checked", "most", "least").where(same.isNull()), "nodes")

    # the smallest member answers for a node: its part of a conversation is a tail, and at most its last node is childless
    owners = nodes.where("depth > 0").groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("depth").alias("first"), F.sum("size").alias("owned"), F.max((F.col("ends") == F.col("n_convs")).cast("long")).alias("leaf"))
    shares = (pieces.join(owners, "conv").select(*pieces.columns, "first", "owned", "leaf").repartition(*dealt).sortWithinPartitions(*sort)
              .mapInArrow(_owned(band, shard), SHARES).groupBy(*key).agg(F.sum("leaves").alias("leaves"), F.sum("distinct").alias("distinct")))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    members = pieces.select("conv", "start", "before", "digests", "len").mapInArrow(_ends, "depth long, d1 long, d2 long, conv long")
    order = [*key, "conv"]
    listed = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, LISTED)
    ends = listed.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_digested, "depth long, d1 long, d2 long, ends_sha256 string")
    whole = stored(nodes.join(children, key, "left").join(shares, key, "left").join(ends, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
                   "joined-nodes")

    # parents with very many children are few, at most nodes by limit: they travel to the children
    limit = max(1000, nodes.count() // 200)
    parents = whole.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"),
                                                   "n_children")
    up = ["depth", "p1", "p2"]
    many = parents.where(F.col("n_children") > limit).drop("n_children").withColumnRenamed("parent_conv_id", "of_many")
    tagged = whole.join(F.broadcast(many), up, "left")
    few = tagged.where("of_many IS NULL").drop("of_many").join(parents.where(F.col("n_children") <= limit).drop("n_children"), up, "left")
    done = few.unionByName(tagged.where("of_many IS NOT NULL").withColumnRenamed("of_many", "parent_conv_id"))
    return done.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
                       F.when(F.col("depth") == 0, F.greatest(F.coalesce("leaves", F.lit(0)), (F.col("n_children") == 0).cast("long"))).otherwise(F.coalesce("leaves", F.lit(0)))
                       .cast("long").alias("n_leaves"), (F.col("weighted") - F.coalesce("distinct", F.lit(0))).cast("long").alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
