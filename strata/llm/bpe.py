"""Byte-level BPE encoding and decoding by public rank files.

A text is cut by the tokenizer's pattern; each piece is encoded on its own.
For a piece, an Aho-Corasick automaton over the vocabulary (bytes mapped to
Latin-1 characters) gives the longest matches.  Encoding
takes the longest matches end to end as long as each may follow its left
neighbour; from there on the longest token that may, stepping back when none can.  Two tokens may stand side by side when merging their bytes by
rank would not cross the border; that is memoised per pair.  Every step either
moves on or rules out one (position, token) choice for good, so the work is
linear in the piece, and the result is the one that merging by rank gives.
"""

from __future__ import annotations

import base64
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import ship

#: Bounds of the per-process memos (entries); a full memo starts again, results stay the same.
PIECES, PAIRS = 300_000, 400_000
#: A text of more characters is cut into pieces lazily instead of in one list; rows are sent on in groups of so many tokens.
LONG_TEXT, TOKENS_OUT = 1 << 22, 1 << 19


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 bytes, space, rank, one per line)."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


class BytePairs:
    """Encoder and decoder of one vocabulary; ``tokens[i]`` are the bytes of id ``i``."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.pair: dict[tuple[int, int], int] = {}    # (left, right) -> token that merges them
        self.left, self.right = list(range(len(tokens))), list(range(len(tokens)))
        self.memo: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.sizes = [len(t) for t in tokens]
        self.longest = max(self.sizes)
        for i, token in enumerate(tokens):
            if len(token) > 1:
                self._learn(i, token)
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.memo.clear()

    def _learn(self, i: int, token: bytes) -> None:
        """The last merge that makes token ``i``: its two parts are valid neighbours with lower ranks."""
        for cut in range(len(token) - 1, 0, -1):
            a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
            if a is not None and b is not None and a < i and b < i and self._may_follow(a, b):
                self.left[i], self.right[i] = a, b
                self.pair[a, b] = i
                return
        raise ValueError(f"token {i} is not a merge of earlier tokens")

    def compatible(self, a: int, b: int) -> bool:
        known = self.memo.get((a, b))
        if known is None:
            if len(self.memo) >= PAIRS:
                self.memo.clear()
            known = self.memo[a, b] = self._may_follow(a, b)
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between tokens ``a`` and ``b``.

        Undo the merges next to the border from the latest to the earliest (of equal ranks the right one
        was made later); if at any time the two neighbours would merge before the one last undone, that
        merge would have crossed the border.
        """
        pair, left, right = self.pair, self.left, self.right
        before = (len(self.tokens), 0)                 # (rank, 1 if right of the border) of the merge last undone
        while True:
            across = pair.get((a, b))
            if across is not None and (across, 0) < before:
                return False
            a_whole, b_whole = right[a] == a, left[b] == b
            if a_whole and b_whole:
                return True
            if b_whole or not a_whole and a > b:
                before, a = (a, 0), right[a]
            else:
                before, b = (b, 1), left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        sizes, rank, known, compatible, n = self.sizes, self.rank, self.memo, self.compatible, len(piece)
        out: list[int] = []
        at, last = 0, -1
        for _, token in self.automaton.iter_long(piece.decode("latin-1")):   # longest matches, end to end
            if at and not (known[last, token] if (last, token) in known else compatible(last, token)):
                break
            out.append(token)
            at += sizes[token]
            last = token
        if at == n:
            return out
        dead = set()                                   # positions from which no way leads on
        size = min(self.longest, n - at)
        while True:
            while size:
                token = rank.get(piece[at:at + size])
                if token is not None and at + size not in dead and (
                        not out or (known[last, token] if (last, token) in known else compatible(last, token))):
                    out.append(token)
                    last = token
                    at += size
                    if at == n:
                        return out
                    size = min(self.longest, n - at)
                    break
                size -= 1
            else:
                dead.add(at)
                size = sizes[out.pop()]
                last = out[-1] if out else -1
                at -= size
                size -= 1

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Worker:
    """What a Python worker keeps between tasks: vocabulary and the memo of whole pieces."""

    kept: dict[tuple, _Worker] = {}

    def __init__(self, path: str, pattern: str):
        self.pairs, self.pieces, self.pattern = BytePairs(load_ranks(path)), {}, regex.compile(pattern)

    @classmethod
    def get(cls, path: str, pattern: str) -> _Worker:
        if (path, pattern) not in cls.kept:
            cls.kept[path, pattern] = cls(path, pattern)
        return cls.kept[path, pattern]

    def encode(self, text: str) -> bytes:
        """Ids as native 32-bit integers, end to end."""
        if len(text) < LONG_TEXT:
            return self._pieces(self.pattern.findall(text))
        parts, pieces = [], []
        for m in self.pattern.finditer(text):
            pieces.append(m[0])
            if len(pieces) == LONG_TEXT // 8:
                parts.append(self._pieces(pieces))
                pieces = []
        return b"".join([*parts, self._pieces(pieces)])

    def _pieces(self, pieces: list[str]) -> bytes:
        known = self.pieces
        got = [*map(known.get, pieces)]
        if None in got:
            for i, ids in enumerate(got):
                if ids is None:
                    piece = pieces[i]
                    got[i] = ids = known.get(piece) or array("i", self.pairs.encode_piece(piece.encode())).tobytes()
                    if len(piece) < 64:
                        if len(known) >= PIECES:
                            known.clear()
                        known[piece] = ids
        return b"".join(got)


def _encode(path, pattern, decoded):
    def run(batches):
        worker = _Worker.get(path, pattern)
        decode = worker.pairs.decode
        for batch in batches:
            first, ids, held, column = 0, [], 0, batch.column(1)
            for i in range(len(column)):
                ids.append(worker.encode(column[i].as_py() or ""))
                held += len(ids[-1])
                if held >= 4 * TOKENS_OUT or i + 1 == len(column):
                    ends = np.cumsum([0, *map(len, ids)]) // 4
                    flat = np.frombuffer(b"".join(ids), np.int32)
                    out = [batch.column(0).slice(first, len(ids)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                    if decoded:
                        out.append(pa.array([decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, ["id", "ids", "decoded"][:len(out)])
                    first, ids, held = i + 1, [], 0
    return run


def _decode(path, pattern):
    def run(batches):
        worker = _Worker.get(path, pattern)
        for batch in batches:
            texts = [worker.pairs.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["id", "decoded"])
    return run


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 decoded: bool = False) -> DataFrame:
    """``id_col, ids (array<int>)`` of every whole text; with ``decoded`` also the bytes that the ids give back.

    One row per input row.  A null or empty text has no ids (an empty array) and decodes to no bytes; a null
    id stays null.  Special tokens' strings are ordinary text.  ``path`` is a rank file that every executor
    can open.  Rows that repeat are encoded alike; an empty table gives no rows.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _encode(path, pattern, decoded), f"id {kind}, ids array<int>" + ", decoded binary" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, decoded (binary)`` of an array of ids; null counts as no ids, an unknown id is an error."""
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        _decode(path, pattern), f"id {kind}, decoded binary").withColumnRenamed("id", id_col)
