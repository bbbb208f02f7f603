"""Spelling variant grouping over a variable-length gram index.

Words are decomposed into grams of :data:`SHORTEST` to :data:`LONGEST` letters:
at each place the gram grows while the dictionary of frequent grams holds it,
and grams inside an earlier one are left out.  For every place that an edit
can hit, the grams that it cannot affect are known from the word alone, and a
near word has all of them: those to the left at the same distance from the
start, those to the right at the same distance from the end.  Words meet under
the rarest of these grams.  There their gram lists are merged; what shares as
many grams as the bounds of affected grams leave is verified letter by letter.

A gram under which too many words meet is refined: its words meet under all
unaffected grams of an edit place instead, which loses no pair either.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import LOWER, ship
from strata.session import stored

SHORTEST, LONGEST = 3, 6
#: Marks in front of and behind a word: with three, some gram of a word of six letters or more outlives any edit.
PAD = LONGEST - SHORTEST
#: Frequent grams are those with more than this many words, or more than a 2**15th of all grams of their length.
COMMON, GRAM_SHARE = 100, 1 << 15
#: Words that may meet under one gram before it is refined.
BUCKET_WORDS = 20_000
#: Words under one key from which their gram lists are merged.
MERGE_FROM = 256
#: Distinct words counted at once in a task.
COUNT_AT_ONCE = 200_000


def _counts(least: int, every: int):
    """(word, n) of the texts, counted per task some distinct words at a time."""
    found = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def flush(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1)):
                raw = (text.as_py() or "").encode().translate(LOWER).decode()
                start = zlib.crc32(((id_.as_py() or "") + ":").encode())
                for word, n in Counter(found.findall(raw)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    counts[word] += n
                if len(counts) >= COUNT_AT_ONCE:
                    yield flush(counts)
                    counts = Counter()
        yield flush(counts)
    return run


def count_words(df: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    ship(df.sparkSession)
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _counts(least, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _grams(size: int, frequent: set[str]):
    """(gram, words) of the grams of ``size`` letters whose first ``size - 1`` are frequent."""
    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                padded = "<" * PAD + word + ">" * PAD
                counts.update({padded[i:i + size] for i in range(len(padded) - size + 1) if size == SHORTEST or padded[i:i + size - 1] in frequent})
            if len(counts) >= COUNT_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])
    return run


def gram_dictionary(vocabulary: DataFrame, common: int = COMMON, share: int = GRAM_SHARE) -> dict[str, int]:
    """Frequent grams and their words, length by length: only frequent grams grow.

    A gram is frequent above ``common`` words and above a ``share``-th of the words' letters, so that each length has at
    most a few times ``share`` of them, however many words there are.
    """
    letters = vocabulary.agg(F.sum(F.length("word") + 2 * PAD)).first()[0] or 0
    least = max(common, letters // share)
    out: dict[str, int] = {}
    for size in range(SHORTEST, LONGEST + 1):
        rows = vocabulary.select("word").mapInArrow(_grams(size, set(out)), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > least)
        out.update((r["gram"], r["n"]) for r in rows.toLocalIterator())
    return out


class Decomposed(NamedTuple):
    """Variable-length grams of a padded word: texts, places, and the key and number of unaffected grams by edit place.

    ``change[i]`` is for a letter at ``i`` that is replaced or deleted, ``insert[i]`` for one inserted before ``i``.
    """

    grams: list[str]
    at: list[int]
    change: list[tuple[int, int, str]]
    insert: list[tuple[int, int, str]]


def variable_grams(word: str, frequent: dict[str, int]) -> tuple[list[str], list[int]]:
    """Grams of the padded ``word`` and where they start; each is read from its own letters alone."""
    padded = "<" * PAD + word + ">" * PAD
    n, grams, at, reach = len(padded), [], [], 0
    for a in range(n - SHORTEST + 1):
        b = a + SHORTEST
        while b < n and b - a < LONGEST and padded[a:b] in frequent:
            b += 1
        if b > reach:
            grams.append(padded[a:b])
            at.append(a)
            reach = b
    return grams, at


def decompose(word: str, frequent: dict[str, int]) -> Decomposed:
    """Grams of ``word`` and, for every place of an edit, the bound on what it affects.

    A gram that ends before the edit stays, at the same start; one that starts after the edit stays, at the same
    distance from the end, unless a gram from before it may reach its end: so it must end more than :data:`LONGEST`
    letters behind the last letter before those that stay.
    """
    grams, at = variable_grams(word, frequent)
    ends = [a + len(g) for a, g in zip(at, grams)]
    m, n = len(grams), len(word) + 2 * PAD
    rank = [(frequent.get(g, 0), -len(g), g) for g in grams]
    left: list = [None]                                # rarest of the first j grams, as (rank, side, distance)
    for j in range(m):
        own = (rank[j], 0, at[j])
        left.append(own if left[-1] is None or own < left[-1] else left[-1])
    right: list = [None] * (m + 1)
    for j in range(m - 1, -1, -1):
        own = (rank[j], 1, n - at[j])
        right[j] = own if right[j + 1] is None or own < right[j + 1] else right[j + 1]

    def by_place(places, skipped):
        out, lo, hi = [], 0, 0
        for i in range(places):
            edge = PAD + i                             # letters before the edit: padded[:edge]; after it: padded[edge + skipped:]
            while lo < m and ends[lo] <= edge:
                lo += 1
            while hi < m and ends[hi] <= edge + skipped - 1 + LONGEST:
                hi += 1
            a, b = left[lo], right[hi]
            out.append((lo, hi, b if a is None or b is not None and b < a else a))
        return out

    return Decomposed(grams, at, by_place(len(word), 1), by_place(len(word) + 1, 0))


def _key(best, size: int) -> int:
    (_, _, gram), side, distance = best
    return xxhash.xxh3_64_intdigest(f"{size} {side} {distance} {gram}".encode()) - (1 << 63)


def _full_key(d: Decomposed, place: tuple, size: int, n: int) -> int:
    lo, hi, _ = place
    h = xxhash.xxh3_64(f"all {size}".encode())
    for j in range(lo):
        h.update(f" {d.at[j]} {d.grams[j]}".encode())
    for j in range(hi, len(d.grams)):
        h.update(f" -{n - d.at[j]} {d.grams[j]}".encode())
    return h.intdigest() - (1 << 63)


def word_keys(word: str, frequent: dict[str, int], crowded: frozenset[int] = frozenset()) -> tuple[list[int], list[int], Decomposed]:
    """Keys under which a word meets its near words, for each letter that is changed and for each place of an insertion.

    Two words of ``l`` letters meet as changed words, one of ``l - 1`` meets one of ``l`` as the one with a letter less.
    """
    d, n = decompose(word, frequent), len(word)

    def keys(places, size):
        out, last, key = [], None, 0
        for p in places:
            if p[2] is not last:
                last, key = p[2], _key(p[2], size)
            out.append(_full_key(d, p, size, n + 2 * PAD) if key in crowded else key)
        return out

    return keys(d.change, n), keys(d.insert, n + 1), d


MET = "key long, size long, word string, n long, least long, first long, last long"
_MET_NAMES = tuple(x.split()[0] for x in MET.split(", "))
_MET = tuple(pa.string() if x.endswith("string") else pa.int64() for x in MET.split(", "))


def _meet(frequent: dict[str, int], crowded: frozenset[int]):
    """Rows of :data:`MET`: ``least`` is how many of the word's grams no edit affects, first and last are the key's edit places."""
    def run(batches):
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                changed, inserted, d = word_keys(word, frequent, crowded)
                least = len(d.grams) - max(hi - lo for places in (d.change, d.insert) for lo, hi, _ in places)
                for size, keys in ((len(word), changed), (len(word) + 1, inserted)):
                    last = dict(zip(keys, range(len(keys))))      # the places of a key stand side by side
                    first = dict(zip(reversed(keys), range(len(keys) - 1, -1, -1)))
                    rows += [(key, size, word, n, least, first[key], last[key]) for key in last]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(list(zip(*rows)) or [()] * 7, _MET)], list(_MET_NAMES))
    return run


def differ_by_one(a: str, b: str) -> int:
    """Where ``a`` and the equally long or shorter ``b`` first differ, if by one edit; else -1."""
    lo, hi = 0, len(b)                                 # length of the common prefix by halving
    if hi < 32:
        while lo < hi and a[lo] == b[lo]:
            lo += 1
        hi = lo
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    same_length = len(a) == len(b)
    return lo if a != b and a[lo + 1:] == b[lo + 1 if same_length else lo:] else -1


class GramLists:
    """Inverted lists of the words that meet under one key, merged by counting."""

    def __init__(self, words: list[str], least: list[int], frequent: dict[str, int]):
        self.sizes, self.least = np.array([len(w) for w in words]), least
        ids: dict = {}
        token, owner, self.own = [], [], []
        for i, w in enumerate(words):
            grams, at = variable_grams(w, frequent)
            n = len(w) + 2 * PAD
            mine = [ids.setdefault((g, a), len(ids)) for g, a in zip(grams, at)] + [ids.setdefault((g, a - n), len(ids)) for g, a in zip(grams, at)]
            token += mine
            owner += [i] * len(mine)
            self.own.append(mine)
        token, owner = np.array(token), np.array(owner)
        self.members = owner[np.argsort(token, kind="stable")]
        self.starts = np.searchsorted(np.sort(token), np.arange(len(ids) + 1)).tolist()

    def search(self, q: int) -> list[int]:
        """Words after ``q`` of its length, or with a letter less, that share as many grams as no edit of ``q`` affects."""
        lists = [self.members[self.starts[t]:self.starts[t + 1]] for t in self.own[q]]
        counts = np.bincount(np.concatenate(lists), minlength=len(self.sizes))
        some = np.flatnonzero(counts >= self.least[q])
        # grams of an equally long word agree from both ends at once
        return [i for i, n, size in zip(some.tolist(), counts[some].tolist(), self.sizes[some].tolist())
                if size == self.sizes[q] - 1 or i > q and size == self.sizes[q] and n >= 2 * self.least[q]]


def _near(frequent: dict[str, int]):
    """(word, near, near_n) both ways of the near pairs of each key."""
    def pairs(key, size, rows):
        words = [r[0] for r in rows]
        whole = [i for i, w in enumerate(words) if len(w) == size]
        if not whole:
            return
        if len(words) > MERGE_FROM:
            lists = GramLists(words, [r[2] for r in rows], frequent)
            tried = [(q, i) for q in whole for i in lists.search(q)]
        else:                                          # a few words are told apart by the letters outside the key's edit places
            tried, tables = [], {}
            for q in whole:
                first, last = rows[q][3:]
                behind = size - last - 1
                table = tables.get((first, last))
                if table is None:
                    table = tables[first, last] = {}
                    for i, w in enumerate(words):
                        table.setdefault((w[:first], w[len(w) - behind:]), []).append(i)
                word = words[q]
                tried += [(q, i) for i in table[word[:first], word[size - behind:]] if i > q or len(words[i]) < size]
        for q, i in tried:
            word, near = words[q], words[i]
            at = differ_by_one(word, near)
            # a pair may meet under several keys; it counts under the one of the place where the words first differ
            if at >= 0 and rows[q][3] <= at <= rows[q][4]:
                yield word, near, rows[i][1]
                yield near, word, rows[q][1]

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(list(zip(*out)) or [()] * 3, (pa.string(), pa.string(), pa.int64()))],
                                          ["word", "near", "near_n"])

    def run(batches):
        held, last, out = [], None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if row[:2] != last:
                    if len(held) > 1:
                        out += pairs(*last, held)
                    held, last = [], row[:2]
                    if len(out) >= 1 << 14:
                        yield _rows(out)
                        out = []
                held.append(row[2:])
        if len(held) > 1:
            out += pairs(*last, held)
        yield _rows(out)
    return run


def near_words(vocabulary: DataFrame, common: int = COMMON, share: int = GRAM_SHARE, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """``word, near, near_n`` of every ordered pair of different words of ``vocabulary`` (``word, n``) one edit apart."""
    frequent = gram_dictionary(vocabulary, common, share)
    met = stored(vocabulary.select("word", "n").mapInArrow(_meet(frequent, frozenset()), MET), "words-by-gram")
    # at most the rows of all words by bucket_words
    crowded = frozenset(r["key"] for r in met.groupBy("key").count().where(F.col("count") > bucket_words).toLocalIterator())
    if crowded:
        met = vocabulary.select("word", "n").mapInArrow(_meet(frequent, crowded), MET)
    return met.repartition(_partitions(vocabulary), "key").sortWithinPartitions("key", "size").mapInArrow(
        _near(frequent), "word string, near string, near_n long")


def _partitions(df: DataFrame) -> int:
    """Partitions for stages whose work is Python's: their small rows would let adaptive execution make too few."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that follow from each word of ``word, form``.

    A form occurs ten times as often as its word, so no chain is longer than a count has digits; each round doubles the
    steps taken, and five rounds take 32.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(5):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")
    return now


def group_spellings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, least_count: int = 2,
                    ratio: int = 10, every: int = 31, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with ``least_letters`` code points and ``least_count`` occurrences.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF of the whole texts, with A-Z lower-cased; a run whose crc32 together
    with the row's id is divisible by ``every`` loses one letter first.  Near words differ by exactly one inserted,
    deleted or replaced code point.  The form is the near word with the largest count (ties: smallest by code points)
    if that is at least ``ratio`` times the word's own; the root is the last form of the chain.  A null text has no
    words, a null id counts as an empty one, rows that repeat count again, an empty table has no words.
    """
    if least_letters < 2 * PAD or ratio < 2:
        raise ValueError(f"words of at least {2 * PAD} letters, and a ratio of 2 or more")
    words = count_words(df, id_col, text_col, least_letters, every).where(F.col("n") >= least_count)
    vocabulary = stored(words.repartition(_partitions(df), "word"), "vocabulary")
    near = near_words(vocabulary, **options).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form"))).alias("best"))
    judged = stored(vocabulary.join(near, "word", "left").withColumn("best_n", -F.col("best.order"))
                    .withColumn("chosen", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
                    .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("chosen"), F.col("best.form")).alias("form"),
                            F.when(F.col("chosen"), F.col("best_n")).alias("form_n")), "judged-words")
    roots = with_roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
