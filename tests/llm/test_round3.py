"""Spelling variants, language ID and the conversation trie against plain models."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, prefix_trie, spelling
from strata.llm.langid import Samples, phrases, parser, predict_language, sample_languages, suffix_automaton
from strata.llm.prefix_trie import NodeTable, conversation_trie
from strata.llm.spelling import decompose, differ_by_one, group_spellings, near_words
from tests.llm import brute


def everything(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# -- spelling variants ----------------------------------------------------------
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def spellings(rows, ratio=10):
    counts = Counter()
    for d, text in rows:
        for word in re.findall("[a-zÀ-ÿ]+", (text or "").translate(brute.LOWER)):
            h = zlib.crc32(f"{'' if d is None else d}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 7:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n > 1}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


SPELLED = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.fixture(scope="module")
def misspelt():
    rnd = random.Random(8)
    base = ["".join(rnd.choice(["ab", "er", "un", "é", "ting", "o", "ss"]) for _ in range(rnd.randint(3, 6))) for _ in range(60)]
    rows = [(None, "Spelling spelling"), (1, None), (2, ""), (3, "a" * 3000 + " " + "a" * 2999 + " " + "a" * 3000 + " " + "a" * 2999), (4, "×÷×÷×÷×Ā×÷×÷×÷×"), (4, "×÷×÷×÷×")]
    for i in range(10, 200):
        words = []
        for _ in range(rnd.randint(1, 60)):
            w = base[min(int(rnd.expovariate(0.15)), 59)]
            if rnd.random() < 0.1:
                at = rnd.randint(0, len(w) - 1)
                w = rnd.choice([w[:at] + w[at + 1:], w[:at] + "x" + w[at + 1:], w[:at] + w[at] + w[at:], w + "s"])
            words.append(w.upper() if rnd.random() < 0.05 else w)
        rows.append((i, rnd.choice([" ", "-", ". "]).join(words)))
    return rows + [rows[20]] * 3


@pytest.mark.parametrize("options", [{}, {"common": 2, "bucket_words": 3}, {"common": 1, "share": 40}])
def test_spellings(spark, misspelt, options):
    got = everything(group_spellings(brute.frame(spark, misspelt), **options), *SPELLED)
    want = spellings(misspelt)
    assert got == want and sum(r[1] is not None for r in want) > 10 and any(r[2] not in (r[0], r[1]) or r[1] for r in want)
    assert group_spellings(brute.frame(spark, misspelt[:0] + [(1, None)])).count() == 0


def test_merged_lists_find_what_verifying_every_word_finds(spark, monkeypatch):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(7, 10))) for _ in range(700)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = Counter((r.word, r.near) for r in near_words(frame, common=100_000).collect())       # short grams only: crowded keys, merged lists
    want = Counter((a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b))
    assert got == want
    lists = spelling.GramLists(words, [1] * len(words), {})
    assert set(lists.search(0)) >= {i for i, w in enumerate(words) if len(w) <= len(words[0]) and i and one_edit(words[0], w)}


def test_bounds_of_affected_grams():
    rnd = random.Random(5)
    frequent = {"".join(rnd.choice("abc<>") for _ in range(k)): k for k in (3, 4, 5) for _ in range(60)}
    for _ in range(3000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(7, 12)))
        i, kind = rnd.randint(0, len(a) - 1), rnd.choice("dr")
        b = a[:i] + ("x" if kind == "r" else "") + a[i + 1:]
        for word, other, places in ((a, b, "change"), (b, a, "change" if kind == "r" else "insert")):
            d, o = decompose(word, frequent), decompose(other, frequent)
            lo, hi, best = getattr(d, places)[i]
            n, m = len(word) + 6, len(other) + 6
            assert set(zip(d.grams[:lo], d.at[:lo])) <= set(zip(o.grams, o.at))
            assert {(g, n - x) for g, x in zip(d.grams[hi:], d.at[hi:])} <= {(g, m - x) for g, x in zip(o.grams, o.at)}
            assert best is not None
    assert differ_by_one("abc" * 50, "abc" * 49 + "ab") >= 0 and differ_by_one("same", "same") == -1 and differ_by_one("abcd", "abdc") == -1


# -- language ID ------------------------------------------------------------------
def parsed(sample, text):
    """Phrases of a text by looking for ever longer pieces in the sample."""
    sample, text = (bytes(langid.symbols_of(np.frombuffer(x, np.uint8))) for x in (sample, text))
    total = 0
    for a in range(0, len(text), langid.BLOCK):
        block, at = text[a:a + langid.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at:at + size + 1] in sample:
                size += 1
            total, at = total + 1, at + size
    return total


def test_suffix_automaton_accepts_the_substrings():
    rnd = random.Random(1)
    for _ in range(50):
        text = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 30)))
        steps = suffix_automaton(text)
        for _ in range(50):
            word, state = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 6))), 0
            for c in word:
                state = steps[state].get(c) if state is not None else None
            assert (state is not None) == (word in text)


def test_phrases_are_longest_matches():
    rnd = random.Random(6)
    samples = Samples(("x", "y"), (" ".join(brute.sentence(rnd, 40).split()).encode(), "Straße über Öl\0naïve".encode()))
    texts = [b"", b"!", "über Straße the 語".encode(), brute.sentence(rnd, 300).encode(), bytes(range(1, 128)), b"zzz" * 400]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = phrases(parser(samples), data, offsets)
    for row, text in zip(found.tolist(), texts):
        assert row == [parsed(s, text) for s in samples.texts]


LANGS = {"en": ["the", "of", "and", "with", "nothing"], "de": ["der", "und", "nicht", "für", "straße"], "ru": ["это", "не", "что", "всё"]}


def written(rnd, lang, n):
    return " ".join(rnd.choice(LANGS[lang]) + rnd.choice(["", "", "."]) for _ in range(n))


def test_languages_held_out_and_edge_cases(spark):
    rnd = random.Random(3)
    rows = [(i, written(rnd, lang, rnd.randint(4, 80)), lang) for i in range(300) for lang in [rnd.choice(sorted(LANGS))]]
    rows += [(400, None, "en"), (401, "", "de"), (402, "123 !?", "en"), (403, "語", None), (404, "the " * 60_000, None), (None, "und nicht", "ru"), (405, "no label", None),
             rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"id": F.lit("x"), "letters": F.lit(1), "score": F.lit(2)})
    samples = sample_languages(df)
    assert samples.langs == ("de", "en", "ru")
    taught = {t for d, t, lang in rows if d is not None and zlib.crc32(str(d).encode()) % 3 != 1 and t}
    assert all(piece.decode(errors="ignore").strip() in " ".join(taught) for s in samples.texts for piece in s.split(b"\0")[:-1])
    got = defaultdict(list)
    for r in predict_language(df, samples).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert sum(map(len, got.values())) == len(rows) and len(got[0]) == 3 and len(set(got[0])) == 1
    assert all(got[i] == [("und", 0.0)] for i in (400, 401, 402)) and got[404][0][0] == "en"
    held = [(d, lang) for d, _, lang in rows[:300] if zlib.crc32(str(d).encode()) % 3 == 1]
    assert len(held) > 60 and sum(got[d][0][0] == lang for d, lang in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 for x in got.values() for _, s in x)
    nothing = sample_languages(df.where("lang IS NULL"))
    assert nothing.langs == () and {r.lang_pred for r in predict_language(df, nothing).collect()} == {"und"}
    assert predict_language(df.limit(0), samples).count() == 0
    many = sample_languages(df.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 90)), sample_bytes=9000)
    assert len(many.langs) > 60 and max(map(len, many.texts)) <= 9000 // len(many.langs)


def test_language_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = predict_language(docs, sample_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out() & F.col("lang").isNotNull())
    right, n = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 200 and right >= 0.98 * n


# -- conversation trie --------------------------------------------------------------
def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h, rest = zlib.crc32(str(c).encode()) % 9, abs(c) % 5 * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(c - rest, [])[:h] + v[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for k in range(len(v) + 1):
            members[v[:k]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, conv string, d1 string").repartition(5)


def test_trie_of_messy_conversations(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(-12, 60)]), rnd.choice([None, 0, 1, 2, 3, 3, 4, 5]), rnd.choice([None, "user", "assistant"]), rnd.choice([None, "", "a", "é", "bb"]))
            for _ in range(700)]
    rows += [(100 + i % 40, i // 40, "u", f"t{i // 40}") for i in range(40 * 30)]                          # copies
    rows += [(c, i, "u", f"x{i // 3}") for c in (777, 778) for i in range(4500)]                           # very long ones
    rows += [(900, 0, "u", "only turn"), (10**12, 1, "u", "x" * 200_000)] + [rows[0]] * 4
    want = trie(rows)
    assert everything(conversation_trie(talk(spark, rows)), *NODE) == want
    assert everything(conversation_trie(talk(spark, rows), band=3, shard=50), *NODE) == want
    assert conversation_trie(talk(spark, [])).count() == 0


def test_parents_with_very_many_children(spark):
    rows = [(c, t, "u", "hello" if not t else f"{c}") for c in range(3000) for t in range(9)]
    assert everything(conversation_trie(talk(spark, rows)), *NODE) == trie(rows)


def test_node_table_is_minimal_perfect_and_checked():
    rng = np.random.RandomState(1)
    for n in (1, 2, 50, 5000):
        depth, d1, d2 = (rng.randint(0, 1 << 40, n) for _ in range(3))
        again = rng.randint(0, n, 3 * n)
        table = NodeTable(depth[again], d1[again], d2[again])
        slots = table.lookup(depth[again], d1[again], d2[again])
        assert len(table.depth) == len(np.unique(again)) and set(slots) == set(range(len(table.depth)))
        assert (table.d1[slots] == d1[again]).all()
        with pytest.raises(ValueError):
            table.lookup(depth[:1] + 1, d1[:1], d2[:1])


def test_digests_do_not_depend_on_where_runs_are_cut():
    lanes = prefix_trie.lanes_of([hashlib.sha256(str(i).encode()).digest()[:16] for i in range(300)])
    whole = prefix_trie.prefix_sums(lanes)
    for cut in (0, 1, 150, 299):
        tail = prefix_trie.prefix_sums(lanes[:, cut:]) * prefix_trie.power(cut)[:, None] % np.uint64(prefix_trie.PRIME)
        assert ((whole[:, cut:cut + 1] + tail) % np.uint64(prefix_trie.PRIME) == whole[:, cut:]).all()
