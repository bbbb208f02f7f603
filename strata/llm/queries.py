"""One query per operator over its whole table, and DuckDB SQL where SQL can express the result.

The queries only pick the table, the production parameters and the digest
columns; the work is the operators'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    from strata.llm.bpe import encode_texts
    out = encode_texts(_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_suffix_array_dedup(spark, sf_dir):
    from strata.llm.suffix_array import remove_repeats
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_url_filter(spark, sf_dir):
    from strata.llm.urls import filter_urls
    return filter_urls(_table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark, sf_dir):
    from strata.llm.jaccard import similar_components
    return similar_components(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


OP4_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT p.a, p.b FROM pairs p JOIN sizes x ON p.a = x.doc_id JOIN sizes y ON p.b = y.doc_id WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS start FROM documents UNION SELECT l.b, r.start FROM reach r JOIN both_ways l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.start) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""


def op5_decontaminate(spark, sf_dir):
    from strata.llm.decontaminate import find_contamination
    out = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), unnamed=True)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM grams),
spots AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT s.doc_id, s.i, s.n, g.item_id FROM spots s JOIN grams g ON s.n = g.n AND s.g = g.g),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)"""


def op6_line_dedup(spark, sf_dir):
    from strata.llm.lines import dedup_lines
    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.pos, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(d.ls) AS line, unnest(range(len(d.ls))) AS pos) u),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AND l.doc_id <> s.keeper AS dropped FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def op7_substring_dedup(spark, sf_dir):
    from strata.llm.suffix_tree import remove_later_repeats
    out = remove_later_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs)
SELECT d.doc_id, count(w.i) AS n_words, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM docs d LEFT JOIN words w USING (doc_id) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY d.doc_id"""


def op8_license_scan(spark, sf_dir):
    from strata.llm.licenses import scan_licenses
    out = scan_licenses(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def op9_quality_rules(spark, sf_dir):
    import public_tokenizers as P

    from strata.llm.rules import judge_texts
    out = judge_texts(_table(spark, sf_dir, "documents"), P.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "chars_per_token", "fallback_share", "token_entropy")


def op10_quality_classifier(spark, sf_dir):
    from strata.llm.quality import held_out, score_texts, train
    docs = _table(spark, sf_dir, "documents")
    model = train(docs, _table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


def op11_spelling_variants(spark, sf_dir):
    from strata.llm.spelling import group_spellings
    return group_spellings(_table(spark, sf_dir, "documents"))


def op12_language_id(spark, sf_dir):
    from strata.llm.langid import held_out, predict_language, sample_languages
    docs = _table(spark, sf_dir, "documents")
    out = predict_language(docs, sample_languages(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op13_prefix_trie(spark, sf_dir):
    from strata.llm.prefix_trie import conversation_trie
    return conversation_trie(_table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) AS seq
  FROM turns GROUP BY conv_id),
borrow AS (
  SELECT conv_id, conv_id - conv_id % 5 AS lender, xor(list_reduce(
           list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT)),
           lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)),
           4294967295), 4294967295) % 9 AS h
  FROM own),
built AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(l.seq, []), 1, b.h), list_slice(o.seq, b.h + 1, len(o.seq))) AS seq
  FROM own o JOIN borrow b USING (conv_id) LEFT JOIN own l ON l.conv_id = b.lender),
prefixes AS (
  SELECT conv_id, d, list_slice(seq, 1, d) AS p, d = len(seq) AS is_end FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM built)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends
  FROM prefixes GROUP BY d, p),
children AS (SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT a.d, a.p, count(*) FILTER (WHERE c.n IS NULL) AS leaves, sum(CASE WHEN b.d > 0 THEN (b.n - 1) * octet_length(encode(b.p[b.d].text)) ELSE 0 END) AS saved
  FROM nodes a JOIN nodes b ON b.d >= a.d AND list_slice(b.p, 1, a.d) = a.p LEFT JOIN children c ON c.d = b.d AND c.p = b.p GROUP BY a.d, a.p)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN below s ON s.d = n.d AND s.p = n.p LEFT JOIN children c ON c.d = n.d AND c.p = n.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = list_slice(n.p, 1, n.d - 1)"""


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_language_id": op12_language_id,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op4_jaccard_join": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op13_prefix_trie": OP13_SQL,
}
