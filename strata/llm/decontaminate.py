"""Benchmark decontamination with DataFrame functions only.

The benchmark's word windows are hashed once and sent with the plan as a hash
set (behind a check of their number; beyond it the same windows are joined by
shuffle).  Each text's windows are tested where the text is read; the few that
hit are verified word by word against the windows themselves, and the words
that verified windows cover decide what goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.urls import lower_ascii

#: What separates words once A-Z are lower-cased: ASCII other than digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _starts(words: Column, length: int) -> Column:
    return F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = 13,
                      unnamed: bool = False) -> DataFrame:
    """``window (array<string>), length, items (array<string>)``: every window of ``n`` words, or the one of a shorter item.

    Items without words (null or empty texts) have no window.  Items without an id are left out, or (``unnamed``) have windows too and are in no list of items.
    """
    items = (benchmark.where(F.lit(unnamed) | F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
             .withColumn("length", F.least(F.size("words"), F.lit(n))).where("length > 0"))
    at = items.select("item", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("at"))
    return (at.select("item", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("window"))
            .groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .withColumn("hash", F.xxhash64("window")))


def _with_length(starts: Column, length: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(length).alias("length")))


def _candidates(docs: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """``docs`` with ``hits``: array of (start, hash, window) that may be benchmark windows."""
    empty = F.array().cast("array<int>")
    found = []
    for length in lengths:
        own = windows.where(F.col("length") == length)
        if not small:
            starts = _starts(F.col("words"), length)
        else:
            hashes = [r[0] for r in own.select("hash").distinct().collect()]
            heads = [r[0] for r in own.select(F.xxhash64(*[F.col("window")[i] for i in range(min(length, 2))])).distinct().collect()]

            head = ", ".join(f"get(words, i + {k})" for k in range(min(length, 2)))
            starts = _starts(F.col("words"), length)
            docs = docs.withColumn(f"starts{length}", starts)
            starts = F.expr(f"filter(starts{length}, i -> xxhash64({head}) IN ({', '.join(map(str, heads))}) "
                            f"AND xxhash64(slice(words, i + 1, {length})) IN ({', '.join(map(str, hashes))}))")
        found.append(_with_length(starts, length))
    at = F.concat(*found) if found else F.transform(empty, lambda i: F.struct(i.alias("start"), i.alias("length")))
    return docs.withColumn("at", at).withColumn(
        "hits", F.transform("at", lambda x: F.struct(x["start"].alias("start"), F.slice("words", x["start"] + 1, x["length"]).alias("window"))))


def find_contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", n: int = 13, share: int = 20, max_windows: int = 100_000,
                       unnamed: bool = False) -> DataFrame:
    """``id_col, n_words, hit_words (sorted positions), n_hit, items (sorted as strings), contaminated`` per row of ``df``.

    A word is hit when any occurrence of a benchmark window covers it; a row is contaminated when it has a hit word
    and ``share`` times its hit words reach its words.  A null text has no words; rows that repeat are judged alike,
    each on its own; without benchmark rows nothing is hit.  ``unnamed`` items, without an id, hit but are not listed.  Up to ``max_windows`` distinct windows (about 100 bytes
    each) travel as a hash set and a broadcast; more are joined by shuffle, with the same result.
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, n, unnamed)
    lengths = {r["length"]: r["count"] for r in windows.groupBy("length").count().collect()}
    small = sum(lengths.values()) <= max_windows
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    tried = _candidates(docs, windows, sorted(lengths), small).select("row", "id", F.size("words").cast("long").alias("n_words"), "hits")
    exploded = tried.select("row", "id", "n_words", F.explode_outer("hits").alias("hit")).select(
        "row", "id", "n_words", "hit.start", "hit.window").withColumn("hash", F.xxhash64("window"))
    listed = windows.select("hash", "window", "items", "length")
    verified = exploded.join(F.broadcast(listed) if small else listed, ["hash", "window"], "left")
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    none = F.array().cast("array<int>")
    return (verified.groupBy("row").agg(
                F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                F.collect_list(F.when(F.col("items").isNotNull(), F.struct("start", "length"))).alias("spans"),
                F.collect_set("items").alias("items"))
            .select(F.col("id").alias(id_col), "n_words",
                    F.when(F.size("spans") > 0, F.array_sort(F.array_distinct(covered))).otherwise(none).alias("hit_words"),
                    F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
            .withColumn("n_hit", F.size("hit_words").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: str = "documents",
                  **options) -> DataFrame:
    """``df`` without its contaminated documents, or (``remove="spans"``) with their hit words cut out; columns as they are.

    With spans, a contaminated text becomes its other words, lower-cased and joined by one space.  Rows with the same id
    must be equal texts or count as one document: an id goes when any of its rows is contaminated.  A row without an id is
    known by its text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove: documents or spans")
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    own, text = (F.col(f"c{columns.index(c)}") for c in (id_col, text_col))
    keyed = plain.withColumn("key", F.coalesce(own.cast("string"), F.concat(F.lit("text:"), F.sha2(text, 256)), F.lit("none")))
    judged = find_contamination(keyed, benchmark, "key", f"c{columns.index(text_col)}", **options).where("contaminated")
    if remove == "documents":
        return keyed.join(judged.select("key").distinct(), "key", "left_anti").drop("key").toDF(*columns)
    hits = judged.groupBy("key").agg(F.max("hit_words").alias("hit_words"))
    joined = keyed.join(hits, "key", "left").withColumn("words", words_of(text))
    cut = F.array_join(F.filter("words", lambda w, i: ~F.array_contains("hit_words", i)), " ")
    name = f"c{columns.index(text_col)}"
    return joined.withColumn(name, F.when(F.col("hit_words").isNull(), F.col(name)).otherwise(cut)).select(*plain.columns).toDF(*columns)
