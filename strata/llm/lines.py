"""Line dedup: drop lines that many documents share, except in one of them.

Two passes over the texts produce ``(line key, document)`` rows; the keys
shared by enough documents come from one hash aggregate with a map-side
combine, so a line in a third of all documents reaches the reducers as one
row per map task.  The second join carries hot keys, which adaptive execution
splits.  Reassembly happens per document, next to its text.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.text import LOWER, SPACES, ship
from strata.session import stored


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit key of a line: stripped, A-Z lower-cased; None when shorter than ``min_chars`` code points."""
    line = line.strip(SPACES)
    if len(line) < min_chars or not line.isascii() and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line.translate(LOWER))


def _keys(min_chars):
    def run(batches):
        for batch in batches:
            ids, owners, keys = batch.column(0), [], []
            for i, text in enumerate(batch.column(1)):
                own = {line_key(x, min_chars) for x in (text.as_py() or "").encode().split(b"\n")} - {None}
                keys += own
                owners += [i] * len(own)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(owners, pa.int32())), pa.array(keys, pa.binary())], ["doc", "key"])
    return run


def _reassemble(min_chars, at):
    """Rows with the text (column ``at``) replaced by its other lines, and the line counts at the end."""
    def run(batches):
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                text, drop = text.as_py(), drop.as_py()
                lines = (text or "").encode().split(b"\n")
                drop = set(drop or ())
                stay = [x for x in lines if line_key(x, min_chars) not in drop] if drop else lines
                kept.append(b"\n".join(stay).decode() if text is not None else None)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            columns = [*batch.columns[:-1], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_lines", "n_dropped"])
    return run


def drop_shared_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                      min_docs: int = 3) -> DataFrame:
    """``df`` with the text without its shared lines, all other columns as they are, then ``n_lines`` and ``n_dropped``.

    Lines whose key is in at least ``min_docs`` documents stay only in the largest id that holds it.  Lines end at
    ``\\n`` alone; keys of fewer than ``min_chars`` code points never count.  A null text stays null and is one empty
    line, as an empty one is.  Each row is a document: rows that repeat an id count once each and share its decisions.
    A row without an id counts, but is never the one that keeps a line; if no document that holds a line has an id,
    no row keeps it.  An empty table gives no rows.
    """
    ship(df.sparkSession)
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    own, text = (names[df.columns.index(c)] for c in (id_col, text_col))
    kind = plain.schema[own].dataType.simpleString()
    # a row without an id is known by its text; its hash has a column of its own, as an id may be of any type
    docs = plain.withColumns({"doc": F.col(own), "anonymous": F.when(F.col(own).isNull(), F.xxhash64(text))})
    lines = docs.select(F.struct("doc", "anonymous").alias("doc"), F.col(text).alias("text")).mapInArrow(
        _keys(min_chars), f"doc struct<doc:{kind},anonymous:long>, key binary").select("doc.*", "key")
    # written, so that the join below has nothing but exchanges under it and adaptive execution can split its hot keys
    shared = stored(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs).select("key", "keeper"),
                    "shared-lines")
    drops = (lines.join(shared, "key").where(F.col("doc").isNull() | F.col("keeper").isNull() | (F.col("doc") != F.col("keeper")))
             .groupBy(F.col("doc").alias("of_doc"), F.col("anonymous").alias("of_anonymous")).agg(F.collect_set("key").alias("drop")))
    joined = docs.join(drops, docs["doc"].eqNullSafe(drops["of_doc"]) & docs["anonymous"].eqNullSafe(drops["of_anonymous"]), "left").select(*names, "drop")
    schema = T.StructType([*plain.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(_reassemble(min_chars, names.index(text)), schema).toDF(*df.columns, "n_lines", "n_dropped")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col, kept (string), n_lines (before dropping), n_dropped`` of every row, as :func:`drop_shared_lines` decides."""
    out = drop_shared_lines(df.select(id_col, text_col), id_col, text_col, **options)
    return out.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("kept"), "n_lines", "n_dropped")
