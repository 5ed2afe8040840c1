"""Line de-duplication across documents with DataFrame operations only.

Lines are exploded, normalised and hashed (two 64-bit hashes); a key found in at least ``min_docs`` documents loses all
its lines except in the smallest document that holds it; the kept lines are put together again by position.

The lines are hashed once into a durable table of ids, positions and hashes. min() and max() of the document id combine
before the shuffle, so a line that a third of all documents hold costs one row per task. Keys that hold a share of
1 / ``HOT`` of all lines or more, of which there are at most ``HOT``, are broadcast to their lines, which therefore aren't
shuffled; the others are joined by hash, and none of them can fill a task. The text is shuffled once, to meet the dropped
positions of its document.

Defined cases: a null text is one empty line, as is an empty one; rows with a null id count as one document that comes
after all others; repeated rows (same id and text) give repeated results and count as one document; extra columns are
not read unless ``carry`` names them, and a carried name that a result column has is a ValueError; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import BLANKS, NO_ID, ascii_lower, durable

MIN_CHARS = 10
MIN_DOCS = 2
#: A key is hot from this part of all lines on.
HOT = 1000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_positions(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(_id, _fp, _drop): per document that loses lines, their positions from 0."""
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text_col).alias("_fp"), F.posexplode(split_lines(F.col(text_col))).alias("_pos", "_line"))
    trimmed = lines.select("_id", "_fp", "_pos", F.btrim("_line", F.lit(BLANKS)).alias("_line")).where(F.char_length("_line") >= min_chars)
    keyed = trimmed.select("_id", "_fp", "_pos", ascii_lower(F.col("_line")).alias("_key"))
    hashed = durable(keyed.select("_id", "_fp", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), F.col("_key")).alias("_h2")))
    holders = hashed.groupBy("_h1", "_h2")
    if min_docs == 2:  # two documents at least: the smallest and the largest id differ
        common = holders.agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.count("*").alias("_n")).where("_first < _last")
    else:
        common = holders.agg(F.min("_id").alias("_first"), F.count_distinct("_id").alias("_docs"), F.count("*").alias("_n")).where(F.col("_docs") >= min_docs)
    common = durable(common.select("_h1", "_h2", "_first", "_n"))
    is_hot = F.col("_n") * HOT >= hashed.count()
    key = ["_h1", "_h2"]
    hot = F.broadcast(common.where(is_hot).drop("_n"))  # at most HOT rows
    rest = hashed.join(hot.select(*key), key, "left_anti").join(common.where(~is_hot).drop("_n"), key)
    met = hashed.join(hot, key).unionByName(rest)
    return met.where("_id <> _first").groupBy("_id", "_fp").agg(F.collect_set("_pos").alias("_drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """id, the carried columns, ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``; one row per row of docs."""
    if clash := {id_col, *carry} & {"kept_text", "n_lines", "n_dropped"}:
        raise ValueError(f"columns {sorted(clash)} are results of dedup_lines")
    docs = docs.select(*dict.fromkeys([id_col, text_col, *carry]))
    drop = dropped_positions(docs, id_col, text_col, min_chars, min_docs)
    own = docs.withColumns({"_own_id": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "_own_fp": F.xxhash64(text_col)})
    met = own.join(drop, (F.col("_own_id") == F.col("_id")) & (F.col("_own_fp") == F.col("_fp")), "left").withColumn("_lines", split_lines(F.col(text_col)))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n")
    return met.select(
        id_col,
        *carry,
        F.when(F.col("_drop").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
    )
