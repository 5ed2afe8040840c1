"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and grouping by links.

1. One pass over the texts: the set of word shingles (64-bit hashes), a fingerprint of the set and its SuperMinHash
   signature, cut into bands. SuperMinHash gives every element one random rank per signature place (a random permutation,
   dealt by Fisher-Yates, plus a fraction) and keeps minima; a document is finished as soon as no further rank can lower
   any place.
2. Documents with equal sets form a class; only its smallest id is compared further.
3. Band buckets: every class is paired with the smallest of its bucket (a star, never all pairs), candidate texts are
   gathered once, pairs are verified on full sets and links grouped.
4. Buckets that still hold several groups are searched for links across them by exact bounds only. In an order of shingles
   that puts those few documents have first, two sets of the similarity share one of their first n - ceil(0.8 n) + 1
   shingles (their prefixes), so a document whose prefix no other document of these buckets shares leaves the search. A pair
   of one bucket is looked at in the first bucket the two share; sizes, prefixes and at last the full sets are compared
   there, and links come out of that join, not pairs. A bucket of more than ``SPLIT`` documents is dealt out by prefix
   shingle first, so its work follows what its documents share beyond their common part, not the square of its size.

At 0.8 and 30 bands of 5 rows a linked pair shares no band with probability 7e-6; nothing else can lose a link, and two
groups stay apart only if that happens to every link between them.

Defined cases: null or blank texts have no shingles and link with nothing; rows with a null id count as one document that
comes after all others (its component shows as null where it stands alone); rows with the same id count as one document,
each with its own n_shingles; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import NO_ID, components, durable, forget, slices, small_batches
from courtside.llm.tokens import mix, shingles, words_of_batch

WORDS = 5
PERCENT = 80
BANDS, ROWS = 30, 5
#: Larger buckets are dealt out by prefix shingle.
SPLIT = 5000
#: Elements that get ranks together.
CHUNK = 60_000
_FRACTION = 24


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of m signature values for every set of distinct 64-bit hashes (an empty set keeps the largest value).

    A value is rank * 2**24 + a 24-bit fraction, so m is at most 255.
    """
    sig = np.full((len(sets), m), 0xFFFFFFFF, dtype=np.uint32)
    begin = 0
    while begin < len(sets):
        end, held = begin, 0
        while end < len(sets) and (end == begin or held + len(sets[end]) <= CHUNK):
            held += len(sets[end])
            end += 1
        _rank(sets[begin:end], sig[begin:end], m)
        begin = end
    return sig


def _rank(sets: list[np.ndarray], sig: np.ndarray, m: int) -> None:
    e = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    d = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat, perm, first = sig.reshape(-1), None, None
    for j in range(m):
        if not len(e):
            return
        with np.errstate(over="ignore"):
            r = mix(e + np.uint64(j + 1) * np.uint64(0xD1342543DE82EF95))
        k = (j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.intp)
        if j == 0:
            place, first = k, k
        else:
            rows = np.arange(len(e))
            place = perm[rows, k].astype(np.intp)
            perm[rows, k] = perm[:, j]
        np.minimum.at(flat, d * m + place, (np.uint32(j << _FRACTION) | (r >> np.uint64(64 - _FRACTION)).astype(np.uint32)))
        open_docs = sig.max(axis=1) >= np.uint32(min((j + 1) << _FRACTION, 0xFFFFFFFF))
        keep = open_docs[d]
        if j == 0:
            e, d, first = e[keep], d[keep], first[keep]
            perm = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(e), m)).copy()
            perm[np.arange(len(e)), first] = 0
        elif not keep.all():
            e, d, perm = e[keep], d[keep], perm[keep]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    with np.errstate(over="ignore"):
        for i in range(rows):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + sig[:, i : bands * rows : rows].astype(np.uint64))
    return acc.view(np.int64)


def text_bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n, f1, f2, bands) for (id, text): set size, set fingerprint (null for an empty set) and band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [np.unique(shingles(w, words)) for w in words_of_batch(text_bytes(batch.column(1)))]
            keys = band_keys(super_minhash(sets, bands * rows), bands, rows)
            empty = np.array([not len(s) for s in sets], dtype=bool)
            with np.errstate(over="ignore"):
                f1 = np.array([np.add.reduce(s) for s in sets], dtype=np.uint64).view(np.int64)
                f2 = np.array([np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(f1, pa.int64(), mask=empty),
                    pa.array(f2, pa.int64(), mask=empty),
                    pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(keys.reshape(-1))),
                ],
                names=["id", "n", "f1", "f2", "bands"],
            )

    return docs.mapInArrow(sign, "id long, n long, f1 long, f2 long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) of pairs whose full sets reach the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, rows=500):
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            own = {t: None for t in left} | {t: None for t in right}
            for t, w in zip(list(own), words_of_batch(list(own)), strict=True):
                own[t] = np.unique(shingles(w, words))
            keep = []
            for x, y in zip(left, right, strict=True):
                x, y = own[x], own[y]
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = np.array(keep, dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def mixed(buckets: DataFrame) -> DataFrame:
    """Of buckets(key, id, group, ...), the rows of those with several groups."""
    several = buckets.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("key")
    return buckets.join(durable(several), "key")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, set) of texts(id, text): the hashes of all their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [np.unique(shingles(w, words)) for w in words_of_batch(text_bytes(batch.column(1)))]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)))], names=["id", "set"])

    return texts.select("id", "text").mapInArrow(run, "id long, set array<long>")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, set, prefix) of sets(id, set), without those that no other can be similar to.

    The order of shingles is: those in one document, those in two (by value), all others in the order of the sets. The
    first kind is counted in the prefix and left out of it, as nothing can share it.
    """
    seen = sets.select("id", F.explode("set").alias("h")).groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("n <= 2")
    own = seen.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("id"), "n", "h").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("few"))  # at most the set
    met = sets.join(own, "id", "left").withColumn("few", F.coalesce("few", F.array().cast("array<struct<n:bigint,h:bigint>>")))
    lone = F.size(F.filter("few", lambda x: x["n"] == 1))
    size = F.size("set")
    room = (size - F.floor((percent * size + 99) / 100) + 1 - lone).cast("int")
    ordered = F.concat(F.transform(F.filter("few", lambda x: x["n"] == 2), lambda x: x["h"]), F.array_except("set", F.transform("few", lambda x: x["h"])))
    return met.withColumn("room", room).where("room > 0").select("id", "set", F.slice(ordered, F.lit(1), F.col("room")).alias("prefix"))


def links_across(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the links between different groups of buckets(key, id, group, set, prefix, bands).

    The full sets are compared within the join, after the bounds, so only links leave it.
    """
    side = lambda s: buckets.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "group", "set", "prefix", "bands")])
    n_a, n_b = F.size("set_a"), F.size("set_b")
    reach = lambda common: 100 * common >= percent * (n_a + n_b - common)
    # a case is decided by its first true branch, so the costly comparison comes last and rarely
    link = (
        F.when(F.col("group_a") >= F.col("group_b"), False)
        .when(~reach(F.least(n_a, n_b)), False)
        .when(F.get(F.array_intersect("bands_a", "bands_b"), 0) != F.col("key"), False)
        .when(~F.arrays_overlap("prefix_a", "prefix_b"), False)
        .otherwise(reach(F.size(F.array_intersect("set_a", "set_b"))))
    )
    return side("a").join(side("b").withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & link).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def pairs_across(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different groups of buckets(key, id, group, set, prefix) that share a prefix shingle there and
    whose sizes allow the similarity."""
    rows = buckets.select("key", "id", "group", F.size("set").alias("n"), F.explode("prefix").alias("h"))
    several = durable(rows.groupBy("key", "h").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("key", "h"))
    rows = rows.join(several, ["key", "h"])
    side = lambda s: rows.select(F.col("key").alias(f"key_{s}"), F.col("h").alias(f"h_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("id", "group", "n")])
    fits = (F.col("group_a") < F.col("group_b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    met = side("a").join(side("b"), (F.col("key_a") == F.col("key_b")) & (F.col("h_a") == F.col("h_b")) & fits)
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, n_shingles, component_id (the smallest id that links reach) and kept (it is that id); a row per row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    sig = durable(signed(texts, words, bands, rows))
    classes = durable(sig.where("f1 is not null").groupBy("f1", "f2").agg(F.min("id").alias("id"), F.first("bands").alias("bands")))
    keys = classes.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first")
    buckets = durable(keys.join(shared, "key").select("key", "id", "first"))
    pairs = durable(buckets.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct())
    candidates = durable(texts.join(buckets.select("id").distinct(), "id", "left_semi"))
    links = durable(verified(pairs, candidates, words, percent))
    groups = components(links)
    placed = buckets.join(groups.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("group"))
    open_ = durable(mixed(placed))
    searched = candidates.join(open_.select("id").distinct(), "id", "left_semi")
    sets = durable(shingle_sets(searched, words))
    able = durable(prefixes(sets, percent).join(classes.select("id", "bands"), "id"))
    still = durable(mixed(open_.join(able.select("id"), "id")))
    large = durable(still.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT).select("key"))
    links = links.unionByName(links_across(still.join(large, "key", "left_anti").join(able, "id"), percent))
    if large.limit(1).count():
        links = links.unionByName(verified(pairs_across(still.join(large, "key").join(able, "id"), percent), candidates, words, percent))
    groups = components(durable(links))
    # a class may stand for several rows; its group goes to all of them by the fingerprint
    own = classes.select("f1", "f2", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("component"))
    own = durable(own)
    forget(spark, candidates)
    met = sig.select("id", "n", F.coalesce("f1", F.lit(0)).alias("f1"), "f2").join(own, ["f1", "f2"], "left")
    component = F.coalesce("component", "id")
    shown = lambda c: F.when(c == NO_ID, F.lit(None)).otherwise(c)
    return met.select(shown(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"), shown(component).alias("component_id"), (F.col("id") == component).alias("kept"))
