"""Benchmark decontamination by spaced seeds.

A mask of fixed shape ignores some word positions of a window, so a window whose differing words fall on ignored positions
hashes as the original does. Every window of every benchmark item is hashed under its masks, document windows are hashed
in the same way, and both sides are joined on the hash. A hit fixes the alignment of a document with an item, and the words
around it are compared one by one. Of an item of ``LONG`` words and more, the best run of aligned words, in which a match
gains 1 and a substitution costs 2, is an overlap if it holds ``min_words`` matching words. A shorter item overlaps if
``short_share`` of its words (``min_words`` at most) match anywhere in the alignment.

Items of ``LONG`` words and more use ``LONG_MASKS``, which find every stretch of 16 words with at most two substitutions.
Items of 5 to 16 words use ``SHORT_MASKS``: between them these forgive any one substitution among five words, and with
0.8 of the words matching there are five in a row with at most one, so no overlap with a short item is missed. Items below
5 words must match whole and are one window of their own length.

Ways to join: an index of at most ``block_bytes`` of benchmark text is broadcast and looked up while the documents
are read, which shuffles nothing. A larger benchmark stays distributed: document windows that pass a bit table of all
seeds (broadcast, 2**``FILTER_BITS`` bits) are joined with the seeds by hash, and only texts with hits are gathered for
verification. Both give the same rows. Alignments are listed and verified in pieces of bounded size however often a
word repeats.

Defined cases: null and blank texts of either table match nothing; repeated rows give repeated results; repeated items are
listed once by their id with their best overlap (the first one in the text of several equal ones), a null item id as -1;
extra columns are not read unless ``carry`` names them (a name that a result column has is a ValueError); with an empty
benchmark all documents are clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import durable, slices, small_batches
from courtside.llm.minhash import text_bytes
from courtside.llm.tokens import mix, words_of_batch

# 1 marks a word that counts, 0 one that is ignored.
LONG_MASKS = ("11101101011", "11010111011", "1101100010111", "111100001111")
SHORT_MASKS = ("1111", "11011", "10111", "11101")
LONG = 17
MIN_WORDS = 13
SHORT_SHARE = 0.8
BLOCK_BYTES = 16 << 20
FILTER_BITS = 27
#: Alignments that are listed together, and aligned words that are compared together.
HITS, COMPARED = 1 << 20, 1 << 22
_B = np.uint64(0x9E3779B97F4A7C15)


def masks_for(n: int) -> tuple[str, ...]:
    """The masks that look for an item of n words."""
    return LONG_MASKS if n >= LONG else SHORT_MASKS if n >= 5 else ("1" * n,)


def spaced(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window under a mask."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, int(mask, 2), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i, c in enumerate(mask):
            if c == "1":
                acc = mix(acc * _B + words[i : i + n])
    return acc


def joined(parts: list[np.ndarray], kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(all parts as one, where each begins and the last ends)."""
    return np.concatenate([*parts, np.empty(0, kind)]), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


class Aligned:
    """Texts and items as hashed words, with the verification of alignments between them."""

    def __init__(self, texts: list[np.ndarray], items: list[np.ndarray]) -> None:
        (self.text, self.text_at), (self.item, self.item_at) = joined(texts), joined(items)

    def overlaps(self, text: np.ndarray, item: np.ndarray, shift: np.ndarray, min_words: int, short_share: float) -> tuple[np.ndarray, ...]:
        """(text, item, matches, first word, one past the last) of each alignment that holds an overlap; text position
        minus item position is the shift."""
        n_text, n_item = np.diff(self.text_at)[text], np.diff(self.item_at)[item]
        begin, stop = np.maximum(0, shift), np.minimum(n_text, shift + n_item)
        keep = stop > begin
        text, item, shift, begin, stop, n_item = (x[keep] for x in (text, item, shift, begin, stop, n_item))
        need = np.minimum(min_words, np.maximum(1, np.ceil(short_share * n_item - 1e-9))).astype(np.int64)
        out = []
        ends = np.cumsum(stop - begin)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED, "right")))
            part = slice(at, to)
            matches, first, last = self._runs(self.text_at[text[part]] + begin[part], self.item_at[item[part]] + begin[part] - shift[part], (stop - begin)[part], n_item[part] < LONG)
            ok = matches >= need[part]
            out.append((text[part][ok], item[part][ok], matches[ok], (begin[part] + first)[ok], (begin[part] + last)[ok]))
            at = to
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(5))

    def _runs(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best run of each alignment of ``size`` words from a and b on, or where ``whole`` says so all from the first
        to the last match: (matches, start, one past its end)."""
        starts = np.concatenate(([0], np.cumsum(size)))[:-1]
        segment = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(segment)) - starts[segment]
        same = self.text[a[segment] + inside] == self.item[b[segment] + inside]
        gain = np.where(same, 1, np.where(whole, 0, -2)[segment]).astype(np.int64)
        after = np.cumsum(gain)
        after -= (after[starts] - gain[starts])[segment]
        before = after - gain
        # segments are set apart so far that the running minimum starts anew with each
        apart = segment * (4 * int(size.max()) + 4)
        low = np.minimum.accumulate(before - apart) + apart
        value = after - low

        def first(where: np.ndarray) -> np.ndarray:
            at = np.flatnonzero(where)
            _, k = np.unique(segment[at], return_index=True)
            return at[k]

        end = first(value == np.maximum.reduceat(value, starts)[segment])
        start = first((before == low[end][segment]) & (same | ~whole[segment] | (np.arange(len(same)) == end[segment])))
        held = np.concatenate(([0], np.cumsum(same)))
        return held[end + 1] - held[start], start - starts, end + 1 - starts


class Index:
    """The seeds of items: for each mask sorted hashes with item and position, and the items' words."""

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        self.words = [w for _, w in items]
        seeds: dict[str, list[tuple[np.ndarray, int]]] = {}
        for k, w in enumerate(self.words):
            for m in masks_for(len(w)) if len(w) else ():
                seeds.setdefault(m, []).append((spaced(w, m), k))
        self.tables = {}
        for m, own in seeds.items():
            h = np.concatenate([s for s, _ in own])
            item = np.repeat([k for _, k in own], [len(s) for s, _ in own])
            at = np.concatenate([np.arange(len(s)) for s, _ in own])
            order = np.argsort(h, kind="stable")
            few = np.zeros(1 << 16, dtype=bool)  # most windows already differ in these bits
            few[h >> np.uint64(48)] = True
            self.tables[m] = (h[order], item[order], at[order], few)

    def hits(self, words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces of (text, item, shift), the distinct alignments of seed hits; text i has the words up to ends[i]."""
        begins = np.concatenate(([0], ends))[:-1]
        held, size = [], 0
        for m, (h, item, at, few) in self.tables.items():
            own = spaced(words, m)
            place = np.flatnonzero(few[own >> np.uint64(48)])
            lo = np.searchsorted(h, own[place], "left")
            same = h[np.minimum(lo, len(h) - 1)] == own[place]
            place, lo = place[same], lo[same]
            text = np.searchsorted(ends, place, "right")
            inside = place + len(m) <= ends[text] if len(place) else same[:0]
            place, lo, text = place[inside], lo[inside], text[inside]
            count = np.searchsorted(h, own[place], "right") - lo
            edge, begin = np.cumsum(count), 0
            while begin < len(place):
                stop = max(begin + 1, int(np.searchsorted(edge, (edge[begin - 1] if begin else 0) + HITS, "right")))
                n = count[begin:stop]
                k = np.repeat(lo[begin:stop] - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(n.sum())
                t = np.repeat(text[begin:stop], n)
                held.append((t, item[k], np.repeat(place[begin:stop], n) - begins[t] - at[k]))
                size += len(t)
                begin = stop
                if size >= HITS:
                    yield distinct(held)
                    held, size = [], 0
        if held:
            yield distinct(held)


def distinct(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The distinct rows of the parts, in order."""
    cols = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)]
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return tuple(c[new] for c in cols)


def best_of(index: Index, texts: list[np.ndarray], min_words: int, short_share: float) -> dict[int, list[tuple[int, int, int, int]]]:
    """text -> (item id, matches, first word, one past the last) of its best overlap with every item id, in order."""
    both = Aligned(texts, index.words)
    found = [both.overlaps(*hits, min_words, short_share) for hits in index.hits(both.text, both.text_at[1:])]
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    if not found:
        return out
    text, item, matches, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    ids = index.ids[item]
    order = np.lexsort((last, first, -matches, ids, text))
    seen = None
    for row in zip(*(x[order].tolist() for x in (text, ids, matches, first, last)), strict=True):
        if row[:2] != seen:
            seen = row[:2]
            out.setdefault(row[0], []).append(row[1:])
    return out


_RESULT = "items array<long>, matches array<long>, spans array<array<long>>"


def looked_up(docs: DataFrame, items: list[tuple[int, str]], text_col: str, min_words: int, short_share: float) -> DataFrame:
    """docs with the result columns, by a broadcast index."""
    words = words_of_batch([t.encode() for _, t in items])
    index = docs.sparkSession.sparkContext.broadcast(Index([(i, w) for (i, _), w in zip(items, words, strict=True) if len(w)]))
    names = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, names.index(text_col)):
            hashed = words_of_batch(text_bytes(batch.column(names.index(text_col))))
            found = best_of(index.value, hashed, min_words, short_share)
            rows = [found.get(i, []) for i in range(batch.num_rows)]
            new = [pa.array([[x[0] for x in r] for r in rows], pa.list_(pa.int64())), pa.array([[x[1] for x in r] for r in rows], pa.list_(pa.int64())), pa.array([[list(x[2:]) for x in r] for r in rows], pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*names, "items", "matches", "spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{schema}, {_RESULT}")


def joined_seeds(docs: DataFrame, items: DataFrame, text_col: str, min_words: int, short_share: float) -> DataFrame:
    """docs with the result columns, by a join of document windows with the seeds of items(id, text)."""
    spark = docs.sparkSession
    items = durable(items.withColumn("item", F.xxhash64("id", "text")).dropDuplicates(["item"]))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            own = words_of_batch(text_bytes(batch.column(1)))
            parts = [(h := spaced(w, m), np.full(len(h), item), np.full(len(h), len(m), np.int32), np.arange(len(h))) for item, w in zip(batch.column(2).to_pylist(), own, strict=True) if len(w) for m in masks_for(len(w))]
            h, item, size, at = (np.concatenate([*x]) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(item.astype(np.int64)), pa.array(size), pa.array(at)], names=["h", "item", "size", "at"])

    known = durable(items.select("id", "text", "item").mapInArrow(seeds, "h long, item long, size int, at long"))
    used = sorted({m for n in [r[0] for r in known.select("size").distinct().collect()] for m in (*LONG_MASKS, *SHORT_MASKS, *("1" * k for k in range(1, 5))) if len(m) == n})
    # at most 2**(FILTER_BITS - 6) rows
    words_ = known.groupBy(F.shiftrightunsigned("h", 70 - FILTER_BITS).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - FILTER_BITS}) & 63 as int))")).alias("bits")).toPandas()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words_["w"].to_numpy(np.int64)] = words_["bits"].to_numpy(np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(bits)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, 0):
            text, at = joined(words_of_batch(text_bytes(batch.column(0))))
            ends = at[1:]
            f1, f2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for m in used:
                own = spaced(text, m)
                key = own >> np.uint64(64 - FILTER_BITS)
                place = np.flatnonzero((table[(key >> np.uint64(6)).astype(np.int64)] >> (key & np.uint64(63))) & np.uint64(1))
                doc = np.searchsorted(ends, place, "right")
                inside = place + len(m) <= ends[doc] if len(place) else np.empty(0, bool)
                place, doc = place[inside], doc[inside]
                yield pa.RecordBatch.from_arrays([pa.array(own[place].view(np.int64)), pa.array(f1[doc]), pa.array(f2[doc]), pa.array(place - at[doc])], names=["h", "f1", "f2", "pos"])

    texts = docs.select(F.col(text_col).alias("t"), F.xxhash64(text_col).alias("f1"), F.xxhash64(F.lit(7), text_col).alias("f2")).where("t is not null")
    met = texts.mapInArrow(windows, "h long, f1 long, f2 long, pos long").join(known, "h").select("f1", "f2", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    hits = durable(met.groupBy("f1", "f2", "item").agg(F.collect_list("shift").alias("shifts")))  # fewer than the text has words
    own = texts.join(hits.select("f1", "f2").distinct(), ["f1", "f2"], "left_semi").groupBy("f1", "f2").agg(F.first("t").alias("t"))
    pairs = hits.join(own, ["f1", "f2"]).join(items.select("item", "id", F.col("text").alias("it")), "item").select("f1", "f2", "id", "t", "it", "shifts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            both = Aligned(words_of_batch(text_bytes(batch.column(3))), words_of_batch(text_bytes(batch.column(4))))
            lists = batch.column(5)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at, _, n, a, b = both.overlaps(row, row, lists.flatten().to_numpy(), min_words, short_share)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), batch.column(2).take(pa.array(at)), pa.array(n), pa.array(a), pa.array(b)], names=["f1", "f2", "id", "n", "a", "b"])

    good = pairs.mapInArrow(verify, "f1 long, f2 long, id long, n long, a long, b long")
    best = good.groupBy("f1", "f2", "id").agg(F.max_by(F.struct("n", "a", "b"), F.struct("n", -F.col("a"), -F.col("b"))).alias("o"))
    rows = durable(best.groupBy("f1", "f2").agg(F.sort_array(F.collect_list(F.struct("id", "o"))).alias("o")))
    rows = rows.select("f1", "f2", F.col("o.id").alias("items"), F.col("o.o.n").alias("matches"), F.transform("o", lambda x: F.array(x["o"]["a"], x["o"]["b"])).alias("spans"))
    keyed = docs.withColumns({"_f1": F.xxhash64(text_col), "_f2": F.xxhash64(F.lit(7), text_col)})
    out = keyed.join(rows, (F.col("_f1") == F.col("f1")) & (F.col("_f2") == F.col("f2")) & F.col(text_col).isNotNull(), "left")
    empty = {"items": "array<long>", "matches": "array<long>", "spans": "array<array<long>>"}
    return out.select(*docs.columns, *[F.coalesce(F.col(c), F.array().cast(k)).alias(c) for c, k in empty.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = (), min_words: int = MIN_WORDS, short_share: float = SHORT_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, the carried columns, contaminated, items (ids), matches (words) and spans (first word, one past the last)."""
    if clash := {id_col, *carry} & {"contaminated", "items", "matches", "spans"}:
        raise ValueError(f"columns {sorted(clash)} are results of decontaminate")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(-1)).alias("id"), F.col(item_text_col).alias("text")).where(F.length("text") > 0).distinct()
    # what is broadcast costs about 20 bytes for each byte of text, and 1 kB for each item
    size = items.agg(F.sum(F.octet_length("text") + 50)).first()[0] or 0
    kept = docs.select(*dict.fromkeys([id_col, text_col, *carry]))
    small_batches(docs.sparkSession)
    if size <= block_bytes:
        out = looked_up(kept, [(r["id"], r["text"]) for r in items.collect()], text_col, min_words, short_share)
    else:
        out = joined_seeds(kept, items, text_col, min_words, short_share)
    return out.select(id_col, *[c for c in carry if c != id_col], (F.size("items") > 0).alias("contaminated"), "items", "matches", "spans")
