"""Exact substring de-duplication over all documents: each byte covered by a ``length``-byte string that also starts
earlier (in a document with a smaller id, or earlier in the same one) is removed.

The windows of ``length`` bytes are represented by anchors (see anchors.py): equal windows have equal anchor k-mers at the
same offset.

A. Tasks hash their texts and find anchors; each anchor stands for a run of windows, its context is their bytes. Contexts
   that occur again within a batch (by hash, and then compared byte by byte) lose to the first at once, so a passage in a
   third of all documents sends one record per batch. What is left goes to partitions by k-mer hash.
B. A k-mer that occurs once has no equal window; the others are looked at byte by byte:
C. the documents meet what B asks of them and send the contexts of these anchors, by k-mer again;
D. the suffixes that start at the anchors and the reversed prefixes that end before them are sorted by hash-compared
   mergesort (see suffixes.py). Verified common extensions of neighbours give the classes of equal right parts and equal
   left parts at every length, and with them the windows that are equal, of which the first stays.
E. The documents meet all duplicates and keep the rest.

So no byte goes on the strength of a hash: A compares bytes, and D verifies extensions on them.

K-mers of which there would be more than ``HOT_RECORDS`` records, or a share of ``HOT_SHARE`` (as a sample of the documents tells;
it only steers the plan) are not sent whole to one partition: their windows travel on their own, by the window's hash instead of the
k-mer's, and cost a record each.

The texts are shuffled once, compressed; C and E read the same shuffle. Groups of documents are dealt by hash in about
``GROUP_BYTES`` each (more, where that would make more than ``MAX_BUCKETS`` groups). Partitions grow with the input up to
``PART_MOST`` bytes; where more than ``MAX_PARTS`` of them would be needed, A to D run in several passes over ranges of
k-mer hashes. What B and D find are durable tables, so a lost executor repeats only its own part.

Defined cases: a null text is an empty one; a text shorter than ``length`` loses nothing; rows with a null id come after
all others; rows with the same id and text are one document and each row shows its result; rows with the same id and
different texts are ordered by a hash of the text; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.anchors import PrefixHashes, anchors
from courtside.llm.common import NO_ID, durable
from courtside.llm.minhash import text_bytes
from courtside.llm.suffixes import Suffixes
from courtside.llm.tokens import mix

LENGTH = 100
K = 16
#: Bytes hashed together; documents whose anchors are held together; contexts sorted together (whole k-mers).
BUFFER = 1 << 20
BATCH, SORTED = 4000, 12_000
GROUP_BYTES, MAX_BUCKETS = 8 << 20, 1 << 20
#: Input for each partition of k-mers at least and at most, and partitions in one pass.
PART_BYTES, PART_MOST, MAX_PARTS = 16 << 20, 256 << 20, 20_000
#: The sample for hot k-mers: one document in this many, but at most so many bytes.
SAMPLE, SAMPLE_BYTES = 16, 1 << 31
#: A k-mer is hot from so many records or this share of all on, if the sample has so many of them.
HOT_RECORDS, HOT_SHARE, HOT_LEAST = 2_000_000, 1 / 2000, 40

_RECORDS = "bucket int, ids binary, fps binary, kh binary, doc binary, a binary, d binary"
_FOUND = "bucket int, ids binary, fps binary, doc binary, start binary, stop binary, kh binary"


class Documents:
    """The distinct (id, text) of a batch in order, with a fingerprint of each text."""

    def __init__(self, ids: list[int], texts: list[bytes]) -> None:
        rows = sorted({(i, xxhash.xxh3_64_intdigest(t) - (1 << 63), t) for i, t in zip(ids, texts, strict=True)}, key=lambda r: r[:2])
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.fps = np.array([r[1] for r in rows], dtype=np.int64)
        self.texts = [r[2] for r in rows]


def planes(a: np.ndarray) -> bytes:
    """The bytes of 32-bit numbers, all lowest bytes first: neighbours share the upper ones, which then compress well."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (document, offset, bytes) of about BUFFER bytes; longer texts are cut with length - 1 bytes in common."""
    group: list[tuple[int, int, bytes]] = []
    held = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), BUFFER):
            part = t[at : at + BUFFER + length - 1]
            if len(part) < length:
                continue
            if held and held + len(part) > BUFFER:
                yield group
                group, held = [], 0
            group.append((i, at, part))
            held += len(part)
    if group:
        yield group


def records(texts: list[bytes], length: int, k: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(kh, ch, doc, a, dlo, dhi) of all anchors: k-mer and context hash, document, anchor place, and how far before it
    the first and the last of its windows start."""
    out = []
    for group in pieces(texts, length):
        buf = np.frombuffer(b"".join(p for _, _, p in group), dtype=np.uint8)
        sizes = np.array([len(p) for _, _, p in group])
        begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        n = len(buf)
        usable = np.ones(n, dtype=bool)
        for b in begins[1:]:
            usable[b - length + 1 : b] = False
        hashes = PrefixHashes(buf)
        place, first, last, kh = anchors(hashes, n, length, k, usable[: n - length + 1])
        if len(hot):
            at = np.minimum(np.searchsorted(hot, kh), len(hot) - 1)
            is_hot = hot[at] == kh
            count = (last - first + 1)[is_hot]
            s = np.repeat(first[is_hot] - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(count.sum())
            place, first, last, kh = np.concatenate((place[~is_hot], s)), np.concatenate((first[~is_hot], s)), np.concatenate((last[~is_hot], s)), np.concatenate((kh[~is_hot], mix(hashes.of(s, s + length))))
        with np.errstate(over="ignore"):
            shape = ((place - first) * 256 + (place - last)).astype(np.uint64)
            # two independent sums make the context's hash independent of the k-mer's
            ch = mix(hashes.of(first, last + length) ^ mix(hashes.of(first, first + length // 2) + np.uint64(1)) ^ mix(shape + np.uint64(0x9E3779B97F4A7C15)))
        piece = np.searchsorted(begins, first, "right") - 1
        doc = np.array([i for i, _, _ in group])[piece]
        offset = np.array([o for _, o, _ in group])[piece] - begins[piece]
        out.append((kh, ch, doc, place + offset, place - first, place - last))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            yield whole.slice(at, BATCH)


def split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its rows in order) of each bucket."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(bucket[rows[0]]), rows


def doc_bucket(ids: np.ndarray, fps: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.view(np.uint64) ^ mix(fps.view(np.uint64))) % np.uint64(buckets)).astype(np.int64)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int32() if c.endswith(" int") else pa.binary() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * len(names), kinds, strict=True)], names=names)


def found_rows(ids: np.ndarray, fps: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, kh: np.ndarray | None, buckets: int, a: np.ndarray | None = None) -> Iterator[tuple]:
    """Rows of _FOUND: duplicates (no kh) or contexts to be looked at (kh; start and stop of its windows relative to a)."""
    if not len(doc):
        return
    own = doc_bucket(ids, fps, buckets)
    for bucket, rows in split(own[doc]):
        used, local = np.unique(doc[rows], return_inverse=True)
        yield bucket, ids[used].tobytes(), fps[used].tobytes(), planes(local), planes(start[rows]), planes(stop[rows]), b"" if kh is None else kh[rows].tobytes() + planes(a[rows])


def read_found(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    for r in table.select(["ids", "fps", "doc", "start", "stop", "kh"]).to_pylist():
        doc = from_planes(r["doc"])
        kh = np.frombuffer(r["kh"][: 8 * len(doc)], np.uint64) if r["kh"] else None
        a = from_planes(r["kh"][8 * len(doc) :]) if r["kh"] else None
        yield np.frombuffer(r["ids"], np.int64), np.frombuffer(r["fps"], np.int64), doc, from_planes(r["start"]), from_planes(r["stop"]), kh, a


def same_context(texts: list[bytes], doc: np.ndarray, start: np.ndarray, stop: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether contexts i and j have the same bytes."""
    pairs = zip(doc[i].tolist(), start[i].tolist(), stop[i].tolist(), doc[j].tolist(), start[j].tolist(), stop[j].tolist(), strict=True)
    return np.fromiter((texts[d][s:e] == texts[f][t:g] for d, s, e, f, t, g in pairs), dtype=bool, count=len(i))


def sent_anchors(docs: DataFrame, length: int, k: int, hot, kmer_buckets: int, doc_buckets: int, passes: int, own: int) -> DataFrame:
    """Stage A: records for the k-mer partitions, and duplicates within a batch as finished findings (bucket < 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            d = Documents(batch.column(0).to_pylist(), text_bytes(batch.column(1)))
            kh, ch, doc, a, lo, hi = records(d.texts, length, k, hot.value)
            if passes > 1:
                mine = (kh >> np.uint64(32)) % np.uint64(passes) == np.uint64(own)
                kh, ch, doc, a, lo, hi = (x[mine] for x in (kh, ch, doc, a, lo, hi))
            order = np.lexsort((ch, kh))
            again = np.concatenate(([False], (kh[order][1:] == kh[order][:-1]) & (ch[order][1:] == ch[order][:-1])))[: len(order)]
            at = np.flatnonzero(again)
            again[at] = same_context(d.texts, doc, a - lo, a - hi + length, order[at - 1], order[at])
            gone = np.sort(order[again])
            out = [(-1 - b, i, f, b"", n, s, e) for b, i, f, n, s, e, _ in found_rows(d.ids, d.fps, doc[gone], (a - lo)[gone], (a - hi)[gone] + length, None, doc_buckets)]
            keep = np.sort(order[~again])
            bucket = (kh[keep] % np.uint64(kmer_buckets)).astype(np.int64)
            for b, rows in split(bucket):
                rows = keep[rows]
                used, local = np.unique(doc[rows], return_inverse=True)
                out.append((b, d.ids[used].tobytes(), d.fps[used].tobytes(), kh[rows].tobytes(), planes(local), planes(a[rows]), lo[rows].astype(np.uint8).tobytes() + hi[rows].astype(np.uint8).tobytes()))
            for at in range(0, len(out), 4000):
                yield batch_of(out[at : at + 4000], _RECORDS)

    return docs.mapInArrow(run, _RECORDS)


def judged(sent: DataFrame, doc_buckets: int) -> DataFrame:
    """Stage B: duplicates found by A, and the contexts to be looked at, by documents (_FOUND)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for whole in batches:
            ready = []
            for r in whole.to_pylist():
                if r["bucket"] < 0:
                    ready.append((-1 - r["bucket"], r["ids"], r["fps"], r["doc"], r["a"], r["d"], b""))
                    continue
                doc, d = from_planes(r["doc"]), np.frombuffer(r["d"], np.uint8).reshape(2, -1)
                ids, fps = np.frombuffer(r["ids"], np.int64)[doc], np.frombuffer(r["fps"], np.int64)[doc]
                parts.append((np.frombuffer(r["kh"], np.uint64), ids, fps, from_planes(r["a"]).astype(np.uint32), d[0], d[1]))
            if ready:
                yield batch_of(ready, _FOUND)
        if not parts:
            return
        kh, ids, fps, a, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(kh, kind="stable")
        several = kh[order][1:] == kh[order][:-1]
        order = order[np.concatenate(([False], several)) | np.concatenate((several, [False]))]
        kh, ids, fps, a, lo, hi = (x[order] for x in (kh, ids, fps, a, lo, hi))
        order = np.lexsort((a, fps, ids, kh))
        kh, ids, fps, a, lo, hi = (x[order] for x in (kh, ids, fps, a.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64)))
        # a repeated row is the same place
        new = np.ones(len(kh), dtype=bool)
        new[1:] = (kh[1:] != kh[:-1]) | (ids[1:] != ids[:-1]) | (fps[1:] != fps[:-1]) | (a[1:] != a[:-1])
        pair, doc = np.unique(np.stack((ids, fps)), axis=1, return_inverse=True)
        doc = doc.reshape(-1)
        out = list(found_rows(pair[0], pair[1], doc[new], lo[new], hi[new], kh[new], doc_buckets, a[new]))
        for at in range(0, len(out), 4000):
            yield batch_of(out[at : at + 4000], _FOUND)

    return sent.mapInArrow(run, _FOUND)


def packed(docs: DataFrame, doc_buckets: int) -> DataFrame:
    """Compressed texts by bucket: (bucket, ids, fps, sizes, rows, texts); rows: how often each document was given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        names = ["bucket", "ids", "fps", "sizes", "texts"]
        for whole in batches:
            ids = np.array(whole.column(0).to_pylist(), dtype=np.int64)
            texts = text_bytes(whole.column(1))
            fps = np.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], dtype=np.int64)
            rows = [(b, ids[r].tobytes(), fps[r].tobytes(), np.array([len(texts[i]) for i in r], np.int64).tobytes(), squeeze(b"".join(texts[i] for i in r))) for b, r in split(doc_bucket(ids, fps, doc_buckets))]
            for at in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(zip(*rows[at : at + 2000], strict=True))], names=names)

    return docs.mapInArrow(run, "bucket int, ids binary, fps binary, sizes binary, texts binary")


def unpacked(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    for r in table.select(["ids", "fps", "sizes", "texts"]).to_pylist():
        sizes = np.frombuffer(r["sizes"], np.int64)
        whole = zstandard.ZstdDecompressor().decompress(r["texts"], max_output_size=int(sizes.sum())) if sizes.sum() else b""
        ends = np.cumsum(sizes)
        for i, f, n, e in zip(np.frombuffer(r["ids"], np.int64).tolist(), np.frombuffer(r["fps"], np.int64).tolist(), sizes.tolist(), ends.tolist(), strict=True):
            yield i, f, whole[e - n : e]


_CONTEXTS = "bucket int, ids binary, fps binary, a binary, lo binary, hi binary, kh binary, bytes binary"


def contexts(texts: DataFrame, found: DataFrame, length: int, kmer_buckets: int) -> DataFrame:
    """Stage C: the bytes around the anchors that must be looked at, by k-mer."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted: dict[tuple[int, int], list[tuple]] = {}
        for ids, fps, doc, start, stop, kh, a in read_found(right):
            if kh is not None:
                for n, rows in split(doc):
                    wanted.setdefault((int(ids[n]), int(fps[n])), []).append((a[rows], start[rows], stop[rows], kh[rows]))
        parts, chunks = [], []
        seen = set()
        for i, f, text in unpacked(left):
            if (i, f) in wanted and (i, f) not in seen:
                seen.add((i, f))
                a, lo, hi, kh = (np.concatenate(x) for x in zip(*wanted[i, f], strict=True))
                parts.append((np.full(len(a), i, np.int64), np.full(len(a), f, np.int64), a, lo, hi, kh))
                chunks += [text[s:e] for s, e in zip((a - lo).tolist(), (a - hi + length).tolist(), strict=True)]
        if not parts:
            return pa.Table.from_batches([batch_of([], _CONTEXTS)])
        ids, fps, a, lo, hi, kh = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows = []
        for b, r in split((kh % np.uint64(kmer_buckets)).astype(np.int64)):
            rows.append((b, ids[r].tobytes(), fps[r].tobytes(), planes(a[r]), lo[r].astype(np.uint8).tobytes(), hi[r].astype(np.uint8).tobytes(), kh[r].tobytes(), b"".join(chunks[n] for n in r)))
        return pa.Table.from_batches([batch_of(rows, _CONTEXTS)])

    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(run, _CONTEXTS)


def equal_windows(kh: np.ndarray, lo: np.ndarray, hi: np.ndarray, buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset before the anchor) of every window that equals one of an earlier context.

    Contexts are in order within equal kh, which is ascending; each has length - hi + lo bytes in buf.
    """
    size = length + lo - hi
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    n = len(kh)
    group = np.concatenate(([0], np.cumsum(kh[1:] != kh[:-1])))
    back = buf[::-1]

    def ranked(s: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        order = s.sort(group)
        return order, s.extensions(order, group)

    right_order, right = ranked(Suffixes(buf, begin + lo, begin + size))
    total = len(buf)
    left_order, left = ranked(Suffixes(back, total - (begin + lo), total - begin))
    at = np.arange(n)

    def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
        out = np.empty(n, dtype=np.int64)
        out[order] = np.maximum.accumulate(np.where(common < depth, at, 0))
        return out

    found = []
    for o in range(int(hi.min()), int(lo.max()) + 1):
        own = np.flatnonzero((hi <= o) & (o <= lo))
        if len(own) < 2:
            continue
        key = classes(left_order, left, o)[own] * n + classes(right_order, right, length - o)[own]
        order = np.argsort(key, kind="stable")
        again = np.concatenate(([False], key[order][1:] == key[order][:-1]))
        hit = own[order[again]]
        found.append((hit, np.full(len(hit), o)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def compared(sent: DataFrame, length: int, doc_buckets: int) -> DataFrame:
    """Stage D: duplicates among contexts that share a k-mer, by documents (_FOUND)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bufs = [], []
        for whole in batches:
            for r in whole.to_pylist():
                parts.append((np.frombuffer(r["kh"], np.uint64), np.frombuffer(r["ids"], np.int64), np.frombuffer(r["fps"], np.int64), from_planes(r["a"]), np.frombuffer(r["lo"], np.uint8).astype(np.int64), np.frombuffer(r["hi"], np.uint8).astype(np.int64)))
                bufs.append(r["bytes"])
        if not parts:
            return
        kh, ids, fps, a, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        data = np.frombuffer(b"".join(bufs), np.uint8)
        size = length + lo - hi
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        order = np.lexsort((a, fps, ids, kh))
        cuts = np.flatnonzero(np.concatenate(([True], kh[order][1:] != kh[order][:-1])))
        edges = [0]
        for c in cuts.tolist():
            if c - edges[-1] >= SORTED:
                edges.append(c)
        for x, y in zip(edges, [*edges[1:], len(order)], strict=True):
            rows = order[x:y]
            take = np.repeat(begin[rows] - np.concatenate(([0], np.cumsum(size[rows])))[:-1], size[rows]) + np.arange(size[rows].sum())
            hit, o = equal_windows(kh[rows], lo[rows], hi[rows], data[take], length)
            if not len(hit):
                continue
            # neighbouring offsets of a context form one stretch
            sort = np.lexsort((o, hit))
            hit, o = hit[sort], o[sort]
            begins = np.flatnonzero(np.concatenate(([True], (hit[1:] != hit[:-1]) | (o[1:] != o[:-1] + 1))))
            ends = np.concatenate((begins[1:] - 1, [len(hit) - 1]))
            place = rows[hit[begins]]
            pair, doc = np.unique(np.stack((ids[place], fps[place])), axis=1, return_inverse=True)
            out = list(found_rows(pair[0], pair[1], doc.reshape(-1), a[place] - o[ends], a[place] - o[begins] + length, None, doc_buckets))
            for at in range(0, len(out), 4000):
                yield batch_of(out[at : at + 4000], _FOUND)

    return sent.mapInArrow(run, _FOUND)


def cut(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Stage E: (id, n_bytes, n_removed, spans, kept)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        gone: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for ids, fps, doc, start, stop, kh, _ in read_found(right):
            if kh is None:
                for n, rows in split(doc):
                    gone.setdefault((int(ids[n]), int(fps[n])), []).append((start[rows], stop[rows]))
        out: list[list] = [[], [], [], [], []]
        for i, f, text in unpacked(left):
            spans: list[list[int]] = []
            if (i, f) in gone:
                start, stop = (np.concatenate(x) for x in zip(*gone[i, f], strict=True))
                depth = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, stop, -1)
                covered = np.cumsum(depth)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).view(np.int8)))
                spans = edge.reshape(-1, 2).tolist()
            kept, at = [], 0
            for s, e in spans:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            for x, v in zip(out, (i, len(text), sum(e - s for s, e in spans), spans, b"".join(kept)), strict=True):
                x.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.large_binary())
        return pa.table([pa.array(x, k).cast(pa.binary()) if k == pa.large_binary() else pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "spans", "kept"])

    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(run, "id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")


def hot_kmers(docs: DataFrame, total: int, length: int, k: int) -> np.ndarray:
    """The sorted hashes of k-mers with very many different contexts, by a bounded sample; at most 1 / HOT_SHARE of them and
    one for every HOT_RECORDS records."""
    share = min(1 / SAMPLE, SAMPLE_BYTES / max(total, 1))
    sample = docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            d = Documents(batch.column(0).to_pylist(), text_bytes(batch.column(1)))
            kh, ch, *_ = records(d.texts, length, k, np.empty(0, np.uint64))
            pair = np.unique(np.stack((kh, ch)), axis=1)[0] if len(kh) else kh
            key, n = np.unique(pair, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["kh", "n"])

    seen = durable(sample.mapInArrow(count, "kh long, n long").groupBy("kh").agg(F.sum("n").alias("n")).where("n > 1"))
    whole = total * share / (length - k + 2) * 2  # about as many anchors as the sample has
    least = max(HOT_LEAST, min(whole * HOT_SHARE, HOT_RECORDS * share))
    rows = seen.where(F.col("n") >= int(least)).select("kh").collect()
    return np.sort(np.array([r["kh"] for r in rows], dtype=np.int64).view(np.uint64))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K) -> DataFrame:
    """id, n_bytes, n_removed, spans (start, end of each maximal removed run) and kept (bytes); one row per row of docs."""
    if not k <= length <= 255:
        raise ValueError("length must be between k and 255")
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = min(max(PART_BYTES, total / MAX_PARTS), PART_MOST)
    parts = max(least, math.ceil(total / size))
    passes = math.ceil(parts / MAX_PARTS)
    parts = math.ceil(parts / passes)
    doc_buckets = max(2 * least, min(MAX_BUCKETS, math.ceil(total / GROUP_BYTES)))
    # k-mers are dealt evenly by their hash; documents in as many partitions as the input needs, once for C and E
    by_kmer = lambda df: df.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))
    by_doc = lambda df: df.repartition(max(least, math.ceil(total / size)), "bucket")
    hot = spark.sparkContext.broadcast(hot_kmers(docs, total, length, k))
    texts = by_doc(packed(docs, doc_buckets))
    gone = None
    for own in range(passes):
        found = durable(judged(by_kmer(sent_anchors(docs, length, k, hot, parts, doc_buckets, passes, own)), doc_buckets))
        more = compared(by_kmer(contexts(texts, by_doc(found.where(F.length("kh") > 0)), length, parts)), length, doc_buckets)
        both = found.where(F.length("kh") == 0).unionByName(durable(more) if passes > 1 else more)
        gone = both if gone is None else gone.unionByName(both)
    gone = by_doc(gone)
    out = cut(texts, gone)
    shown = F.when(F.col("id") == NO_ID, F.lit(None)).otherwise(F.col("id"))
    return out.select(shown.alias(id_col), "n_bytes", "n_removed", "spans", "kept")
