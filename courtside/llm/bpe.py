"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has exactly one BPE encoding, and that has one last token. ``PrefixEncoding`` stores that
token for each prefix: among the tokens that end at position i it is the one that may follow the last token of the prefix
before it. Whether two tokens may stand side by side depends on the two alone: merging their bytes must not join them
across the border before both are complete. So appending costs only the new bytes, and after an edit positions are
computed anew only until as many of them as the longest token agree with what was stored.

A text is cut by the pre-tokenisation pattern and each match is encoded on its own; a match that is a token is that token.
Matches recur, so each task keeps their encodings in two tables of at most ``CACHE`` entries (when the newer one
is full it becomes the older). New matches of a batch are encoded in sorted order, and each goes on from the prefix that
it shares with the one before. The rank file (some
hundred kB; its size is checked) is read on the driver and broadcast. Texts are never shuffled.

Defined cases: a null or empty text has no tokens and decodes to no bytes; repeated rows give repeated results; extra
columns are not read unless ``carry`` names them (a name that a result column has is a ValueError); a null list of ids
decodes to no bytes; an unknown id is a KeyError.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from courtside.llm.common import cut_by, slices, small_batches

#: Entries of each table that a task keeps (matches, token pairs).
CACHE = 300_000
#: Texts handled together, and ids decoded together (one list at least).
ROWS, IDS = 500, 2 << 20
#: Rank files up to this size may be broadcast.
MAX_RANK_BYTES = 64 << 20
_NEVER = 1 << 62


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, blank, rank, on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class Vocabulary:
    """Tokens by bytes and rank, and which may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: The ends of all tokens: the rank of those that are tokens, -1 for the others.
        self.ends = {b[i:]: -1 for b in ranks for i in range(1, len(b))} | ranks
        self._halves: dict[int, tuple[bytes, bytes] | None] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self._pairs: dict[int, bool] = {}
        self._formed: set[int] = set()

    def halves(self, token: int) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None where merging its bytes never does."""
        if token not in self._halves:
            parts = [self.bytes[token][i : i + 1] for i in range(len(self.bytes[token]))]
            while len(parts) > 2:
                joined = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
                i = min(range(len(joined)), key=joined.__getitem__)
                if joined[i] >= token:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's bytes makes the token."""
        if len(self.bytes[token]) > 1 and self.halves(token) is None:
            return False
        self._formed.add(token)
        return True

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at an edge (0: left, 1: right) while this one forms, each with the rank that ends it."""
        known = self._edges[side]
        if token not in known:
            out, ends, at = [], _NEVER, token
            while True:
                out.append((self.bytes[at], ends))
                if len(self.bytes[at]) == 1 or self.halves(at) is None:
                    break
                ends, at = at, self.ranks[self.halves(at)[side]]
            known[token] = out
        return known[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves just these two tokens.

        A merge across the border comes first if its rank is below the one that ends the left part and not above the one
        that ends the right part (of equal ranks the leftmost merge is made first).
        """
        get = self.ranks.get
        for a, a_ends in self.edge(left, 1):
            for b, b_ends in self.edge(right, 0):
                r = get(a + b)
                if r is not None and r < a_ends and r <= b_ends:
                    return False
        return True

    def last_token(self, data: bytes, i: int, last: list[int]) -> int:
        """The last token of the first i bytes, from the last tokens of all shorter prefixes."""
        get, pairs = self.ends.get, self._pairs
        for start in range(i - 1, -1, -1):
            t = get(data[start:i])
            if t is None:  # no token ends like this, so no longer one does
                break
            if t < 0:
                continue
            if start:
                key = last[start - 1] << 32 | t
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= CACHE:
                        pairs.clear()
                    fits = pairs[key] = self.may_follow(last[start - 1], t)
                if not fits:
                    continue
            if t in self._formed or self.reachable(t):
                return t
        raise ValueError(f"byte {data[i - 1]} has no token")


class PrefixEncoding:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        step, whole, last = self.vocabulary.last_token, self.data, self.last
        for i in range(len(last) + 1, len(whole) + 1):
            last.append(step(whole, i, last))

    def truncate(self, size: int) -> None:
        self.data = self.data[:size]
        del self.last[size:]

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put data in place of the bytes from start to end; returns how many positions were computed anew."""
        old_tail, old_last = self.data[end:], self.last[end:]
        self.data, self.last = self.data[:start] + data + old_tail, self.last[:start]
        agreed, done = 0, 0
        border = start + len(data)
        for i in range(start + 1, len(self.data) + 1):
            t = self.vocabulary.last_token(self.data, i, self.last)
            self.last.append(t)
            done += 1
            if i > border:
                agreed = agreed + 1 if t == old_last[i - border - 1] else 0
                if agreed >= self.vocabulary.longest:
                    self.last += old_last[i - border :]
                    break
        return done

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to tokens, with the encodings of matches that have been met."""

    def __init__(self, content: bytes, pattern: str) -> None:
        import regex

        self.vocabulary = Vocabulary(parse_ranks(content))
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        # \s is White_Space here, which the rule files mean; the module's own \s also takes some control characters
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def learn(self, matches: set[str]) -> None:
        """Put the encodings of all these matches into the newer table."""
        unknown = matches.difference(self.new)
        if len(self.new) + len(unknown) > CACHE:
            self.old, self.new = self.new, {}
            unknown = matches
        known = unknown.intersection(self.old)
        for m in known:
            self.new[m] = self.old[m]
        get = self.vocabulary.ranks.get
        prefix = PrefixEncoding(self.vocabulary)
        for data, m in sorted((m.encode(), m) for m in unknown.difference(known)):
            whole = get(data)
            if whole is not None:
                self.new[m] = (whole,)
                continue
            before = prefix.data
            same = min(len(before), len(data))
            while before[:same] != data[:same]:
                same -= 1
            prefix.truncate(same)
            prefix.append(data[same:])
            self.new[m] = tuple(prefix.tokens())

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.cut(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.new.__getitem__
        return [np.fromiter(chain.from_iterable(map(get, c)), dtype=np.int32) for c in cut]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]


class Decoder:
    """Token ids to bytes, for many texts at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=-1) + 1
        self.length = np.full(size, -1, dtype=np.int64)
        self.start = np.zeros(size, dtype=np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        at = 0
        for token, rank in ranks.items():
            self.start[rank] = at
            at += len(token)
        self.bytes = np.frombuffer(b"".join(ranks), dtype=np.uint8)

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all lists of ids (list i has those from ends[i] to ends[i + 1]) and where each list's bytes end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or (self.length[ids] < 0).any()):
            raise KeyError("an id is not in the vocabulary")
        length = self.length[ids]
        before = np.concatenate(([0], np.cumsum(length)))
        take = np.repeat(self.start[ids] - before[:-1], length) + np.arange(before[-1])
        return self.bytes[take], before[ends]


def binaries(data: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Binary values that end at stops[1], stops[2], ... of the bytes."""
    return pa.Array.from_buffers(pa.binary(), len(stops) - 1, [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(data)])


def broadcast_ranks(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        content = file.read(MAX_RANK_BYTES + 1)
    if len(content) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def encode(docs: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """id, the carried columns and tokens (array<int>); one row per row of docs. With decoded also that column (binary), the bytes
    of the tokens as decode() gives them, by the same worker."""
    results = ["tokens", *["decoded"] * decoded]
    if clash := sorted({id_col, *carry} & set(results)):
        raise ValueError(f"columns {clash} are results of encode")
    kept = list(dict.fromkeys([id_col, *carry]))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)  # a task's own: idle workers keep no tables
        decoder = Decoder(encoder.vocabulary.ranks) if decoded else None
        for batch in slices(batches, text_col, rows=ROWS):
            ids = encoder.encode_batch([t or "" for t in batch.column(text_col).to_pylist()])
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate([*ids, np.empty(0, np.int32)])
            out = [pa.ListArray.from_arrays(ends, flat)]
            if decoder is not None:
                out.append(binaries(*decoder.decode_batch(flat, ends)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *out], names=[*kept, *results])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", tokens array<int>" + ", decoded binary" * decoded
    return docs.select(*dict.fromkeys([text_col, *kept])).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: Broadcast, tokens_col: str = "tokens") -> DataFrame:
    """encoded with decoded (binary) added: the bytes of its token ids."""
    if "decoded" in encoded.columns:
        raise ValueError("columns ['decoded'] are results of decode")
    at_tokens = encoded.columns.index(tokens_col)
    names = [*encoded.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(parse_ranks(ranks.value))
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(at_tokens)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for batch in cut_by(whole, sizes, ROWS, IDS):
                lists = batch.column(at_tokens)
                ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
                data, stops = decoder.decode_batch(lists.flatten().to_numpy(zero_copy_only=False), ends)
                yield pa.RecordBatch.from_arrays([*batch.columns, binaries(data, stops)], names=names)

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary")
