"""Vectorised word hashing over raw UTF-8 bytes, for operators on words and shingles."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time; a text is only cut at white space.
CHUNK = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[ord("A") : ord("Z") + 1] = _TABLE[ord("a") : ord("z") + 1]  # A-Z as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                a = np.full(n, base, dtype=np.uint64)
                a[0] = 1
                _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash_chunk(buf: np.ndarray) -> np.ndarray:
    blank = _BLANK[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(max(len(buf), 1 << 16) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[buf] * up[: len(buf)], dtype=np.uint64)))
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of a text, A-Z taken as a-z, in order."""
    buf = np.frombuffer(text, dtype=np.uint8)
    if len(buf) <= CHUNK:
        return _hash_chunk(buf)
    out, at = [], 0
    while at < len(buf):
        end = min(at + CHUNK, len(buf))
        if end < len(buf):
            cut = np.flatnonzero(_BLANK[buf[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # a word longer than a chunk stays whole
                more = np.flatnonzero(_BLANK[buf[end:]])
                end = end + int(more[0]) + 1 if len(more) else len(buf)
        out.append(_hash_chunk(buf[at:end]))
        at = end
    return np.concatenate(out)


def words_of_batch(texts: list[bytes]) -> list[np.ndarray]:
    """word_hashes() of many texts, hashed together in chunks."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            whole = _hash_chunk(buf := np.frombuffer(b" ".join(group), dtype=np.uint8))
            begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in group])))[:-1]
            blank = _BLANK[buf]
            first = np.concatenate(([True], blank[:-1])) & ~blank if len(buf) else blank
            count = np.concatenate(([0], np.cumsum(first)))
            at = np.concatenate((count[begins], [count[-1]]))
            out.extend(whole[at[i] : at[i + 1]] for i in range(len(group)))
        group, held = [], 0

    for t in texts:
        if len(t) > CHUNK:
            flush()
            out.append(word_hashes(t))
            continue
        if held + len(t) > CHUNK:
            flush()
        group.append(t)
        held += len(t) + 1
    flush()
    return out


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles in order; of the whole sequence where it has fewer words; none without words."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        acc = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            acc = mix(acc * np.uint64(_BASE) + words[i : i + n])
    return acc
