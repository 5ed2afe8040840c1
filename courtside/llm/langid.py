"""Language identification with string kernels.

The kernel of two texts is the mean over n = 1, 2, 3 of ``shared / sqrt(|A| * |B|)``, where A and B are the sets of byte
n-grams present in the lower-cased texts (a blended spectrum). Nystroem features come from ``landmarks`` training texts,
and kernel ridge regression is solved once for every language against the rest. The kernel is linear in the presence
vector of each n, so landmarks, Nystroem map and coefficients fold into one weight matrix per n; a batch of texts is
scored by one sparse-times-dense product per n.

The classifier is fitted on at most ``SAMPLE`` distinct labelled texts of at most ``SAMPLE_CHARS`` characters each (those with
the smallest hashes, in equal shares of the languages as far as they last), which also bounds what reaches the driver. Every text is scored whole, in the tasks that read it.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text where no labelled text was
found; repeated rows give repeated results; null languages are not learned; equal scores go to the language that sorts
first; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import slices, small_batches

SAMPLE, SAMPLE_CHARS, LANDMARKS = 1200, 20_000, 240
RIDGE = 1e-2
NONE = "und"
ORDERS = (1, 2, 3)
#: Bytes whose n-grams are looked at together; places within them are 16-bit numbers.
PIECE = 60_000


class Grams:
    """Distinct byte n-grams of texts, with a table that is allocated once."""

    def __init__(self) -> None:
        self.stamp = np.zeros(1 << 24, dtype=np.uint16)

    def distinct(self, text: str) -> list[np.ndarray]:
        """For each n the codes of the n-grams that are present, each once."""
        whole = np.frombuffer(text.lower().encode(), dtype=np.uint8)
        parts: list[list[np.ndarray]] = [[] for _ in ORDERS]
        # pieces of a long text have all but one byte of the longest n-gram in common
        for begin in range(0, max(1, len(whole) - ORDERS[-1] + 1), PIECE):
            b = whole[begin : begin + PIECE + ORDERS[-1] - 1].astype(np.int32)
            for o, n in enumerate(ORDERS):
                codes = b[: max(0, len(b) - n + 1)]
                for i in range(1, n):
                    codes = (codes << 8) | b[i : len(b) - n + 1 + i]
                at = np.arange(len(codes), dtype=np.uint16)
                self.stamp[codes] = at  # the last place of each code is the one that is kept
                parts[o].append(codes[self.stamp[codes] == at])
        return [p[0] if len(p) == 1 else np.unique(np.concatenate(p)) for p in parts]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: For each n the sorted codes known to the landmarks and their weights for each language.
    codes: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]
    bias: np.ndarray


def fit_texts(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model of labelled texts; the first ``landmarks`` texts are the landmarks."""
    languages = tuple(sorted(set(langs)))
    grams = Grams()
    sets = [grams.distinct(t) for t in texts]
    m = min(landmarks, len(texts))
    k_nm = np.zeros((len(texts), m))
    codes, marks = [], []
    for o in range(len(ORDERS)):
        known = np.unique(np.concatenate([s[o] for s in sets[:m]]))
        dense = np.zeros((len(known), m), dtype=np.float32)
        for j, s in enumerate(sets[:m]):
            if len(s[o]):
                dense[np.searchsorted(known, s[o]), j] = 1 / np.sqrt(len(s[o]))
        for i, s in enumerate(sets):
            own = s[o]
            at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
            at = at[known[at] == own] if len(known) else at[:0]
            if len(at):
                k_nm[i] += dense[at].sum(axis=0) / np.sqrt(len(own)) / len(ORDERS)
        codes.append(known)
        marks.append(dense)
    value, vector = np.linalg.eigh(k_nm[:m])
    root = vector[:, value > 1e-8] / np.sqrt(value[value > 1e-8])
    phi = k_nm @ root
    y = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # every language weighs the same
    w = 1 / np.array([max(1, langs.count(x)) for x in langs])
    w = (w / w.sum() * len(w))[:, None]
    mean, target = (w * phi).sum(0) / w.sum(), (w * y).sum(0) / w.sum()
    x = phi - mean
    coef = np.linalg.solve(x.T @ (w * x) + ridge * len(x) * np.eye(x.shape[1]) / 100, x.T @ (w * (y - target)))
    folded = root @ coef
    weights = tuple((d @ folded / len(ORDERS)) for d in marks)
    return Model(languages, tuple(codes), weights, target - mean @ coef)


def quotas(counts: dict[str, int], sample: int) -> dict[str, int]:
    """Equal shares of the sample; what a language cannot fill goes to the larger ones, and each has one text at least."""
    out, left = {}, sample
    for at, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, max(1, left // (len(counts) - at)))
        left -= out[lang]
    return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """The model of a bounded sample of the distinct texts of every language; None where there is none."""
    usable = labelled.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}") & (F.length("t") <= sample_chars))
    h1, h2 = F.xxhash64("t", "l"), F.xxhash64(F.lit(7), "t", "l")
    counts = {r["l"]: r["n"] for r in usable.select("l", h1.alias("h1"), h2.alias("h2")).distinct().groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    wanted = quotas(counts, sample)
    # as many hashes as give the quota for all but certain, and some more; the rest is cut below
    cuts = [(lang, min(1 << 30, int((q + 4 * math.sqrt(q) + 8) / counts[lang] * (1 << 30)) + 1)) for lang, q in wanted.items()]
    cut = F.broadcast(labelled.sparkSession.createDataFrame(cuts, "l string, cut long"))
    picked = usable.join(cut, "l").withColumn("h", F.pmod(h1, F.lit(1 << 30))).where("h < cut")
    # equal texts combine before the shuffle
    rows = picked.withColumns({"h1": h1, "h2": h2}).groupBy("h1", "h2", "h", "l").agg(F.first("t").alias("t")).collect()
    held: dict[str, int] = dict.fromkeys(wanted, 0)
    kept = []
    for r in sorted(rows, key=lambda r: (r["h"], r["t"], r["l"])):
        if held[r["l"]] < wanted[r["l"]]:
            held[r["l"]] += 1
            kept.append(r)
    return fit_texts([r["t"] for r in kept], [r["l"] for r in kept])


class Scorer:
    def __init__(self, model: Model) -> None:
        import regex

        self.model, self.grams = model, Grams()
        self.letter = regex.compile(r"\p{L}").search
        self.tables = []
        for n, known in zip(ORDERS, model.codes, strict=True):
            t = np.full(1 << (8 * n), -1, dtype=np.int16 if len(known) < 1 << 15 else np.int32)
            t[known] = np.arange(len(known))
            self.tables.append(t)

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        c = len(self.model.languages)
        total = np.tile(self.model.bias, (len(texts), 1))
        sets = [self.grams.distinct(t) if t is not None and self.letter(t) else None for t in texts]
        for o in range(len(ORDERS)):
            found = [self.tables[o][s[o]] if s is not None else np.empty(0, np.int32) for s in sets]
            found = [f[f >= 0] for f in found]
            rows = np.repeat(np.arange(len(texts)), [len(f) for f in found])
            picked = self.model.weights[o][np.concatenate([*found, np.empty(0, np.int32)])]
            norm = np.sqrt(np.array([max(1, len(s[o])) if s is not None else 1 for s in sets]))
            for k in range(c):
                total[:, k] += np.bincount(rows, picked[:, k], len(texts)) / norm
        best = total.argmax(axis=1)
        score = np.clip((total[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        known = [s is not None for s in sets]
        return [self.model.languages[b] if k else NONE for b, k in zip(best, known, strict=True)], [float(s) if k else 0.0 for s, k in zip(score, known, strict=True)]


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, lang_pred and score; one row per row of docs."""
    if clash := set(carry) & {"lang_pred", "score"}:
        raise ValueError(f"columns {sorted(clash)} are results of identify")
    if model is None:
        return docs.select(*carry, F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches, text_col, rows=500):
            lang, score = scorer.score(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*carry, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) + ", lang_pred string, score double"
    return docs.select(*dict.fromkeys([text_col, *carry])).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether the row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_part(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that may be learned from; rows without an id are not."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
