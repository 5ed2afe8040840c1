"""Document quality by hierarchical empirical Bayes.

1. Evidence: logistic models for quality and for toxicity over the start of each word (4, 5 and 6 bytes, presence) and a
   few measures of form (share of distinct words, of the most frequent word, of symbols, capitals and digits, word length).
   They are fitted on at most ``SAMPLE`` labelled documents of at most ``SAMPLE_CHARS`` characters (smallest hashes).
2. Sites: a grouped aggregation gives each path (within its host) the number and the sum of quality evidence of its
   documents. Host means are shrunk toward the global mean and path means toward their host's, with prior strengths from
   the spread of means beyond sampling noise (method of moments), so sparse sites keep close to what lies above them.
   A document's own evidence is left out of the means it meets, so that it doesn't count twice.
3. Posterior: the odds of a document's evidence times the odds of its path's mean over those of the global mean.
   It is kept if the posterior of quality reaches ``threshold`` and toxicity stays below it.

Only numbers are shuffled; sums of a hot host combine before the shuffle, and the join back on it is one that AQE splits
(or, with few sites, broadcasts by their measured size). The driver receives at most ``SAMPLE`` texts for the fit.

Defined cases: a null or empty text is scored as an empty one; null hosts and paths are sites of their own; rows repeat as
they are; labels that are null or whose document is missing are not learned; of several labels or texts of one id the smallest are
taken; without labels of both kinds a model answers with the share it has seen (0.5 without any, toxicity 0); extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import durable, slices, small_batches
from courtside.llm.minhash import text_bytes
from courtside.llm.tokens import word_hashes

SAMPLE, SAMPLE_CHARS, FEATURES = 4000, 20_000, 400
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.full(256, 4, dtype=np.uint8)  # other bytes
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x21:0x80] = 1  # symbols
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("A") : ord("Z") + 1] = 3
_KIND[ord("a") : ord("z") + 1] = 4


def measures(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Seven measures of form, and the distinct word starts as numbers."""
    buf = np.frombuffer(text, dtype=np.uint8)
    kind = _KIND[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], kind == 0, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(7), np.empty(0, np.uint64)
    _, times = np.unique(word_hashes(text), return_counts=True)
    share = np.bincount(kind, minlength=5) / len(buf)
    form = np.array([np.log1p(len(starts)), len(times) / len(starts), times.max() / len(starts), share[1], share[2], share[3], np.log1p((ends - starts).mean())])
    code = np.zeros(len(starts), dtype=np.uint64)
    found = []
    for i in range(max(PREFIXES)):
        at = starts + i
        inside = at < ends
        code[inside] |= _LOWER[buf[at[inside]]] << np.uint64(8 * i)
        if i + 1 in PREFIXES:
            found.append(code | np.uint64((i + 1) << 56))
    return form, np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Logistic:
    """Weights of standardised measures and of word starts (sorted)."""

    mean: np.ndarray
    scale: np.ndarray
    form: np.ndarray
    codes: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, form: np.ndarray, codes: np.ndarray) -> float:
        out = self.bias + float(((form - self.mean) / self.scale) @ self.form)
        if len(self.codes) and len(codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            out += float(self.weights[at[self.codes[at] == codes]].sum())
        return out


def fit_logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, features: int = FEATURES, penalty: float = 0.2) -> Logistic:
    """A ridge-penalised logistic model on the word starts that tell the classes apart best and on the measures."""
    n, hit = len(y), int(y.sum())
    if not 0 < hit < n:
        rate = (hit + 0.5) / (n + 1) if n else 0.5
        return Logistic(np.zeros(7), np.ones(7), np.zeros(7), np.empty(0, np.uint64), np.empty(0), float(np.log(rate / (1 - rate))))
    known, where = np.unique(np.concatenate([c for _, c in rows]), return_inverse=True)
    doc = np.repeat(np.arange(n), [len(c) for _, c in rows])
    in_hit = np.bincount(where, y[doc], len(known))
    df = np.bincount(where, minlength=len(known))
    expected = df * hit / n
    chi = (in_hit - expected) ** 2 / np.maximum(expected * (1 - hit / n), 1e-9) * (df >= 3)
    picked = np.sort(np.argsort(-chi, kind="stable")[:features])
    place = np.full(len(known), -1)
    place[picked] = np.arange(len(picked))
    x = np.zeros((n, len(picked) + 7))
    keep = place[where] >= 0
    x[doc[keep], place[where[keep]]] = 1
    form = np.array([f for f, _ in rows])
    mean, scale = form.mean(0), np.maximum(form.std(0), 1e-9)
    x[:, len(picked) :] = (form - mean) / scale
    x1 = np.column_stack([x, np.ones(n)])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    b = np.zeros(x1.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(x1.T @ (w[:, None] * x1) + ridge, x1.T @ (y - p) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, b[len(picked) : -1], known[picked], b[: len(picked)], float(b[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", toxic_col: str = "toxic", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> tuple[Logistic, Logistic]:
    """The models of quality and of toxicity, from a bounded sample of labelled documents."""
    own = labels.select(F.col(id_col).alias("k"), F.col(quality_col).alias("q"), F.col(toxic_col).alias("x")).where("k is not null and q is not null and x is not null")
    own = own.groupBy("k").agg(F.min(F.struct("q", "x")).alias("m")).select(F.xxhash64("k").alias("h"), "k", "m.q", "m.x")
    usable = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.length("t") <= sample_chars)
    # the ids are picked first, by hash, so texts are gathered for the sample only; repeated ids combine before the shuffle
    ids = own.join(usable.select("k").distinct(), "k", "left_semi").orderBy("h", "k").limit(sample)
    picked = durable(ids)
    met = usable.join(F.broadcast(picked), "k").groupBy("h", "k", "q", "x").agg(F.min("t").alias("t")).collect()  # at most sample rows
    met = sorted(met, key=lambda r: (r["h"], r["k"]))
    rows = [measures(r["t"].encode()) for r in met]
    quality = fit_logistic(rows, np.array([float(r["q"] > 0) for r in met]))
    toxic = fit_logistic(rows, np.array([float(r["x"] > 0) for r in met]))
    if not met:
        toxic = Logistic(toxic.mean, toxic.scale, toxic.form, toxic.codes, toxic.weights, -30.0)
    return quality, toxic


def evidence(docs: DataFrame, models: tuple[Logistic, Logistic], id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    """(id, host, path, q, toxicity): the logit of quality and the probability of toxicity of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quality, toxic = shared.value
        for batch in slices(batches, 0):
            q, x = [], []
            for text in text_bytes(batch.column(0)):
                form, codes = measures(text)
                q.append(float(np.clip(quality.logit(form, codes), -30, 30)))
                x.append(1 / (1 + float(np.exp(-np.clip(toxic.logit(form, codes), -30, 30)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(q, pa.float64()), pa.array(x, pa.float64())], names=["id", "host", "path", "q", "toxicity"])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(text_col).alias("t"), F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    return source.mapInArrow(run, f"id {kind}, host string, path string, q double, toxicity double")


def strength(groups: DataFrame, mean: str, above: str, rate: float) -> float:
    """The prior strength of groups(n, mean, above): rate * (1 - rate) over the variance of means beyond sampling noise."""
    row = groups.agg(F.sum("n").alias("n"), F.count("*").alias("g"), F.sum(F.expr(f"n * ({mean} - {above}) * ({mean} - {above})")).alias("v")).first()
    if not row["n"]:
        return 1.0
    noise = rate * (1 - rate)
    between = row["v"] / row["n"] - row["g"] / row["n"] * noise
    return float(np.clip(noise / max(between, 1e-9) - 1, 1.0, 1e6))


def classify(docs: DataFrame, models: tuple[Logistic, Logistic], id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", threshold: float = THRESHOLD) -> DataFrame:
    """id, evidence, host_quality, path_quality, quality (posterior), toxicity and kept; one row per row of docs."""
    scored = durable(evidence(docs, models, id_col, text_col, host_col, path_col)).withColumn("p", 1 / (1 + F.exp(-F.col("q"))))
    site = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c) for c in ("host", "path")]
    scored = scored.select("id", *site, "q", "p", "toxicity")
    paths = durable(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = float(np.clip(total["s"] / total["n"], 1e-6, 1 - 1e-6)) if total["n"] else 0.5
    k_host = strength(hosts.withColumn("m", F.col("s") / F.col("n")).withColumn("above", F.lit(rate)), "m", "above", rate)
    shrunk = lambda total, n, k, above: (total + k * above) / (n + k)
    met = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    whole = met.withColumn("above", shrunk(F.col("host_s"), F.col("host_n"), k_host, rate)).withColumn("m", F.col("s") / F.col("n"))
    k_path = strength(whole, "m", "above", rate)
    sites = durable(met)
    # what a document meets are the sums of the others
    host = shrunk(F.col("host_s") - F.col("p"), F.col("host_n") - 1, k_host, rate)
    path = shrunk(F.col("s") - F.col("p"), F.col("n") - 1, k_path, F.col("host_quality"))
    odds = lambda c: F.log(c / (1 - c))
    shift = odds(F.greatest(F.least(F.col("path_quality"), F.lit(1 - 1e-6)), F.lit(1e-6))) - float(np.log(rate / (1 - rate)))
    out = scored.join(sites, ["host", "path"]).withColumn("host_quality", host).withColumn("path_quality", path).withColumn("quality", 1 / (1 + F.exp(-(F.col("q") + shift))))
    return out.select(F.col("id").alias(id_col), F.col("p").alias("evidence"), "host_quality", "path_quality", "quality", "toxicity", ((F.col("quality") >= threshold) & (F.col("toxicity") < threshold)).alias("kept"))
