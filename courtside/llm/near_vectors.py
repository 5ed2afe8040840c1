"""Near-duplicate embeddings within a label by NN-descent.

1. Equal vectors of a label form a class with a multiplicity; only classes are compared.
2. A neighbour graph holds the ``k`` nearest classes found for each. It starts from ``tables`` random-hyperplane orders: classes
   are range-sorted by label and sign code, and every run of ``block`` rows is compared by one matrix product. Rounds of
   NN-descent join the neighbours of every class with their vectors and compare them with each other, until a round
   improves the lists no more.
3. A list is saturated if even its last entry reaches the threshold: there may be more. Saturated lists are enlarged to
   ``WIDER`` times their length and refined again. Where they stay saturated, the class is dense.
4. The edges that reach the threshold are links. A class that isn't dense has all its links in its own list or in that of
   the other side. Dense classes link with more classes than a list holds; the groups that hold them are cut into tiles, and
   pairs of tiles are compared by matrix products: not at all if their centres are further apart than both radii
   and the threshold's angle together (triangle inequality), and without products if no two of their vectors can be further
   apart than that angle. So the exact way covers what lists cannot, and it gives counts and smallest ids, never pairs.
5. Audit: the links of ``audit`` classes, picked by hash, are counted against all classes of their label (a stated query
   set against all rows). The sample grows to ``AUDIT_MORE`` times that until it holds ``LEAST`` links. If fewer than ``RECALL`` of
   them were found, lists are made longer and steps 2 to 4 repeated, once; if that fails too, or the links are too few
   to tell, all classes are compared as in step 4. Recall is logged.

The components of links are grouped by the smallest id that they reach.

Label groups are only sort keys, so a hot label spreads over all tasks. In the exact way for all classes the work grows with the square of
a label's classes where its vectors are spread out; in the others it grows with the classes and the links.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label, link
with nothing and keep their own id; vectors of different lengths never link; rows with the same id and vector count as one
vector, and the links of rows with the same id and different vectors are pooled; a null id takes part as the largest id and is shown as null; extra columns are not read; an empty table gives an
empty result. Cosines are computed in double precision; a tie with the threshold links.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import NO_ID, components, durable, forget

logger = logging.getLogger(__name__)
THRESHOLD = 0.98
K, TABLES, BLOCK, TILE = 8, 6, 256, 256
BITS = 24
#: Rounds of NN-descent at most, and the gain of the summed similarity below which they end.
ROUNDS, STILL = 10, 1e-4
#: By how much saturated lists are enlarged.
WIDER = 4
#: Classes audited, how far the sample may grow, the links it should hold and the share of them that must be found.
AUDIT, AUDIT_MORE, LEAST, RECALL = 512, 8, 100, 0.99


def unit(vecs: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(vecs), dtype=np.float64).reshape(len(vecs), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def packed(valid: DataFrame) -> DataFrame:
    """(label, dim, id, vec as double bytes, h1, h2) of (label, id, embedding, h1, h2)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            vecs = [values[ends[i] : ends[i + 1]].tobytes() for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes.astype(np.int32)), b.column(1), pa.array(vecs, pa.binary()), b.column(3), b.column(4)], names=["label", "dim", "id", "vec", "h1", "h2"])

    label = valid.schema["label"].dataType.simpleString()
    return valid.mapInArrow(pack, f"label {label}, dim int, id long, vec binary, h1 long, h2 long")


def seeded(classes: DataFrame, tables: int, seed: int, k: int, block: int) -> DataFrame:
    """(u, v, sim): for every class the k nearest within its block in each of the orders."""
    label = classes.schema["label"].dataType.simpleString()

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                x = unit(part["vec"].tolist())
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, dim]).standard_normal((dim, BITS))
                    bits = (x @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1))
                    yield part.assign(t=np.int32(t), code=bits.astype(np.int64))[["label", "dim", "t", "code", "id", "vec"]]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            rest = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            while len(rest) >= 2 * block:
                yield nearest(rest.iloc[:block])
                rest = rest.iloc[block:]
            held = rest
        if held is not None and len(held):
            yield nearest(held.iloc[: (len(held) + 1) // 2] if len(held) > block else held)
            if len(held) > block:
                yield nearest(held.iloc[(len(held) + 1) // 2 :])

    def nearest(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby(["label", "dim", "t"], sort=False):
            if len(part) > 1:
                out.append(top(part["id"].to_numpy(), unit(part["vec"].tolist()), k))
        return pd.concat(out) if out else pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64), "sim": np.empty(0)})

    rows = classes.select("label", "dim", "id", "vec").mapInPandas(code, f"label {label}, dim int, t int, code long, id long, vec binary")
    return rows.repartitionByRange("label", "dim", "t", "code", "id").sortWithinPartitions("label", "dim", "t", "code", "id").mapInPandas(compare, "u long, v long, sim double")


def top(ids: np.ndarray, x: np.ndarray, k: int, begins: np.ndarray | None = None) -> pd.DataFrame:
    """Each row's k nearest others within its group; a group reaches from one of begins to the next."""
    us, vs, sims = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    edges = [0, len(ids)] if begins is None else [*begins.tolist(), len(ids)]
    for a, b in zip(edges, edges[1:], strict=False):
        n = min(k, b - a - 1)
        if n < 1:
            continue
        s = x[a:b] @ x[a:b].T
        np.fill_diagonal(s, -2.0)
        at = np.argpartition(-s, n - 1, axis=1)[:, :n] if n < b - a - 1 else np.argsort(-s, axis=1)[:, :n]
        us.append(np.repeat(ids[a:b], n))
        vs.append(ids[a:b][at].reshape(-1))
        sims.append(np.take_along_axis(s, at, 1).reshape(-1))
    return pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "sim": np.concatenate(sims)})


def best(edges: DataFrame, k: int, wide: DataFrame | None = None) -> DataFrame:
    """The k best distinct neighbours of every class, WIDER times as many for those of wide(u)."""
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    ranked = edges.where("u <> v").groupBy("u", "v").agg(F.max("sim").alias("sim")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= (k if wide is None else WIDER * k))
    if wide is not None:
        ranked = ranked.join(wide.withColumn("wide", F.lit(True)), "u", "left").where((F.col("r") <= k) | F.col("wide")).drop("wide")
    return ranked.drop("r")


def descended(graph: DataFrame, classes: DataFrame, k: int, wide: DataFrame | None = None) -> DataFrame:
    """One NN-descent round: neighbours of a common class are compared with each other."""
    back = best(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"), k, wide)
    both = graph.select(F.col("u").alias("w"), F.col("v").alias("id")).unionByName(back.select(F.col("u").alias("w"), F.col("v").alias("id"))).distinct()
    met = both.join(classes.select("id", "vec"), "id")
    longest = k if wide is None else WIDER * k

    def local(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, part in rows.groupby(rows["vec"].str.len(), sort=False):  # a class and its neighbours have one dimension
            w = part["w"].to_numpy()
            yield top(part["id"].to_numpy(), unit(part["vec"].tolist()), longest, np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))))

    # a few entries of two lists share a w, so many groups fill one call
    def grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            rest = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = rest["w"].iat[-1]
            yield from local(rest[rest["w"] != last])
            held = rest[rest["w"] == last]
        if held is not None and len(held):
            yield from local(held)

    found = met.select("w", "id", "vec").repartition("w").sortWithinPartitions("w").mapInPandas(grouped, "u long, v long, sim double")
    return best(graph.unionByName(found), k, wide)


def refined(graph: DataFrame, classes: DataFrame, k: int, wide: DataFrame | None = None) -> DataFrame:
    """Rounds of NN-descent until the lists improve no more."""
    spark = classes.sparkSession
    graph = durable(graph)
    total = lambda g: g.agg(F.sum(F.col("sim") + 1)).first()[0] or 0.0
    before = total(graph)
    for done in range(ROUNDS):
        after = durable(descended(graph, classes, k, wide))
        forget(spark, graph)
        graph, now = after, total(after)
        logger.info("NN-descent round %d: %.6f of the last sum", done + 1, now / before if before else 1.0)
        if now <= before * (1 + STILL):
            break
        before = now
    return graph


def saturated(graph: DataFrame, k: int, threshold: float) -> DataFrame:
    """(u): the classes whose lists of k end above the threshold."""
    return graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("low")).where((F.col("n") >= k) & (F.col("low") >= threshold)).select("u")


def tiled(classes: DataFrame, groups: DataFrame, tile: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(block, id, vec, copies) of all classes and (pair, a, b, sure), the pairs of blocks (a <= b) that can hold a link, and
    whether all their vectors are sure to be linked.

    A group of groups(id, component) that fills a good part of a tile gets tiles of its own; the others share those of
    their label.
    """
    key = ["label", "dim", "own", "part"]
    placed = classes.select("label", "dim", "id", "vec", "copies").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    large = placed.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") * 4 > tile).select("component", F.lit(True).alias("own"))
    placed = placed.join(large, "component", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    placed = placed.withColumn("part", F.when(F.col("own"), F.col("component")).otherwise(0))
    tiles = placed.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    placed = durable(placed.join(tiles, key).withColumn("tile", F.pmod(F.xxhash64(F.when(F.col("own"), F.col("id")).otherwise(F.col("component"))), F.col("tiles")).cast("int")).drop("tiles"))

    def ball(names: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(pdf["vec"].tolist())
        mean = x.sum(axis=0)
        centre = mean / np.sqrt(mean @ mean) if mean @ mean > 1e-12 else x[0]
        return pd.DataFrame([(*names, centre.tolist(), float(np.arccos(np.clip(x @ centre, -1, 1)).max()))])

    label = classes.schema["label"].dataType.simpleString()
    balls = placed.groupBy(*key, "tile").applyInPandas(ball, f"label {label}, dim int, own boolean, part long, tile int, centre array<double>, radius double")
    balls = durable(balls.withColumn("block", F.monotonically_increasing_id()))
    side = lambda s: balls.select("label", "dim", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "centre", "radius")])
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    # the triangle inequality of angles, with room for rounding
    reach = math.acos(max(-1.0, min(1.0, threshold)))
    near = angle <= F.col("radius_a") + F.col("radius_b") + F.lit(reach + 1e-6)
    pairs = side("a").join(side("b"), ["label", "dim"]).where((F.col("block_a") == F.col("block_b")) | ((F.col("block_a") < F.col("block_b")) & near))
    sure = angle + F.col("radius_a") + F.col("radius_b") <= F.lit(reach - 1e-6)
    pairs = durable(pairs.select(F.monotonically_increasing_id().alias("pair"), F.col("block_a").alias("a"), F.col("block_b").alias("b"), sure.alias("sure")))
    return placed.join(balls.select(*key, "tile", "block"), [*key, "tile"]).select("block", "id", "vec", "copies"), pairs


def compared(rows: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(id, links, low) from every pair of blocks: the vectors of other classes that a class links with there, and the smallest
    id that the links of the pair reach from it, so a pair never gives more rows than it has."""
    linked, pairs = pairs.where("sure"), pairs.where("not sure")
    # blocks that are linked as a whole need no vectors: what one block gives the rows of another are two numbers
    sums = rows.groupBy("block").agg(F.sum("copies").alias("copies"), F.min("id").alias("least"))
    met = linked.select("a", "b").unionByName(linked.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = met.join(sums.withColumnRenamed("block", "b"), "b").groupBy(F.col("a").alias("block")).agg(F.sum("copies").alias("copies_"), F.min("least").alias("least"), F.max((F.col("a") == F.col("b")).cast("int")).alias("self"))
    whole = rows.join(met, "block").select("id", (F.col("copies_") - F.when(F.col("self") == 1, F.col("copies")).otherwise(0)).alias("links"), F.least("id", "least").alias("low")).where("links > 0")
    dealt = pairs.select("pair", F.lit(0).alias("side"), F.col("a").alias("block")).unionByName(pairs.where("a <> b").select("pair", F.lit(1).alias("side"), F.col("b").alias("block")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[pdf["side"] == 0]
        b = pdf[pdf["side"] == 1] if (pdf["side"] == 1).any() else a
        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        hit = ((unit(a["vec"].tolist()) @ unit(b["vec"].tolist()).T) >= threshold) & (ids_a[:, None] != ids_b[None, :])
        keep_a, keep_b = hit.any(axis=1), hit.any(axis=0)
        a, b, hit = a[keep_a], b[keep_b], hit[np.ix_(keep_a, keep_b)]
        if not len(a):
            return pd.DataFrame({"id": np.empty(0, np.int64), "links": np.empty(0, np.int64), "low": np.empty(0, np.int64)})
        ids_a, ids_b, low_a, none = a["id"].to_numpy(), b["id"].to_numpy(), a["id"].to_numpy(), np.iinfo(np.int64).max
        while True:
            low_b = np.minimum(ids_b, np.where(hit, low_a[:, None], none).min(axis=0))
            after = np.minimum(low_a, np.where(hit, low_b[None, :], none).min(axis=1))
            if (after == low_a).all():
                break
            low_a = after
        parts = [pd.DataFrame({"id": ids_a, "links": hit @ b["copies"].to_numpy(), "low": low_a})]
        if (pdf["side"] == 1).any():
            parts.append(pd.DataFrame({"id": ids_b, "links": a["copies"].to_numpy() @ hit, "low": low_b}))
        return pd.concat(parts)

    return rows.join(dealt, "block").groupBy("pair").applyInPandas(compare, "id long, links long, low long").unionByName(whole)


def linked(graph: DataFrame, classes: DataFrame, dense: DataFrame, tile: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, links) of classes with links, in parts, and edges (a, b) that connect what links connect: those of the lists, and
    between dense groups by comparison of tiles."""
    near = graph.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
    both = durable(near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    if not dense.limit(1).count():
        return durable(listed(both, classes)), both
    groups = components(both).withColumnRenamed("node", "id")
    # every class of a group with a dense one is compared with all others of such groups
    whole = groups.join(dense.withColumnRenamed("u", "id"), "id").select("component").distinct()
    of_groups = durable(groups.join(whole, "component").select("id", "component"))
    inside = durable(compared(*tiled(classes.join(of_groups.select("id"), "id", "left_semi"), of_groups, tile, threshold), threshold))
    own = of_groups.select(F.col("id").alias("a"), F.lit(True).alias("in_a"))
    other = of_groups.select(F.col("id").alias("b"), F.lit(True).alias("in_b"))
    rest = durable(both.join(own, "a", "left").join(other, "b", "left").where(F.col("in_a").isNull() | F.col("in_b").isNull()).select("a", "b"))
    return durable(listed(rest, classes)).unionByName(inside.select("id", "links")), rest.unionByName(reached(inside))


def listed(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, links) of edges(a, b), which go both ways."""
    return edges.join(classes.select(F.col("id").alias("b"), "copies"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("links"))


def reached(found: DataFrame) -> DataFrame:
    """The edges (a, b) of what compared() found."""
    return found.select(F.col("id").alias("a"), F.col("low").alias("b"))


def recall(found: DataFrame, classes: DataFrame, threshold: float, audit: int) -> float | None:
    """The share of the links of some classes that found(id, links) has; None where they have too few to tell."""
    spark = classes.sparkSession
    for size in (audit, audit * AUDIT_MORE):
        picked = classes.select("label", "dim", "id", "vec").orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(size).toPandas()
        if not len(picked):
            return 1.0
        sides = {k: (g["id"].to_numpy(), unit(g["vec"].tolist())) for k, g in picked.groupby(["label", "dim"])}
        shared = spark.sparkContext.broadcast(sides)

        def count(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for k, g in pdf.groupby(["label", "dim"]):
                    if k in shared.value:
                        ids, x = shared.value[k]
                        hit = ((x @ unit(g["vec"].tolist()).T) >= threshold) & (ids[:, None] != g["id"].to_numpy()[None, :])
                        n = hit @ g["copies"].to_numpy()
                        yield pd.DataFrame({"id": ids[n > 0], "n": n[n > 0]})

        true = classes.select("label", "dim", "id", "vec", "copies").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        own = found.groupBy("id").agg(F.sum("links").alias("links"))
        row = true.join(own, "id", "left").agg(F.sum("n").alias("n"), F.sum(F.least("n", F.coalesce("links", F.lit(0)))).alias("got")).first()
        if (row["n"] or 0) >= LEAST or len(picked) < size:  # enough links, or all classes were audited
            return row["got"] / row["n"] if row["n"] else 1.0
    return None


def links_of(classes: DataFrame, threshold: float, k: int, tables: int, block: int, tile: int, audit: int) -> tuple[DataFrame, DataFrame]:
    """(id, links): with how many vectors of other classes a class links, in parts that add up; and (a, b): edges that
    connect what links connect."""
    for longer in (1, 4):
        own = k * longer
        graph = refined(best(seeded(classes, tables * longer, 0, own, block), own), classes, own)
        wide = durable(saturated(graph, own, threshold))
        dense = wide
        if wide.limit(1).count():
            # the others' lists stay as they are
            graph = refined(graph.join(wide, "u", "left_semi"), classes, own, wide).unionByName(graph.join(wide, "u", "left_anti"))
            dense = durable(saturated(graph, WIDER * own, threshold))
        found, edges = linked(graph, classes, dense, tile, threshold)
        share = recall(found, classes, threshold, audit)
        logger.warning("near vectors: lists of %d, recall of audited links %s", own, "unknown (too few links)" if share is None else f"{share:.4f}")
        if share is None:
            break
        if share >= RECALL:
            return found, edges
    tight = components(graph.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))).withColumnRenamed("node", "id")
    found = durable(compared(*tiled(classes, tight, tile, threshold), threshold))
    return found.select("id", "links"), reached(found)


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, k: int = K, tables: int = TABLES, block: int = BLOCK, tile: int = TILE, audit: int = AUDIT) -> DataFrame:
    """id, n_links, component_id and kept (the id is the component's smallest); one row per row of table."""
    usable = F.col("label").isNotNull() & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))), F.lit(False)) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    own = table.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label")).withColumn("ok", usable)
    keyed = own.withColumns({"h1": F.when(F.col("ok"), F.xxhash64("label", "embedding")), "h2": F.when(F.col("ok"), F.xxhash64(F.lit(7), "label", "embedding"))})
    valid = keyed.where("ok").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    counted = keyed.where("ok").select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("copies"))
    classes = durable(packed(valid.select("label", "id", "embedding", "h1", "h2")).join(counted, ["h1", "h2"]))
    found, edges = links_of(classes, threshold, k, tables, block, tile, audit)
    counts = durable(found.groupBy("id").agg(F.sum("links").alias("links")))
    groups = components(edges).withColumnRenamed("node", "id")
    info = classes.select("h1", "h2", F.col("id").alias("class"), "copies").join(groups.withColumnRenamed("id", "class"), "class", "left").join(counts.withColumnRenamed("id", "class"), "class", "left")
    info = info.select("h1", "h2", F.coalesce("component", "class").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    met = keyed.select("id", F.coalesce("h1", F.lit(0)).alias("h1"), "h2").join(info, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    shown = lambda c: F.when(c == NO_ID, F.lit(None)).otherwise(c)
    return met.select(shown(F.col("id")).alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), shown(component).alias("component_id"), (F.col("id") == component).alias("kept"))
