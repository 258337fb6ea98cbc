"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table
from freshet.llm.components import components

COSINE = 0.9
#: Unit vectors with that cosine are no further apart than this; the slack is for rounding in the sums before the exact test.
EPSILON = float(np.sqrt(2 - 2 * COSINE)) + 1e-6
BLOCK, LEAF, GRID_DIMS, BOX_DIMS = 4096, 512, 6, 32


def units(rows: list) -> np.ndarray:
    out = np.array(rows, dtype=np.float64)
    scale = np.abs(out).max(axis=1, keepdims=True)
    out /= scale  # so that squares neither overflow nor vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that can link: finite, not zero; shorter vectors are filled up with zeros."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    good = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    width = good.agg(F.max(F.size("v"))).first()[0] or 0
    fill = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    return good.withColumn("v", fill)


def axes(reps: DataFrame) -> np.ndarray:
    """Principal directions over all vectors, leading first; what reaches the driver is one sum per pair of dimensions."""

    def moments(batches):
        total = None
        for batch in batches:
            if len(batch):
                x = units(batch["v"].tolist())
                x = np.hstack([np.ones((len(x), 1)), x])
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"place": np.arange(total.size), "value": total.ravel()})

    sums = reps.select("v").mapInPandas(moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    rows = sums.toPandas().sort_values("place")["value"].to_numpy()
    side = int(np.sqrt(len(rows)))
    second = rows.reshape(side, side)
    mean = second[0, 1:] / second[0, 0]
    _, directions = np.linalg.eigh(second[1:, 1:] / second[0, 0] - np.outer(mean, mean))
    return directions[:, ::-1]


def blocks(reps: DataFrame, directions: np.ndarray, size: int = BLOCK) -> DataFrame:
    """Runs of at most ``size`` vectors in epsilon grid order, each one packed row with its box along the leading axes."""
    dims = min(GRID_DIMS, directions.shape[1])

    def cells(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.floor(units(v.tolist()) @ directions[:, :dims] / EPSILON).astype(np.int32)))

    def packed(batches):
        rest, k = pd.DataFrame(), 0

        def made(rows):
            x = units(rows["v"].tolist()) @ directions
            box = x[:, :BOX_DIMS]
            return pd.DataFrame(
                {
                    "part": [int(rows["part"].iloc[0])], "k": [k], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
                    "copies": [rows["copies"].to_numpy(np.int64).tobytes()], "v": [np.array(rows["v"].tolist(), dtype=np.float64).tobytes()],
                    "low": [box.min(axis=0).tolist()], "high": [box.max(axis=0).tolist()],
                }
            )

        for batch in batches:
            rest = pd.concat([rest, batch], ignore_index=True)
            while len(rest) >= size:
                yield made(rest.iloc[:size])
                rest, k = rest.iloc[size:].reset_index(drop=True), k + 1
        if len(rest):
            yield made(rest)

    placed = reps.withColumn("cells", F.pandas_udf(cells, "array<int>")("v"))
    order = [F.col("cells")[k] for k in range(dims)] + [F.col("vec_id")]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("cells")
    kind = "part int, k int, ids binary, copies binary, v binary, low array<double>, high array<double>"
    return ordered.mapInPandas(packed, kind).withColumn("block", F.col("part").cast("long") * 2**31 + F.col("k"))


def join_intervals(x: np.ndarray, y: np.ndarray, xb: np.ndarray, yb: np.ndarray, same: bool, leaf: int = LEAF):
    """Yields (rows of x, rows of y) with cosine of at least COSINE; halves both sequences and skips halves whose boxes are too far apart."""
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and c < a:
            continue
        gap = np.maximum(0, np.maximum(xb[a:b].min(axis=0) - yb[c:d].max(axis=0), yb[c:d].min(axis=0) - xb[a:b].max(axis=0)))
        if (gap * gap).sum() > EPSILON * EPSILON:
            continue
        if b - a <= leaf and d - c <= leaf:
            hit = (x[a:b] @ y[c:d].T) >= COSINE
            if same and a == c:
                hit &= np.triu(np.ones(hit.shape, dtype=bool), 1)
            left, right = np.nonzero(hit)
            yield left + a, right + c
            continue
        # the same cut points on both sides keep a < c order in a self join
        xs = [(a, b)] if b - a <= leaf else [(a, (a + b) // 2), ((a + b) // 2, b)]
        ys = [(c, d)] if d - c <= leaf else [(c, (c + d) // 2), ((c + d) // 2, d)]
        todo += [(*p, *q) for p in xs for q in ys]


def _spanning(n: int, left: np.ndarray, right: np.ndarray, parent: np.ndarray) -> list[tuple[int, int]]:
    """Links that join two trees of ``parent``; the rest would add nothing to a component."""

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    kept = []
    for p, q in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(p), root(q)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((p, q))
    return kept


def _joined(directions: np.ndarray):
    def run(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                same = r.left_block == r.right_block
                ids = [np.frombuffer(b, dtype=np.int64) for b in (r.left_ids, r.right_ids)]
                copies = [np.frombuffer(b, dtype=np.int64) for b in (r.left_copies, r.right_copies)]
                x, y = (units(np.frombuffer(b, dtype=np.float64).reshape(len(i), -1)) for b, i in zip((r.left_v, r.right_v), ids, strict=True))
                xb, yb = x @ directions[:, :BOX_DIMS], y @ directions[:, :BOX_DIMS]
                shift = 0 if same else len(ids[0])
                linked = np.zeros(shift + len(ids[1]), dtype=np.int64)
                parent, edges = np.arange(len(linked)), []
                for left, right in join_intervals(x, y, xb, yb, same):
                    np.add.at(linked, left, copies[1][right])
                    np.add.at(linked, right + shift, copies[0][left])
                    edges += _spanning(len(linked), left, right + shift, parent)
                names = ids[0] if same else np.concatenate(ids)
                some = np.flatnonzero(linked)
                ends = np.array(edges, dtype=np.int64).reshape(-1, 2)
                yield pd.DataFrame({"u": names[some], "v": names[some], "links": linked[some]})
                yield pd.DataFrame({"u": names[ends[:, 0]], "v": names[ends[:, 1]], "links": 0})

    return run


def near_vectors(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row with links at a cosine of at least COSINE.

    Equal vectors are one node, their least vec_id, with a number of copies; a block pair reports sums of links and a
    spanning forest, never all pairs. Null, zero and non-finite vectors link with nothing; a null vec_id has no component
    and is kept; rows that share a vec_id and a vector count as copies; an empty table gives no rows. The boxes cut block
    pairs by all their leading axes; where vectors spread evenly over many dimensions few are cut and the work is quadratic.
    """
    rows = stored(usable(vectors).withColumn("cls", F.sha2(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string"))), 256)), "vectors")
    classes = stored(rows.groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    own = rows.join(classes.select("cls", F.col("rep").alias("vec_id"), "copies"), ["cls", "vec_id"]).dropDuplicates(["cls"])
    reps = stored(own.select("vec_id", "v", "copies"), "reps")
    out = vectors.select("vec_id")
    if not reps.head(1):
        return _shaped(out.withColumn("n_links", F.lit(0)).withColumn("component_id", F.col("vec_id")))
    directions = axes(reps)
    made = stored(blocks(reps, directions, block), "blocks")
    boxes = made.select("block", "low", "high")
    # every block meets those at or behind it in the order; only boxes travel, then the pairs that may touch
    ranked = stored(boxes.join(_numbered(made.select("block")), "block"), "boxes")
    n = ranked.count()
    later = ranked.select(F.col("block").alias("left_block"), F.col("low").alias("a_low"), F.col("high").alias("a_high"), F.explode(F.sequence(F.col("at"), F.lit(n - 1))).alias("at"))
    gaps = F.zip_with(F.arrays_zip(F.col("low").alias("low"), F.col("a_low").alias("a_low")), F.arrays_zip(F.col("high").alias("high"), F.col("a_high").alias("a_high")), lambda lo, hi: F.greatest(lo["low"] - hi["a_high"], lo["a_low"] - hi["high"], F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = later.join(ranked, "at").where(far <= EPSILON * EPSILON).select("left_block", F.col("block").alias("right_block"))
    sides = {s: made.select(*[F.col(c).alias(f"{s}_{c}") for c in ("block", "ids", "copies", "v")]) for s in ("left", "right")}
    both = pairs.join(sides["left"], "left_block").join(sides["right"], "right_block")
    # one pair of blocks per call bounds a task's memory
    results = both.groupBy("left_block", "right_block").applyInPandas(lambda pair: pd.concat(list(_joined(directions)([pair])), ignore_index=True), "u long, v long, links long")
    found = stored(results, "found")
    links = found.where("u = v").groupBy("u").agg(F.sum("links").alias("links"))
    parts = stored(components(found.where("u <> v").select("u", "v")), "components")
    facts = (
        classes.join(links, classes["rep"] == links["u"], "left")
        .join(parts, classes["rep"] == parts["node"], "left")
        .select("cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    )
    linked = rows.select("vec_id", "cls").join(facts, "cls").select("vec_id", "n_links", "component_id")
    none = vectors.join(rows.select("vec_id").distinct(), "vec_id", "left_anti").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return _shaped(linked.union(none))


def _numbered(made: DataFrame) -> DataFrame:
    """Blocks numbered by order: each partition's count is summed first, so no task sees more than its own and the counts."""
    from pyspark.sql import Window

    parts = made.withColumn("part", F.floor(F.col("block") / 2**31)).groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = parts.withColumn("first", before)
    return made.withColumn("part", F.floor(F.col("block") / 2**31)).join(firsts, "part").select("block", (F.col("first") + F.pmod("block", F.lit(2**31))).alias("at"))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", F.col("n_links").cast("long"), F.col("component_id").cast("long"), F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
