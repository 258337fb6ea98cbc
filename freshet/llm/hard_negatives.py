"""Hard negatives by best-first search in sort-tile-recursive packed R-trees.

Rows are laid out by label, then in slabs and tiles along the coordinates that vary most, and packed into trees of bounded
size; a leaf holds one label. A box bounds every coordinate, so it bounds the inner product with an anchor from both sides.
A search takes boxes from a queue, the most promising first, and drops those outside all score windows or strictly below the
kth score found. Anchors visit their most promising trees first; the others get them with the kth scores known by then.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Rows of a leaf, boxes of an inner box, anchors searched together, coordinates that tiles are cut along.
LEAF, FANOUT, TOGETHER, TILES = 256, 8, 64, 3
#: Bytes of a tree, and numbers in the directory of all trees' boxes, which every task holds; beyond that trees grow instead.
TREE_BYTES, DIRECTORY = 4 << 20, 1 << 20
_LEAST, _MOST = -(2**63), 2**63 - 1
_TREE = "tree long, first long, ids binary, labels binary, x binary, picked binary, starts binary, lo array<long>, hi array<long>, low_label long, high_label long"
_ASKED = "row long, label long, x binary, lo array<long>, hi array<long>, kth array<long>"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x, picked): the sound rows, ``x`` in doubles, not yet scaled."""
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"), F.coalesce("picked", F.lit(False)).alias("picked"))
    return rows.where(F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).withColumnRenamed("v", "x")


class Shape:
    """What all tasks agree on: width, largest size of an entry, how numbers are kept, coordinates to tile along."""

    def __init__(self, n: int, width: int, largest: float, spread: np.ndarray, scale: int, slots: int):
        self.n, self.width, self.scale = n, width, scale
        self.limit = float(math.isqrt(2**55 // max(1, width)))
        top = min(largest * scale + 1, self.limit)
        self.kept = next(np.dtype(k) for k in ("<i2", "<i4", "<i8") if top <= np.iinfo(k).max)
        self.exact = np.float64 if width * top * top < 2**53 else np.int64
        self.tiles = np.argsort(-spread)[:TILES].tolist()
        rows = min(TREE_BYTES // (max(1, width) * self.kept.itemsize), max(4 * LEAF, -(-n // (2 * slots))))
        self.tree_rows = max(rows, -(-n * 2 * width // DIRECTORY))
        self.trees = max(1, -(-n // self.tree_rows))

    def whole(self, lists: pa.ListArray) -> np.ndarray:
        """The rows as a matrix of whole numbers; shorter ones are filled up with zeros."""
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        x = np.zeros((len(lists), self.width))
        x[np.arange(self.width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return np.clip(np.floor(self.scale * x), -self.limit, self.limit).astype(self.kept)

    def matrix(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kept).reshape(-1, self.width).astype(self.exact)


def shape_of(rows: DataFrame, scale: int) -> Shape | None:
    """Counts and the spread per coordinate: one pass, one row per task and coordinate; None for an empty table."""
    head = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(F.array_max(F.transform("x", F.abs))).alias("largest")).first()
    if not head["n"]:
        return None
    width = max(1, head["width"])  # empty vectors count as one zero

    def moments(batches):
        n, total, squares = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            lists = batch.column("x")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((len(lists), width))
            x[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            x = np.clip(x, -1e100, 1e100)
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total), pa.array(squares)], names=["place", "s", "q"])

    spread = np.zeros(width)
    for r in rows.select("x").mapInArrow(moments, "place int, s double, q double").groupBy("place").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).collect():
        spread[r["place"]] = r["q"] / head["n"] - (r["s"] / head["n"]) ** 2
    slots = rows.sparkSession.sparkContext.defaultParallelism
    return Shape(head["n"], width, head["largest"] or 0.0, spread, scale, slots)


def tile(x: np.ndarray, rows: np.ndarray, along: list[int], leaf: int = LEAF) -> list[np.ndarray]:
    """Sort-tile-recursive packing: runs of at most ``leaf`` of ``rows``, cut along one coordinate after the other."""
    leaves = -(-len(rows) // leaf)
    if not along or leaves <= 1:
        return [rows[k : k + leaf] for k in range(0, len(rows), leaf)]
    ordered = rows[np.argsort(x[rows, along[0]], kind="stable")]
    slices = math.ceil(leaves ** (1 / len(along)))
    size = -(-leaves // slices) * leaf
    return [part for k in range(0, len(ordered), size) for part in tile(x, ordered[k : k + size], along[1:], leaf)]


def trees(rows: DataFrame, shape: Shape) -> DataFrame:
    """One row per packed tree; equal rows, of whatever number, spread over trees by their ids."""
    first, second = (F.coalesce(F.get("x", F.lit(k)), F.lit(0.0)) for k in (shape.tiles * 2)[:2]) if shape.tiles else (F.lit(0.0), F.lit(0.0))
    slabs = math.ceil(math.sqrt(shape.trees))
    cuts = rows.agg(F.percentile_approx(first, [k / slabs for k in range(1, slabs)], 1000).alias("c")).first()["c"] if slabs > 1 else []
    slab = F.lit(0)
    for k, cut in enumerate(cuts, 1):
        slab = F.when(first >= cut, k).otherwise(slab)
    keys = ["label", "slab", "at", "vec_id"]
    laid = rows.withColumn("slab", slab).withColumn("at", second).repartitionByRange(shape.trees, *keys).sortWithinPartitions(*keys)
    most = 2 * shape.tree_rows

    def pack(batches):
        part = TaskContext.get().partitionId()
        waiting, held, made, done = [], 0, 0, 0

        def tree(ids, labels, x, picked):
            runs = [run for label in np.unique(labels) for run in tile(x, np.flatnonzero(labels == label), shape.tiles)]
            order = np.concatenate(runs)
            starts = np.cumsum([0, *[len(run) for run in runs[:-1]]])
            row = [
                (part << 20) + made, (part << 33) + done, ids[order].tobytes(), labels[order].tobytes(), x[order].tobytes(), picked[order].tobytes(), starts.astype("<i8").tobytes(),
                x.min(axis=0).tolist(), x.max(axis=0).tolist(), int(labels.min()), int(labels.max()),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TREE_TYPES, strict=True)], names=_TREE_NAMES)

        def joined():
            return [np.concatenate(c) for c in zip(*waiting, strict=True)]

        for batch in batches:
            for start in range(0, len(batch), 4096):
                some = batch.slice(start, 4096)
                numbers = [some.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label")]
                waiting.append((numbers[0].astype("<i8"), numbers[1].astype("<i8"), shape.whole(some.column("x")), some.column("picked").to_numpy(zero_copy_only=False).astype(bool)))
                held += len(some)
                while held >= most:
                    every = joined()
                    yield tree(*[c[:most] for c in every])
                    waiting, held, made, done = [tuple(c[most:] for c in every)], held - most, made + 1, done + most
        if held:
            yield tree(*joined())

    return laid.select("vec_id", "label", "x", "picked").mapInArrow(pack, _TREE)


_TREE_NAMES = [field.split()[0] for field in _TREE.split(", ")]
_TREE_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]


def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each row of ``q`` with any point of each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def _best(row, score, name, tie, k: int):
    """The first ``k`` of each ``row`` by falling score and then the smaller name."""
    order = np.lexsort((tie, name, -score, row))
    row, score, name, tie = row[order], score[order], name[order], tie[order]
    first = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
    rank = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
    keep = rank < k
    return row[keep], score[keep], name[keep], tie[keep]


class Tree:
    """A packed tree in memory, level by level from the leaves up."""

    def __init__(self, record: dict, shape: Shape):
        self.x = shape.matrix(record["x"])
        self.ids, self.labels = np.frombuffer(record["ids"], "<i8"), np.frombuffer(record["labels"], "<i8")
        self.rows = record["first"] + np.arange(len(self.ids))
        starts = np.frombuffer(record["starts"], "<i8")
        self.ends, self.starts = np.append(starts[1:], len(self.ids)), starts
        low, high = self.labels[starts], self.labels[starts]
        self.levels = [(np.minimum.reduceat(self.x, starts, axis=0), np.maximum.reduceat(self.x, starts, axis=0), low, high)]
        while len(self.levels[-1][0]) > FANOUT:
            some = np.arange(0, len(self.levels[-1][0]), FANOUT)
            lo, hi, low, high = self.levels[-1]
            self.levels.append((np.minimum.reduceat(lo, some, axis=0), np.maximum.reduceat(hi, some, axis=0), np.minimum.reduceat(low, some), np.maximum.reduceat(high, some)))

    def search(self, q, owner, label, lo, hi, kth, own, same: bool, k: int):
        """(window, score, id) of the first ``k`` rows of each window, if not below ``kth``.

        Window w asks for scores in [lo, hi] with row ``owner[w]`` of ``q`` among rows of the same label, itself
        (``own``) apart, or of other labels.
        """
        best = (np.zeros(0, np.int64), np.zeros(0, q.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64))
        floor, queue, number = np.maximum(kth, lo), [], 0

        def push(level, nodes):
            nonlocal number
            box = [c[nodes] for c in self.levels[level]]
            least, most = bounds(q, box[0], box[1])
            for at, node in enumerate(nodes):
                fits = (box[2][at] <= label) & (label <= box[3][at]) if same else ~((box[2][at] == label) & (box[3][at] == label))
                want = fits & (most[owner, at] >= floor) & (least[owner, at] <= hi)
                if want.any():
                    number += 1
                    heapq.heappush(queue, (-most[owner[want], at].max(), number, level, node, want, most[:, at]))

        push(len(self.levels) - 1, np.arange(len(self.levels[-1][0])))
        while queue:
            _, _, level, node, want, most = heapq.heappop(queue)
            want &= most[owner] >= floor
            if not want.any():
                continue
            if level:
                push(level - 1, np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0]))))
                continue
            a, b = self.starts[node], self.ends[node]
            asked = np.flatnonzero(want)
            of, where = np.unique(owner[asked], return_inverse=True)
            score = (q[of] @ self.x[a:b].T)[where]
            hit = (score >= floor[asked, None]) & (score <= hi[asked, None])
            if same:
                hit &= self.rows[a:b] != own[asked, None]
            w, at = np.nonzero(hit)
            if len(w):
                fresh = (asked[w], score[w, at], self.ids[a:b][at], self.rows[a:b][at])
                best = _best(*[np.concatenate(c) for c in zip(best, fresh, strict=True)], k)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(floor)) >= k)
                last = np.searchsorted(best[0], full, side="right") - 1
                floor[full] = np.maximum(floor[full], best[1][last])
        return best[:3]


def _windows(records: list[dict], shape: Shape):
    """The anchors of some rows of ``_ASKED`` and their windows as arrays."""
    q = shape.matrix(b"".join(r["x"] for r in records))
    owner = np.repeat(np.arange(len(records)), [len(r["lo"]) for r in records])
    lo, hi, kth = (np.array([v for r in records for v in r[c]], dtype=np.int64).astype(shape.exact) for c in ("lo", "hi", "kth"))
    label, own = (np.array([r[c] for r in records], dtype=np.int64)[owner] for c in ("label", "row"))
    return q, owner, label, lo, hi, kth, own


def _targets(directory: list, shape: Shape, same: bool, rest: bool):
    """Adds the trees an anchor visits: the most promising ones, or those others that may still hold something for it."""
    number = np.array([r["tree"] for r in directory])
    lo, hi = (np.array([r[c] for r in directory], dtype=np.int64).reshape(len(number), -1).astype(shape.exact) for c in ("lo", "hi"))
    low, high = (np.array([r[c] for r in directory]) for c in ("low_label", "high_label"))
    early = math.ceil(math.sqrt(len(number)))

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                some = batch.slice(start, 512)
                records = some.to_pylist()
                q, owner, label, least_score, most_score, kth, _ = _windows(records, shape)
                least, most = bounds(q, lo, hi)
                fits = (low <= label[:, None]) & (label[:, None] <= high) if same else ~((low == label[:, None]) & (high == label[:, None]))
                fits &= (most[owner] >= least_score[:, None]) & (least[owner] <= most_score[:, None])
                any_of = np.zeros((len(records), len(number)), dtype=bool)
                np.logical_or.at(any_of, owner, fits)
                promise = np.where(any_of, most.astype(np.float64), -np.inf)
                first = np.zeros_like(any_of)
                np.put_along_axis(first, np.argsort(-promise, axis=1, kind="stable")[:, :early], True, axis=1)
                if rest:
                    alive = np.zeros_like(any_of)
                    np.logical_or.at(alive, owner, fits & (most[owner] >= kth[:, None]))
                    goes = alive & ~first
                else:
                    goes = any_of & first
                lists = pa.array([number[g].tolist() for g in goes], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=[*some.schema.names, "trees"])

    return run


def _visit(asked: DataFrame, packed: DataFrame, directory: list, shape: Shape, same: bool, k: int, rest: bool) -> DataFrame:
    """(row, w, id, score): what the trees find; anchors travel to the trees, which stay whole."""
    sent = asked.mapInArrow(_targets(directory, shape, same, rest), f"{_ASKED}, trees array<long>").withColumn("tree", F.explode("trees")).drop("trees")
    both = packed.select("tree", F.lit(0).alias("kind"), "first", "ids", "labels", F.col("x").alias("points"), "starts").unionByName(sent.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def run(batches):
        record, tree, waiting = None, None, []

        def answers():
            w, score, name = tree.search(*_windows(waiting, shape), same, k)
            counts = np.array([len(r["lo"]) for r in waiting])
            of = np.repeat(np.arange(len(waiting)), counts)[w]
            within = w - (np.cumsum(counts) - counts)[of]
            rows = np.array([r["row"] for r in waiting], dtype=np.int64)[of]
            return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(within.astype(np.int32)), pa.array(name), pa.array(score.astype(np.int64))], names=["row", "w", "id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0 or len(waiting) == TOGETHER:
                    if waiting:
                        yield answers()
                    waiting = []
                if r["kind"] == 0:
                    record, tree = r | {"x": r["points"]}, None
                    continue
                tree = tree or Tree(record, shape)
                waiting.append(r)
        if waiting:
            yield answers()

    return both.repartition("tree").sortWithinPartitions("tree", "kind", "row").mapInArrow(run, "row long, w int, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(asked: DataFrame, packed: DataFrame, directory: list, shape: Shape, same: bool, k: int) -> DataFrame:
    """(row, w, id, score, rank): the first ``k`` rows of each window of ``asked``, in two visits."""
    early = _ranked(stored(_visit(asked, packed, directory, shape, same, k, False), "early"), k)
    known = early.where(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("known"))
    again = asked.join(known, "row", "left").withColumn("kth", F.transform("lo", lambda _, w: F.coalesce(F.col("known")[w], F.lit(_LEAST)))).drop("known")
    late = _visit(again.select(*asked.columns), packed, directory, shape, same, k, True)
    return stored(_ranked(early.select("row", "w", "id", "score").unionByName(late), k), "nearest")


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label, embedding and ``picked``, which marks the anchors. A negative's score is within ``low``
    and ``high`` percent of its positive's. Scores are exact; ties go to the smaller id. Rows with a null id, label or
    vector, or a null or non-finite component, take no part; a null ``picked`` is no anchor. Shorter vectors are filled up
    with zeros. Repeated rows are rows of their own, also as positives and negatives of each other. A component whose scaled
    size is beyond sqrt(2^55 / width) is taken as that, so that scores fit a long. Further columns are ignored; an empty
    table, no anchors or no pairs give no rows.
    """
    rows = usable(vectors)
    shape = shape_of(rows, scale)
    if shape is None:
        return _shaped(rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
    packed = stored(trees(rows, shape), "trees")
    directory = packed.select("tree", "lo", "hi", "low_label", "high_label").collect()  # at most about DIRECTORY numbers

    def anchors(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["picked"], dtype=bool))
                ids, labels = np.frombuffer(r["ids"], "<i8")[at], np.frombuffer(r["labels"], "<i8")[at]
                x = np.frombuffer(r["x"], shape.kept).reshape(-1, shape.width)[at]
                yield pa.RecordBatch.from_arrays([pa.array(r["first"] + at), pa.array(ids), pa.array(labels), pa.array([v.tobytes() for v in x], pa.binary())], names=["row", "anchor_id", "label", "x"])

    picked = packed.select("first", "ids", "labels", "x", "picked").mapInArrow(anchors, "row long, anchor_id long, label long, x binary")
    every = [F.array(F.lit(v).cast("long")) for v in (_LEAST, _MOST, _LEAST)]
    asked = picked.select("row", "label", "x", *[c.alias(n) for c, n in zip(every, ("lo", "hi", "kth"), strict=True)])
    close = nearest(asked, packed, directory, shape, True, positives)

    floor = lambda v: ((v - F.pmod(v, F.lit(100))) / 100).cast("long")
    least, most = -floor(-low * F.col("score")), floor(high * F.col("score"))
    ranged = close.select("row", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), least.alias("lo"), most.alias("hi")).where("lo <= hi")
    numbered = ranged.withColumn("w", F.row_number().over(Window.partitionBy("row").orderBy("place")) - 1)
    lists = numbered.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("w", "lo", "hi"))).alias("all"))
    asked = picked.join(lists, "row").select("row", "label", "x", F.col("all.lo").alias("lo"), F.col("all.hi").alias("hi"), F.transform("all", lambda _: F.lit(_LEAST).cast("long")).alias("kth"))
    far = nearest(asked, packed, directory, shape, False, negatives)
    return _shaped(far.select("row", "w", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank").join(numbered, ["row", "w"]).join(picked.select("row", "anchor_id"), "row"))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"), (vec_id % 100 == 0).alias("picked")))


ORACLE_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), anchors AS (
  SELECT * FROM sound WHERE vec_id % 100 = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM anchors a JOIN sound b ON a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""
