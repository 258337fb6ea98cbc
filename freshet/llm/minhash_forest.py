"""Near duplicates by an LSH forest: sorted signature orders, neighbours by longest common prefix."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import free, lower_ascii, stored, table
from freshet.llm.components import components

SHINGLE = 5
TREES, DEPTH, LEAST_DEPTH, NEIGHBOURS = 24, 6, 2, 8
#: More than NEIGHBOURS rows that share so many hashes are a crowd; shingles of more components than that are dense.
CROWD, DENSE = 3, 32
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")
_FACTORS = np.random.default_rng(7).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)]
_SEEN = "row long, doc_id long, cls binary, n_shingles long, signature binary, marks binary, body binary"
_PASSED = "a long, b long, tree int, key binary, c8 long, row long, n_shingles long"
#: Words of 64 bits that say how far two sets are apart at least.
PARITY = 8
_BITS = [f"b{k}" for k in range(PARITY)]
_APART = "(" + " + ".join(f"bit_count(x.{b} ^ y.{b})" for b in _BITS) + ")"
#: A link has 3/7 of both sets' sizes in common and no more than 1/7 of them apart. ``left`` counts the shingles from the shared one on.
_MAY_LINK = f"7 * least(x.left, y.left) >= 3 * (x.n + y.n) and 7 * {_APART} <= x.n + y.n"
#: Texts of a task whose copies leave their signature and body out.
REMEMBERED = 1_000_000


def words_of(text: str | None) -> list[str]:
    return [w for w in _SPLIT.split(lower_ascii(text or "")) if w]


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word windows; word hashes are remembered up to a bound."""

    def __init__(self, remembered: int = 500_000):
        self.known: dict[str, int] = {}
        self.remembered = remembered

    def __call__(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        for word in words:
            if word not in known:
                known[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        codes = np.array([known[w] for w in words], dtype=np.uint64)
        width = min(SHINGLE, len(words))
        total = np.full(len(words) - width + 1, len(words) if width < SHINGLE else 0, dtype=np.uint64)
        for k in range(width):
            total = (total ^ codes[k : k + len(total)]) * _MIX[0]
            total ^= total >> np.uint64(29)
        total *= _MIX[1]
        return np.unique(total ^ (total >> np.uint64(32)))


def signature(shingles: np.ndarray, block: int = 2048) -> np.ndarray:
    """The least value of each hash function, its upper 32 bits; blocks bound the memory of long texts."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), block):
        np.minimum(least, np.multiply.outer(_FACTORS, shingles[at : at + block]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(">u4")


def _sketch(batches):
    """One row per document, numbered; the first of equal texts in a task has the signature, its marks and the body."""
    import zstandard

    shingled, squeeze = Shingles(), zstandard.ZstdCompressor(level=1)
    at, met = TaskContext.get().partitionId() << 33, set()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = words_of(text)
            plain = " ".join(words).encode("utf-8", "surrogatepass")
            found = shingled(words)
            cls = blake2b(plain, digest_size=16).digest()
            whole = (None, None, None)
            if len(found) and cls not in met:
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(cls)
                made = signature(found)
                # the last byte of each place is enough to see whether two signatures agree
                whole = (made.tobytes(), made.view(np.uint8)[3::4].tobytes(), squeeze.compress(plain))
            rows.append((at, doc_id, cls, len(found), *whole))
            at += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SEEN_TYPES, strict=True)] if rows else [pa.array([], t) for t in _SEEN_TYPES], names=_SEEN_NAMES)


_SEEN_NAMES = [field.split()[0] for field in _SEEN.split(", ")]
_SEEN_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), *[pa.binary()] * 3]


def _neighbours(batches):
    """Rows in sorted order: pairs with near successors, and the rows at both ends for a second pass.

    A row's depth is one more than what it shares with its NEIGHBOURS-th successor, so a crowded region asks for a
    longer prefix. All rows of a window whose ends share CROWD hashes are marked as crowded by a pair of a row with itself.
    Copies of a text that come from several tasks stand side by side here; the first of them goes on.
    """
    tail = pd.DataFrame(columns=["tree", "key", "c8", "row", "n_shingles"])
    first, last = True, None
    for batch in batches:
        again = (batch["tree"].eq(batch["tree"].shift()) & batch["key"].eq(batch["key"].shift()) & batch["c8"].eq(batch["c8"].shift())).to_numpy()
        if len(batch):
            again[0] = last == tuple(batch.iloc[0][["tree", "key", "c8"]])
            last = tuple(batch.iloc[-1][["tree", "key", "c8"]])
        batch = batch[~again]
        if not len(batch):
            continue
        if first:
            yield batch.head(NEIGHBOURS).assign(a=None, b=None).astype({"a": "Int64", "b": "Int64"})
            first = False
        rows = pd.concat([tail, batch], ignore_index=True) if len(tail) else batch.reset_index(drop=True)
        done = len(tail)
        keys = np.frombuffer(b"".join(rows["key"]), dtype=">u4").reshape(len(rows), DEPTH)
        tree, ids = rows["tree"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)
        n = rows["n_shingles"].to_numpy(np.int64)

        def shared(lag, keys=keys, tree=tree):
            same = np.logical_and.accumulate(keys[:-lag] == keys[lag:], axis=1).sum(axis=1)
            return np.where(tree[:-lag] == tree[lag:], same, 0)

        depth = np.full(len(rows), LEAST_DEPTH)
        if len(rows) > NEIGHBOURS:
            depth[:-NEIGHBOURS] = np.clip(shared(NEIGHBOURS) + 1, LEAST_DEPTH, DEPTH)
        pairs = []
        for lag in range(1, min(NEIGHBOURS, len(rows) - 1) + 1):
            left = np.flatnonzero(shared(lag) >= depth[:-lag])
            left = left[left + lag >= done]  # pairs inside the carried tail are out already
            right = left + lag
            fits = 100 * np.minimum(n[left], n[right]) >= 75 * np.maximum(n[left], n[right])
            left, right = left[fits], right[fits]
            pairs.append(np.stack([np.minimum(ids[left], ids[right]), np.maximum(ids[left], ids[right])]))
        if pairs:
            both = np.unique(np.concatenate(pairs, axis=1), axis=1)
            both = both[:, both[0] < both[1]]
            if len(rows) > NEIGHBOURS:
                starts = np.flatnonzero(shared(NEIGHBOURS) >= CROWD)
                marked = np.unique(ids[np.unique(starts[:, None] + np.arange(NEIGHBOURS + 1))])
                both = np.concatenate([both, np.stack([marked, marked])], axis=1)
            yield pd.DataFrame({"a": both[0], "b": both[1], "tree": None, "key": None, "c8": None, "row": None, "n_shingles": None}).astype(
                {"a": "Int64", "b": "Int64", "tree": "Int32", "c8": "Int64", "row": "Int64", "n_shingles": "Int64"}
            )
        tail = rows.tail(NEIGHBOURS)
    if len(tail):
        yield tail.assign(a=None, b=None).astype({"a": "Int64", "b": "Int64"})


def candidates(seen: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, votes) of neighbours in any tree; ``seen`` has row, cls, n_shingles, signature.

    A crowded row, whose partners may be further away than its neighbours, is paired with itself.
    """
    width = 4 * DEPTH
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    heads = seen.where("signature is not null")
    rows = heads.select("row", "n_shingles", "signature", F.xxhash64("cls").alias("c8"), tree).selectExpr(
        "tree", f"substring(signature, tree * {width} + 1, {width}) AS key", "c8", "row", "n_shingles"
    )
    order = ["tree", "key", "c8"]
    # equal keys stay together, so copies of a text do too; there is one from each task at most
    passed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order, "row").mapInPandas(_in_order, _PASSED), "neighbours"
    )
    ends = passed.where("a is null").select("tree", "key", "c8", "row", "n_shingles").distinct()
    again = ends.repartition("tree").sortWithinPartitions(*order, "row").mapInPandas(_in_order, _PASSED)
    pairs = passed.union(again).where("a is not null")
    found = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("votes")), "candidates")
    free(passed)
    return found


def _in_order(batches):
    for made in _neighbours(batches):
        yield made[["a", "b", "tree", "key", "c8", "row", "n_shingles"]]


def confirmed(pairs: DataFrame, seen: DataFrame, least_agreement: float = 0.5) -> DataFrame:
    """The (a, b) whose full shingle sets have 100 * intersection >= 75 * union, stored.

    Signatures that agree in fewer than half of their 144 places are passed over first: at a similarity of 0.75 that
    has a chance below one in 10^9. Of each place one byte is compared, so a few more pairs go on than need to.
    """
    marks = seen.where("marks is not null").select("row", "marks")

    def agrees(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= least_agreement for x, y in zip(left, right, strict=True)], dtype=bool)

    likely = stored(
        pairs.select("a", "b")
        .join(marks.select(F.col("row").alias("a"), F.col("marks").alias("left")), "a")
        .join(marks.select(F.col("row").alias("b"), F.col("marks").alias("right")), "b")
        .where(F.pandas_udf(agrees, "boolean")("left", "right"))
        .select("a", "b"),
        "likely",
    )
    needed = likely.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    bodies = stored(seen.where("body is not null").select("row", "body").join(needed, "row"), "bodies")

    def check(batches):
        import zstandard

        shingled, open_ = Shingles(), zstandard.ZstdDecompressor()

        def made(body):
            return shingled(open_.decompress(body).decode("utf-8", "surrogatepass").split(" "))

        for batch in batches:
            hits = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                x, y = made(left), made(right)
                common = len(np.intersect1d(x, y, assume_unique=True))
                hits.append(100 * common >= 75 * (len(x) + len(y) - common))
            yield batch.loc[np.array(hits, dtype=bool), ["a", "b"]]

    found = stored(
        likely.join(bodies.select(F.col("row").alias("a"), F.col("body").alias("left")), "a")
        .join(bodies.select(F.col("row").alias("b"), F.col("body").alias("right")), "b")
        .mapInPandas(check, "a long, b long"),
        "confirmed",
    )
    free(likely, bodies)
    return found


def _parity(shingles: np.ndarray) -> np.ndarray:
    """PARITY words, each bit the parity of the shingles that fall on it; two sets differ in at least as many shingles as bits."""
    odd = np.bincount((shingles % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _met(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Lists of rows of different components that share a shingle; columns h, part, row, n, left, bits.

    A component's rows of one shingle are one list in at most 64 pieces, so its rows never meet each other.
    """

    def lists(postings: DataFrame, side: str) -> DataFrame:
        piece = F.pmod(F.xxhash64("row"), F.lit(64))
        listed = postings.groupBy("h", F.col("part").alias(f"{side}_part"), piece.alias("piece"))
        return listed.agg(F.collect_list(F.struct("row", "n", "left", *_BITS)).alias(f"{side}_rows")).drop("piece")

    return lists(left, "x").join(lists(right, "y"), "h").where(f"x_part {order} y_part")


def _sharing(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of the lists in ``met`` that may be links; the others are passed over before they are rows."""
    met = met.select(F.explode("x_rows").alias("x"), "y_rows")
    met = met.select("x", F.explode(F.expr(f"filter(y_rows, y -> {_MAY_LINK})")).alias("y"))
    return met.selectExpr("least(x.row, y.row) AS a", "greatest(x.row, y.row) AS b").distinct()


def _nearest(met: DataFrame) -> DataFrame:
    """Of each two components in ``met`` the pair (a, b) that is most likely a link."""
    near = f"struct({_APART} / (x.n + y.n) AS apart, least(x.row, y.row) AS a, greatest(x.row, y.row) AS b)"
    least = F.expr(f"array_min(flatten(transform(x_rows, x -> transform(filter(y_rows, y -> {_MAY_LINK}), y -> {near}))))")
    best = met.select(F.least("x_part", "y_part").alias("p"), F.greatest("x_part", "y_part").alias("q"), least.alias("best"))
    return best.where("best is not null").groupBy("p", "q").agg(F.min("best").alias("best")).select("best.a", "best.b").distinct()


def crowd_sets(seen: DataFrame, crowd: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``crowd`` with the rare shingles to meet others by, and the units that consist of dense ones; both stored.

    A link needs three quarters of each set in common, all of it in shingles that occur in more than one component.
    In one order of these, rare ones first, both sets have the first common shingle in what may be missing plus one, so
    rows that share a shingle there are paired if it is in at most DENSE components. Where all common shingles are in more,
    one of the two sets has 6/7 of its own among such: of those, rows with the same dense shingles link to the
    smallest set of them, and that one stands for them against all others by the same order.
    """
    own = parts.select(F.col("node").alias("row"), "component_id")
    wanted = crowd.distinct().join(own, "row", "left").selectExpr("row", "coalesce(component_id, row) AS part")
    # stored, so that its size is known: while it is small, the bodies of all other rows are not shuffled
    rows = seen.where("body is not null").selectExpr("row", "n_shingles AS n", "body").join(stored(wanted, "wanted"), "row")

    def opened(batches):
        import zstandard

        shingled, open_ = Shingles(), zstandard.ZstdDecompressor()
        for batch in batches:
            found = [shingled(open_.decompress(body).decode("utf-8", "surrogatepass").split(" ")) for body in batch["body"]]
            bits = np.array([_parity(x) for x in found]).reshape(len(batch), PARITY)
            made = batch[["row", "n", "part"]].assign(found=[x.view(np.int64) for x in found])
            yield made.assign(**{name: bits[:, k] for k, name in enumerate(_BITS)})

    words = ", ".join(f"{name} long" for name in _BITS)
    sets = stored(rows.mapInPandas(opened, f"row long, n long, part long, found array<long>, {words}"), "crowd")
    postings = sets.select("row", "part", F.explode("found").alias("h"))
    spread = postings.select("h", "part").distinct().groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    ordered = postings.join(spread, "h").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("found"))
    ordered = ordered.join(sets.drop("found"), "row").where("4 * size(found) >= 3 * n")
    prefix = "slice(found, 1, int(size(found) - ceil(3 * n / 4) + 1))"
    ordered = stored(
        ordered.selectExpr(
            "row",
            "n",
            "part",
            f"filter(transform({prefix}, (x, i) -> struct(x.df, x.h, size(found) - i AS left)), x -> x.df <= {DENSE}) AS rare",
            f"transform(filter(found, x -> x.df > {DENSE}), x -> x.h) AS dense",
            *_BITS,
        ),
        "ordered",
    )
    units = ordered.where("size(dense) > 0 and 4 * size(dense) >= 3 * n").withColumn("cls", F.md5(F.concat_ws(",", F.col("dense").cast("array<string>"))))
    units = stored(units.groupBy("cls", "part").agg(F.min(F.struct("n", "row", "dense", *_BITS)).alias("u")).select("cls", "part", "u.*"), "units")
    free(sets)
    return ordered.drop("dense"), units


def _meetings(ordered: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists of rows that share a rare shingle, and of units that share a dense one with a head."""
    rare = ordered.select("row", "n", "part", *_BITS, F.explode("rare").alias("x")).select("row", "n", "part", *_BITS, "x.h", "x.left")
    first = F.expr("posexplode(slice(dense, 1, int(size(dense) - ceil(3 * n / 4) + 1)))").alias("i", "h")
    sides = [side.select("row", "n", "part", *_BITS, F.size("dense").alias("all"), first).withColumn("left", F.expr("all - i")) for side in (units, _heads(units))]
    return _met(rare, rare, "<"), _met(*sides, "<>")


def _heads(units: DataFrame) -> DataFrame:
    full = units.where("7 * size(dense) >= 6 * n")
    return full.groupBy("cls").agg(F.min(F.struct("n", "row", "part", "dense", *_BITS)).alias("u")).select("cls", "u.*")


def _chained(units: DataFrame) -> DataFrame:
    """Pairs (a, b) of the rows with the same dense shingles and the smallest set of them."""
    salted = _heads(units).select("cls", F.col("row").alias("head"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    full = units.where("7 * size(dense) >= 6 * n").withColumn("salt", F.pmod("row", F.lit(16)).cast("int"))
    return full.join(salted, ["cls", "salt"]).where("row <> head").selectExpr("least(row, head) AS a", "greatest(row, head) AS b")


def crowd_pairs(seen: DataFrame, crowd: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) that, once confirmed, join all components that a link between two rows of ``crowd`` would join."""
    ordered, units = crowd_sets(seen, crowd, parts)
    rare, dense = _meetings(ordered, units)
    return _sharing(rare).union(_sharing(dense)).union(_chained(units)).distinct()


def crowd_links(seen: DataFrame, crowd: DataFrame, parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``links`` (stored) and of all links between rows of ``crowd``.

    Two components are joined by one link, so the nearest pair of each two is confirmed first; all pairs that may be links
    are made only between the components that are still apart then.
    """
    ordered, units = crowd_sets(seen, crowd, parts)
    rare, dense = _meetings(ordered, units)
    near = stored(_nearest(rare).union(_nearest(dense)).union(_chained(units)).distinct(), "nearest")
    links = stored(links.union(confirmed(near, seen)), "links")
    parts = stored(components(links.toDF("u", "v")), "components")
    own = parts.select(F.col("node").alias("row"), "component_id")

    def joined(rows: DataFrame) -> DataFrame:
        return rows.join(own, "row", "left").withColumn("part", F.coalesce("component_id", "part")).drop("component_id")

    rare, dense = _meetings(joined(ordered), joined(units))
    apart = _sharing(rare).union(_sharing(dense)).distinct().join(near, ["a", "b"], "left_anti")
    beyond = confirmed(stored(apart, "apart"), seen)
    return parts if beyond.isEmpty() else stored(components(links.union(beyond).toDF("u", "v")), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Texts with the same words are one class, whatever their ids; its first row is its node, so copies are never paired and
    texts that share an id are compared each by itself. Every node first proposes its best neighbour; other candidates are
    checked if their ends are still in different components, for only they can change one. Crowded rows, whose partners
    may be beyond their neighbours, are then joined exactly. Null and empty texts have no shingles and link with nothing; a
    row without an id is kept and has no component, though its text may link others; an empty table gives no rows.
    """
    seen = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sketch, _SEEN), "sketches")
    found = candidates(seen)
    pairs, crowd = found.where("a < b"), found.where("a = b").select(F.col("a").alias("row"))
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("votes", -F.col("a"))).alias("a")).select("a", "b")
    links = confirmed(best, seen)
    parts = stored(components(links.toDF("u", "v")), "components")
    ends = pairs.select("a", "b")
    for end in ("a", "b"):
        part = parts.select(F.col("node").alias(end), F.col("component_id").alias(f"{end}_part"))
        ends = ends.join(part, end, "left")
    crossing = ends.where("coalesce(a_part, a) <> coalesce(b_part, b)").select("a", "b").join(best, ["a", "b"], "left_anti")
    links = stored(links.union(confirmed(crossing, seen)), "links")
    parts = stored(components(links.toDF("u", "v")), "components")
    parts = crowd_links(seen, crowd, parts, links)
    # classes and their nodes, then the least id of each component
    light = seen.where("n_shingles > 0").select("cls", "doc_id", F.when(F.col("body").isNotNull(), F.col("row")).alias("row"))
    classes = light.groupBy("cls").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    placed = classes.join(parts, "node", "left").select("cls", "least", F.coalesce("component_id", "node").alias("part"))
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    return (
        seen.select("doc_id", "cls", "n_shingles")
        .join(placed.join(least, "part").select("cls", "component_id"), "cls", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op7_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
