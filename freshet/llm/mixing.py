"""Mixing sources to target weights over a domain, language and source tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import WORD, stored, table

LEVELS = ("domain", "lang", "source")


def token_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_domain(source: str = "source") -> Column:
    """A source's domain by its number: even ones are web, odd ones reference; others misc."""
    number = F.regexp_extract(F.col(source), r"(\d+)$", 1)
    return F.when(number == "", "misc").when(F.col(source).isNull(), "misc").when(
        number.substr(F.length(number), F.lit(1)).isin("0", "2", "4", "6", "8"), "web"
    ).otherwise("reference")


def share_out(children: DataFrame, parent: list[str], budget: str, capacity: str, weight: str, into: str) -> DataFrame:
    """Deals each parent's ``budget`` to its children by weight, none above its capacity.

    What a child cannot take goes to its siblings by their weights: the level at which children fill up is the
    largest of the levels that the children, by rising capacity per weight, would set. Children with no positive
    weight get nothing.
    """
    by = Window.partitionBy(*parent).orderBy("_fill", *[c for c in LEVELS if c in children.columns])
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    some = F.col(weight) > 0
    return (
        children.withColumn("_fill", F.when(some, F.col(capacity) / F.col(weight)).otherwise(F.lit(float("inf"))))
        .withColumn("_taken", F.coalesce(F.sum(F.when(some, F.col(capacity))).over(before), F.lit(0)))
        .withColumn("_rest", F.sum(F.when(some, F.col(weight)).otherwise(0.0)).over(from_here))
        .withColumn("_level", F.when(F.col("_rest") > 0, (F.col(budget) - F.col("_taken")) / F.col("_rest")).otherwise(0.0))
        .withColumn("_level", F.max("_level").over(Window.partitionBy(*parent)))
        .withColumn(into, F.when(some, F.least(F.col(capacity).cast("double"), F.col(weight) * F.greatest("_level", F.lit(0.0)))).otherwise(0.0))
        .drop("_fill", "_taken", "_rest", "_level")
    )


def leaf_budgets(leaves: DataFrame, fraction: float, epochs: int, weights: dict[str, dict[str, float]]) -> DataFrame:
    """``leaves`` (the levels and their ``tokens``) with a ``budget`` of tokens each.

    The whole budget is ``fraction`` of all tokens. It goes down the tree level by level, so a shortage stays among
    siblings while they can take it and reaches other branches only through the capacity of the ancestor.
    """
    node = leaves.withColumn("capacity", F.col("tokens") * epochs)
    path: list[str] = []
    budgets = node.agg((F.sum("tokens") * F.lit(fraction)).alias("budget")).withColumn("_root", F.lit(0))
    for level in LEVELS:
        parent, path = ["_root", *path], [*path, level]
        given = weights.get(level, {})
        weight = F.lit(1.0)
        for name, value in given.items():
            weight = F.when(F.col(level).eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
        children = node.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("_root", F.lit(0))
        above = budgets.withColumnsRenamed({c: f"_of_{c}" for c in parent} | {"budget": "_whole"})
        joined = children.join(above, _all([F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in parent])).drop(
            *[f"_of_{c}" for c in parent]
        )
        dealt = share_out(joined.withColumn("_weight", weight), parent, "_whole", "capacity", "_weight", "budget")
        budgets = dealt.select("_root", *path, "budget")
    return budgets.drop("_root")


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out &= test
    return out


def mix(
    docs: DataFrame,
    fraction: float = 0.9,
    epochs: int = 2,
    weights: dict[str, dict[str, float]] | None = None,
    seed: int = 11,
    per_chunk: int = 50_000,
) -> DataFrame:
    """``docs`` (doc_id, lang, source, text and any others, in place of ``domain``) as often as the mixture wants them.

    Added: ``domain``, ``n_tokens`` and ``epoch`` (0 and up). An epoch orders a leaf by a seeded hash; all epochs but
    its last are whole, the last is the prefix in which each document starts below the budget, so a leaf ends at most one document
    over. Null levels are a branch of their own; empty texts cost nothing and come along with the prefix; repeated rows
    are counted together and come as often as the budget has room for them, rows that share an id or have none by
    themselves; an empty table stays empty. A leaf is summed in chunks of its order, so a large one is many tasks' work.
    """
    own = [c for c in docs.columns if c not in ("domain", "n_tokens", "epoch", "_row")]
    hashed = [c for c in own if not docs.schema[c].dataType.simpleString().startswith("map")]
    sized = docs.select(*own, source_domain().alias("domain"), token_count().alias("n_tokens"), F.xxhash64(*hashed).alias("_row"))
    light = sized.groupBy("_row", *LEVELS, "n_tokens").agg(F.count("*").alias("copies"))
    light = stored(light, "sizes")
    leaves = light.groupBy(*LEVELS).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("n_docs"))
    leaves = stored(leaves, "leaves")
    budgets = leaf_budgets(leaves.select(*LEVELS, "tokens"), fraction, epochs, weights or {})
    budgets = budgets.withColumnsRenamed({c: f"_{c}" for c in LEVELS})
    same = _all([F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS])
    plan = leaves.join(budgets, same).select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(0).cast("int").alias("whole"),
        (F.col("budget") - F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(0) * F.col("tokens")).alias("part"),
        (1 + F.floor(F.col("n_docs") / per_chunk)).alias("chunks"),
        F.xxhash64(*[F.coalesce(F.col(c), F.lit("\0")) for c in LEVELS]).alias("leaf"),
    )
    plan = stored(plan, "plan")
    named = plan.withColumnsRenamed({c: f"_{c}" for c in LEVELS})
    ranks = light.join(named, same).select("_row", "n_tokens", "copies", "leaf", "whole", "part", "chunks")
    # a row's place in the epoch that is cut: 62 bits of a hash, their upper half is the chunk
    place = F.pmod(F.xxhash64(F.lit(seed), "whole", "_row"), F.lit(2**62))
    in_chunk = lambda at, chunks: F.floor(F.shiftright(at, 31) * chunks / F.lit(2**31))
    size = F.col("n_tokens") * F.col("copies")
    ranks = ranks.withColumn("place", place).withColumn("chunk", in_chunk(F.col("place"), F.col("chunks")))
    steps = ranks.groupBy("leaf", "chunk", "part").agg(F.sum(size).alias("sum"))
    upto = F.coalesce(F.sum("sum").over(Window.partitionBy("leaf").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = stored(steps.withColumn("before", upto), "chunks")
    within = Window.partitionBy("leaf", "chunk").orderBy("place", "_row").rowsBetween(Window.unboundedPreceding, -1)
    # chunks before the one that crosses the budget come whole, later ones not at all: one chunk per leaf is ordered
    crossing = cut.where("before < part and before + sum > part").select("leaf", "chunk", "before")
    room = F.when(F.col("n_tokens") > 0, F.ceil((F.col("part") - F.col("at")) / F.col("n_tokens"))).otherwise(F.col("copies"))
    border = (
        ranks.join(crossing, ["leaf", "chunk"])
        .withColumn("at", F.col("before") + F.coalesce(F.sum(size).over(within), F.lit(0)))
        .where(F.col("at") < F.col("part"))
        .groupBy("leaf", "chunk")
        .agg(F.max(F.struct("place", F.least(F.col("copies"), room).alias("copies"))).alias("last"))
    )
    limits = plan.join(border, "leaf", "left").join(
        cut.where("before + sum <= part and part > 0").groupBy("leaf").agg(F.max("chunk").alias("whole_chunk")), "leaf", "left"
    ).select(*[plan[c] for c in LEVELS], "whole", "part", "chunks", "chunk", F.col("last.place").alias("last"), F.col("last.copies").alias("copies"), "whole_chunk")
    limits = limits.withColumnsRenamed({c: f"_{c}" for c in limits.columns})
    full = sized.join(limits, same)
    here = F.pmod(F.xxhash64(F.lit(seed), "_whole", "_row"), F.lit(2**62))
    chunk = in_chunk(here, F.col("_chunks"))
    at_border = F.coalesce((chunk == F.col("_chunk")) & (here == F.col("_last")), F.lit(False))
    taken = F.coalesce(chunk <= F.col("_whole_chunk"), F.lit(False)) | F.coalesce((chunk == F.col("_chunk")) & (here < F.col("_last")), F.lit(False))
    names = [*own, "domain", "n_tokens", "epoch"]
    most = full.withColumn("_times", F.col("_whole") + F.when(taken, 1).otherwise(0)).where("_times > 0")
    most = most.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))).select(*names)
    # of the row at the border only some copies have room; equal rows are one and the same
    last = full.where(at_border).dropDuplicates(["_row"]).withColumn("epoch", F.col("_whole"))
    last = last.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*names)
    return most.unionByName(last)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return mix(docs, weights=TARGET).drop("text")


#: Production weights; what is not named has weight 1.
TARGET = {"domain": {"web": 2.0}, "lang": {"en": 3.0}}
