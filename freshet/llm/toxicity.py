"""Toxicity by a small convolutional text classifier, trained in numpy."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

BUCKETS, SIZE, FILTERS, WIDTHS = 2**17, 8, 8, (1, 2, 3)
_WORD = re.compile(r"[^\W_]+")


def _bucket(part: str) -> int:
    return crc32(part.encode("utf-8", "surrogatepass")) % BUCKETS


class Codes:
    """Two buckets a word, lower-cased: its own and its first four characters'; remembers words up to a bound."""

    def __init__(self, remembered: int = 500_000):
        self.known: dict[str, tuple[int, int]] = {}
        self.remembered = remembered

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.known) > self.remembered:
            self.known.clear()
        known, out = self.known, []
        for word in _WORD.findall((text or "").lower()):
            code = known.get(word)
            if code is None:
                code = known[word] = _bucket(word), _bucket("^" + word[:4])
            out.append(code)
        return np.array(out, dtype=np.int32).reshape(-1, 2)


class Model:
    """Hashed embeddings, filters of several widths, rectified and max-pooled over the text, a logistic output."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.table = draw.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
        self.filters = [draw.normal(0, 0.3, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shifts = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.out = draw.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(0)

    def pooled(self, codes: np.ndarray, block: int = 65_536):
        """Largest response of every filter and the word where it begins; long texts go block by block."""
        best, where = np.zeros((len(WIDTHS), FILTERS), dtype=np.float32), np.full((len(WIDTHS), FILTERS), -1)
        for at in range(0, len(codes), block):
            part = self.table[codes[at : at + block + max(WIDTHS) - 1]].sum(axis=1)
            for k, width in enumerate(WIDTHS):
                n = len(part) - width + 1
                if n < 1:
                    continue
                response = sum(part[j : j + n] @ self.filters[k][j * SIZE : (j + 1) * SIZE] for j in range(width)) + self.shifts[k]
                top = response.argmax(axis=0)
                value = response[top, np.arange(FILTERS)]
                better = value > best[k]
                best[k][better], where[k][better] = value[better], top[better] + at
        return best, where

    def score(self, codes: np.ndarray) -> float:
        z = float(self.pooled(codes)[0].ravel() @ self.out + self.bias)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(texts: list[np.ndarray], marks: np.ndarray, rounds: int = 8, rate: float = 0.08, seed: int = 5) -> Model:
    """Adagrad over documents one by one; gradients flow to the pooled words only.

    The first number of a bucket starts as the smoothed log odds of the marked documents that hold it.
    """
    model = Model(seed)
    if not len(texts) or marks.min() == marks.max():
        model.out[:] = 0
        model.bias = np.float32(-3 if not len(texts) or marks.max() == 0 else 3)
        return model
    seen = np.zeros((2, BUCKETS))
    for codes, mark in zip(texts, marks, strict=True):
        seen[int(mark), np.unique(codes)] += 1
    odds = np.log((seen[1] + 0.5) / (marks.sum() + 1)) - np.log((seen[0] + 0.5) / ((1 - marks).sum() + 1))
    model.table[:, 0] = np.where(seen.sum(axis=0) >= 10, odds, 0).clip(-4, 4) / 2
    for k in range(len(WIDTHS)):
        model.filters[k][::SIZE] = np.abs(model.filters[k][::SIZE])
    model.out = np.abs(model.out)
    draw = np.random.default_rng(seed)
    memory = {k: np.full_like(v, 1e-2) for k, v in {"table": model.table, "out": model.out, **{f"f{k}": v for k, v in enumerate(model.filters)}, **{f"s{k}": v for k, v in enumerate(model.shifts)}}.items()}
    bias_memory = 1e-2
    weight = np.where(marks == 1, len(marks) / 2 / marks.sum(), len(marks) / 2 / (1 - marks).sum())

    def step(name, value, gradient, rows=slice(None)):
        memory[name][rows] += gradient**2
        value[rows] -= rate * gradient / np.sqrt(memory[name][rows])

    for _ in range(rounds):
        for i in draw.permutation(len(texts)):
            codes = texts[i]
            best, where = model.pooled(codes)
            flat = best.ravel()
            z = float(flat @ model.out + model.bias)
            error = np.float32((1 / (1 + np.exp(-np.clip(z, -30, 30))) - marks[i]) * weight[i])
            if abs(error) < 1e-3:
                continue
            back = (error * model.out).reshape(best.shape)
            step("out", model.out, error * flat + 1e-4 * model.out)
            bias_memory += float(error) ** 2
            model.bias -= np.float32(rate * error / np.sqrt(bias_memory))
            for k, width in enumerate(WIDTHS):
                on = np.flatnonzero(where[k] >= 0)
                if not len(on):
                    continue
                rows = codes[where[k][on][:, None] + np.arange(width)]
                vectors = model.table[rows].sum(axis=2).reshape(len(on), -1)
                to_table = (model.filters[k][:, on].T * back[k][on][:, None]).reshape(len(on), width, SIZE)
                gradient = np.zeros_like(model.filters[k])
                gradient[:, on] = (vectors * back[k][on][:, None]).T
                step(f"f{k}", model.filters[k], gradient)
                shift = np.zeros(FILTERS, dtype=np.float32)
                shift[on] = back[k][on]
                step(f"s{k}", model.shifts[k], shift)
                names, place = np.unique(rows.reshape(-1, 2), return_inverse=True)
                total = np.zeros((len(names), SIZE), dtype=np.float32)
                for half in place.reshape(-1, 2).T:
                    np.add.at(total, half, to_table.reshape(-1, SIZE))
                step("table", model.table, total, names)
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 3_000) -> Model:
    """Fits on at most ``sample`` labelled documents of each mark, least by hash of id and never held out.

    That bound is a parameter and so documented; null marks are no labels; of repeated ids the highest mark counts.
    """
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    marks = stored(marks, "marks")
    picked = None
    for mark in (0, 1):
        some = marks.where(F.col("toxic") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = some if picked is None else picked.union(some)
    known = docs.select("doc_id", "text").join(F.broadcast(stored(picked, "picked")), "doc_id")

    def coded(batches):
        codes = Codes()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "codes": [codes(t).tobytes() for t in batch["text"]]})

    rows = known.mapInPandas(coded, "doc_id long, toxic int, codes binary").toPandas()
    rows = rows.sort_values(["doc_id", "codes"]).drop_duplicates(["codes"])
    return fit([np.frombuffer(c, dtype=np.int32).reshape(-1, 2) for c in rows["codes"]], rows["toxic"].to_numpy(float))


def scored(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text; null texts count as empty and get the empty text's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        codes = Codes()
        for texts in batches:
            yield pd.Series([shared.value.score(codes(t)) for t in texts], dtype=float)

    from collections.abc import Iterator

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(into, F.pandas_udf(score, "double")(F.col("text")))


def calibrated(judged: DataFrame, labels: DataFrame, precision: float = 0.95, least: float = 0.7) -> dict[str | None, float]:
    """By language, the lowest threshold of a fixed grid from ``least`` up whose flagged training rows are toxic in ``precision`` of cases.

    Languages without flagged labelled rows, and those not named, take ``least``.
    """
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    step = F.floor(F.col("score") * 100).cast("int")
    counts = judged.where(~held_out() & (F.col("score") >= least)).join(marks, "doc_id").groupBy("lang", step.alias("step")).agg(F.sum("toxic").alias("hits"), F.count("*").alias("n"))
    found: dict[str | None, float] = {}
    for lang, rows in counts.toPandas().groupby("lang", dropna=True):  # at most 31 steps a language
        rows = rows.sort_values("step", ascending=False)
        share = rows["hits"].cumsum() / rows["n"].cumsum()
        fits = rows["step"][share >= precision]
        found[lang] = max(least, float(fits.min()) / 100) if len(fits) else least
    return found


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
