"""Language-model scores by word pairs interpolated with single words."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table
from freshet.llm.minhash_forest import words_of

START, END = b"\xff<", b"\xff>"  # bytes that no UTF-8 word holds
SMOOTH, PAIR_SHARE = 0.1, 0.4
CHUNK_CHARS = 4_000_000
#: Grams of a bucket on average, and at least so many buckets (as powers of two).
BUCKET_BITS, LEAST_BITS = 21, 5
HELD, NO_ID = 1, 2
_CHUNK = "chunk long, n_tokens long, n_trained long, n_texts long, ids binary, flags binary, lengths binary, words binary, places binary"
_ASKED = "chunk long, single boolean, bucket long, codes binary, n binary"
_ANSWER = "chunk long, single boolean, bucket long, totals binary, n_distinct long"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def _code(part: bytes) -> int:
    return int.from_bytes(blake2b(part, digest_size=8).digest(), "little", signed=True)


def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit codes of two tokens that follow each other."""
    mixed = left * np.uint64(0x9E3779B97F4A7C15) ^ right
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in few bytes: first bytes together, then second ones, and so on."""
    import zstandard

    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    made = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(made, names=[name for name, _ in fields])


class Chunk:
    """Documents as places in a list of the words they hold, END among them."""

    def __init__(self):
        self.place: dict[str | bytes, int] = {END: 0}
        self.ids, self.flags, self.lengths, self.places, self.size = [], [], [], [], 0

    def add(self, doc_id: int | None, text: str | None, out: bool) -> None:
        words, place = words_of(text), self.place
        for word in words:
            if word not in place:
                place[word] = len(place)
        self.places.append(np.array([*(place[w] for w in words), 0], dtype=np.uint32))
        self.lengths.append(len(words) + 1)
        self.ids.append(doc_id or 0)
        self.flags.append(HELD * out + NO_ID * (doc_id is None))
        self.size += len(text or "") + 1

    def row(self, number: int) -> tuple:
        lengths, flags = np.array(self.lengths), np.array(self.flags)
        words = np.array([_code(w if w is END else w.encode("utf-8", "surrogatepass")) for w in self.place], dtype=np.int64)
        trained = flags & HELD == 0
        return (
            number, int(lengths.sum()), int(lengths[trained].sum()), int(trained.sum()),
            _packed(np.array(self.ids, dtype=np.int64).view(np.uint64)), _packed(flags), _packed(lengths),
            _packed(words.view(np.uint64)), _packed(np.concatenate(self.places)),
        )


def _chunks(batches):
    """Documents in chunks of bounded size, one row each."""
    number, chunk = TaskContext.get().partitionId() * 2**24, Chunk()
    for batch in batches:
        for doc_id, text, out in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "held_out")), strict=True):
            chunk.add(doc_id, text, out)
            if chunk.size >= CHUNK_CHARS:
                yield _table([chunk.row(number)], _CHUNK)
                number, chunk = number + 1, Chunk()
    if chunk.ids:
        yield _table([chunk.row(number)], _CHUNK)


def _opened(words: bytes, places: bytes, lengths: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a chunk's tokens and of each token with the one before it, and where its documents begin."""
    one = _unpacked(words)[_unpacked(places)]
    starts = np.concatenate([[0], np.cumsum(_unpacked(lengths)).astype(np.int64)])
    before = np.roll(one, 1)
    before[starts[:-1]] = np.uint64(_code(START) % 2**64)
    return one, pairs(before, one), starts


def _asked(bits: int):
    """The distinct grams of each chunk in order, with their training counts, cut into buckets by their first bits."""

    def run(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                one, two, starts = _opened(chunk["words"], chunk["places"], chunk["lengths"])
                trained = np.repeat(_unpacked(chunk["flags"]) & np.uint64(HELD) == 0, np.diff(starts))
                for single, codes in ((True, one), (False, two)):
                    names, place = np.unique(codes, return_inverse=True)
                    n = np.bincount(place, weights=trained, minlength=len(names))
                    bucket = (names >> np.uint64(64 - bits)).astype(np.int64)
                    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(names)]
                    rows = [
                        (chunk["chunk"], single, int(bucket[low]), _packed(np.diff(names[low:high], prepend=np.uint64(0))), _packed(n[low:high]))
                        for low, high in zip(cuts, cuts[1:], strict=False)
                    ]
                    yield _table(rows, _ASKED)

    return run


def _answers(asked: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's grams of a bucket their training counts in the whole corpus, in the same order."""
    codes = [np.cumsum(_unpacked(blob), dtype=np.uint64) for blob in asked["codes"]]
    ends = np.cumsum([len(c) for c in codes])
    names, place = np.unique(np.concatenate(codes), return_inverse=True)
    del codes
    n = np.concatenate([_unpacked(blob) for blob in asked["n"]])
    totals = np.bincount(place, weights=n, minlength=len(names)).astype(np.int64)
    made = asked[["chunk", "single", "bucket"]].copy()
    made["totals"] = [_packed(totals[at]) for at in np.split(place, ends[:-1])]
    made["n_distinct"] = [int((totals > 0).sum()), *[0] * (len(made) - 1)]
    return made


def _traverse(total: int, distinct: int, texts: int):
    def run(chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows, answers = [], answers.sort_values("bucket")
        # a chunk is one row
        for chunk in chunks.itertuples():
            one, two, starts = _opened(chunk.words, chunk.places, chunk.lengths)

            def count(codes, single, answers=answers):
                found = np.concatenate([_unpacked(blob) for blob in answers["totals"][answers["single"] == single]])
                return found[np.unique(codes, return_inverse=True)[1]].astype(np.int64)

            c, both = count(one, True), count(two, False)
            base = (c + SMOOTH) / (total + SMOOTH * (distinct + 1))
            context = np.roll(c, 1)  # the state before each token
            context[starts[:-1]] = texts
            seen = context > 0
            arc = np.where(seen, PAIR_SHARE * both / np.maximum(context, 1), 0.0)
            failure = np.where(seen, 1 - PAIR_SHARE, 1.0)
            plain, whole = np.log10(base), np.log10(arc + failure * base)
            for doc_id, flag, low, high in zip(_unpacked(chunk.ids).view(np.int64), _unpacked(chunk.flags), starts, starts[1:], strict=False):
                flag = int(flag)
                rows.append((
                    None if flag & NO_ID else int(doc_id), bool(flag & HELD), int(high - low), int((c[low:high] > 0).sum()),
                    float(plain[low:high].sum()), float(whole[low:high].sum()),
                ))
        made = pd.DataFrame(rows, columns=[field.split()[0] for field in _SCORED.split(", ")])
        made["doc_id"] = pd.array([row[0] for row in rows], dtype="Int64")
        return made

    return run


def scored(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Interpolated, not backed off: after a word seen in training, its share of the pairs from here and the smoothed share of
    the single word are always added, 0.4 to 0.6, so each word's probabilities sum to one. The counts stay
    distributed: each chunk of documents asks for the grams it holds, as one sorted list for each bucket of codes, and gets
    their counts in the same order, so no task holds the model and no gram is a row.
    Null and empty texts are one end token; a null id is a training row; repeated rows count and are scored each; an
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out().alias("held_out"))
    made = stored(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    sums = made.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n_tokens", "n_trained", "n_texts"))).first()
    bits = max(LEAST_BITS, int(sums["n_tokens"]).bit_length() - BUCKET_BITS)
    asked = made.select("chunk", "flags", "lengths", "words", "places").mapInArrow(_asked(bits), _ASKED)
    answers = stored(asked.groupBy("bucket", "single").applyInPandas(_answers, _ANSWER), "answers")
    distinct = answers.where("single").agg(F.sum("n_distinct")).first()[0] or 0
    traverse = _traverse(sums["n_trained"], distinct, sums["n_texts"])
    answers = answers.select(F.col("chunk").alias("of"), "single", "bucket", "totals")
    result = made.groupBy("chunk").cogroup(answers.groupBy("of")).applyInPandas(traverse, _SCORED)
    return result.withColumn("train_tokens", F.lit(sums["n_trained"]).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_backoff_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
