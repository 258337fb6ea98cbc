"""Best-two-fit packing of token pieces into sequences of bounded length."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.common import stored, table

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048

_PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: ASCII marks but the apostrophe.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


class _Runs:
    """Runs of ids in one growing array, by number."""

    def __init__(self):
        self.ids, self.begins, self.used, self.count = np.zeros(1 << 16, dtype=np.uint32), np.zeros(1 << 14, dtype=np.int64), 0, 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """More runs, given in a row with their lengths."""
        used, count = self.used + len(ids), self.count + len(lengths)
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * used - self.used, dtype=np.uint32)])
        if count >= len(self.begins):
            self.begins = np.concatenate([self.begins[: self.count + 1], np.zeros(2 * count - self.count, dtype=np.int64)])
        self.ids[self.used : used] = ids
        self.begins[self.count + 1 : count + 1] = self.used + np.cumsum(lengths)
        self.used, self.count = used, count

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs in a row, and their lengths."""
        begins = self.begins[numbers]
        lengths = self.begins[numbers + 1] - begins
        before = np.cumsum(lengths) - lengths
        return self.ids[np.repeat(begins - before, lengths) + np.arange(lengths.sum())], lengths


class WordEncoder:
    """Ids of many texts at once, from a bounded memory of the parts of words.

    The tokenizer drops white space, lower-cases, and merges neither across white space nor between a run of letters
    and the marks behind it. So a text's ids are those of its words in a row, and a word's those of its letters and
    of its marks; apostrophes, which bind some letters, and all but ASCII words, whose lower case may bring marks with
    it, stay whole. A batch is split, its distinct words are found and its ids put in a row by array kernels.
    """

    #: Stands between parts that are encoded together, as a pre-token and an id of its own.
    BETWEEN = "|"

    def __init__(self, path: str, remembered: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core's work, and each thread would keep memory of its own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self.tokenizer.encode(self.BETWEEN, add_special_tokens=False).ids
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.parts = pa.array([""], pa.large_string())
        self.pieces = _Runs()
        self.pieces.add(np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))

    def _numbers(self, names: pa.Array) -> np.ndarray:
        """The numbers of parts; new ones are encoded, a thousand in one text."""
        found = pc.index_in(names, value_set=self.parts)
        if found.null_count:
            missing = found.is_null()
            unknown = names.filter(missing)
            fresh = pc.unique(unknown)
            odd = pc.match_substring(fresh, self.BETWEEN)
            fresh = pa.concat_arrays([fresh.filter(pc.invert(odd)), fresh.filter(odd)])
            self._learn(fresh.to_pylist(), len(fresh) - pc.sum(odd).as_py())
            numbers = pc.add(pc.index_in(unknown, value_set=fresh), pa.scalar(len(self.parts), pa.int32()))
            self.parts = pa.concat_arrays([self.parts, fresh])
            found = pc.replace_with_mask(found, missing, numbers)
        return found.to_numpy()

    def _learn(self, fresh: list[str], plain: int) -> None:
        """Ids of new parts; the first ``plain`` of them do not hold what stands between."""
        between = f" {self.BETWEEN} "
        texts = [between.join(fresh[k : min(k + 1000, plain)]) + between for k in range(0, plain, 1000)]
        made = [np.array(code.ids, dtype=np.uint32) for code in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, dtype=np.uint32), *made])
        stops = np.flatnonzero(ids == self.between)
        self.pieces.add(np.delete(ids, stops), np.diff(stops, prepend=-1) - 1)
        for part in fresh[plain:]:
            own = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype=np.uint32)
            self.pieces.add(own, np.array([len(own)]))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and the last end); null counts as empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        flat = pc.list_flatten(words)
        coded = pc.if_else(pc.string_is_ascii(flat), pc.ascii_lower(flat), flat).dictionary_encode()
        whole = coded.dictionary
        letters = pc.ascii_rtrim(whole, characters=_MARKS)
        parted = pc.and_(pc.ascii_is_alpha(letters), pc.string_is_ascii(whole))
        heads = pc.if_else(parted, letters, whole)
        tails = pc.if_else(parted, pc.ascii_ltrim(whole, characters=_LETTERS), "").dictionary_encode()
        if len(self.parts) + len(heads) > self.remembered:
            self._forget()
        numbers = self._numbers(pa.concat_arrays([heads, tails.dictionary]))
        pairs = np.empty((len(whole), 2), dtype=np.int64)
        pairs[:, 0] = numbers[: len(heads)]
        pairs[:, 1] = numbers[len(heads) :][tails.indices.to_numpy()]
        ids, lengths = self.pieces.take(pairs[coded.indices.to_numpy()].ravel())
        ends = np.concatenate([[0], np.cumsum(lengths)])
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return ids, ends[2 * borders]

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text]))[0].astype("<u4").tobytes()


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, together: int = 4 << 20) -> DataFrame:
    """One row per piece of a document: its ids and a closing 0, cut every ``capacity`` ids.

    A null or empty text is the closing 0 alone. Repeated rows are repeated documents. Texts are encoded ``together``
    bytes at a time, a longer one by itself.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)

    def cut(batches):
        encoder = WordEncoder(path)
        for batch in batches:
            texts = batch.column("text")
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < len(batch):
                done = size[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(size, done + together, side="right")))
                yield made(encoder, batch.slice(first, last - first))
                pa.default_memory_pool().release_unused()
                first = last

    def made(encoder, some):
        ids, borders = encoder.batch(some.column("text"))
        rows = []
        for k in range(len(some)):
            own = np.append(ids[borders[k] : borders[k + 1]], 0).astype("<u4")
            for piece, start in enumerate(range(0, len(own), capacity)):
                part = own[start : start + capacity]
                rows.append((k, piece, start, len(part), zlib.crc32(part)))
        k, *rest = zip(*rows, strict=True)
        columns = [some.column("doc_id").take(pa.array(k)), *[pa.array(c, t) for c, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]]
        return pa.RecordBatch.from_arrays(columns, names=_PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, _PIECES)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many such bins) for ``counts`` pieces of each length.

    A bin takes the longest piece left and then the longest that fits, again and again. Then its smallest piece
    gives way to two unpacked ones if they fill the widened gap better. The same bin is made as often as the
    counts allow, so the work depends on the number of lengths, not of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    bins: list[tuple[list[int], int]] = []

    def longest(most: int, free) -> int | None:
        k = bisect_right(lengths, most) - 1
        while k >= 0 and free(lengths[k]) <= 0:
            k -= 1
        return lengths[k] if k >= 0 else None

    while lengths:
        used: dict[int, int] = {}
        free = lambda n: left[n] - used.get(n, 0)
        packed: list[int] = []
        gap = capacity
        while gap and (nxt := longest(gap, free)) is not None:
            take = min(gap // nxt, free(nxt))
            packed += [nxt] * take
            used[nxt] = used.get(nxt, 0) + take
            gap -= nxt * take
        if gap and len(packed) > 1:
            smallest = min(packed)
            wide = gap + smallest
            best, pair = smallest, None
            for k in range(bisect_right(lengths, wide) - 1, -1, -1):
                first = lengths[k]
                if 2 * first <= best:
                    break
                if free(first) <= 0:
                    continue
                second = longest(min(first, wide - first), lambda n, f=first: free(n) - (n == f))
                if second is not None and first + second > best:
                    best, pair = first + second, (first, second)
                    if best == wide:
                        break
            if pair:
                packed.remove(smallest)
                used[smallest] -= 1
                for n in pair:
                    packed.append(n)
                    used[n] = used.get(n, 0) + 1
        times = min(left[n] // k for n, k in used.items() if k)
        bins.append((packed, times))
        for n, k in used.items():
            left[n] -= k * times
        lengths = [n for n in lengths if left[n] > 0]
    return bins


def slots(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of each run of equal places."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for packed, times in bins:
        offset = 0
        for length in packed:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + times
            offset += length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*runs, strict=True)) for length, runs in found.items()}


def ranked(made: DataFrame, per_chunk: int = 50_000) -> DataFrame:
    """``made`` with ``rank``, 0 and up within each length; a common length is numbered in chunks.

    ``made`` must be stored: its rows are read twice.
    """
    total = made.count()
    chunk = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1 + total // per_chunk))
    cut = made.withColumn("chunk", chunk)
    sums = cut.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sums.select("length", "chunk", F.coalesce(upto, F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "start", "ids_crc32"))
    return (
        cut.withColumn("k", within)
        .join(firsts, ["length", "chunk"])
        .withColumn("rank", F.col("first") + F.col("k") - 1)
        .drop("chunk", "k", "first")
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; see ``pieces`` for what a piece is.

    Only the counts of each length reach the driver, at most ``capacity`` rows. An empty table gives no rows.
    """
    made = stored(pieces(docs, path, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(best_two_fit(counts, capacity))
    schema = T.StructType([*_PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            sequence = np.zeros(len(batch), dtype=np.int64)
            offset = np.zeros(len(batch), dtype=np.int64)
            rank, lengths = (batch.column(name).to_numpy() for name in ("rank", "length"))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                first, begin, at = places[length]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = begin[k] + rank[rows] - first[k]
                offset[rows] = at[k]
            columns = [batch.column(name) for name in _PIECES.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked(made).select(*_PIECES.names, "rank").mapInArrow(place, schema)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
