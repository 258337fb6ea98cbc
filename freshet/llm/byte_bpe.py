"""Byte-level BPE of whole texts by overlapping chunks, and back to bytes.

A text of more than one chunk is cut on a grid; each window reaches some way back over its left grid point and, on the
right, past the next place where a blank follows a visible character. No pre-token crosses such a place, so two scans
that began apart have met there at the latest. Windows are pre-tokenised in parallel; neighbours are stitched at the first
boundary both scans share at or behind the grid point, and the pieces between stitches are then encoded in parallel.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

RANKS = "byte_bpe_50k.tiktoken"
#: Code points between grid points, and how far a window reaches back.
CHUNK, OVERLAP = 16_384, 256
#: A boundary this far from the window's end depends on nothing behind it (the longest contraction has three characters).
SETTLED = 3
#: Longer runs of white space than this overflow the library's matcher; their text is matched by `regex` instead.
LONG_BLANK = 50_000

# White space as the pattern has it; \x1c to \x1f are not in it, though Python's \s has them.
_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SURE = re.compile(f"(?!{_BLANK})[\\s\\S](?={_BLANK})")
_LONG_BLANK = re.compile(f"{_BLANK}{{{LONG_BLANK}}}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class ByteEncoder:
    """Ids of a text and bytes of ids; one per task."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_BLANK and _LONG_BLANK.search(text):
            found = [k for m in self.pattern.finditer(text) for k in self.encoding._encode_single_piece(m[0])]
        else:
            found = self.encoding.encode_ordinary(text)
        return np.array(found, dtype="<u4")

    def text_bytes(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def grid(text: str, chunk: int = CHUNK) -> list[tuple[int, int]]:
    """(grid point, end of the window on its left) of every inner grid point.

    The window on the left ends behind the next sure place, and the next grid point is never before that place.
    """
    points, at = [], chunk
    while at < len(text):
        sure = _SURE.search(text, at - 1)
        end = min(len(text), sure.end() + SETTLED) if sure else len(text)
        points.append((at, end))
        at = max(at + chunk, end)
    return points


def windows(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, int | None]]:
    """(begin, end, where the next window begins) of each window; the last has no next."""
    points = grid(text, chunk)
    begins = [0, *[max(0, at - overlap) for at, _ in points]]
    ends = [*[end for _, end in points], len(text)]
    return list(zip(begins, ends, [*begins[1:], None], strict=True))


def stitch(pattern, window: str, next_begin: int, grid_at: int, last: bool) -> int:
    """The first settled boundary at or behind ``grid_at`` that this window's scan and the next window's share.

    All places count from this window's begin. ``last`` says that the window ends with the text.
    """
    limit = len(window) if last else len(window) - SETTLED
    mine = {m.end() for m in pattern.finditer(window) if grid_at <= m.end() <= limit}
    if next_begin in mine:
        return next_begin
    for m in pattern.finditer(window, next_begin):
        if m.end() in mine:
            return m.end()
    raise AssertionError("two scans have not met at a sure place")


_CHUNKS = "row long, doc_id long, chunk int, n_chunks int, begin long, grid_at long, next_begin long, last boolean, text string"


def chunks(docs: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The windows of each text of ``docs`` (doc_id, text), one row each; ``row`` numbers the texts."""

    def cut(batches):
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                parts = windows(text, chunk, overlap)
                points = [p for p, _ in grid(text, chunk)]
                for first in range(0, len(parts), 256):  # a very long text leaves in bounded batches
                    rows = [
                        (at, doc_id, k, len(parts), a, None if c is None else points[k] - a, None if c is None else c - a, b == len(text), text[a:b])
                        for k, (a, b, c) in enumerate(parts[first : first + 256], first)
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _CHUNK_TYPES, strict=True)], names=_CHUNK_NAMES)
                at += 1

    return docs.select("doc_id", "text").mapInArrow(cut, _CHUNKS)


_CHUNK_NAMES = [field.split()[0] for field in _CHUNKS.split(", ")]
_CHUNK_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]


def stitches(cut: DataFrame, pattern: str) -> DataFrame:
    """(row, chunk, start, stop): the piece of text, by place in the text, that each window answers for."""

    def scan(batches):
        import regex

        rule = regex.compile(pattern)
        for batch in batches:
            rows = batch.select(["row", "chunk", "begin", "grid_at", "next_begin", "last", "text"]).to_pylist()
            stops = [r["begin"] + (len(r["text"]) if r["next_begin"] is None else stitch(rule, r["text"], r["next_begin"], r["grid_at"], r["last"])) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(stops, pa.int64())], names=["row", "chunk", "stop"])

    found = cut.mapInArrow(scan, "row long, chunk int, stop long")
    order = Window.partitionBy("row").orderBy("chunk")
    return found.withColumn("start", F.coalesce(F.lag("stop").over(order), F.lit(0)).cast("long"))


def _encode_pieces(path: str, pattern: str):
    def run(batches):
        encoder = ByteEncoder(path, pattern)
        for batch in batches:
            made = []
            for start, stop, begin, text in zip(*[batch.column(c).to_pylist() for c in ("start", "stop", "begin", "text")], strict=True):
                made.append(encoder.ids(text[start - begin : stop - begin]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("chunk"), batch.column("n_chunks"), pa.array(made, pa.binary())], names=["row", "doc_id", "piece", "n_pieces", "ids"])

    return run


_PIECES = "row long, doc_id long, piece int, n_pieces int, ids binary"


def _whole(docs: DataFrame, chunk: int) -> DataFrame:
    return docs.where(F.coalesce(F.length("text"), F.lit(0)) <= chunk)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def long_pieces(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encoded pieces (row, doc_id, piece, n_pieces, ids) of the texts longer than ``chunk`` code points."""
    cut = stored(chunks(_texts(docs).where(F.length("text") > chunk), chunk, overlap), "bpe-chunks", row_group_mb=4)
    places = stored(stitches(cut, pattern), "bpe-stitches")
    return cut.join(places, ["row", "chunk"]).mapInArrow(_encode_pieces(path, pattern), _PIECES)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Ids of every text as pieces: (doc_id, row, piece, n_pieces, ids little-endian unsigned 32-bit).

    A text's ids are its pieces' in order of ``piece``; a text of at most ``chunk`` code points is one piece with a null
    ``row``. Null and empty texts are one empty piece; repeated rows are repeated texts, each with a ``row`` of its own;
    an empty table gives no rows; further columns are ignored.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches):
        encoder = ByteEncoder(path, pattern)
        for batch in batches:
            ids = [encoder.ids(text or "").tobytes() for text in batch.column("text").to_pylist()]
            n = len(batch)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), batch.column("doc_id"), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(ids, pa.binary())], names=["row", "doc_id", "piece", "n_pieces", "ids"])

    short = _whole(_texts(docs), chunk).mapInArrow(run, _PIECES)
    return short.unionByName(long_pieces(docs, path, pattern, chunk, overlap))


def decode(pieces: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``pieces`` of ``encode`` with their ``bytes``; a text's bytes are those of its pieces in a row."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches):
        encoder = ByteEncoder(path, pattern)
        for batch in batches:
            raw = [encoder.text_bytes(np.frombuffer(ids, "<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "bytes"])

    return pieces.select("row", "doc_id", "piece", "n_pieces", "ids").mapInArrow(run, f"{_PIECES}, bytes binary")


_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per text: number of ids, digest of the ids, digest of the bytes they decode to; see ``encode`` for odd rows.

    Pieces of long texts are sorted by (text, piece) and hashed as they stream by, so no task holds a text's ids.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def whole(batches):
        encoder = ByteEncoder(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder.ids(text or "")
                rows.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(encoder.text_bytes(ids)).hexdigest()))
            yield _digest_batch(rows)

    def joined(batches):
        encoder = ByteEncoder(path, pattern)
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            rows = []
            for doc_id, piece, pieces, raw in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "piece", "n_pieces", "ids")], strict=True):
                ids = np.frombuffer(raw, "<u4")
                of_ids.update(raw)
                of_bytes.update(encoder.text_bytes(ids))
                n += len(ids)
                if piece == pieces - 1:
                    rows.append((doc_id, n, of_ids.hexdigest(), of_bytes.hexdigest()))
                    n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
            yield _digest_batch(rows)

    pieces = long_pieces(docs, path, pattern, chunk, overlap).repartition("row").sortWithinPartitions("row", "piece")
    return _whole(_texts(docs), chunk).mapInArrow(whole, _DIGEST).unionByName(pieces.mapInArrow(joined, _DIGEST))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
