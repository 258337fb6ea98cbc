"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import run_dir
from freshet.streaming.shared_files import SharedFiles

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words as most contracts have them: everything between blanks and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
_LOWER = str.maketrans(UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str) -> str:
    return text.translate(_LOWER)


#: Tables of ``stored`` that are still there, for ``free_all``.
_OPEN: list[DataFrame] = []


def stored(df: DataFrame, name: str, row_group_mb: int | None = None) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it back: lineage ends here.

    A lost executor then costs a rerun of one read, and readers of one run
    all see the same rows. Small row groups let several tasks read one file.
    """
    path = run_dir(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    if row_group_mb:
        out = out.option("parquet.block.size", row_group_mb << 20)
    out.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.stored_at = path
    _OPEN.append(made)
    return made


def free(*tables: DataFrame) -> None:
    """Removes tables of ``stored`` that nothing reads any more: what was made from them must be stored itself."""
    for made in tables:
        SharedFiles(made.sparkSession).remove(made.stored_at)
        _OPEN[:] = [other for other in _OPEN if other is not made]


def free_all(spark: SparkSession) -> None:
    """Removes what earlier steps of this session have stored; only for a caller whose input stands by itself."""
    own = [made for made in _OPEN if made.sparkSession is spark or made.sparkSession.sparkContext is spark.sparkContext]
    free(*own)
