"""Search-phrase tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Runs of ASCII letters and digits, or one CJK character.
TOKEN_PATTERN = "[a-z0-9]+|[\\u4e00-\\u9fff]"


def tokens(text: Column | str, segment: Callable[[Column], Column] | None = None) -> Column:
    """Distinct tokens of a phrase; null text has none.

    ``segment`` replaces the built-in splitting, for example by
    ``dictionary_segmenter``.
    """
    text = F.col(text) if isinstance(text, str) else text
    if segment is not None:
        return F.array_distinct(segment(text))
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.array_distinct(found)


def dictionary_segmenter(words: Iterable[str]) -> Callable[[Column], Column]:
    """A segmenter that joins CJK characters into the longest listed word."""
    known = frozenset(word.lower() for word in words)
    longest = max((len(word) for word in known), default=1)

    @F.pandas_udf("array<string>")
    def segment(texts: pd.Series) -> pd.Series:
        import re

        pieces = re.compile("[a-z0-9]+|[一-鿿]+")

        def cut(run: str) -> list[str]:
            if run[0] < "一":
                return [run]
            out, at = [], 0
            while at < len(run):
                size = next(
                    (n for n in range(min(longest, len(run) - at), 1, -1)
                     if run[at:at + n] in known),
                    1,
                )
                out.append(run[at:at + size])
                at += size
            return out

        def split(text):
            if text is None:
                return None
            return [word for run in pieces.findall(text.lower()) for word in cut(run)]

        return texts.map(split)

    return segment


def register_kw_split(spark: SparkSession, name: str = "kw_split") -> None:
    """Table function for SQL: ``SELECT ... FROM t, LATERAL kw_split(t.phrase)``."""
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING)
        RETURNS TABLE (keyword STRING)
        RETURN SELECT explode(
            array_distinct(regexp_extract_all(lower(phrase), '{pattern}', 0)))
        """
    )
