"""Quality rules: decision lists learned from labelled statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

# The ASCII blanks that part words, the characters that count as symbols.
BLANKS = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

_TO_BLANK = str.maketrans(dict.fromkeys(BLANKS, " "))
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_digits", "n_marks", "n_lines", "n_distinct"]
#: Ratios the rules may test; each is count / count, or a plain count where the second is None.
FEATURES: dict[str, tuple[str, str | None]] = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_lines_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "n_words": ("n_words", None),
}


def _words(text: str) -> list[str]:
    return [w for w in text.translate(_TO_BLANK).split(" ") if w]


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words inside a window of ``width`` words that the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    kind = ids[:n]
    for k in range(1, width):  # pairs of (window so far, next word), renumbered: exact, and never overflows
        kind = np.unique(kind * len(known) + ids[k : k + n], return_inverse=True)[1]
    often = np.bincount(kind)[kind] > 1
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    marks[:n] += often
    marks[width : width + n] -= often
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def statistics(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = _words(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.translate(_TO_BLANK).strip(" "):
            lines += 1
            dup += line in seen
            seen.add(line)
    joined = "".join(words)
    return (
        len(words),
        len(joined),
        sum(map(text.count, SYMBOLS)),
        dup,
        repeated_words(words),
        len(text),
        sum(map(str.isupper, joined)),
        sum(map(str.isdigit, joined)),
        joined.count("!") + joined.count("?"),
        lines,
        len(set(words)),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``stats``; a null text counts as empty."""

    def count(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in column], columns=_COUNTS, dtype="int64")

    kind = ", ".join(f"{name} long" for name in _COUNTS)
    return docs.withColumn("stats", F.pandas_udf(count, kind)(F.col(text)))


def base_failed(stats: str = "stats") -> Column:
    words, repeat = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 10) | (100 * repeat > 20 * words)


def feature(name: str, stats: str = "stats") -> Column:
    over, under = FEATURES[name]
    value = F.col(f"{stats}.{over}").cast("double")
    return value if under is None else value / F.greatest(F.col(f"{stats}.{under}"), F.lit(1))


Rule = list[tuple[str, str, float]]


def _holds(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for name, sign, limit in rule:
        out &= x[name] >= limit if sign == ">=" else x[name] <= limit
    return out


def _grown(x: dict[str, np.ndarray], y: np.ndarray, most_terms: int, steps: int) -> Rule:
    """Adds the test with the best information gain until only bad rows are covered."""
    rule: Rule = []
    cover = np.ones(len(y), dtype=bool)
    while len(rule) < most_terms and (y[cover] == 0).any():
        p, n = y[cover].sum(), (~y[cover].astype(bool)).sum()
        base, best = np.log2(p / (p + n)), (1e-9, None, None)
        for name, values in x.items():
            here = values[cover]
            for limit in np.unique(np.quantile(here, np.linspace(0, 1, steps))):
                for sign in (">=", "<="):
                    hit = here >= limit if sign == ">=" else here <= limit
                    good = y[cover][hit].sum()
                    if good:
                        gain = good * (np.log2(good / hit.sum()) - base)
                        if gain > best[0]:
                            best = (gain, (name, sign, float(limit)), hit)
        if best[1] is None:
            break
        rule.append(best[1])
        cover[np.flatnonzero(cover)] = best[2]
    return rule


def learn(stats: pd.DataFrame, bad: np.ndarray, precision: float = 0.95, most_rules: int = 12, most_terms: int = 4, steps: int = 64) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune its tail on the rest, drop what it covers.

    Stops when a pruned rule is right for fewer than ``precision`` of the held-back rows it covers. Labelled rows of one
    class only, or none, give no rules.
    """
    x = {name: stats[over].to_numpy(float) / (1 if under is None else np.maximum(stats[under].to_numpy(float), 1)) for name, (over, under) in FEATURES.items()}
    third = np.arange(len(bad)) % 3 == 2
    rest, rules = np.ones(len(bad), dtype=bool), []
    for _ in range(most_rules):
        grow, prune = rest & ~third, rest & third
        if not bad[grow].any() or not bad[prune].any():
            break
        rule = _grown({k: v[grow] for k, v in x.items()}, bad[grow].astype(int), most_terms, steps)
        held, y = {k: v[prune] for k, v in x.items()}, bad[prune]

        def worth(r: Rule, held=held, y=y) -> float:
            hit = _holds(r, held, len(y))
            return (y[hit].sum() - (~y[hit]).sum()) / max(1, hit.sum())

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _holds(rule, held, len(y))
        if not rule or hit.sum() < 3 or y[hit].mean() < precision:
            break
        rules.append(rule)
        rest &= ~_holds(rule, x, len(bad))
    return rules


def rule_number(rules: list[Rule], stats: str = "stats") -> Column:
    """The number of the first rule that fits, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        test = F.lit(True)
        for name, sign, limit in rule:
            test &= feature(name, stats) >= limit if sign == ">=" else feature(name, stats) <= limit
        out = F.when(test, number).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000, carry_text: bool = False) -> DataFrame:
    """``docs``, without their text unless ``carry_text``, with ``stats``, ``base_failed``, ``rule`` and ``kept``.

    Rules are fitted on at most ``sample`` labelled documents (those least by hash of their id; the documented bound of
    the fit); statistics, base tests and rules then cover every row. Rows that fail the base tests take no part in the fit.
    Null texts count as empty and so fail; null qualities are no labels; repeated rows are judged alike; with no labels, ``kept`` is the base verdict.
    """
    made = ["stats", "base_failed", "rule", "kept", *([] if carry_text else ["text"])]
    columns = [c for c in docs.columns if c not in made]
    seen = stored(with_statistics(docs).select(*columns, "stats"), "statistics")
    marks = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = (
        seen.where(~base_failed())
        .select("doc_id", "stats.*")
        .join(marks, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .toPandas()
    )
    rules = learn(known[_COUNTS], (known["quality"] == 0).to_numpy()) if len(known) else []
    failed = seen.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
    return failed.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", *(f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", "kept", "rule"
    )
