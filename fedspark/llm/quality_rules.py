"""Quality rules whose cutoffs carry a guarantee: exact binomial tests on labelled documents choose, for
each stratum, the strictest cutoffs that reject at most a given share of good documents."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ready_for_python

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """A document fails if score > cutoff. grid: a cutoff for each level, from lenient to strict, fixed
    before any label is seen."""

    name: str
    score: str
    grid: tuple[float, ...]


#: Scores are SQL over the features; each is 0 or more, larger is worse. Grids have one length.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", (2.0, 1.0, 0.5, 0.35, 0.25, 0.2)),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.55, 0.5)),
    Rule("capitals", "n_upper / greatest(word_chars, 1)", (0.9, 0.7, 0.5, 0.4, 0.35, 0.3)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (40.0, 25.0, 18.0, 16.0, 14.0, 12.0)),
)


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of width words that the text has twice or more, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    # equal windows have equal sums, so without equal sums nothing repeats
    sums = sum(ids[k : k + n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * 0x5851F42D4C957F2D * k & (1 << 64) - 1) for k in range(width))
    ordered = np.sort(sums)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(sums, twice))
    windows = ids[at[:, None] + np.arange(width)]
    _, which, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    hit = at[counts[which.reshape(-1)] > 1]
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + width, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def text_features(text: str) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word), n_upper."""
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    upper = len(text) - len(text.translate(_NO_UPPER))
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), dup, repeated_words(words), lines, upper


#: Drops A to Z.
_NO_UPPER = {c: None for c in range(ord("A"), ord("Z") + 1)}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the features of each whole text; a null text has none of anything."""
    ready_for_python(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            found = [text_features(x.as_py() or "") for x in batch.column(2)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "stratum", *FEATURES])

    return rows.mapInArrow(run, f"doc_id {kind}, stratum string, " + ", ".join(f"{f} long" for f in FEATURES))


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial of n draws at p: the exact p-value of "the true rate is p or more" after k
    rejections in n."""
    if p <= 0 or k >= n:
        return 1.0
    base = math.lgamma(n + 1)
    terms = [base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * sum(math.exp(t - top) for t in terms))


def upper_bound(k: int, n: int, level: float) -> float:
    """Upper end of the exact one-sided interval of a rate, by bisection of its tail."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(k, n, mid) > level else (low, mid)
    return high


def choose_levels(counts: dict[str | None, tuple[int, list[int]]], risk: float, level: float) -> dict[str | None, dict]:
    """counts: by stratum the number of good holdouts, and how many of them each level of the grids rejects
    by any rule. Levels are tested from lenient to strict and the first that fails ends the sequence, so
    that within a sequence no correction is due; between strata level is split evenly (Bonferroni). With
    probability 1 - level no stratum loses more than risk of its good documents. Where no level
    passes, as with few labels, no rule rejects. bound: what the test proves of the chosen level."""
    alpha, out = level / max(1, len(counts)), {}
    for stratum, (n, rejected) in counts.items():
        out[stratum] = {"level": None, "good": n, "rejected": None, "bound": None}
        for k, hits in enumerate(rejected):
            if n == 0 or tail(hits, n, risk) > alpha:
                break
            out[stratum] = {"level": k, "good": n, "rejected": hits, "bound": upper_bound(hits, n, alpha)}
    return out


def _fails(rules: Sequence[Rule], k: int) -> Column:
    bad = F.lit(False)
    for r in rules:
        bad = bad | (F.expr(r.score) > F.lit(r.grid[k]))
    return bad


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def select_levels(rows: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, risk: float = 0.03, level: float = 0.05) -> dict[str | None, dict]:
    """Levels for the strata of rows (features) from labels: doc_id, good (0 or 1). Null ids and labels are
    ignored, and a document counts as good only if all its labels say so. The holdout is every labelled
    good document that passes the base; one aggregation counts it and gives a row a stratum."""
    good = labels.select(F.col("doc_id").alias("__id"), F.col("good").alias("good")).dropna().groupBy("__id").agg(F.min("good").alias("good")).where("good = 1")
    held = rows.where(~_base_failed()).join(good, F.col("doc_id") == F.col("__id"), "left_semi")
    levels = range(min(len(r.grid) for r in rules))
    found = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *(F.sum(_fails(rules, k).cast("long")).alias(f"k{k}") for k in levels)).collect()
    return choose_levels({r["stratum"]: (r["n"], [r[f"k{k}"] for k in levels]) for r in found}, risk, level)


def filter_by_rules(docs: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, risk: float = 0.03, level: float = 0.05, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for each row.

    base_failed: under 10 words, or over a fifth of the words in repeated windows. kept: not base_failed
    and under every cutoff of the row's stratum. A stratum (null is one) without enough labelled good
    documents has no cutoffs. Repeated rows come out repeated; without labels only the base decides.
    """
    rows = materialize(features(docs, doc_id, text, stratum))
    fails = F.lit(False)
    for name, chosen in select_levels(rows, labels, rules, risk, level).items():
        if chosen["level"] is not None:
            fails = F.when(F.col("stratum").eqNullSafe(F.lit(name)), _fails(rules, chosen["level"])).otherwise(fails)
    return rows.select("doc_id", *FEATURES[:5], _base_failed().alias("base_failed"), (~_base_failed() & ~fails).alias("kept"), "n_lines", "n_upper", "stratum")
