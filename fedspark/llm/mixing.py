"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, apart, materialize, together

#: Bins of rounding keys in a class of sizes.
_BINS = 64


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_targets(totals: Sequence[int], weights: Sequence[float], cap: float = 3.0) -> list[float]:
    """Shares the sum of totals by weight; what exceeds cap times a total goes to the others by weight."""
    whole, targets, open_ = float(sum(totals)), [0.0] * len(totals), set(range(len(totals)))
    left = whole
    while open_:
        weight = sum(weights[k] for k in open_)
        full = [k for k in open_ if left * weights[k] / weight > cap * totals[k]]
        if not full:
            for k in open_:
                targets[k] = left * weights[k] / weight
            break
        for k in full:
            targets[k] = cap * totals[k]
            open_.discard(k)
        left = max(0.0, whole - sum(targets[k] for k in range(len(totals)) if k not in open_))
    return targets


@dataclass
class Source:
    name: str | None
    total: int
    mean: float
    target: float
    low: float = -1e4
    high: float = 1e4
    tilt: float = 0.0


def _rate(size: Column, mean: Column, tilt: Column, cap: float) -> Column:
    """exp(tilt * size / mean), at most cap: among all rates with the same sum of tokens the one of least
    relative entropy to one copy of each document."""
    power = F.least(tilt * size / mean, F.lit(math.log(cap)))
    return F.when(power >= math.log(cap), F.lit(float(cap))).otherwise(F.exp(power))


def _frame(spark, columns: dict) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


def _per_source(spark, sources: list[Source]) -> DataFrame:
    return _frame(spark, {"__source": pa.array([s.name for s in sources], pa.string()), "__mean": pa.array([s.mean for s in sources], pa.float64()), "__tilt": pa.array([s.tilt for s in sources], pa.float64())})


def _solve(sizes: DataFrame, sources: list[Source], cap: float, rounds: int) -> None:
    """Newton's method on the convex dual of all sources at once. Each round is one aggregation over the
    counts of (source, size); its sums are decimal, so that they don't depend on the order of rows. A
    step that leaves the bracket of the root is replaced by the bracket's middle."""
    spark = sizes.sparkSession
    for s in sources:
        if s.target >= cap * s.total:
            s.tilt = s.low = s.high = 1e4
    exact = "decimal(38,6)"
    for _ in range(rounds):
        todo = [s for s in sources if s.high - s.low > 1e-12 and s.total]
        if not todo:
            break
        t = sizes.join(_per_source(spark, todo), F.col("source").eqNullSafe(F.col("__source")))
        rate = _rate(F.col("size"), F.col("__mean"), F.col("__tilt"), cap)
        words = (F.col("n") * F.col("size") * rate).cast(exact)
        slope = F.when(rate < cap, F.col("n") * F.col("size") * F.col("size") / F.col("__mean") * rate).otherwise(0.0).cast(exact)
        got = {r["source"]: (float(r["words"]), float(r["slope"])) for r in t.groupBy("source").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope")).collect()}
        for s in todo:
            words_now, slope_now = got[s.name]
            gap = words_now - s.target
            if abs(gap) <= 1e-7 * max(1.0, s.target):
                s.low = s.high = s.tilt
                continue
            s.low, s.high = (s.low, s.tilt) if gap > 0 else (s.tilt, s.high)
            step = s.tilt - gap / slope_now if slope_now > 0 else math.inf
            s.tilt = step if s.low < step < s.high else (s.low + s.high) / 2
    for s in sources:
        s.tilt = float(f"{s.tilt:.9g}")  # far above what the last round leaves open, so reruns agree


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, doc_id: str = "doc_id", text: str = "text", source: str = "source", rounds: int = 60) -> DataFrame:
    """docs with columns __size, __source_size, __target, __rate, __copies.

    Sources in order of code points, null last, weigh what weights says, repeating, and share all words
    of docs; a target stops at cap times its source's words. Rates solve the entropy balance; each is
    rounded down or up by a hash of the id and of the text's length. From the largest sizes (by powers of
    two) to the smallest, the cut between down and up is set so that what the larger sizes left over is
    made up for by the smaller. The driver holds a few numbers a source, and sums of 64 bins for each
    source and power of two; the number of sources is the only thing they grow with. Null texts and
    texts without a word have size 0 and rate 1; rows that repeat are rounded alike. Columns of docs with
    the names of the added ones are replaced; an empty table gives no rows.
    """
    spark, names = docs.sparkSession, docs.columns
    docs, (doc_id, text, source) = apart(docs, doc_id, text, source)
    sized = docs.select(F.col(source).cast("string").alias("source"), F.col(doc_id).cast("string").alias("id"), n_words(F.col(text)).alias("size"))
    sized = materialize(sized.select("source", "size", _draw(F.col("id"), F.col("size")).alias("draw")))
    sizes = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("total"), F.sum("n").alias("n")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = shared_targets([r["total"] for r in totals], [weights[k % len(weights)] for k in range(len(totals))], cap)
    sources = [Source(r["source"], r["total"], r["total"] / r["n"] or 1.0, t) for r, t in zip(totals, targets)]
    _solve(sizes, sources, cap, rounds)
    params = _per_source(spark, sources)
    rate = _rate(F.col("size"), F.col("__mean"), F.col("__tilt"), cap)
    one = sized.where("size > 0").join(params, F.col("source").eqNullSafe(F.col("__source"))).select("source", "size", rate.alias("rate"), "draw")
    one = one.select("source", "size", _class(F.col("size")).alias("class"), "rate", F.when(F.col("rate") < cap, _bin(F.col("draw"), F.col("rate"))).alias("bin"))
    sums = one.groupBy("source", "class", "bin").agg(F.sum(F.floor("rate") * F.col("size")).alias("down"), F.sum("size").alias("words"), F.sum((F.col("rate") * F.col("size")).cast("decimal(38,6)")).alias("wanted"))
    cuts = _cuts(sums.collect(), sources)
    last = _frame(spark, {
        "__source": pa.array([s.name for s in sources for _ in range(64)], pa.string()), "__class": pa.array([c for _ in sources for c in range(64)], pa.int32()),
        "__cut": pa.array([cuts.get((s.name, c), -1) for s in sources for c in range(64)], pa.int32()),
        "__mean": pa.array([s.mean for s in sources for _ in range(64)], pa.float64()), "__tilt": pa.array([s.tilt for s in sources for _ in range(64)], pa.float64()),
        "__source_size": pa.array([s.total for s in sources for _ in range(64)], pa.int64()), "__target": pa.array([s.target for s in sources for _ in range(64)], pa.float64()),
    })
    whole = docs.withColumns({"__size": n_words(F.col(text)), "__key": F.col(source).cast("string")})
    whole = whole.withColumns({"__of": _class(F.col("__size")), "__draw": _draw(F.col(doc_id).cast("string"), F.col("__size"))})
    out = whole.join(last, F.col("__key").eqNullSafe(F.col("__source")) & (F.col("__of") == F.col("__class")))
    rate = F.when(F.col("__size") > 0, _rate(F.col("__size"), F.col("__mean"), F.col("__tilt"), cap)).otherwise(1.0)
    out = out.withColumn("__rate", rate)
    up = (F.col("__rate") < cap) & (F.col("__size") > 0) & (_bin(F.col("__draw"), F.col("__rate")) <= F.col("__cut"))
    out = out.withColumn("__copies", (F.floor("__rate") + up.cast("long")).cast("long"))
    return together(out, names, "__size", "__source_size", "__target", "__rate", "__copies")


def _class(size: Column) -> Column:
    """Power of two of a size: the number of its binary digits."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("int")


def _draw(doc: Column, size: Column) -> Column:
    """A number from 0 to 1 that belongs to the document."""
    return F.pmod(F.xxhash64(doc, size), F.lit(1 << 40)) / float(1 << 40)


def _bin(draw: Column, rate: Column) -> Column:
    """0 to 2 * _BINS - 1: documents of small bins are the first to be rounded up. Half of the bins, those
    below _BINS, are rounded up when nothing is to be made up for."""
    return F.floor((draw - (rate - F.floor(rate)) + 1) * _BINS).cast("int")


def _cuts(rows, sources: list[Source]) -> dict:
    """Last bin to be rounded up, for each source and class."""
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], {}).setdefault(r["class"], []).append(r)
    cuts = {}
    for s in sources:
        left = 0.0
        for c in sorted(by.get(s.name, {}), reverse=True):
            group = by[s.name][c]
            want = left + float(sum(r["wanted"] for r in group)) - sum(r["down"] for r in group)
            best, cut, got = abs(want), -1, 0
            for r in sorted((r for r in group if r["bin"] is not None), key=lambda r: r["bin"]):
                got += r["words"]
                if abs(want - got) < best:
                    best, cut = abs(want - got), r["bin"]
            taken = sum(r["words"] for r in group if r["bin"] is not None and r["bin"] <= cut)
            cuts[s.name, c], left = cut, want - taken
    return cuts


def repeat(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: each document as often as it has copies, with the columns of docs."""
    plain, (a, b, c) = apart(docs, doc_id, text, source)
    rows = mix(plain, doc_id=a, text=b, source=c, **options).where("__copies > 0")
    return together(rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))), docs.columns)
