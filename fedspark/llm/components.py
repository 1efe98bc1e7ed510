"""Connected components of a graph given by its links, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Links up to which one task does a round (about 3 MB).
_FEW = 200_000
#: Steps along the hooks in one pass.
_STEPS = 3


def _joined(left: DataFrame, right: DataFrame, on, near) -> DataFrame:
    """left with what right has for it; in one partition by hash, which then needs no shuffle."""
    return near(left).join(near(right).hint("shuffle_hash") if near is _one else right, on, "left")


def _one(df: DataFrame) -> DataFrame:
    return df.coalesce(1)


def _chased(hooks: DataFrame, kept: Scratch, near) -> DataFrame:
    """node, to, moved: every node of a forest (node, to) with the root of its tree. Each pass follows the
    hooks _STEPS times, by doubling, so paths shrink to their eighth."""
    now, left = hooks, 1
    while left:
        then = now.select("node", "to")
        for _ in range(_STEPS):
            ahead = then.select(F.col("node").alias("mid"), F.col("to").alias("far"))
            then = _joined(then, ahead, F.col("to") == F.col("mid"), near).select("node", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved"))
        then, seen = kept.counted(near(then), moved=F.sum(F.col("moved").cast("long")))
        kept.drop(now)
        now, left = then, seen["moved"]
    return now


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node of a link; root is the smallest node that links reach.

    Each round hooks every node to its smallest smaller neighbour, follows the hooks to the end of each
    path by doubling, and puts these ends in place of the nodes of all links; links within a node go. A
    round at least halves the nodes that still have links, so the rounds are logarithmic in the number of
    nodes, and the passes of a round in the length of a path, whatever the graph; there is no limit of
    rounds. Each table is written to the shared folder and deleted once nothing reads it any more. A
    hub's minimum is combined before the shuffle. Nulls and self links are ignored, repeated links count
    once; no links give an empty result.
    """
    kept = Scratch(links.sparkSession)
    first = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    first, seen = kept.counted(first.where("hi <> lo").distinct())
    # few links are no work for many tasks: in one partition no step needs a shuffle
    near = _one if seen["n"] <= _FEW else (lambda df: df)
    live, left, maps = first, seen["n"], []
    while left:
        hooks = near(live).groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("to"))
        maps.append(_chased(hooks if near is _one else kept.keep(hooks), kept, near))
        x, y = (maps[-1].select(F.col("node").alias(n), F.col("to").alias(t)) for n, t in (("x", "p"), ("y", "q")))
        moved = _joined(_joined(live, x, F.col("hi") == F.col("x"), near), y, F.col("lo") == F.col("y"), near).select("p", F.coalesce("q", "lo").alias("q"))
        then, seen = kept.counted(near(moved.where("p <> q").select(F.greatest("p", "q").alias("hi"), F.least("p", "q").alias("lo")).distinct()))
        if live is not first:
            kept.drop(live)
        live, left = then, seen["n"]

    def further(roots: DataFrame, step: DataFrame) -> DataFrame:
        step = step.select(F.col("node").alias("x"), "to")
        return _joined(roots, step, F.col("root") == F.col("x"), near).select("node", F.coalesce("to", "root").alias("root"))

    nodes = near(first).select(F.col("hi").alias("node")).union(near(first).select("lo"))
    out = kept.keep(near(reduce(further, maps, near(nodes).distinct().select("node", F.col("node").alias("root")))))
    kept.clear(out)
    return out


def merged_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after more links (a, b): only what the links join is worked on."""
    ra = roots.select(F.col("node").alias("na"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("nb"), F.col("root").alias("rb"))
    ends = links.join(ra, F.col("a") == F.col("na"), "left").join(rb, F.col("b") == F.col("nb"), "left")
    moves = connected_components(ends.select(F.coalesce("ra", "a").alias("p"), F.coalesce("rb", "b").alias("q")), "p", "q").select(F.col("node").alias("was"), F.col("root").alias("now"))
    every = roots.union(links.select("a", "a")).union(links.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))
    return every.join(moves, F.col("root") == F.col("was"), "left").select("node", F.coalesce("now", "root").alias("root"))
