"""Embedding near-dedup by sorted projection passes.

Each pass hashes every vector by the signs of its own random projections and orders the vectors of one
label lexicographically by those bits. Neighbours that share the leading bits form a window; all
pairs of a window are verified by cosine. Windows are cut in parts of bounded size, and the parts of
one long window are compared part against part, so a window has no cap. A pair is counted in the
first pass that brings it together, which both vectors' leading bits of all passes tell, so no list
of pairs is kept: what leaves a task is a count for each vector and a forest of links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, materialize, ready_for_python
from .components import connected_components
from .runs import sorted_runs

#: Rows of a window that are compared at once.
_PART = 4096
#: Windows up to this length are compared in vector operations over many windows.
_SHORT = 16
_BITS = 64
_planes_of: dict[tuple, np.ndarray] = {}


def _planes(dim: int, passes: int, seed: int) -> np.ndarray:
    """One random direction for each bit of each pass."""
    key = (dim, passes, seed)
    if key not in _planes_of:
        _planes_of[key] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * _BITS))
    return _planes_of[key]


def _packed(rows: DataFrame, kind: str) -> DataFrame:
    """vec_id, label, vec: the vector's doubles as bytes, null if it links with nothing."""

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(2):
                v = None if not x.is_valid or x.values.null_count else np.asarray(x.values, np.float64)
                norm = 0.0 if v is None or not len(v) else float(np.sqrt(v @ v))
                out.append(v.tobytes() if 0.0 < norm < np.inf else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "vec"])

    return rows.mapInArrow(run, kind)


def _with_codes(reps: DataFrame, passes: int, prefix: int, seed: int) -> DataFrame:
    """uid, n, label, vec (of unit length), codes (a sort key of 64 bits for each pass), leads (the leading
    bits of all passes)."""

    def run(batches):
        for batch in batches:
            dims = np.array([len(x) // 8 for x in batch.column("vec").to_pylist()], int)
            units, codes, leads = [None] * len(dims), [None] * len(dims), [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = np.stack([np.frombuffer(batch.column("vec")[int(k)].as_py(), np.float64) for k in at])
                v = v / np.abs(v).max(axis=1, keepdims=True)
                v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
                bits = (v @ _planes(int(dim), passes, seed) > 0).reshape(len(at), passes, _BITS)
                words = np.packbits(bits, axis=2).view(">u8")[:, :, 0].astype(np.uint64)
                lead = (words >> np.uint64(64 - prefix)).astype(np.uint32)
                # lexicographic order of bits is the order of unsigned numbers; Spark sorts signed ones
                signed = (words ^ np.uint64(1 << 63)).view(np.int64)
                for k, row in enumerate(at):
                    units[row], codes[row], leads[row] = v[k].tobytes(), signed[k].tolist(), lead[k].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("n"), batch.column("label"), pa.array(units, pa.binary()), pa.array(codes, pa.list_(pa.int64())), pa.array(leads, pa.binary())], ["uid", "n", "label", "vec", "codes", "leads"])
        give_back()

    return reps.mapInArrow(run, "uid long, n long, label string, vec binary, codes array<long>, leads binary")


def _forest(linked: np.ndarray) -> np.ndarray:
    """Least member of each row's component, for a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _first(leads_a: np.ndarray, leads_b: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Whether pass now is the first in which both share their leading bits."""
    return np.argmax(leads_a == leads_b, axis=1) == now


def _arrays(table, passes: int):
    vec = np.frombuffer(b"".join(table["vec"]), np.float64).reshape(len(table["vec"]), -1)
    leads = np.frombuffer(b"".join(table["leads"]), np.uint32).reshape(-1, passes)
    return np.asarray(table["uid"]), np.asarray(table["n"]), np.asarray(table["pass"]), vec, leads


def _block(uid_a, n_a, vec_a, leads_a, uid_b, n_b, vec_b, leads_b, now, similarity, same):
    """Counts for both sides, and links that connect what all links of the block connect."""
    count_a, count_b = np.zeros(len(uid_a), np.int64), np.zeros(len(uid_b), np.int64)
    linked = np.zeros((len(uid_a), len(uid_b)), bool)
    for k in range(0, len(uid_a), 256):
        mask = vec_a[k : k + 256] @ vec_b.T >= similarity
        if same:
            mask &= np.arange(len(uid_b))[None, :] > np.arange(k, k + len(mask))[:, None]
        linked[k : k + 256] = mask
        i, j = np.nonzero(mask)
        for s in range(0, len(i), 1 << 18):
            a, b = i[s : s + (1 << 18)] + k, j[s : s + (1 << 18)]
            ok = _first(leads_a[a], leads_b[b], now)
            np.add.at(count_a, a[ok], n_b[b[ok]])
            np.add.at(count_b, b[ok], n_a[a[ok]])
    return count_a, count_b, linked


def _rows(kind: int, a, b, **more) -> pa.RecordBatch:
    n = len(a)
    columns = {"kind": pa.array(np.full(n, kind, np.int32)), "a": pa.array(np.asarray(a, np.int64)), "b": pa.array(np.asarray(b, np.int64))}
    for name, typ in (("key", pa.int64()), ("kin", pa.int64()), ("part", pa.int64()), ("pass", pa.int64()), ("vec", pa.binary()), ("leads", pa.binary())):
        columns[name] = more.get(name, pa.nulls(n, typ))
    return pa.RecordBatch.from_pydict(columns)


_OUT = "kind int, a long, b long, key long, kin long, part long, pass long, vec binary, leads binary"


def _scan(passes: int, similarity: float, most: int):
    def run(batches):
        for table, starts, part, split in sorted_runs(batches, ["key", "kin"], most):
            total = table.num_rows
            lengths = np.diff(np.r_[starts, total])
            if split:
                yield _rows(2, table["uid"].to_numpy(), table["n"].to_numpy(), key=table["key"].combine_chunks(), kin=table["kin"].combine_chunks(), part=pa.array(np.full(total, part, np.int64)), **{"pass": table["pass"].combine_chunks().cast(pa.int64()), "vec": table["vec"].combine_chunks(), "leads": table["leads"].combine_chunks()})
            keep = np.repeat(lengths > 1, lengths)
            if not keep.any():
                continue
            table, lengths = table.filter(pa.array(keep)).combine_chunks(), lengths[lengths > 1]
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            dims = np.array([len(table["vec"][int(s)].as_py()) for s in starts])
            for dim in np.unique(dims):
                rows = pa.array(np.repeat(dims == dim, lengths))
                yield from _compare(table.filter(rows).to_pydict(), lengths[dims == dim], passes, similarity)
        give_back()

    return run


def _compare(table: dict, lengths: np.ndarray, passes: int, similarity: float):
    """Counts and links of whole windows, of vectors of one length."""
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    uid, n, now, vec, leads = _arrays(table, passes)
    run_of = np.repeat(np.arange(len(starts)), lengths)
    small = np.repeat(lengths <= _SHORT, lengths)
    for d in range(1, min(_SHORT, len(uid))):
        i = np.flatnonzero((run_of[d:] == run_of[:-d]) & small[d:])
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", vec[i], vec[i + d]) >= similarity]
        i = i[_first(leads[i], leads[i + d], now[i])]
        if len(i):
            yield _rows(0, uid[i], n[i + d])
            yield _rows(0, uid[i + d], n[i])
            yield _rows(1, uid[i], uid[i + d])
    for s, m in zip(starts[lengths > _SHORT], lengths[lengths > _SHORT]):
        w = slice(s, s + m)
        x, y, linked = _block(uid[w], n[w], vec[w], leads[w], uid[w], n[w], vec[w], leads[w], now[s], similarity, True)
        hit = np.flatnonzero(x + y)
        if len(hit):
            yield _rows(0, uid[w][hit], (x + y)[hit])
        root = _forest(linked | linked.T)
        own = np.flatnonzero(root != np.arange(m))
        if len(own):
            yield _rows(1, uid[w][own], uid[w][root[own]])


def plan_passes(rows: int, similarity: float = 0.98, missed: float = 5e-5) -> tuple[int, int]:
    """Passes, and the leading bits that vectors of a window share, for so many different vectors.

    The bits grow with the logarithm of the rows, so that windows of vectors that have nothing to do with
    each other stay as short as they are; the passes grow so that a pair at the threshold is missed by
    all of them with at most this probability: one bit is equal with p = 1 - acos(similarity) / pi.
    """
    prefix = min(32, max(16, math.ceil(math.log2(max(rows, 1) / 2))))
    equal = (1 - math.acos(similarity) / math.pi) ** prefix
    return math.ceil(math.log(missed) / math.log1p(-equal)), prefix


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", similarity: float = 0.98, passes: int | None = None, prefix: int | None = None, seed: int = 11, part: int = _PART) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row.

    Rows link if their labels are equal and not null, their vectors have one length and the cosine of
    these, in double precision, is at least similarity. Exact copies are counted once with their number. A
    null or zero vector, or one with a null, infinite or NaN component, links with nothing. A null id
    never names a component unless all its ids are null; it is kept if nothing smaller names its own.
    passes and prefix, where not given, follow from the number of different vectors (plan_passes): a pair
    at the threshold is missed with a probability of 5e-5, nearer ones with less. Repeated rows come out
    repeated, an empty table gives no rows, columns beside the three are not looked at.
    """
    spark = vectors.sparkSession
    ready_for_python(spark)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("vec"))
    kind = dict(rows.dtypes)["vec_id"]
    packed = materialize(_packed(rows, f"vec_id {kind}, label string, vec binary"))
    fit = packed.where("label is not null and vec is not null")
    reps = fit.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    reps, seen = Scratch(spark).counted(reps.withColumn("uid", F.monotonically_increasing_id()))
    wanted = plan_passes(seen["n"], similarity)
    passes, prefix = passes or wanted[0], prefix or wanted[1]
    coded = _with_codes(reps.select("uid", "n", "label", "vec"), passes, prefix, seed)
    dealt = coded.select("uid", "n", "label", "vec", "leads", F.posexplode("codes").alias("pass", "code"))
    lead = F.shiftright("code", 64 - prefix)
    # two independent hashes, so that windows of different labels, lengths or bits don't run into each other
    of = ("pass", "label", F.octet_length("vec"), lead)
    dealt = dealt.withColumns({"key": F.xxhash64(*of), "kin": F.xxhash64(F.lit(1), *of)})
    dealt = dealt.select("key", "kin", "code", "uid", "n", "pass", "vec", "leads").repartition("key").sortWithinPartitions("key", "kin", "code", "uid")
    found = materialize(dealt.mapInArrow(_scan(passes, similarity, part), _OUT))
    counts, links = found.where("kind = 0").select("a", "b"), found.where("kind = 1").select("a", "b")
    rest = found.where("kind = 2")
    if not rest.isEmpty():
        parts = rest.groupBy("key", "kin").agg(F.max("part").alias("parts"))
        both = rest.join(parts, ["key", "kin"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts")))).where("other <> part")
        both = both.select("key", "kin", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", F.col("a").alias("uid"), F.col("b").alias("n"), "pass", "vec", "leads")

        def cross(pdf):
            import pandas as pd

            left, right = pdf[pdf["part"] == pdf["i"]], pdf[pdf["part"] == pdf["j"]]
            if not len(left) or not len(right):
                return pd.DataFrame({"kind": [], "a": [], "b": []}).astype({"kind": "int32", "a": "int64", "b": "int64"})
            ua, na, now, va, la = _arrays(left, passes)
            ub, nb, _, vb, lb = _arrays(right, passes)
            x, y, linked = _block(ua, na, va, la, ub, nb, vb, lb, now[0], similarity, False)
            whole = np.zeros((len(ua) + len(ub),) * 2, bool)
            whole[: len(ua), len(ua) :] = linked
            root, uid = _forest(whole | whole.T), np.r_[ua, ub]
            own = np.flatnonzero(root != np.arange(len(uid)))
            a, b = np.r_[uid, uid[own]], np.r_[x, y, uid[root[own]]]
            return pd.DataFrame({"kind": np.r_[np.zeros(len(uid), np.int32), np.ones(len(own), np.int32)], "a": a, "b": b})

        more = materialize(both.groupBy("key", "kin", "i", "j").applyInPandas(cross, "kind int, a long, b long"))
        counts, links = counts.union(more.where("kind = 0").select("a", "b")), links.union(more.where("kind = 1").select("a", "b"))
    sums = counts.groupBy("a").agg(F.sum("b").alias("links"))
    roots = connected_components(links)
    firsts = reps.select("uid", "first")
    seated = roots.join(firsts, F.col("node") == F.col("uid")).select("node", "root", "first")
    least = seated.groupBy("root").agg(F.min("first").alias("least"))
    named = seated.join(least, "root").select("node", "least")
    known = reps.join(sums, F.col("uid") == F.col("a"), "left").join(named, F.col("uid") == F.col("node"), "left")
    known = known.select(F.col("label").alias("l"), F.col("vec").alias("v"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.when(F.col("node").isNull(), F.col("first")).otherwise(F.col("least")).alias("component"))
    out = packed.join(known, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    component = F.when(F.col("l").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
