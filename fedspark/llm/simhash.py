"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, Hamming verification."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, materialize, ready_for_python
from .components import connected_components
from .runs import sorted_runs

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Runs up to this length are compared pair by pair in vector operations, longer ones by search.
_SHORT = 8
#: Rows of one run that a task compares at once; longer runs are compared part against part.
_PART = 65_536


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is set if over half of the shingles' XXH64 have it."""
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for k in range(0, n, 16_384):
        part = words[k : k + 16_384 + shingle - 1]
        hashes = [digest(join(x), seed) for x in zip(*(part[i:] for i in range(shingle)))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) for each row. A null text counts as empty; a text
    without a word has fingerprint zero."""
    ready_for_python(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])
        give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of all choices of blocks - distance blocks out of 64 bits: two fingerprints that differ in at
    most distance bits agree on at least one mask, since each bit spoils one block only."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _forest(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect just what all links within distance connect, one fewer than members. Each
    member is compared with all that no search has reached yet, so dense groups take one sweep."""
    out, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            for p in queue.pop():
                near = np.bitwise_count(rest ^ p) <= distance
                if near.any():
                    hits, rest = rest[near], rest[~near]
                    out.append((np.full(len(hits), p), hits))
                    queue.append(hits)
                    if not len(rest):
                        break
    return out


def _scan(distance: int, most: int):
    def run(batches):
        for table, starts, part, split in sorted_runs(batches, ["key"], most):
            fps = table.column("fp").to_numpy().view(np.uint64)
            lengths = np.diff(np.r_[starts, len(fps)])
            found = []
            run_of = np.repeat(np.arange(len(starts)), lengths)
            small = np.repeat(lengths <= _SHORT, lengths)
            for d in range(1, min(_SHORT, len(fps))):
                ok = (run_of[d:] == run_of[:-d]) & small[d:]
                if not ok.any():
                    break
                i = np.flatnonzero(ok)
                i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= distance]
                found.append((fps[i], fps[i + d]))
            for s, n in zip(starts[lengths > _SHORT], lengths[lengths > _SHORT]):
                found += _forest(fps[s : s + n], distance)
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                nulls = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), nulls, nulls], ["a", "b", "key", "part"])
            if split:
                n = len(fps)
                yield pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.nulls(n, pa.int64()), table.column("key").combine_chunks(), pa.array(np.full(n, part, np.int64))], ["a", "b", "key", "part"])
        give_back()

    return run


def links(fps: DataFrame, distance: int = 4, blocks: int = 7, part: int = _PART) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect the same groups as all links of
    at most distance differing bits. Distinct fingerprints are dealt out by each mask of blocks and
    compared within a run of equal keys; within a large run only a forest of links comes out. Runs over
    part rows go on part against part, each pair of parts a task of its own."""
    spark = fps.sparkSession
    keys = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64)))) for k, m in enumerate(block_masks(blocks, distance))]
    dealt = fps.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("key"))
    ready_for_python(spark)
    found = materialize(dealt.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_scan(distance, part), "a long, b long, key long, part long"))
    rest = found.where("b is null")
    out = found.where("b is not null").select("a", "b")
    if not rest.isEmpty():
        parts = rest.groupBy("key").agg(F.max("part").alias("parts"))
        rest = rest.join(parts, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts")))).where("other <> part")
        rest = rest.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), F.col("a").alias("fp"))

        def cross(pdf):
            import pandas as pd

            pairs = _forest(pdf["fp"].to_numpy().view(np.uint64), distance)
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
            return pd.DataFrame({"a": a, "b": b})

        out = out.union(rest.groupBy("key", "i", "j").applyInPandas(cross, "a long, b long"))
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, blocks: int = 7) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach) for each row.

    Equal fingerprints link. Rows without an id take part and get the smallest id of their group, null
    if it has none. Repeated rows come out as often as they came in; an empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, doc_id, text, shingle))
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(prints, distance, blocks))
    linked = materialize(roots.join(firsts, roots["node"] == firsts["fp"]).select("fp", "root", "first"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select(F.col("fp").alias("node"), "least")
    # a linked group's first may be null while another's is not
    classes = firsts.join(linked, F.col("fp") == F.col("node"), "left").select("fp", F.when(F.col("node").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without near-duplicates: of each group one row stays, that of the smallest id (null last). Rows
    go by id and a hash of the text, so rows that share an id but not a group are told apart, and rows
    without an id take part. Of rows equal in both one stays."""
    body = F.xxhash64(F.col(text))
    name = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), body.alias("body"))
    found = materialize(near_duplicates(docs.select(name.alias("name"), F.col(text).alias("text")), "name", "text", **options))
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    at, dropped, its = fresh(docs, "at", "dropped", "its")
    gone = found.where(~same).select(F.col("doc_id.id").alias(dropped), F.col("doc_id.body").alias(its)).distinct()
    kept = docs.withColumn(at, body).join(gone, F.col(doc_id).eqNullSafe(F.col(dropped)) & (F.col(at) == F.col(its)), "left_anti")
    if not found.where(same).groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([doc_id, at])
    return kept.drop(at)
