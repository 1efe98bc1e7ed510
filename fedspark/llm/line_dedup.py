"""Fuzzy line dedup: MinHash signatures of character shingles, high-recall banding, exact Jaccard
verification, then connected components that keep one line each. DataFrame operations only.

Equal lines are merged by two independent 64-bit hashes. Shingles are counted in UTF-8 bytes, which a
binary column can cut in constant time. Lines that share a band get a number of their own, and all further
work is on these.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, fresh, settings
from .components import connected_components, merged_components

#: Positions of one line that are exploded at a time.
_CHUNK = 65_536
#: Rows (of up to 40 bytes) up to which a table is broadcast; beyond, the same join shuffles.
_MOST_SENT = 1_000_000
#: Longs of marks for a line: enough to tell lines of up to some thousand shingles apart.
_WORDS = 32
#: How many shingles a row of a band has on average that may be its least; and what stands for none.
_LEAST, _NONE = 2, (1 << 31) - 1
#: Lines up to which all of a bucket are pivots at once; pivots of a larger bucket in the first round, and by
#: what they grow from round to round.
_SMALL, _PIVOTS, _GROWTH = 16, 16, 16
#: Pairs above which it pays to verify one pair of two classes before the others.
_MANY = 5_000


def _blank(line: str) -> Column:
    return F.ltrim(line, F.lit(SPACES)) == ""


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, body (hash of the text), pos, line for all lines that hold more than white space."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("body"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
    return rows.where(~_blank("line"))


def _hashed(lines: DataFrame, *more: str) -> DataFrame:
    return lines.select(*more, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _signatures(lines: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """h1, h2, n (occurrences), b0, b1 and so on (a key for each band) for each different line.

    Lines are shingled where they are read, and only the least hashes of each are shuffled. A shingle's hash
    deals it to one band, and the band's rows are the least of its shingles' hashes under one of several flips
    of high bits: bands share no shingle, so they hit or miss independently. A hash that is small under no flip
    is not the least of a row but by chance, so it isn't weighed: of n shingles those below _LEAST / n of the
    range of a row stay, and a line's first. A row without such takes the least of what its band has. A band
    without a shingle has no key; a line has at least one band. A line shorter than a shingle is its own.
    """
    bins = _hashed(lines, F.col("line").cast("binary").alias("bin")).withColumn("last", F.greatest(F.octet_length("bin") - k, F.lit(0)))
    below = F.least(F.lit(float(1 << 32)), F.lit(float(_LEAST * bands << 32)) / (F.col("last") + 1)) - float(1 << 31) - 1
    chunks = bins.select("h1", "h2", "bin", "last", below.cast("int").alias("below"), F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(_CHUNK))).alias("from"))
    each = chunks.select("h1", "h2", "bin", "below", F.explode(F.sequence("from", F.least(F.col("from") + F.lit(_CHUNK - 1), "last"))).alias("at"))
    # adding a partition's number, of which 0 is taken, keeps the optimizer from hashing once for each use
    h = each.select("h1", "h2", "below", "at", (F.xxhash64(F.substring("bin", F.col("at") + 1, F.lit(k))) + F.least(F.spark_partition_id(), F.lit(0))).alias("h"))
    x = F.shiftright(F.shiftleft("h", 32), 32).cast("int")
    flips = [j * ((1 << 32) // rows) - (1 << 31) for j in range(rows)]
    small = reduce(Column.__or__, [x.bitwiseXOR(F.lit(f)) <= F.col("below") for f in flips], F.col("at") == 0)
    few = h.where(small).select("h1", "h2", "at", F.pmod(F.shiftrightunsigned("h", 33), F.lit(bands)).cast("int").alias("band"), (x + F.least(F.spark_partition_id(), F.lit(0))).alias("x"))
    least = {f"m{b}_{j}": F.min(F.when(F.col("band") == b, F.col("x").bitwiseXOR(F.lit(f))).otherwise(_NONE)) for b in range(bands) for j, f in enumerate(flips)}
    found = few.groupBy("h1", "h2").agg(F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("n"), *(v.alias(c) for c, v in least.items()))
    keys = {f"b{b}": [f"m{b}_{j}" for j in range(rows)] for b in range(bands)}
    return found.select("h1", "h2", "n", *(F.when(F.least(*of, F.lit(_NONE)) < _NONE, F.xxhash64(F.lit(b), *of)).alias(b) for b, of in keys.items()))


def _sent(small: DataFrame, seen: dict) -> DataFrame:
    """small, to be broadcast if it has at most _MOST_SENT rows (seen: n); a larger one is joined by a
    shuffle."""
    return F.broadcast(small) if seen["n"] <= _MOST_SENT else small


def _shingles(line: str, k: int) -> Column:
    """The hashes of a line's shingles. The outer transform, of one element, hands the bytes to the inner one
    as a variable; as a column they would be copied for each shingle."""
    places = F.sequence(F.lit(1), F.greatest(F.octet_length(line) - k + 1, F.lit(1)))
    each = F.transform(F.array(F.col(line).cast("binary")), lambda whole: F.transform(places, lambda i: F.xxhash64(F.substring(whole, i, F.lit(k)))))
    return F.element_at(each, 1)


def _profiles(texts: DataFrame, k: int) -> DataFrame:
    """id, n (different shingles), marks: the parity of the shingles that fall on each of 2,048 bits, in an
    array of longs. A line of more than _CHUNK bytes, which marks can't tell from others, has nulls."""
    short = F.octet_length("line") <= _CHUNK
    sets = texts.where(short).repartition("id").select("id", F.array_distinct(_shingles("line", k)).alias("set"))
    h = sets.select("id", F.size("set").alias("n"), F.explode_outer("set").alias("h"))  # explode() would make a filter that shingles again
    h = h.select("id", "n", F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"), F.expr(f"cast(shiftrightunsigned(h, 6) & {_WORDS - 1} as int)").alias("word"))
    words = h.groupBy("id", "word").agg(F.max("n").alias("n"), F.bit_xor("bit").alias("bits"))
    found = words.groupBy("id").agg(F.max("n").alias("n"), *(F.sum(F.when(F.col("word") == w, F.col("bits")).otherwise(0)).alias(f"w{w}") for w in range(_WORDS)))
    marked = found.select("id", "n", F.array(*(f"w{w}" for w in range(_WORDS))).alias("marks"))
    return marked.union(texts.where(~short).select("id", F.lit(None).cast("int"), F.lit(None).cast("array<bigint>")))


def _may_reach(similarity: float) -> Column:
    """False only for pairs of profiles x_, y_ that can't have the similarity: each bit in which marks differ
    stands for a shingle of its own that one side alone has, and of these there are too many."""
    apart = F.aggregate(F.zip_with("x_marks", "y_marks", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, v: total + v)
    return F.coalesce(apart * (1 + similarity) <= (1 - similarity) * (F.col("x_n") + F.col("y_n")) + 1e-9, F.lit(True))


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{name}{c}") for c in df.columns))


def _verified(pairs: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets have at least the given Jaccard similarity. texts: id, line. Repeats
    within a line are only looked for where they decide."""
    lines = texts.select("id", "line")
    both = pairs.join(_side(lines, "x_"), F.col("a") == F.col("x_id")).join(_side(lines, "y_"), F.col("b") == F.col("y_id"))
    sets = both.select("a", "b", _shingles("x_line", k).alias("x"), _shingles("y_line", k).alias("y"))
    sized = sets.select("a", "b", "x", "y", F.size(F.array_intersect("x", "y")).alias("shared"))
    reaches = lambda x, y: F.col("shared") >= similarity * (F.size(x) + F.size(y) - F.col("shared"))
    return sized.where(F.when(reaches(F.col("x"), F.col("y")), True).otherwise(reaches(F.array_distinct("x"), F.array_distinct("y")))).select("a", "b")


def _seated(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (key, id) with their root, and their number in the bucket (n), of the buckets that hold
    different classes."""
    now = members.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    mixed = now.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("n")).where("r1 <> r2").select("key", "n")
    return now.join(mixed, "key")


def line_classes(lines: DataFrame, scratch: Scratch, k: int = 10, bands: int = 8, rows: int = 3, similarity: float = 0.8) -> DataFrame:
    """h1, h2, n, root: the lines that occur more than once (n) or have near-equal others. root names the
    class of the latter and is null for the former.

    Lines that share a band key are candidates. First each line is compared with the first line of one of
    its buckets. Then, where a bucket holds different classes, rounds follow: up to 16, 256 and so on of its
    lines (of up to 16, all), of different classes, are pivots that all the bucket's lines of other classes
    are compared with; then they leave the bucket, all their links in it being known. Two lines are compared
    in that of their common buckets alone which has the least key. So every pair that shares a bucket is
    compared unless it is in one class already, and the rounds end when each bucket is empty or of
    one class. Pairs are made and weighed in one join, from which they only come out if marks of both
    shingle sets (2,048 parities) allow the similarity, which they never deny wrongly; the exact check follows.
    """
    keep = scratch.keep
    with settings(lines.sparkSession, spark__sql__codegen__aggregate__map__twolevel__enabled="false"):
        signed = keep(_signatures(lines, k, bands, rows))
        dealt = signed.select("h1", "h2", F.explode(F.array(*(f"b{b}" for b in range(bands)))).alias("key")).where("key is not null")
        shared, seen = scratch.counted(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
        crowd = keep(dealt.join(_sent(shared, seen), "key").select("key", "h1", "h2"))
        ids, seen = scratch.counted(crowd.select("h1", "h2").distinct())
        found = lines.select("line").join(_sent(ids, seen), (F.xxhash64("line") == F.col("h1")) & (F.xxhash64(F.lit(1), "line") == F.col("h2")))
        texts = found.groupBy("h1", "h2").agg(F.first("line").alias("line"))
        texts = keep(texts.select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "line"))
        members = keep(crowd.join(texts.select("id", "h1", "h2"), ["h1", "h2"]).select("key", "id"))
        profiles = keep(_profiles(texts, k).join(members.groupBy("id").agg(F.collect_list("key").alias("keys")), "id"))
    scratch.drop(shared, crowd, ids)
    may = _may_reach(similarity)
    first = F.array_min(F.array_intersect("x_keys", "y_keys")) == F.col("x_key")

    heads = members.groupBy("key").agg(F.min("id").alias("head"))
    star = members.join(heads, "key").groupBy("id").agg(F.min("head").alias("head")).where("id <> head")
    marked = profiles.drop("keys")
    near = star.join(_side(marked, "x_"), F.col("id") == F.col("x_id")).join(_side(marked, "y_"), (F.col("head") == F.col("y_id")) & may)
    links = keep(_verified(near.select(F.col("id").alias("a"), F.col("head").alias("b")), texts, k, similarity))
    roots = connected_components(links)
    scratch.drop(links)
    (members, seen), most = scratch.counted(_seated(members, roots)), _PIVOTS
    while seen["n"]:
        slot = F.when(F.col("n") <= max(most, _SMALL), F.col("id")).otherwise(F.pmod(F.xxhash64(F.lit(most), "root"), F.lit(most)))
        pivots = members.groupBy("key", slot.alias("slot")).agg(F.min(F.struct("id", "root")).alias("pivot"))
        pivots = keep(pivots.select("key", "pivot.id", "pivot.root"))
        x, y = _side(members.drop("n").join(profiles, "id"), "x_"), _side(pivots.join(profiles, "id"), "y_")
        near = x.join(y, (F.col("x_key") == F.col("y_key")) & (F.col("x_root") != F.col("y_root")) & first & may)
        near, seen = scratch.counted(near.select(F.greatest("x_id", "y_id").alias("a"), F.least("x_id", "y_id").alias("b"), F.greatest("x_root", "y_root").alias("p"), F.least("x_root", "y_root").alias("q")).distinct())
        tried = near.select("a", "b")
        if seen["n"] > _MANY:  # first one pair for each two classes, then those that this has not brought together
            tried = keep(near.groupBy("p", "q").agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.a", "pair.b"))
        links = more = keep(_verified(tried, texts, k, similarity))
        roots = keep(merged_components(roots, links))
        if seen["n"] > _MANY:
            one, two = (roots.select(F.col("node").alias(f"n{c}"), F.col("root").alias(f"r{c}")) for c in "ab")
            apart = near.join(one, F.col("a") == F.col("na"), "left").join(two, F.col("b") == F.col("nb"), "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b"))
            more, seen = scratch.counted(apart.select("a", "b").join(tried, ["a", "b"], "left_anti"))
            if seen["n"]:
                links = keep(_verified(more, texts, k, similarity))
                roots = keep(merged_components(roots, links))
        left, seen = scratch.counted(_seated(members.select("key", "id").join(pivots.select("key", "id"), ["key", "id"], "left_anti"), roots))
        scratch.drop(members, pivots, near, tried, more, links)
        members, most = left, most * _GROWTH
    named = roots.join(texts.select("id", "h1", "h2"), F.col("node") == F.col("id")).select("h1", "h2", "root")
    out, seen = scratch.counted(signed.select("h1", "h2", "n").join(named, ["h1", "h2"], "left").where("n > 1 or root is not null"))
    scratch.clear(out)
    return _sent(out, seen)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 10, bands: int = 8, rows: int = 3, similarity: float = 0.8) -> DataFrame:
    """docs with __text (the text without repeated lines), __lines and __kept (lines that hold more than
    white space, before and after). Columns of docs with these names are replaced.

    Of each class of near-equal lines the first stays: least id (null last), then least position. Lines of
    white space stay. A line shorter than a shingle is its own shingle. Rows with equal id and text
    are treated alike, as nothing tells them apart; a null text stays null with no lines. An empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    lines = _lines(docs, doc_id, text)
    classes = line_classes(lines, scratch, k, bands, rows, similarity)
    seated = _hashed(lines, "doc", "body", "pos").join(classes, ["h1", "h2"])
    # a class is named by its root; a repeated line that is alone in its class by both its hashes
    seated = scratch.keep(seated.select("doc", "body", "pos", F.coalesce("root", "h1").alias("c1"), F.when(F.col("root").isNull(), F.col("h2")).alias("c2")))
    order = F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("body"), F.col("pos"))
    firsts = scratch.keep(seated.groupBy("c1", "c2").agg(F.min(order).alias("first")))
    extra = seated.join(firsts.withColumnsRenamed({"c1": "k1", "c2": "k2"}), (F.col("c1") == F.col("k1")) & F.col("c2").eqNullSafe(F.col("k2"))).where(~order.eqNullSafe(F.col("first")))
    at, key, body, own, dropped, parts = fresh(docs, "at", "key", "body", "own", "dropped", "parts")
    drops, seen = scratch.counted(extra.groupBy(F.col("doc").alias(key), F.col("body").alias(body)).agg(F.collect_set("pos").alias(dropped)), places=F.sum(F.size(dropped)))
    scratch.clear(drops)
    few = seen["n"] + (seen["places"] or 0) // 8 <= _MOST_SENT
    out = docs.withColumns({at: F.xxhash64(F.col(text)), own: F.col(doc_id)})
    out = out.join(F.broadcast(drops) if few else drops, F.col(own).eqNullSafe(F.col(key)) & (F.col(at) == F.col(body)), "left")
    out = out.withColumn(parts, F.split(F.col(text), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.coalesce(dropped, F.array().cast("array<int>")))
    full = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.filter(parts, lambda x: F.ltrim(x, F.lit(SPACES)) != "")))
    kept_text = F.when(F.col(dropped).isNull(), F.col(text)).otherwise(F.array_join(F.transform(F.array_sort(stay), lambda i: F.get(parts, i)), "\n"))
    added = {"__text": kept_text, "__lines": full.cast("long"), "__kept": full.cast("long") - F.coalesce(F.size(dropped), F.lit(0))}
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added), *(v.alias(c) for c, v in added.items()))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with repeated lines taken out of the text. Documents of which nothing is left go; those that
    held no line from the start stay. Columns named __text, __lines or __kept are not carried."""
    out = dedup_lines(docs, doc_id, text, **options).where("__kept > 0 or __lines = 0")
    return out.select(*(F.col("__text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("__text", "__lines", "__kept")))
