"""Language identification in two steps: the family first, then one-versus-one linear support vector
machines between the languages of that family."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cmp_to_key
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, give_back, ready_for_python, together

#: Language codes by family. A code that isn't here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms tl",
}
UNKNOWN = "und"
_DIM = 8192
_CHUNK = 1 << 16


def family(code: str) -> str:
    return next((f for f, codes in FAMILIES.items() if code.lower().split("-")[0] in codes.split()), f"own:{code}")


_letters: np.ndarray | None = None


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, all that isn't a letter as one space."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters[points], points, 32).astype(np.uint32)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    return points[keep]


def grams(text: str):
    """Hashes below _DIM of all pairs and triples of neighbouring characters, block by block; none of a text
    without a letter."""
    codes = _codes(text)
    if not (codes != 32).any():
        return
    codes = np.r_[np.uint32(32), codes, np.uint32(32)]
    for k in range(0, len(codes) - 1, _CHUNK):
        part = codes[k : k + _CHUNK + 2].astype(np.uint64)
        two = part[:-1] * np.uint64(0x9E3779B97F4A7C15) + part[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        pair = (two[:_CHUNK] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(51)
        triple = ((two[:-1] + part[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(51)
        yield pair.astype(np.int64)
        yield triple[:_CHUNK].astype(np.int64)


def counts(text: str) -> np.ndarray:
    out = np.zeros(_DIM, np.float64)
    for g in grams(text):
        out += np.bincount(g, minlength=_DIM)
    return out


def _packed(x: np.ndarray) -> tuple[bytes, bytes]:
    """Places and values of the counts over 0."""
    at = np.flatnonzero(x)
    return at.astype(np.uint16).tobytes(), x[at].astype(np.float32).tobytes()


def _spread(row) -> np.ndarray:
    out = np.zeros(_DIM, np.float32)
    out[np.frombuffer(row["at"], np.uint16)] = np.frombuffer(row["n"], np.float32)
    return out


def _compared(p, q) -> int:
    return (p > q) - (p < q)


def _svm(x: np.ndarray, of: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by dual coordinate descent over the rows of
    x that of names. Returns the weights, with the bias (a constant input of 1) at the end."""
    order, w, a = np.random.default_rng(seed), np.zeros(x.shape[1] + 1), np.zeros(len(of))
    norm = np.array([float(x[i] @ x[i]) for i in of]) + 1 + 1 / (2 * c)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(of)):
            row = x[of[i]]
            g = y[i] * (float(row @ w[:-1]) + w[-1]) - 1 + a[i] / (2 * c)
            new = max(0.0, a[i] - g / norm[i])
            if new != a[i]:
                step = (new - a[i]) * y[i]
                w[:-1] += step * row
                w[-1] += step
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Model:
    """weights: _DIM + 1 rows (the last is the bias), a column for each machine."""

    families: list[str]
    languages: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score from 0 to 1; und and 0 if the text is null or has no letter or nothing was
        learned."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for g in grams(text or "") if self.families else ():
            total += self.weights[g].sum(axis=0)
            n += len(g)
        if not n:
            return UNKNOWN, 0.0
        margins = total / n + self.weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(4 * margins, -50, 50)))
        own = chance[: len(self.families)]
        best = int(np.argmax(own))
        name, score = self.families[best], float(own[best] / own.sum()) if len(own) > 1 else 1.0
        languages = self.languages[name]
        if len(languages) == 1:
            return languages[0], score
        votes = {x: (0, 0.0) for x in languages}
        at = {p: len(self.families) + k for k, p in enumerate(self.pairs)}
        for a, b in combinations(languages, 2):
            p = float(chance[at[a, b]])
            for x, q in ((a, p), (b, 1 - p)):
                votes[x] = (votes[x][0] + (q >= 0.5), votes[x][1] + q)
        lang = max(languages, key=lambda x: votes[x])
        return lang, score * votes[lang][1] / (len(languages) - 1)


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """x: a row of gram counts a text, which this overwrites. Counts become shares, each scaled by the
    inverse root of its mean share; the scale goes into the weights."""
    names = sorted(set(langs))
    groups: dict[str, list[str]] = {}
    for n in names:
        groups.setdefault(family(n), []).append(n)
    families = sorted(groups)
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6) if len(x) else np.ones(_DIM)
    x *= scale
    of, lang, every = np.array([family(n) for n in langs]), np.array(langs), np.arange(len(langs))
    columns = [_svm(x, every, np.where(of == f, 1.0, -1.0)) if len(families) > 1 else np.zeros(_DIM + 1) for f in families]
    pairs = [p for f in families for p in combinations(groups[f], 2)]
    for a, b in pairs:
        rows = np.flatnonzero((lang == a) | (lang == b))
        columns.append(_svm(x, rows, np.where(lang[rows] == a, 1.0, -1.0)))
    w = np.stack(columns, axis=1) if columns else np.zeros((_DIM + 1, 0))
    w[:-1] *= scale[:, None]
    return Model(families, groups, pairs, w)


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 4, is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 2000) -> Model:
    """Learns from at most sample labelled documents that aren't held out, an even share for each language:
    those whose ids hash lowest. Ids choose the sample and are no input of a prediction. Rows without
    an id, a text or a language teach nothing. Each language's sample is a distributed top-k; of each
    row only the counts over 0 reach the driver, 6 bytes each, where the matrix of all is filled row by row."""
    spark = docs.sparkSession
    ready_for_python(spark)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    rows = rows.where(~held_out(F.col("id"))).where(F.col("text").rlike(r"\p{L}"))
    known = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    if not known:
        return fit(np.zeros((0, _DIM), np.float32), [])
    each = max(1, sample // len(known))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    # about twice the share of each language, then exactly the lowest
    near = F.lit(False)
    for name, n in known:
        near = near | ((F.col("lang") == name) & (draw < F.lit(int(min(1.0, (2 * each + 50) / n) * (1 << 30)))))

    def run(batches):
        for batch in batches:
            at, n = zip(*(_packed(counts(x.as_py())) for x in batch.column(1))) if len(batch) else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["lang", "at", "n"])
        give_back()

    picked = None
    pool = rows.where(near).select("lang", "text", draw.alias("draw"), "id")
    for name, _ in known:
        part = pool.where(F.col("lang") == name).orderBy("draw", "id", "text").limit(each)
        picked = part if picked is None else picked.union(part)
    got = picked.select("lang", "text").mapInArrow(run, "lang string, at binary, n binary").collect()
    # in an order that only the rows' own values fix; a row is spread out when it is looked at, never all of them twice
    got.sort(key=cmp_to_key(lambda p, q: _compared(p["lang"], q["lang"]) or _compared(_spread(p).tobytes(), _spread(q).tobytes())))
    x, langs = np.empty((len(got), _DIM), np.float32), [r["lang"] for r in got]
    for k, row in enumerate(got):
        x[k] = _spread(row)
    model = fit(x, langs)
    del x, got
    give_back()  # the driver lives on beside what comes next
    return model


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with columns __lang and __score, predicted from the whole text alone; columns of docs with these
    names are replaced. Repeated rows come out repeated."""
    spark, names = docs.sparkSession, docs.columns
    docs, (text,) = apart(docs, text)
    ready_for_python(spark)
    sent = spark.sparkContext.broadcast(model)  # of fixed width: 8,193 rows, a column a machine

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(values: pa.Array) -> pa.Array:
        found = [sent.value.predict(x.as_py()) for x in values]
        give_back()
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang", "score"])

    out = docs.withColumn("found", run(F.col(text)))
    return together(out.withColumns({"__lang": F.col("found.lang"), "__score": F.col("found.score")}), names, "__lang", "__score")


def predictions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 2000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; repeated rows come out repeated, an empty table
    gives no rows and without labelled rows every prediction is und."""
    model = train(docs, doc_id, text, lang, sample)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return identify(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
