"""Language identification (operator 1): sparse multinomial logistic regression on character n-grams.

A text is lower-cased, reduced to its letters with one space between runs, and
its 1- to 3-grams of code points are hashed to ``DIM`` slots. Weights are
(1 + log count) * idf with unit length. Document frequencies cover all training
texts; the classifier is fitted on a bounded sample of ``SAMPLE`` training texts,
balanced over languages, by follow-the-regularised-leader with elastic-net
penalties (L1 keeps weights sparse, L2 small). One fifth of the sample isn't
trained on and sets the temperature that divides the scores.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is every text if nothing can be learned; rows without a language or doc_id
are never learned from; equal scores go to the first language by name; rows that
repeat a doc_id each get their own result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, fresh, map_docs, stored

DIM = 1 << 15
SAMPLE = 4000            # texts that the classifier is fitted on, whatever the input
MOST_LANGUAGES = 1000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
UNDETERMINED = "und"

_U = np.uint32
_MULTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], _U)
_ADDS = np.arange(4, dtype=_U) * _MULTS[2]
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Runs of word characters in lower case with a space around each; empty if none is a letter."""
    plain = _NOT_LETTERS.sub(" ", text.lower()).strip(" ")
    return f" {plain} " if any(map(str.isalpha, plain)) else ""


def grams(plain: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of the 1- to 3-grams."""
    c = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), _U)
    h, slots = c * _MULTS[0], []
    for n in range(1, 4):
        if len(h) == 0:
            break
        slots.append((((h ^ (h >> _U(15))) * _MULTS[1]) + _ADDS[n]) >> _U(17))
        h = (h[:-1] ^ (h[:-1] >> _U(13))) * _MULTS[2] + c[n:] * _MULTS[0]
    count = np.bincount(np.concatenate(slots), minlength=DIM)
    own = np.flatnonzero(count)
    return own, count[own]


def weights(own: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(count)) * idf[own]
    return v / max(np.sqrt((v * v).sum()), 1e-12)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> np.ndarray:
    """(classes, DIM + 1) weights from (label, slots, values); the last column is the bias."""
    z, n = np.zeros((classes, DIM + 1)), np.zeros((classes, DIM + 1))

    def weight(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) > L1, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for label, own, v in rows:
            own, v = np.append(own, DIM), np.append(v, 1.0)
            zs, ns = z[:, own], n[:, own]
            w = weight(zs, ns)
            s = w @ v
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = p[:, None] * v
            more = ns + g * g
            z[:, own] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
            n[:, own] = more
    return weight(z, n)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which held-back labels are likeliest."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(labels)), labels]).mean())

    lo, hi = np.log(0.05), np.log(20.0)
    for _ in range(60):
        a, b = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        lo, hi = (lo, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each slot; at slot -1 all texts."""
    n, df = 0, np.zeros(DIM, np.int64)
    for batch in batches:
        for t in batch.column(0).to_pylist():
            plain = letters(t)
            if plain:
                df[grams(plain)[0]] += 1
                n += 1
    own = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(own, -1), pa.int64()), pa.array(np.append(df[own], n))], ["slot", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part, out = batch.slice(at, 200), ([], [], [], [])
            for lang, order, t in zip(*(part.column(i).to_pylist() for i in range(3))):
                plain = letters(t)
                if plain:
                    own, count = grams(plain)
                    for x, v in zip(out, (lang, order, own.astype(np.int32).tobytes(), count.astype(np.int32).tobytes())):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                                             ["lang", "ord", "slots", "counts"])


class Model:
    """Languages, idf, weights and temperature; its size depends on the number of languages only."""

    def __init__(self, languages: list[str], idf: np.ndarray, w: np.ndarray, t: float):
        self.languages, self.idf, self.w, self.t = languages, idf.astype(np.float32), w.astype(np.float32), t

    def predict(self, text: str) -> tuple[str, float]:
        plain = letters(text) if self.languages else ""
        if not plain:
            return UNDETERMINED, 0.0
        own, count = grams(plain)
        s = (self.w[:, own] @ weights(own, count, self.idf) + self.w[:, DIM]).astype(np.float64) / self.t
        p = np.exp(s - s.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from the rows (doc_id, text, lang) of a training table; rows without text, lang or doc_id don't count."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(per) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not per:
        return Model([], np.zeros(DIM), np.zeros((0, DIM + 1)), 1.0)
    df = np.zeros(DIM)
    total = 0
    for r in (arrow_map(rows.select("text"), _frequencies, "slot bigint, n bigint").groupBy("slot")
              .agg(F.sum("n").alias("n")).collect()):   # DIM + 1 rows at most
        if r["slot"] < 0:
            total = r["n"]
        else:
            df[r["slot"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1
    share = [(lang, min(1.0, sample / len(per) / n)) for lang, n in per.items()]
    rates = F.broadcast(docs.sparkSession.createDataFrame(share, "lang string, rate double"))
    order = F.xxhash64("doc_id", F.lit("sample")).alias("ord")
    chosen = (rows.select("lang", order, "text").join(rates, "lang")
              .where(F.pmod("ord", F.lit(1 << 30)) < F.col("rate") * (1 << 30)).select("lang", "ord", "text").limit(2 * sample))
    got = arrow_map(chosen, _features, "lang string, ord bigint, slots binary, counts binary").collect()   # bounded by the sample
    languages = sorted({r["lang"] for r in got})
    place = {x: i for i, x in enumerate(languages)}
    data = []
    for r in sorted(got, key=lambda r: (r["ord"], r["lang"], bytes(r["slots"]), bytes(r["counts"]))):
        own = np.frombuffer(r["slots"], np.int32)
        data.append((place[r["lang"]], own, weights(own, np.frombuffer(r["counts"], np.int32), idf)))
    back = data[::5] if len(data) >= 50 else []
    w = fit([x for i, x in enumerate(data) if not back or i % 5], len(languages)) if languages else np.zeros((0, DIM + 1))
    scores = np.array([w[:, own] @ v + w[:, DIM] for _, own, v in back])
    return Model(languages, idf, w, temperature(scores, np.array([x[0] for x in back], int)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids: list, texts: list) -> dict:
        got = [shared.value.predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return map_docs(docs, "doc_id bigint,lang_pred string,score double", run)


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows whose crc32(doc_id) mod 4 isn't 2."""
    model = train(docs.where(fold(F.col("doc_id"), 4) != 2), sample)
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def drop_undetermined(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """The input's rows and columns without texts that are ``und`` or whose language is hardly a guess.

    Learns from all rows that have a language. Without any, only texts that have no letter go. A guess among k
    languages is 1 / k, so with more than four the limit on the score falls to 1.2 / k.
    """
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    model = train(docs)
    if not model.languages:
        return docs.where(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    least_score = min(least_score, 1.2 / len(model.languages))
    scored = predict(docs.select(key.alias("doc_id"), "text"), model)
    own, gone = fresh(docs, "__own"), fresh(docs, "__rejected")
    out = stored(scored.where((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < least_score))
                 .select(F.col("doc_id").alias(gone)).distinct(), "rejected")
    if out.count() <= 2_000_000:
        out = F.broadcast(out)
    return docs.withColumn(own, key).join(out, F.col(own) == F.col(gone), "left_anti").select(*docs.columns)


__all__ = ["Model", "drop_undetermined", "fit", "language_id", "letters", "predict", "temperature", "train"]
