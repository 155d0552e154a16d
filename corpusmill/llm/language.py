"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of one to three code points of the lower-cased text.  Document frequencies
count every row that may be learnt from; the weights are fitted on a sample of at most TRAIN_ROWS of
them, by follow-the-regularised-leader with an elastic net; a fifth of the sample is kept back to set
the temperature that calibrates the scores.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.ftrl import Ftrl, bounded, softmax
from corpusmill.llm.kernels import texts

#: rows that weights are fitted on, features of all of them together, and passes over them
TRAIN_ROWS, TRAIN_FEATURES, EPOCHS = 3000, 12_000_000, 2
WIDTH = 1 << 16
#: predicted where there is no letter
NONE = "und"
_LETTER = re.compile(r"[^\W\d_]")  # letters, and numbers such as fractions, which are none
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their counts. Long texts are taken in parts that overlap by two."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(WIDTH, np.int64)
    for at in range(0, max(1, len(points)), 1 << 18):
        c = points[at : at + (1 << 18) + 2]
        own = min(len(c), 1 << 18)
        runs = [c * _K[0], c[:-1] * _K[1] + c[1:] * _K[2], c[:-2] * _K[3] + c[1:-1] * _K[4] + c[2:] * _K[5]]
        for h in runs:
            h = h[:own]
            total += np.bincount((h ^ (h >> np.uint32(15))) * _K[2] >> np.uint32(16), minlength=WIDTH)
    found = np.flatnonzero(total)
    return found, total[found]


def has_letter(text: str) -> bool:
    """Whether a character's Unicode category is a letter's."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def held_out(doc_id: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray, idf: np.ndarray, temperature: float):
        self.names, self.weights, self.bias, self.idf, self.temperature = names, weights, bias, idf, temperature

    def scaled(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[found]
        length = np.sqrt((x**2).sum())
        return x / length if length else x

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.scaled(found, counts) @ self.weights[found] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        if not self.names or not has_letter(text):
            return NONE, 1.0
        p = softmax(self.logits(*grams(text)) / self.temperature)
        best = int(p.argmax())
        return self.names[best], float(p[best])


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows each feature occurs, and the number of rows."""

    def count(batches):
        df, n = np.zeros(WIDTH + 1, np.int64), 0
        for batch in batches:
            for t in texts(batch.column("text")).to_pylist():
                df[grams(t)[0]] += 1
                n += 1
        df[WIDTH] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["feature", "n"])

    out = np.zeros(WIDTH + 1, np.int64)
    for r in rows.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[r.feature] = r.n
    return out[:WIDTH], int(out[WIDTH])


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """A model learnt from text and lang of the rows of df that are not held out and have both."""
    known = df.filter(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.xxhash64(F.lit(9), doc_id).alias("h"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    df_of, n = _frequencies(known)
    idf = np.log((1 + n) / (1 + df_of)) + 1
    share = int(min(1.0, 1.2 * rows / max(1, n)) * 1_000_000) + 1

    def features(batches):
        for batch in batches:
            got = [grams(t) for t in texts(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("lang"), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32()))], ["h", "lang", "at", "n"])

    sample = known.filter(F.pmod("h", F.lit(1_000_000)) < share).mapInArrow(features, "h long, lang string, at array<int>, n array<int>")
    table = bounded(sample, ["h", "lang"], F.size("at"), rows, TRAIN_FEATURES).toArrow()
    labels = table.column("lang").to_pylist()
    names = sorted(set(labels))
    model = Model(names, np.zeros((WIDTH, len(names))), np.zeros(len(names)), idf, 1.0)
    if not names:
        return model
    y = np.array([names.index(x) for x in labels])
    x = [(at := np.array(a.values, np.int64), model.scaled(at, np.array(c.values, np.int64))) for a, c in zip(table.column("at"), table.column("n"), strict=True)]
    order = np.random.default_rng(7).permutation(len(x))
    spare, learn = order[: len(x) // 5], order[len(x) // 5 :]
    leader = Ftrl(len(names), WIDTH + 1, alpha=0.5, beta=1.0, l1=0.02, l2=0.01)
    for _ in range(EPOCHS):
        for i in learn:
            at, value = np.append(x[i][0], WIDTH), np.append(x[i][1], 1.0)  # the last feature is the bias
            w = leader.weights(at)
            p = softmax(value @ w)
            p[y[i]] -= 1
            leader.step(at, np.outer(value, p), w)
    w = leader.weights()
    model.weights, model.bias = w[:WIDTH], w[WIDTH]
    if len(spare):
        logits = np.array([v @ model.weights[a] + model.bias for a, v in (x[i] for i in spare)])
        loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(spare)), y[spare]] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def identify(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of df: doc_id, held_out, lang_pred, score.

    lang_pred is a learnt value, `und` (score 1) for null texts, texts without a letter, and where nothing
    could be learnt.  Scores depend on the text alone.  Equal rows get equal results; a null doc_id is
    not held out; other columns are not carried; an empty table gives an empty table.
    """

    def predict(batches):
        for batch in batches:
            got = [model.predict(t) for t in texts(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    source = df.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return source.mapInArrow(predict, source.drop("text").schema.add("lang_pred", "string").add("score", "double"))


def in_test_fold(doc_id) -> bool:
    """held_out() for one id."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
