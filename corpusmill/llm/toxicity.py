"""Toxicity: a counterfactually regularised classifier.

A logistic score over the distinct words of a text (hashed), fitted by follow-the-regularised-leader with
an elastic net.  For every labelled text that names a group, a second text is made in which each identity
term gives way to its neighbour in the same set.  The squared change of the score between the two is
added to the loss, so a text is not held to be toxic for the group it names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.ftrl import Ftrl, bounded, sigmoid
from corpusmill.llm.kernels import ALNUM, Words, chunks, texts
from corpusmill.llm.store import fresh_name

#: labelled rows that weights are fitted on, features of all of them together, passes over them, and the weight of a score change
TRAIN_ROWS, TRAIN_FEATURES, EPOCHS, FAIRNESS = 12_000, 20_000_000, 2, 4.0
WIDTH = 1 << 18
THRESHOLD = 0.3

#: Identity terms, by sets whose members are swapped for one another.
IDENTITY_SETS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("girl", "boy"),
    ("female", "male"),
    ("wives", "husbands"),
    ("mothers", "fathers"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("africans", "europeans", "americans", "mexicans", "chinese", "indians"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("immigrant", "native", "refugee", "citizen"),
    ("disabled", "abled"),
    ("old", "young"),
    ("poor", "rich"),
)


def _hash_of(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    return Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM, lower=True).hash


def swaps() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the identity terms, sorted, and of the terms they give way to."""
    terms = [t for s in IDENTITY_SETS for t in s]
    others = [s[(i + 1) % len(s)] for s in IDENTITY_SETS for i in range(len(s))]
    a, b = _hash_of(terms), _hash_of(others)
    order = np.argsort(a)
    return a[order], b[order]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return np.unique((hashes >> np.uint64(40)).astype(np.int64) % WIDTH)


def _documents(column: pa.Array):
    """The word hashes of each text."""
    for first, last, data, offsets in chunks(column):
        w = Words(data, offsets, ALNUM, lower=True)
        for i in range(last - first):
            yield w.hash[w.bounds[i] : w.bounds[i + 1]]


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> np.ndarray:
    """WIDTH weights and a bias, from at most `rows` labelled documents that are not held out.

    Null labels and null ids are left out; an id labelled more than once counts as toxic if any label says so.
    """
    marks = labels.filter(~held_out(doc_id) & F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), (F.col(label) > 0).cast("int").alias("y"))
    n = marks.count()
    share = int(min(1.0, 1.2 * rows / max(1, n)) * 1_000_000) + 1
    marks = marks.withColumn("h", F.xxhash64(F.lit(4), "id")).filter(F.pmod("h", F.lit(1_000_000)) < share)
    marks = marks.groupBy("h", "id").agg(F.max("y").alias("y")).orderBy("h", "id").limit(rows)

    def features(batches):
        old, new = swaps()
        for batch in batches:
            plain, swapped = [], []
            for words in _documents(texts(batch.column("text"))):
                at = np.minimum(np.searchsorted(old, words), len(old) - 1)
                other = np.where(old[at] == words, new[at], words)
                plain.append(_buckets(words))
                swapped.append(_buckets(other) if (other != words).any() else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), pa.array(plain, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.int32()))], ["h", "y", "at", "other"])

    # at most `rows` small rows are broadcast
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(marks), "id").select("h", "y", "text")
    sample = source.mapInArrow(features, "h long, y int, at array<int>, other array<int>")
    table = bounded(sample, ["h", "y"], F.size("at") + F.size("other"), rows, TRAIN_FEATURES).toArrow()
    x = [np.array(a.values, np.int64) for a in table.column("at")]
    other = [np.array(a.values, np.int64) for a in table.column("other")]
    return learn(x, other, np.array(table.column("y").to_pylist(), np.float64))


def learn(x: list[np.ndarray], other: list[np.ndarray], y: np.ndarray, fairness: float = FAIRNESS) -> np.ndarray:
    """Weights and bias from distinct features of each text, of its counterfactual (none: empty), and the labels."""
    leader = Ftrl(1, WIDTH + 1, alpha=0.5, beta=1.0, l1=5.0, l2=1.0)
    rng = np.random.default_rng(4)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(x)):
            at = np.append(x[i], WIDTH)
            w = leader.weights(at)
            slope = sigmoid(w.sum()) - y[i]
            leader.step(at, np.full((len(at), 1), slope), w)
            if len(other[i]) and fairness:
                apart = np.setxor1d(x[i], other[i], assume_unique=True)
                side = np.where(np.isin(apart, x[i]), 1.0, -1.0)
                w = leader.weights(apart)
                change = float(side @ w[:, 0])
                leader.step(apart, (2 * fairness * change * side)[:, None], w)
    return leader.weights()[:, 0]


def score_texts(df: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """df with a column `out`, from 0 to 1: higher, likelier toxic. Null and empty texts score by the bias alone."""
    names = df.columns

    def run(batches):
        for batch in batches:
            got = [float(sigmoid(weights[_buckets(h)].sum() + weights[WIDTH])) for h in _documents(texts(batch.column(names.index(text))))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


def clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose texts score below threshold, with their columns as they are; all rows if nothing could be learnt."""
    weights = fit(docs, labels, doc_id, text)
    if not weights.any():
        return docs
    out = fresh_name("score", docs.columns)
    return score_texts(docs, weights, text, out).filter(F.col(out) < threshold).drop(out)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted (1 if score >= threshold).

    Every whole text is scored, labelled or not, by its words alone.  Equal texts get equal scores; a null
    doc_id is not held out; without any label all texts get one score of 0.5; other columns are not
    carried; an empty table gives an empty table.
    """
    weights = fit(docs, labels, doc_id, text)
    rows = score_texts(docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text")), weights)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
