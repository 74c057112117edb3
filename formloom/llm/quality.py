"""Quality classifier over hashed word n-grams (operator 3).

Method: logistic regression trained by follow-the-regularised-leader (FTRL)
updates; a text is scored as the sparse dot product of its hashed uni- and
bigram counts (unit length) with the weights.  Words are runs of letters, runs
of digits or runs of signs, as written; a word that repeats the one before it
makes the same bigram whatever the word, so that looping text is recognised.

Training takes at most ``TRAIN_ROWS`` labelled rows, those with the least hash
of their id.  They are dealt to ``SHARDS`` tasks, each of which runs FTRL over
its rows; the weights are averaged.  Only the weights (a few MB whatever the
corpus) pass through the driver.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Memo
from .common import WorkerStore, drop_idle_stores, map_batches, small_batches, text_of

BITS = 18
#: Bound of the training sample, its shards, passes and FTRL's parameters.
TRAIN_ROWS, SHARDS, PASSES = 12_000, 4, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
THRESHOLD = 0.7
#: Words whose hash a worker keeps; a missing one is quickly made.
REMEMBERED = 1 << 16

WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
MASK = np.uint64((1 << BITS) - 1)
BIAS, REPEATED = 0, 1


@WorkerStore
def word_hashes() -> Memo:
    return Memo(lambda word: zlib.crc32(word.encode()), limit=REMEMBERED)


def ngram_ids(text: str) -> np.ndarray:
    """Slots of the uni- and bigrams, in no order; 0 and 1 are kept free."""
    words = WORDS.findall(text)
    h = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    pairs = np.where(h[1:] == h[:-1], np.uint64(REPEATED), np.maximum((mixed >> np.uint64(40)) & MASK, np.uint64(2)))
    single = np.maximum((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & MASK, np.uint64(2))
    return np.concatenate([single, pairs]).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: counts at unit length, and a bias of one."""
    slots, counts = np.unique(ngram_ids(text), return_counts=True)
    values = counts / max(1.0, float(np.sqrt((counts * counts).sum())))
    return np.append(slots, BIAS), np.append(values, 1.0)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> np.ndarray:
    """Weights after ``PASSES`` passes over the rows in their order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(zs, ns):
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(PASSES):
        for (slots, values), label in zip(rows, labels):
            w = weights(z[slots], n[slots])
            g = (_sigmoid(float(w @ values)) - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA
            z[slots] += g - sigma * w
            n[slots] += g * g
    return weights(z, n)


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights learnt from labelled rows that are not held out.

    Of several labels of a document the least counts; null labels and ids are
    ignored, labels outside 0 and 1 too.  Without any label all weights are
    zero, and every score one half.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(target).cast("int").alias("_y")).where("_y in (0, 1) and _id is not null")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_y").alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    rows = texts.join(F.broadcast(sample), "_id")  # the sample is bounded

    def prepare(batch):
        found = [features(t) for t in batch["_text"]]
        return {
            "doc_id": pa.array(batch["_id"], pa.int64()), "y": pa.array(batch["_y"], pa.int32()),
            "slots": pa.array([s.tolist() for s, _ in found], pa.list_(pa.int32())),
            "vals": pa.array([v.astype(np.float32).tolist() for _, v in found], pa.list_(pa.float32())),
        }

    ready = map_batches(rows.select("_id", "_y", "_text"), "doc_id long, y int, slots array<int>, vals array<float>", prepare)

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        # A fixed, mixed order; copies of a row are told apart by nothing.
        part = part.assign(_o=[zlib.crc32(str(i).encode()) for i in part["doc_id"]]).sort_values(["_o", "doc_id"], kind="stable")
        w = ftrl([(np.asarray(s), np.asarray(v, float)) for s, v in zip(part["slots"], part["vals"])], part["y"].tolist())
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()]})

    shard = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).alias("shard")
    learnt = [np.frombuffer(r[0], np.float32) for r in ready.groupBy(shard).applyInPandas(learn, "w binary").collect()]
    return np.mean(learnt, axis=0, dtype=np.float64) if learnt else np.zeros(1 << BITS)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    packed = weights.astype(np.float32).tobytes()

    def work(batch):
        w = np.frombuffer(packed, np.float32).astype(np.float64)
        scores = []
        for text in batch["text"]:
            slots, values = features(text)
            scores.append(_sigmoid(float(w[slots] @ values)))
        return {"doc_id": pa.array(batch["doc_id"], pa.int64()), "score": pa.array(scores, pa.float64())}

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    scored = map_batches(plain, "doc_id long, score double", work)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the labelled rows and score every row.

    Null and empty texts score by the bias alone.  Null ids and repeated rows
    are scored like any row; extra columns are ignored; an empty table gives an
    empty table.
    """
    return score(docs, train(docs, labels, "quality", id_col, text_col), id_col, text_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, all columns as they
    are."""
    small_batches(docs.sparkSession)
    packed = train(docs, labels, "quality", id_col, text_col).astype(np.float32).tobytes()

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        drop_idle_stores()
        w = np.frombuffer(packed, np.float32).astype(np.float64)
        found = (features(t) for t in texts)
        return pd.Series([_sigmoid(float(w[s] @ v)) for s, v in found], dtype=float)

    return docs.where(scores(text_of(text_col)) >= THRESHOLD)
