"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

Features are hashed into 2^BITS weights: words, pairs of neighbouring words,
and the same for word shapes (letters as a or A, digits as 0, runs collapsed),
which carry over to words never seen. A document is a sparse vector of feature
shares, so its score is one sparse dot product whatever its length.

The model is fitted on at most max_rows labelled documents, those of the
smallest id hashes (the bound is a parameter, so that fitting is one task of
bounded size); every document is scored, whole.

Defined results: an empty or null text has no features and gets the bias's
score. Labels of a null id or null value are ignored; a document with several
labels counts as good if any of them is 1. No labels at all: all scores 0.5.
Rows that repeat get the same score. Only the text enters a score. Texts may be
of any length. Other columns pass through; score_names gives the new ones' names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cache_of, free_name, remainder, ship, tidy

BITS = 20
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_SHAPE = bytes(65 if 65 <= i <= 90 else 97 if 97 <= i <= 122 or i >= 128 else 48 if 48 <= i <= 57 else i for i in range(256))
_LOW = np.uint64(0xFFFFFFFF)


class _Codes(dict):
    """Word (bytes) to its hash in the low and its shape's in the high 32 bits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        shape = _RUNS.sub(rb"\1", word.translate(_SHAPE))
        code = self[word] = zlib.crc32(word.lower()) | zlib.crc32(shape) << 32
        return code


_CODES = _Codes()


def features(text: str | None) -> np.ndarray:
    """Feature numbers of a text, with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    code = np.fromiter(map(cache_of(_CODES).__getitem__, words), np.uint64, len(words))
    out = []
    for salt, h in ((1, code & _LOW), (2, code >> np.uint64(32))):
        out.append(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))
        pair = h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:] * np.uint64(0x165667B19E3779F9)
        out.append((pair ^ pair >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))
    return np.concatenate(out) >> np.uint64(64 - BITS)


SCALE = 20.0


def sparse(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document as feature numbers and values, the bias last; 8 bytes a feature."""
    at, times = np.unique(f, return_counts=True)
    return np.append(at, 2**BITS).astype(np.int32), np.append(times * (SCALE / max(1, len(f))), 1.0).astype(np.float32)


def ftrl(samples: list[tuple[tuple[np.ndarray, np.ndarray], int]], alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 3) -> np.ndarray:
    """Weights, the bias last, after the samples have been seen in turn, epochs times."""
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for (at, x), y in samples:
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(slice(None))


def labelled(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", modulus: int = 3, held_out: int = 1) -> DataFrame:
    """_id and _y of the rows to learn from."""
    kept = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (remainder(F.col(id_col), modulus) != held_out))
    return kept.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))


def fitted(docs: DataFrame, train: DataFrame, max_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights learned from train's rows (_id, _y): max_rows of them at most."""
    ship(docs.sparkSession)
    # at most max_rows ids and labels, so this side may be broadcast
    some = train.select("_id", "_y", F.xxhash64("_id").alias("_h")).orderBy("_h", "_id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(F.broadcast(some), F.col("_doc") == F.col("_id"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for b in batches:
            seen += [(h, i, zlib.crc32((t or "").encode("utf-8", "surrogatepass")), sparse(features(t)), y) for h, i, t, y in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)]
        seen.sort(key=lambda x: x[:3])
        yield pa.RecordBatch.from_arrays([pa.array([ftrl([x[3:] for x in seen]).astype("<f4").tobytes()])], ["w"])

    got = rows.select("_h", "_id", "_text", "_y").repartition(1).mapInArrow(tidy(learn, "quality"), "w binary").collect()
    return np.frombuffer(got[0]["w"], "<f4") if got else np.zeros(2**BITS + 1, np.float32)


def scored(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", name: str = "_score") -> DataFrame:
    """docs with name, the chance of a good label, added."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 4 MB, whatever the data

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for part in texts:
            out = np.empty(len(part))
            for k, text in enumerate(part):
                f = features(text)
                dot = float(w[-1]) + (float(w[f].sum(dtype=np.float64)) * SCALE / len(f) if len(f) else 0.0)
                out[k] = 1 / (1 + np.exp(-min(35.0, max(-35.0, dot))))
            yield pd.Series(out)

    def tidied(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(score, "quality")(texts)

    return docs.select("*", F.pandas_udf(tidied, "double")(F.col(text_col)).alias(name))


def score_names(columns: list[str]) -> tuple[str, str]:
    """What the two new columns are called: one more underscore in front where there is such a column already."""
    return free_name("_score", columns), free_name("_predicted", columns)


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """docs with _score and _predicted (1 from 0.5 on) added, by the names of score_names."""
    weights = fitted(docs, labelled(labels, label_col, id_col), max_rows, id_col, text_col)
    score, predicted = score_names(docs.columns)
    return scored(docs, weights, id_col, text_col, score).select("*", (F.col(score) >= 0.5).cast("int").alias(predicted))
