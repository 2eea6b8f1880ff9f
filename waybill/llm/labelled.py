"""Bounded training samples: labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from waybill.llm.tables import keep


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, target: str, learn: Column, bound: int) -> DataFrame:
    """Stored (text, y) of about ``bound`` labelled documents at most, for which ``learn`` holds.

    Labels are thinned by a hash of the id before they meet the documents, so the joined side has a
    known size and is broadcast. Labels other than 0 and 1 and null ids are left out; of repeated
    labels the larger counts, of rows that repeat an id one.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
    rows = rows.filter(F.col("y").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, bound / max(1, rows.count()))
    steps = 1 << 24
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(steps)) < int(share * steps))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("y").alias("y"))
    return keep(met.select("text", "y"), "training")


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last belongs to the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), gradient)
    return w
