"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-case UTF-8 bytes. From the training
texts each n-gram gets the log-ratio of its smoothed shares in texts with label 1 and label 0; the
``features`` n-grams with the clearest ratios are kept. A logistic regression is then fitted on
indicators multiplied by these ratios, and every text is scored by it.

The classifier is fitted on a bounded sample of the training rows: the ``sample`` rows with the
smallest hashes of their ids. Only the sample's n-gram lists reach the one task that fits; the model has
a fixed size and is what the scoring tasks receive. Scoring covers whole texts, however long.

Contract. The inputs of a score are the text and nothing else. A null or empty text has no n-grams and
the score of the intercept. Labels of a row with several ones count as 1 if any is 1; null labels and
null ids are no training rows, and of an id with several texts the first in their order is one. Every row of ``docs`` gives one row, repeated rows included; empty
tables give empty results, and without training rows of both kinds all scores are the share of label 1
(0 without any). Only the named columns are read.
"""

from __future__ import annotations

import dataclasses
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lists, map_rows, own_names, prepare
from tidemark.session import stage

SIZES = (3, 4, 5, 6)
BITS = 20
#: Bounds of the fit: training rows, and n-grams with a weight.
SAMPLE = 20_000
FEATURES = 6_000
_BLOCK = 1 << 14


def ngrams(text: str | None, keep: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct n-gram numbers of a text, only those with a mark in ``keep`` if given."""
    if not text:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(b" " + text.lower().encode("utf-8") + b" ", np.uint8).astype(np.uint32)
    rolling = np.zeros(len(raw), np.uint32)
    found = []
    for size in range(1, SIZES[-1] + 1):
        if len(raw) < size:
            break
        # the number of the n-gram that starts at each place
        rolling = rolling[: len(raw) - size + 1] * np.uint32(0x01000193) + raw[size - 1 :] + np.uint32(1)
        if size in SIZES:
            mixed = (rolling ^ np.uint32(size * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            ids = mixed >> np.uint32(32 - BITS)
            found.append(ids if keep is None else ids[keep[ids]])
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)


@dataclasses.dataclass(frozen=True)
class Model:
    """Weights by n-gram number (the product of log-ratio and coefficient) and the intercept."""

    numbers: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        weight = np.zeros(1 << BITS, np.float64)
        weight[self.numbers] = self.weights
        return weight != 0, weight


def _fit(counts: np.ndarray, flat: np.ndarray, labels: np.ndarray, ratio: np.ndarray, ridge: float, steps: int):
    """Logistic regression by accelerated gradient steps with a step size of its own for each feature."""
    row = np.repeat(np.arange(len(counts)), counts)
    value = ratio[flat]
    weight = np.zeros(len(ratio))
    share = labels.mean()
    intercept = float(np.log(share / (1 - share)))
    first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(row, weights=value * weight[flat], minlength=len(counts)) + intercept
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / len(counts)
        slope = np.bincount(flat, weights=value * error[row], minlength=len(ratio)) + ridge * weight
        both = np.append(slope, error.sum())
        first = 0.9 * first + 0.1 * both
        second = 0.99 * second + 0.01 * both**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-12)
        move *= 1 - 0.95 * step / steps
        weight -= move[:-1]
        intercept -= move[-1]
    return weight, intercept


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, train: Column, sample: int) -> DataFrame:
    """(doc, label, text) of the sampled training rows, stored."""
    named = own_names(labels, {"doc": key, "label": label}).where(
        F.col("doc").isNotNull() & F.col("label").isin(0, 1)
    ).where(train)
    # at most ``sample`` ids, so their broadcast has a bound
    chosen = named.groupBy("doc").agg(F.max("label").cast("int").alias("label")).orderBy(
        F.xxhash64("doc"), "doc"
    ).limit(sample)
    texts = own_names(docs, {"doc": key, "text": text}).join(F.broadcast(chosen), "doc")
    # one row for each id, however often it is repeated
    return stage(texts.groupBy("doc", "label").agg(F.min("text").alias("text")), "labelled")


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = 1e-3, steps: int = 150) -> Model:
    """The classifier for ``rows`` (doc, label, text), a bounded sample."""
    prepare(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.uint32)
        sizes = np.zeros(2, np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                seen[label, ngrams(text)] += 1
                sizes[label] += 1
        blocks = range(0, 1 << BITS, _BLOCK)
        packed = [zlib.compress(seen[:, b : b + _BLOCK].tobytes(), 1) for b in blocks]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b // _BLOCK for b in blocks], pa.int32()), pa.array(packed, pa.binary()),
             pa.array([int(sizes[0])] * len(packed), pa.int64()), pa.array([int(sizes[1])] * len(packed), pa.int64())],
            names=["block", "packed", "clean", "toxic"],
        )

    def add(block: pd.DataFrame) -> pd.DataFrame:
        seen = sum(np.frombuffer(zlib.decompress(p), np.uint32).reshape(2, -1).astype(np.int64) for p in block["packed"])
        clean, toxic = int(block["clean"].sum()), int(block["toxic"].sum())
        here = np.flatnonzero(seen.sum(axis=0) >= 3)
        off, on = seen[0, here] + 0.5, seen[1, here] + 0.5
        ratio = np.log(on / (toxic + 1)) - np.log(off / (clean + 1))
        clear = np.abs(ratio) / np.sqrt(1 / on + 1 / off)
        best = np.argsort(-clear, kind="stable")[:features]
        number = here[best] + int(block["block"].iloc[0]) * _BLOCK
        return pd.DataFrame({"number": number, "ratio": ratio[best], "clear": clear[best], "clean": clean, "toxic": toxic})

    counted = rows.select("label", "text").mapInArrow(count, "block int, packed binary, clean bigint, toxic bigint")
    scored = counted.groupBy("block").applyInPandas(
        add, "number bigint, ratio double, clear double, clean bigint, toxic bigint"
    )
    # at most ``features`` rows
    chosen = scored.orderBy(F.desc("clear"), "number").limit(features).toPandas().sort_values("number")
    if chosen.empty or not chosen["clean"].iloc[0] or not chosen["toxic"].iloc[0]:
        # n-grams are too rare to tell, or one label is missing
        share = rows.agg(F.avg("label")).first()[0] or 0.0
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share else -40.0)
        return Model(np.empty(0, np.int64), np.empty(0), float(odds))
    numbers, ratio = chosen["number"].to_numpy(), chosen["ratio"].to_numpy()

    def select(batch):
        keep = np.zeros(1 << BITS, bool)
        keep[numbers] = True
        found = [np.searchsorted(numbers, ngrams(t, keep)) for t in batch.column(1).to_pylist()]
        return [batch.column(0), lists(found, "int32")]

    def train(sample: pd.DataFrame) -> pd.DataFrame:
        counts = sample["found"].map(len).to_numpy()
        flat = np.concatenate(sample["found"].to_list()).astype(np.int64)
        weight, intercept = _fit(counts, flat, sample["label"].to_numpy(float), ratio, ridge, steps)
        return pd.DataFrame({"place": np.append(np.arange(len(weight)), -1), "weight": np.append(weight * ratio, intercept)})

    lean = map_rows(rows.select("label", "text"), select, "label int, found array<int>")
    # the sample is bounded, and so are its rows of kept n-grams: one task fits
    fitted = lean.groupBy(F.lit(0).alias("all")).applyInPandas(train, "place bigint, weight double").toPandas()
    fitted = fitted.sort_values("place")["weight"].to_numpy()
    return Model(numbers, fitted[1:], float(fitted[0]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` of every text; nothing is shuffled."""
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(own_names(docs, {"key": key, "text": text}), scorer(model), f"`{key}` {kind}, score double")


def scorer(model: Model):
    kept: list = []

    def work(batch):
        if not kept:
            kept.append(model.table())
        keep, weight = kept[0]
        margin = np.array([weight[ngrams(t, keep)].sum() for t in batch.column(1).to_pylist()]) + model.intercept
        return [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margin, -40, 40))))]

    return work


def held_out(key: Column) -> Column:
    """Rows that no classifier may learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
