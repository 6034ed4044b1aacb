"""Language identification (operator 4): averaged hashed subword embeddings with a linear softmax, trained by
stochastic gradient descent in numpy; a temperature fitted on texts held back calibrates the scores, and scores
under a line chosen on the same texts are marked as rejected."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import is_held_out, map_arrow, sample_texts, texts_of
from rillsync.llm.subword_bag import Bag, buffer, segments, train

#: Texts the model is fitted on at most, and characters of such a text at most (longer ones are not sampled).
SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 16_384
#: Bytes of a training segment.
SEGMENT = 192
UNKNOWN = "und"


@dataclass
class Model:
    bag: Bag | None
    languages: list[str]
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> np.ndarray:
        data, starts = buffer(texts)
        at, owner = segments(starts, 4096)
        total, count = self.bag.sums(data, at, int(starts[-1]))
        first = np.searchsorted(owner, np.arange(len(texts)))
        return np.add.reduceat(total, first, axis=0) / np.maximum(
            np.add.reduceat(count, first), 1
        )[:, None] + self.bag.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated score of each text; UNKNOWN and 0 without a letter or a model."""
        if self.bag is None or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        z = self.logits(texts) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        lettered = np.array([any(map(str.isalpha, t)) for t in texts])
        best = p.argmax(1)
        return [
            self.languages[b] if a else UNKNOWN for a, b in zip(lettered, best, strict=True)
        ], np.where(lettered, p.max(1), 0.0)


def fit(
    texts: list[str], langs: list[str], bits: int = 16, dims: int = 8, sizes: tuple[int, ...] = (2, 3, 4),
    precision: float = 0.99, seed: int = 5
) -> Model:
    """Fit on texts of known language. reject_below is the least score at which, on the texts held back, at least
    `precision` of the predictions at or above it are right."""
    languages = sorted(set(langs))
    if not languages:
        return Model(None, [], 1.0, 0.0)
    y = np.array([languages.index(x) for x in langs])
    back = np.random.default_rng(seed).random(len(y)) < 0.25
    if back.all() or not back.any():
        back = np.zeros(len(y), bool)
    chosen = np.flatnonzero(~back)
    data, starts = buffer([texts[i] for i in chosen])
    at, owner = segments(starts, SEGMENT)
    n = np.bincount(owner)
    # every text counts the same however long it is, and every language as much as its texts
    weight = (1.0 / n)[owner] * len(at) / len(chosen)
    epochs = min(12, max(1, math.ceil(60_000 / max(1, len(at)))))
    bag, _ = train(
        data, at, int(starts[-1]), y[chosen][owner], np.minimum(weight, 20), len(languages), sizes, bits, dims, epochs,
        0.1, seed
    )
    model = Model(bag, languages, 1.0, 0.0)
    if back.any():
        z, t = model.logits([texts[i] for i in np.flatnonzero(back)]), y[back]

        def loss(scale: float) -> float:
            w = z / scale
            w = w - w.max(1, keepdims=True)
            return float(np.mean(np.log(np.exp(w).sum(1)) - w[np.arange(len(t)), t]))

        model.temperature = min(np.geomspace(0.05, 20, 121), key=loss)
        w = z / model.temperature
        p = np.exp(w - w.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        order = np.argsort(-p.max(1))
        right = np.cumsum((p.argmax(1) == t)[order]) / np.arange(1, len(t) + 1)
        good = np.flatnonzero(right >= precision)
        model.reject_below = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def fit_from_documents(documents: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a sample of about `rows` texts of known language, of at most `chars` characters, outside the held-out
    fold."""
    known = documents.select("doc_id", "text", "lang").where(
        "lang is not null and doc_id is not null"
    ).where(~is_held_out())
    got = sample_texts(known, rows, chars)
    return fit([r.text for r in got], [r.lang for r in got])


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """Per row of `documents`: doc_id, held_out, lang_pred, score (0 to 1), rejected.

    Null texts and texts without a letter get `und`, score 0, rejected. Repeated rows and null ids give a row each;
    columns other than doc_id and text are not read; an empty table gives no rows; texts are read whole.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        model = shared.value
        langs, scores = model.predict(texts_of(table))
        rejected = [g == UNKNOWN or s < model.reject_below for g, s in zip(langs, scores, strict=True)]
        return pa.table(
            {
                "doc_id": table.column("doc_id"), "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_())
            }
        )

    found = map_arrow(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
        "doc_id long, lang_pred string, score double, rejected boolean", rows=512
    )
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "rejected")
