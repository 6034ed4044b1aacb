"""Toxicity scores (operator 7): subword bags averaged into a linear softmax over short windows of a text.

A few words make a text toxic, however long it is, so the average is taken over windows of some words rather than
over the whole text, and a text's score comes from its worst window. Windows first inherit their text's label;
afterwards the windows of a toxic text that look harmless count as harmless, and training goes on. A logistic
regression on texts held back from that training, on the worst window's margin and the number of windows, turns the
margin into a probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import is_held_out, map_arrow, most_of, sample_rows, texts_of
from rillsync.llm.subword_bag import Bag, buffer, logistic, segments, train

#: Labelled texts the model is fitted on at most, and characters of such a text at most (longer ones are not sampled).
SAMPLE_ROWS, SAMPLE_CHARS = 8_000, 16_384
#: Half a window, in bytes; windows overlap by half.
HALF = 64
THRESHOLD = 0.7


@dataclass
class Model:
    bag: Bag | None
    weights: np.ndarray  # of the worst margin, the logarithm of the number of windows, and one
    prior: float

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Worst margin and number of windows of each text; 0 windows where a text has no subword."""
        data, starts = buffer(texts)
        at, owner = segments(starts, HALF)
        total, count = self.bag.sums(data, at, int(starts[-1]))
        margin = total[:, 0]
        same = np.append(owner[1:] == owner[:-1], False)
        after = np.where(same, np.roll(margin, -1), 0.0), np.where(same, np.roll(count, -1), 0)
        m, c = margin + after[0], count + after[1]
        # the last half of a longer text is no window by itself
        tail = ~same & np.append(False, owner[1:] == owner[:-1])
        value = np.where((c > 0) & ~tail, m / np.maximum(c, 12) + self.bag.bias[0], -np.inf)
        first = np.searchsorted(owner, np.arange(len(texts)))
        return np.maximum.reduceat(value, first), np.add.reduceat(np.isfinite(value).astype(int), first)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.bag is None or not texts:
            return np.full(len(texts), self.prior)
        worst, n = self.features(texts)
        x = np.stack([np.where(n > 0, worst, 0), np.log1p(n), np.ones(len(n))], 1)
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))), self.prior)


def fit(
    texts: list[str], labels: list[int], bits: int = 18, dims: int = 2, sizes: tuple[int, ...] = (3, 4, 5, 6),
    seed: int = 7
) -> Model:
    """Fit on labelled texts (1 is toxic). Without both labels the score is the share of toxic texts (0 for none)."""
    y = np.array(labels, np.int64)
    prior = float(y.mean()) if len(y) else 0.0
    if len(set(labels)) < 2 or len(labels) < 8:
        return Model(None, np.zeros(3), prior)
    rng = np.random.default_rng(seed)
    back = rng.random(len(y)) < 0.3
    if len(set(y[back])) < 2 or len(set(y[~back])) < 2:
        back = np.arange(len(y)) % 3 == 0
    fitted = [texts[i] for i in np.flatnonzero(~back)]
    label = y[~back]
    data, starts = buffer(fitted)
    at, owner = segments(starts, 2 * HALF)
    end, target = int(starts[-1]), label[owner]
    share = max(1e-3, target.mean())
    weight = np.where(target == 1, min(10.0, 0.5 / share), 1.0)
    epochs = min(40, max(3, math.ceil(300_000 / max(1, len(at)))))
    _, state = train(data, at, end, target, weight, 2, sizes, bits, dims, epochs, 0.3, seed)
    for _ in range(2):
        emb, out, bias, _seen = state
        margin_bag = Bag(
            (emb @ (out[:, 1:] - out[:, :1])).astype(np.float32), np.array([bias[1] - bias[0]], float), sizes, bits
        )
        total, count = margin_bag.sums(data, at, end)
        margin = total[:, 0] / np.maximum(count, 12) + margin_bag.bias[0]
        # a toxic text's windows count as toxic where they stand out from those of the clean texts
        line = np.quantile(margin[target == 0], 0.99)
        looks = (margin > line) & (label[owner] == 1)
        if not looks.any():
            break
        target = looks.astype(np.int64)
        weight = np.where(target == 1, min(30.0, 0.5 / max(1e-3, target.mean())), 1.0)
        _, state = train(data, at, end, target, weight, 2, sizes, bits, dims, max(1, epochs // 3), 0.3, seed + 1, state)
    emb, out, bias, _seen = state
    model = Model(
        Bag((emb @ (out[:, 1:] - out[:, :1])).astype(np.float32), np.array([bias[1] - bias[0]], float), sizes, bits),
        np.zeros(3), prior
    )
    worst, n = model.features([texts[i] for i in np.flatnonzero(back)])
    ok = n > 0
    model.weights = logistic(np.stack([worst[ok], np.log1p(n[ok]), np.ones(ok.sum())], 1), y[back][ok])
    return model


def fit_from_labels(
    documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> Model:
    """Fit on a sample of about `rows` labelled texts of at most `chars` characters, outside the held-out fold. Null
    labels and texts, and documents whose labels contradict one another, are left out."""
    known = labels.select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    ).where("toxic in (0, 1) and doc_id is not null")
    known = known.where(~is_held_out()).groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("most")
    )
    known = known.where("toxic = most").select("doc_id", "toxic")
    # a bounded sample of the labels is broadcast: the texts are filtered where they lie
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= chars))
    got = texts.join(F.broadcast(sample_rows(known, "doc_id", rows)), "doc_id").limit(most_of(rows)).collect()
    return fit([r.text for r in got], [r.toxic for r in got])


def score_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `documents`: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Null and wordless texts get the share of toxic texts in the sample as their score. Repeated rows and null ids
    give a row each; other columns are ignored; an empty table gives no rows; texts of any length are scored whole.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        return pa.table(
            {"doc_id": table.column("doc_id"), "score": pa.array(shared.value.scores(texts_of(table)), pa.float64())}
        )

    scored = map_arrow(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double",
        rows=512
    )
    return scored.select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `documents` whose text is not predicted toxic, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        return table.filter(pa.array(shared.value.scores(texts_of(table)) < threshold))

    return map_arrow(documents, run, documents.schema, rows=512)
