"""Quality classifier by positive-unlabelled learning.

A linear scorer over the byte-class shape of a text is trained on trusted positives and unlabelled web text by the
non-negative unbiased risk (Kiryo et al., 2017): prior * E_P[loss+] + max(0, E_U[loss-] - prior * E_P[loss-]). Whenever
the bracket goes negative, its gradient is reversed. The class prior is estimated from the same two samples by best bin
estimation (Garg et al., 2021). The loss is logistic, so the score's logistic map is the probability of the positive class
among the unlabelled texts. Negative labels are not used.

Features are computed over whole texts on the executors and don't look at labels, language, source or id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meridian.llm.common import fresh, frugal, held_out, sampled, table, training_rows

#: Classes of bytes: other control characters, then lower case, upper case, digit, space, line end, full stop and comma, ! and ?,
#: symbols, brackets and rules, bytes beyond ASCII, other punctuation.
CLASSES = 12
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,", b"!?", b"#$%&*@^~", b"|<>{}[]()/\\=_+")
FEATURES = CLASSES**3 + 4


@dataclass(frozen=True)
class Settings:
    """Bounds of the samples that the model is fitted on, in rows, and of the training; chance, slack: of the prior's estimate."""

    positives: int = 3000
    unlabelled: int = 6000
    steps: int = 400
    rate: float = 0.02
    decay: float = 1e-3
    least_share: float = 0.002
    threshold: float = 0.5
    chance: float = 0.1
    slack: float = 0.01


@dataclass(frozen=True)
class Model:
    """Weights of the used, standardised features and the intercept; the class prior they were trained with."""

    used: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x[:, self.used] - self.mean) / self.scale, -5, 5)
        return z @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.raw(x))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _classes() -> np.ndarray:
    of = np.zeros(256, np.int32)
    of[33:127] = 11
    of[128:] = 10
    for k, group in enumerate(_GROUPS):
        of[list(group)] = k + 1
    return of


_CLASS_OF = _classes()


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of byte-class trigrams; repeated neighbours, repeated lines, distinct words, length."""
    text = text or ""
    data = _CLASS_OF[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    out = np.zeros(FEATURES, np.float32)
    if len(data) > 2:
        trigrams = (data[:-2] * CLASSES + data[1:-1]) * CLASSES + data[2:]
        out[: CLASSES**3] = np.sqrt(np.bincount(trigrams, minlength=CLASSES**3) / len(trigrams))
    words = text.split()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    n = max(1, len(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    out[CLASSES**3 :] = (repeats / n) ** 0.5, 1 - len(set(lines)) / max(1, len(lines)), len(set(words)) / n, min(1.0, n / 50)
    return out


def _gathered(docs: DataFrame) -> np.ndarray:
    """(text) of a bounded sample -> features, on the driver, in an order that partitions don't change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            packed = [features(t).astype(np.float16).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["x"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "x binary").toArrow()
    return np.frombuffer(b"".join(sorted(rows["x"].to_pylist())), np.float16).reshape(-1, FEATURES).astype(np.float32)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, s: Settings) -> Model:
    """A scorer from features of both samples and the class prior among the unlabelled."""
    used = np.nonzero((unlabelled > 0).mean(axis=0) > s.least_share)[0] if len(unlabelled) else np.arange(1)
    mean, scale = unlabelled[:, used].mean(axis=0), unlabelled[:, used].std(axis=0) + 1e-3
    ready = lambda a: np.hstack([np.clip((a[:, used] - mean) / scale, -5, 5), np.ones((len(a), 1), np.float32)])
    p, u = ready(positive), ready(unlabelled)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, s.steps + 1):
        sp, su = p @ w, u @ w
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        plus = -prior * (_sigmoid(-sp) @ p) / len(p)
        minus = (_sigmoid(su) @ u) / len(u) - prior * (_sigmoid(sp) @ p) / len(p)
        g = (plus + minus if negative >= 0 else -minus) + s.decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(used, mean, scale, w, prior)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, s: Settings) -> float:
    """The share of positives among the unlabelled: the least ratio of how many of either sample score above a threshold.

    A scorer is trained on one half of each sample and the ratio taken on the other, both ways, and averaged. The threshold
    is that of the least upper confidence bound. Held to 0.05 .. 0.98.
    """
    rng = np.random.default_rng(17)
    p, u = positive[rng.permutation(len(positive))], unlabelled[rng.permutation(len(unlabelled))]
    halves = [(p[::2], u[::2], p[1::2], u[1::2]), (p[1::2], u[1::2], p[::2], u[::2])]
    found = []
    for own_p, own_u, other_p, other_u in halves:
        if not (len(own_p) and len(own_u) and len(other_p) and len(other_u)):
            continue
        model = fit(own_p, own_u, 0.5, s)
        sp, su = np.sort(model.raw(other_p)), np.sort(model.raw(other_u))
        at = np.unique(np.concatenate([sp, su]))
        above_p, above_u = 1 - np.searchsorted(sp, at) / len(sp), 1 - np.searchsorted(su, at) / len(su)
        at, above_p, above_u = at[above_p > 0], above_p[above_p > 0], above_u[above_p > 0]
        wide = np.sqrt(np.log(4 / s.chance) / 2) * (len(sp) ** -0.5 + len(su) ** -0.5)
        best = np.argmin((above_u + (1 + s.slack) * wide) / above_p)
        found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.05, 0.98)) if found else 0.5


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model | None:
    """A model from documents labelled 1 and unlabelled text, both of the training folds; None without either."""
    known = training_rows(labels=labels, docs=docs, label="quality").where("label = 1").cache()
    n_good = known.count()
    if not n_good:
        known.unpersist()
        return None
    good = sampled(known, s.positives, n_good, "positive")
    web = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    p = _gathered(docs.select("doc_id", "text").join(F.broadcast(good), "doc_id"))
    u = _gathered(sampled(web, s.unlabelled, web.count(), "web"))
    known.unpersist()
    if not len(p) or not len(u):
        return None
    return fit(p, u, estimated_prior(p, u, s), s)


def scored(docs: DataFrame, model: Model | None, keep: list[str] | None = None, out: str = "quality") -> DataFrame:
    """The columns ``keep`` (all, by default) and ``out`` (0 to 1) of the whole text; 0.5 without a model."""
    keep = keep or docs.columns
    names = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            texts, out = batch.column(len(names)).to_pylist(), np.full(batch.num_rows, 0.5)
            for at in range(0, len(texts) if model else 0, 256):
                out[at : at + 256] = model.score(np.stack([features(t) for t in texts[at : at + 256]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out)], [*names, "quality"])

    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col("text").cast("string").alias("__text"))
    kinds = StructType([*[StructField(n, f.dataType) for n, f in zip(names, docs.select(*[F.col(f"`{c}`") for c in keep]).schema)], StructField("quality", DoubleType())])
    return plain.mapInArrow(run, kinds).toDF(*keep, out)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents: null and empty texts too; repeated rows stay. A null doc_id is not held out, an empty table gives
    no rows, other columns are ignored, and without a positive label every score is 0.5."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    s = Settings()
    found = scored(docs, train(docs, labels, s), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality").alias("score"), (F.col("quality") >= s.threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns, whatever those are called.

    Null and empty texts are scored like any other, repeated rows stay; without a positive label all documents do.
    """
    names, score = docs.columns, fresh(docs, "quality")
    found = scored(docs, train(docs, labels, s), None, score)
    return found.where(F.col(score) >= s.threshold).select(*[F.col(f"`{n}`") for n in names])
