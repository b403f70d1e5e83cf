"""Toxicity by a linear-chain conditional random field over words.

States: clean and toxic. A word's potential comes from hashed features (the word, its beginnings and its end); transitions
and the start are parameters of their own. Words get their training tags from labelled documents: in a toxic one, words
that toxic training documents hold more often than chance allows. Maximum likelihood by gradient steps; forward-backward
gives each word's marginal. A document's score is a logistic map of its words' marginals, fitted on training labels;
runs of words with marginals of at least one half are the offending spans, with their offsets.

Forward-backward runs over many texts at once: laid end to end, cut into columns, the columns' 2 x 2 products chained.
"""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meridian.llm.common import fresh, frugal, held_out, sampled, table, training_rows

TOKEN = re.compile(r"\w+")
#: Steps of a drawn share.
PARTS = 1_000_003
SPANS = "array<struct<start:int,stop:int,score:double>>"


@dataclass(frozen=True)
class Settings:
    """toxic, clean: bounds of the training samples in documents; counted: of the clean ones whose words are counted only.

    document_bytes: of a training document at most. label_bytes: of the training documents of one label, about.

    buckets: of hashed features. chance: how many words may be tagged by chance, of all that are tried (Chernoff's bound);
    near copies count once.
    """

    toxic: int = 1000
    clean: int = 1500
    counted: int = 4500
    document_bytes: int = 1 << 20
    label_bytes: int = 48 << 20
    buckets: int = 1 << 18
    chance: float = 0.5
    steps: int = 60
    rate: float = 0.1
    decay: float = 1e-5
    threshold: float = 0.7
    run: int = 1 << 17
    cache: int = 200_000


@dataclass(frozen=True)
class Model:
    """weights by feature bucket; bias of the toxic state; trans[i, j], start[j] as factors; document: of the document map."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray
    start: np.ndarray
    document: tuple[float, ...]


def hashed(word: str, buckets: int) -> list[int]:
    """The word, its first 4 to 7 letters and its last 4, where longer than that."""
    data = [f"={word}"] + [f"^{word[:k]}" for k in (4, 5, 6, 7) if len(word) >= k] + ([f"${word[-4:]}"] if len(word) > 4 else [])
    return [zlib.crc32(x.encode("utf-8", "replace")) % buckets for x in data]


def forward_backward(potential: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, edges: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
    """potential (n,): factor of the toxic state (clean: 1). first (n,): where a chain begins.

    -> marginals of the toxic state (n,), expected transitions (2, 2) if ``edges``, log-partition.
    """
    n = len(potential)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    length = max(1, int(math.sqrt(n)))
    cols = -(-n // length)
    e = np.ones((2, cols * length))
    e[1, :n] = potential
    begin = np.ones(cols * length, bool)
    begin[:n] = first
    m = np.empty((2, 2, cols * length))
    for i in range(2):
        for j in range(2):
            m[i, j] = np.where(begin, start[j], trans[i, j]) * e[j]
    m = np.ascontiguousarray(m.reshape(2, 2, cols, length).transpose(3, 0, 1, 2))
    whole = np.stack([np.stack([np.ones(cols), np.zeros(cols)]), np.stack([np.zeros(cols), np.ones(cols)])])
    for t in range(length):
        x = m[t]
        whole = np.stack([whole[:, 0] * x[0, 0] + whole[:, 1] * x[1, 0], whole[:, 0] * x[0, 1] + whole[:, 1] * x[1, 1]], axis=1)
        whole = whole / whole.sum(axis=(0, 1))
    ahead, behind = np.empty((2, cols)), np.empty((2, cols))
    a0, a1 = 1.0, 0.0
    products = whole.transpose(2, 0, 1).tolist()
    for c, ((p, q), (r, s)) in enumerate(products):
        ahead[:, c] = a0, a1
        a0, a1 = a0 * p + a1 * r, a0 * q + a1 * s
        a0, a1 = a0 / (a0 + a1), a1 / (a0 + a1)
    b0, b1 = 1.0, 1.0
    for c in range(cols - 1, -1, -1):
        behind[:, c] = b0, b1
        (p, q), (r, s) = products[c]
        b0, b1 = p * b0 + q * b1, r * b0 + s * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    alpha, beta = np.empty((length, 2, cols)), np.empty((length, 2, cols))
    log_z, a = 0.0, ahead
    scale = np.empty((length, cols))
    for t in range(length):
        x = m[t]
        a = np.stack([a[0] * x[0, 0] + a[1] * x[1, 0], a[0] * x[0, 1] + a[1] * x[1, 1]])
        scale[t] = a.sum(axis=0)
        alpha[t] = a = a / scale[t]
    log_z = float(np.log(scale.T.reshape(-1)[:n]).sum())
    b = behind
    for t in range(length - 1, -1, -1):
        beta[t] = b
        x = m[t]
        b = np.stack([x[0, 0] * b[0] + x[0, 1] * b[1], x[1, 0] * b[0] + x[1, 1] * b[1]])
        b = b / b.sum(axis=0)
    own = alpha * beta
    p = (own[:, 1] / own.sum(axis=1)).T.reshape(-1)[:n]
    expected = np.zeros((2, 2))
    if edges:
        before, inside = ahead, ~begin.reshape(cols, length).T
        for t in range(length):
            edge = before[:, None] * m[t] * beta[t][None]
            expected += (edge / edge.sum(axis=(0, 1)))[..., inside[t]].sum(axis=2)
            before = alpha[t]
    return p, expected, log_z


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (weight * (q - y)) + 1e-2 * b)
        b = b - step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
    return b


def _summary(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(documents, 4): logs of the expected toxic words and of their share, logit of the largest marginal, 1."""
    starts = np.concatenate([[0], ends[:-1]])
    some = np.nonzero(ends > starts)[0]
    total, most = np.zeros(len(ends)), np.zeros(len(ends))
    if len(some):
        total[some], most[some] = np.add.reduceat(p, starts[some]), np.maximum.reduceat(p, starts[some])
    most = np.clip(most, 1e-4, 1 - 1e-4)
    share = (total + 1e-2) / (np.diff(ends, prepend=0) + 20)
    return np.stack([np.log(total + 1e-2), np.log(share), np.log(most / (1 - most)), np.ones(len(ends))], axis=1)


def _runs(ends: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """(first document, last, first word, last) of runs of whole documents, of ``size`` words or one document."""
    out, at = [], 0
    while at < len(ends):
        begin = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + size, "right")))
        out.append((at, to, begin, int(ends[to - 1])))
        at = to
    return out


def _cluster(words: list[str]) -> int:
    """The least hash of a text's five-word shingles: near copies mostly share it."""
    return min((zlib.crc32(" ".join(words[i : i + 5]).encode("utf-8", "replace")) for i in range(max(1, len(words) - 4))), default=0)


def telling_words(texts: list[str | None], labels: list[int], s: Settings) -> set[str]:
    """Words that toxic documents hold more often than chance allows; near copies of one label count once."""
    seen: set[tuple[int, int]] = set()
    counts: dict[str, list[int]] = {}
    many = [0, 0]
    for label in (1, 0):
        for text, own in zip(texts, labels):
            if own != label:
                continue
            words = words_of(text)
            key = (label, _cluster(words))
            if key in seen:
                continue
            seen.add(key)
            many[label] += 1
            for w in set(words):
                if label:
                    counts.setdefault(w, [0, 0])[1] += 1
                elif w in counts:
                    counts[w][0] += 1
        if label:
            counts = {w: c for w, c in counts.items() if c[1] > 2}
    if not all(many):
        return set()
    base, least, out = many[1] / sum(many), math.log(max(1, len(counts)) / s.chance), set()
    for w, (clean, toxic) in counts.items():
        n, share = clean + toxic, toxic / (clean + toxic)
        if share > max(0.5, base):
            gap = share * math.log(share / base) + (1 - share) * math.log((1 - share) / (1 - base) if share < 1 else 1)
            if n * gap >= least:
                out.add(w)
    return out


def fit(texts: list[str | None], labels: list[int], s: Settings) -> Model | None:
    """Whole texts and their labels, both among them; None otherwise, or where no word tells them apart."""
    if set(labels) != {0, 1} or not (tags := telling_words(texts, labels, s)):
        return None
    names: dict[str, int] = {}
    word_lists, used_labels, clean = [], [], 0
    for text, k in zip(texts, labels):
        clean += k == 0
        if k or clean <= s.clean:
            word_lists.append(np.array([names.setdefault(w, len(names)) for w in words_of(text)], np.int32))
            used_labels.append(k)
    label = np.array(used_labels, np.int64)
    weight = np.where(label == 1, 1.0, clean / max(1, min(clean, s.clean)))
    telling = np.array([w in tags for w in names])
    sizes = np.array([len(x) for x in word_lists])
    word, ends = np.concatenate(word_lists), np.cumsum(sizes)
    first = np.zeros(len(word), bool)
    first[(ends - sizes)[sizes > 0]] = True
    tagged = telling[word] & np.repeat(label == 1, sizes)
    of = [hashed(w, s.buckets) for w in names]
    row = np.repeat(np.arange(len(of)), [len(x) for x in of])
    used, col = np.unique(np.concatenate([np.array(x) for x in of]), return_inverse=True)
    n_names, n_w, runs = len(names), len(used), _runs(ends, s.run)
    del names, of, word_lists
    seen_word = np.bincount(word[tagged], minlength=n_names).astype(float)
    seen_edge = np.zeros((2, 2))
    np.add.at(seen_edge, (tagged[:-1][~first[1:]].astype(int), tagged[1:][~first[1:]].astype(int)), 1)
    seen_start = np.bincount(tagged[first].astype(int), minlength=2).astype(float)
    guess = np.array([[0.95, 0.05], [0.5, 0.5], [0.95, 0.05]])
    theta = np.concatenate([np.zeros(n_w), [-4.0], np.log(guess).ravel()])
    unpack = lambda t: (t[:n_w], t[n_w], np.exp(t[n_w + 1 : n_w + 5].reshape(2, 2)), np.exp(t[n_w + 5 :]))
    potentials = lambda w, bias: np.exp(np.clip(np.bincount(row, weights=w[col], minlength=n_names) + bias, -30, 30))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, s.steps + 1):
        w, bias, trans, start = unpack(theta)
        score, d_word, d_edge, d_start = potentials(w, bias), -seen_word, -seen_edge, -seen_start
        for _, _, a, b in runs:
            p, edge, _ = forward_backward(score[word[a:b]], first[a:b], trans, start, True)
            d_word = d_word + np.bincount(word[a:b], weights=p, minlength=n_names)
            begun = p[first[a:b]]
            d_edge, d_start = d_edge + edge, d_start + np.array([(1 - begun).sum(), begun.sum()])
        g = np.concatenate([np.bincount(col, weights=d_word[row], minlength=n_w), [d_word.sum()], d_edge.ravel(), d_start]) / max(1, tagged.sum())
        g[:n_w] += s.decay * theta[:n_w]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w, bias, trans, start = unpack(theta)
    full = np.zeros(s.buckets, np.float32)
    full[used] = w
    score = potentials(w, bias)
    told = [_summary(forward_backward(score[word[a:b]], first[a:b], trans, start)[0], ends[i:j] - a) for i, j, a, b in runs]
    document = _logistic(np.concatenate(told), label.astype(float), weight)
    return Model(full, float(bias), trans, start, tuple(map(float, document)))


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words of ``words_of`` stand in the text as it is written; a lower-case form can be longer than its letter."""
    low = text.lower()
    spans = [m.span() for m in TOKEN.finditer(low)]
    if len(low) == len(text):
        return spans
    ends = np.cumsum([len(c.lower()) for c in text])
    return [(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b - 1, "right")) + 1) for a, b in spans]


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model | None:
    """A model from labelled documents of the training folds, within the bounds of ``s`` in rows and bytes; None without both labels."""
    known = training_rows(labels=labels, docs=docs, label="toxic").cache()
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [sampled(known.where(f"label = {k}"), n, counts.get(k, 0), f"toxic{k}") for k, n in ((1, s.toxic), (0, s.clean + s.counted))]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = docs.select("doc_id", text.alias("text"), F.octet_length(text).alias("bytes"), F.md5(text.cast("binary")).alias("digest")).join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").where(F.col("bytes") <= s.document_bytes)
    one = mine.groupBy("doc_id", "label").agg(F.min(F.struct("digest", "bytes")).alias("m")).select("doc_id", "label", "m.digest", "m.bytes")
    totals = {r.label: r.n for r in one.groupBy("label").agg(F.sum("bytes").alias("n")).collect()}
    share = {k: min(1.0, s.label_bytes / max(1, n)) for k, n in totals.items()}
    drawn = F.pmod(F.xxhash64(F.lit("toxic-bytes"), F.col("doc_id")), F.lit(PARTS))
    fits = [(F.col("label") == k) & (drawn < int(PARTS * x)) for k, x in share.items()]
    fit_in = one.where(reduce(operator.or_, fits, F.lit(False))).select("doc_id", "digest")
    rows = mine.join(F.broadcast(fit_in), ["doc_id", "digest"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label").toArrow()
    known.unpersist()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows["text"].to_pylist(), rows["label"].to_pylist(), s)


class Tagger:
    """Marginals of many texts; keeps the potentials of words it has met, up to a bound."""

    def __init__(self, model: Model, s: Settings):
        self.model, self.s, self.known = model, s, {}

    def _potential(self, word: str) -> float:
        score = sum(self.model.weights[hashed(word, self.s.buckets)]) + self.model.bias
        if len(self.known) >= self.s.cache:
            self.known.clear()
        self.known[word] = out = math.exp(min(30.0, max(-30.0, float(score))))
        return out

    def marginals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All words' marginals, and where each text's words end."""
        get, new, all_words, ends = self.known.get, self._potential, [], []
        for t in texts:
            all_words += [get(w) or new(w) for w in words_of(t)]
            ends.append(len(all_words))
        ends = np.array(ends, np.int64)
        first = np.zeros(len(all_words), bool)
        first[np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]] = True
        p, _, _ = forward_backward(np.array(all_words), first, self.model.trans, self.model.start)
        return p, ends

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        p, ends = self.marginals(texts)
        score = 1 / (1 + np.exp(-np.clip(_summary(p, ends) @ np.array(self.model.document), -50, 50)))
        spans: list[list[dict]] = [[] for _ in texts]
        hits = np.nonzero(p >= 0.5)[0]
        for d in np.unique(np.searchsorted(ends, hits, "right")):
            own = p[ends[d - 1] if d else 0 : ends[d]]
            at = word_spans(texts[d])
            for i in np.nonzero(own >= 0.5)[0]:
                if spans[d] and spans[d][-1]["last"] == i - 1:
                    spans[d][-1] |= {"stop": at[i][1], "score": max(spans[d][-1]["score"], float(own[i])), "last": i}
                else:
                    spans[d].append({"start": at[i][0], "stop": at[i][1], "score": float(own[i]), "last": i})
        return score, [[{k: x[k] for k in ("start", "stop", "score")} for x in own] for own in spans]


def scored(docs: DataFrame, model: Model | None, keep: list[str] | None = None, s: Settings = Settings(), out: tuple[str, str] = ("toxicity", "spans")) -> DataFrame:
    """The columns ``keep`` (all, by default), toxicity (0 to 1) and spans (offsets in characters of the text), named by ``out``.

    Without a model: 0 and no spans. Null and empty texts get the score of a text without words.
    """
    keep = keep or docs.columns
    names = [f"c{i}" for i in range(len(keep))]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        tagger = Tagger(model, s) if model else None
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            score, spans, at, chars = [np.zeros(0 if model else len(texts))], [] if model else [[] for _ in texts], 0, 0
            for i, t in enumerate(texts if model else []):
                chars += len(t or "")
                if chars >= s.run * 6 or i == len(texts) - 1:
                    a, b = tagger.scores(texts[at : i + 1])
                    score.append(a)
                    spans += b
                    at, chars = i + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(score)), pa.array(spans, kind)], [*names, "toxicity", "spans"])

    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col("text").cast("string").alias("__text"))
    kinds = StructType([*[StructField(n, f.dataType) for n, f in zip(names, docs.select(*[F.col(f"`{c}`") for c in keep]).schema)], StructField("toxicity", DoubleType()), *StructType.fromDDL(f"spans {SPANS}")])
    return plain.mapInArrow(run, kinds).toDF(*keep, *out)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents. Null and empty texts get the score of a text without words, well under the threshold; repeated
    and null doc_ids keep a row each, a null one is not held out; an empty table gives no rows; other columns are ignored."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    s = Settings()
    found = scored(docs, train(docs, labels, s), ["doc_id"], s)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= s.threshold).cast("int").alias("predicted"), F.size("spans").alias("n_spans"),
        F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))).alias("offsets"),
    )


def kept(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents whose score stays under the threshold, with their own columns, whatever those are called.

    Null and empty texts stay, repeated rows too; without labels of both kinds all documents do.
    """
    names, out = docs.columns, (fresh(docs, "toxicity"), fresh(docs, "spans"))
    found = scored(docs, train(docs, labels, s), None, s, out)
    return found.where(F.col(out[0]) < s.threshold).select(*[F.col(f"`{n}`") for n in names])
