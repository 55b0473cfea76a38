"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (64 words each).  Every passage is encoded
as a vector of style features: frequencies of byte-class pairs, word
lengths, repetition.  A small network embeds each passage, gated attention
gives it a weight, and the weighted sum of the embeddings is scored:

    h = tanh(W x),   a = softmax(w . (tanh(V h) * sigmoid(U h))),   score = sigmoid(c . sum(a h))

All weights are learned together from document labels; no passage is
labelled.  Training takes at most ``max_docs`` labelled documents (those
with the smallest hash of their id) and at most ``max_passages`` of each,
spread evenly; both bounds are parameters and hold for fitting alone.
Passages are encoded on the executors, in training as in scoring, and every
document is scored on all its passages.  A task scores the documents it
reads: there is no shuffle.

Edge cases: null, empty and blank texts are a bag of one empty passage and
get a score like any other; null or other labels than 0 and 1 are ignored;
without labelled rows of both kinds the score is the share of label 1 (0.5
without any); repeated rows are scored each on their own, null ids stay
null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, trimmed
from tablegauge.llm.wordhash import Words

#: Bytes of text that are scored at a time beside rows that pass through: their features take ten times that.
_BLOCK = 2 << 20

PASSAGE_WORDS = 64

#: Byte classes: blank, line break, lower, upper, digit, stop, comma, mark, symbol, bracket or quote, other, non-ASCII.
_CLASSES = [" \t\x0b\x0c", "\n\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?;:",
            "#*$%&|<>", "()[]{}\"'"]
_N = len(_CLASSES) + 2
_CLASS = np.full(256, _N - 2, np.int64)
_CLASS[128:] = _N - 1
for _i, _s in enumerate(_CLASSES):
    _CLASS[list(_s.encode())] = _i
N_FEATURES = _N * _N + 6


def encode(text: bytes) -> np.ndarray:
    """Feature vectors of a text's passages, ``(passages, N_FEATURES)``."""
    words = Words(pa.array([text], pa.binary()))
    data = np.frombuffer(text, np.uint8)
    total = len(words.hash)
    if not total:
        return np.zeros((1, N_FEATURES), np.float32)
    at = words.places
    heads = at[::PASSAGE_WORDS]
    n = len(heads)
    ends = np.append(heads[1:], len(data))
    size = ends - heads
    kind = _CLASS[data[heads[0]:]]
    passage = np.repeat(np.arange(n), size)
    pair = kind[:-1] * _N + kind[1:]
    out = np.zeros((n, N_FEATURES), np.float32)
    counts = np.bincount(passage[:-1] * (_N * _N) + pair, minlength=n * _N * _N).reshape(n, -1)
    out[:, :_N * _N] = np.sqrt(counts / size[:, None])
    of = np.arange(total) // PASSAGE_WORDS
    each = np.bincount(of, minlength=n)
    length = np.diff(np.append(at, len(data))) - 1
    mean = np.bincount(of, length, n) / each
    order = np.lexsort((words.hash, of))
    h, p = words.hash[order], of[order]
    distinct = np.bincount(p, np.append(True, (h[1:] != h[:-1]) | (p[1:] != p[:-1])), n)
    same = np.append(False, words.hash[1:] == words.hash[:-1])
    out[:, -6] = np.log1p(mean)
    out[:, -5] = np.log1p(np.sqrt(np.maximum(np.bincount(of, length.astype(float) ** 2, n) / each - mean ** 2, 0)))
    out[:, -4] = distinct / each
    out[:, -3] = np.bincount(of, same, n) / each
    out[:, -2] = np.log1p(each)
    out[:, -1] = 1
    return out


@dataclass
class Model:
    """Weights of the network; ``base`` alone where nothing could be learned."""
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None
    base: float = 0.5

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores of the bags and their passages' attention."""
        if self.weights is None:
            return np.full(len(bags), self.base), [np.full(len(b), 1 / len(b)) for b in bags]
        first = np.cumsum([0] + [len(b) for b in bags])
        x = (np.concatenate(bags) - self.mean) / self.scale
        p, a = _forward(self.weights, x, first)[:2]
        return p, [a[i:j] for i, j in zip(first, first[1:])]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict, x: np.ndarray, first: np.ndarray):
    size = np.diff(first)
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), size))
    a = e / np.repeat(np.add.reduceat(e, first[:-1]), size)
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return _sigmoid(z @ w["c"] + w["d"]), a, h, t, g, z


def _gradient(w: dict, x: np.ndarray, first: np.ndarray, y: np.ndarray, decay: float) -> dict:
    p, a, h, t, g, z = _forward(w, x, first)
    size = np.diff(first)
    dp = (p - y) / len(y)
    dz = np.repeat(dp, size)[:, None] * w["c"]
    pull = (h * dz).sum(1)                                  # softmax: less the bag's mean
    de = a * (pull - np.repeat(np.add.reduceat(a * pull, first[:-1]), size))
    dt, dg = de[:, None] * w["w"] * g * (1 - t * t), de[:, None] * w["w"] * t * g * (1 - g)
    dh = a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
    du = dh * (1 - h * h)
    out = {"W": x.T @ du, "b": du.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ dp, "d": dp.sum()}
    return {k: v + decay * w[k] * (k in "WVU") for k, v in out.items()}


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 64,
          rate: float = 0.005, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit by Adam on bags and their labels."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), None, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    # bags in a fixed order, so the model doesn't depend on how they arrived
    order = sorted(range(len(bags)), key=lambda i: (bags[i].tobytes(), y[i]))
    flat, y = np.concatenate([bags[i] for i in order]).astype(np.float32), y[order]
    ends = np.cumsum([len(bags[i]) for i in order])
    mean, scale = flat.mean(0, dtype=np.float64), flat.std(0, dtype=np.float64) + 0.02
    flat -= mean.astype(np.float32)
    flat /= scale.astype(np.float32)
    bags = np.split(flat, ends[:-1])            # views: the sample is held once
    w = {"W": rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, hidden)), "b": np.zeros(hidden),
         "V": rng.normal(0, .3, (hidden, gate)), "U": rng.normal(0, .3, (hidden, gate)), "w": rng.normal(0, .3, gate),
         "c": rng.normal(0, .3, hidden), "d": np.array(np.log(y.mean() / (1 - y.mean())))}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        perm = rng.permutation(len(bags))
        for i in range(0, len(bags), batch):
            take = perm[i:i + batch]
            first = np.cumsum([0] + [len(bags[j]) for j in take])
            grad = _gradient(w, np.concatenate([bags[j] for j in take]), first, y[take], decay)
            step += 1
            for k, x in grad.items():
                m[k] = .9 * m[k] + .1 * x
                v[k] = .999 * v[k] + .001 * x * x
                w[k] = w[k] - lr * (m[k] / (1 - .9 ** step)) / (np.sqrt(v[k] / (1 - .999 ** step)) + 1e-8)
    return Model(mean, scale, w)


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, max_docs: int = 2500, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``text, label`` of at most ``max_docs`` labelled documents, by the hash of their id."""
    few = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("label")) \
        .orderBy(F.xxhash64("key"), "key").limit(max_docs)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # max_docs rows at most are broadcast
    return text.join(F.broadcast(few), F.col("id") == F.col("key")).select("text", "label")


def fit(rows: DataFrame, max_passages: int = 64, **settings) -> Model:
    """Learn from ``text, label`` rows; their number must be bounded."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            bags = [encode(t or b"") for t in b.column("text").to_pylist()]
            bags = [x if len(x) <= max_passages else x[np.linspace(0, len(x) - 1, max_passages).astype(int)] for x in bags]
            yield pa.RecordBatch.from_pydict({
                "bag": pa.array([x.astype(np.float16).tobytes() for x in bags], pa.binary()), "label": b.column("label")})

    got = rows.select(F.col("text").cast("binary").alias("text"), "label") \
        .mapInArrow(run, "bag binary, label int").collect()
    bags = [np.frombuffer(r.bag, np.float16).reshape(-1, N_FEATURES).astype(np.float32) for r in got]
    return train(bags, np.array([r.label for r in got], float), **settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, passages`` and the largest attention weight of each document."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            bags = [encode(t or b"") for t in b.column("text").to_pylist()]
            p, attention = model.score(bags)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("id"), "score": pa.array(p, pa.float64()),
                "passages": pa.array([len(x) for x in bags], pa.int32()),
                "attention": pa.array([float(a.max()) for a in attention], pa.float64())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, passages int, attention double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score at least ``threshold``."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text_col, _BLOCK):
            p, _ = model.score([encode((t or "").encode()) for t in b.column(text_col).to_pylist()])
            yield b.filter(pa.array(p >= threshold))
    return docs.mapInArrow(run, docs.schema)
