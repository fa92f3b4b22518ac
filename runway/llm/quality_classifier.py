"""Quality classifier: random-indexing word vectors pooled per document, then
a two-layer numpy network with temperature-calibrated probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import mix64, slices, utf8_buffers, word_hashes
from .workers import ship

#: Word buckets, dimensions, non-zeros of an index vector and context words on
#: either side.  Buckets x dimensions bound the word table (6 MB), whatever the corpus.
BUCKETS = 1 << 15
DIMS = 48
NONZEROS = 4
WINDOW = 2
STRIPE = 1 << 10
#: Partial sums that are added up in one group, and how often they are (8^6 tasks).
FAN_IN, LEVELS = 8, 6
#: Words gathered before their contexts are added up, and words pooled at a time.
GATHERED = 1 << 20
POOLED = 1 << 15


def index_vectors(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of each bucket's sparse ternary index vector."""
    at = np.arange(BUCKETS * NONZEROS, dtype=np.uint64).reshape(BUCKETS, NONZEROS)
    h = mix64(at + np.uint64(seed << 32))
    return (h % np.uint64(DIMS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def _texts(batch_column: pa.Array, most: int = 1 << 20):
    """(bucket of every word, words before each text) of stretches of texts."""
    data, at = utf8_buffers(batch_column)
    for i, j in slices(at, most):
        words, counts = word_hashes(data, at[i:j + 1], lower=False)
        yield (words % np.uint64(BUCKETS)).astype(np.int64), counts


def _contexts(seed: int):
    """Summed index vectors of the words around each bucket's words, over all
    texts of the task: one row per stripe of buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(seed)
        total = np.zeros(BUCKETS * DIMS, dtype=np.float64)
        count = np.zeros(BUCKETS, dtype=np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add():
            centre = np.concatenate([c for c, _ in held])
            around = np.concatenate([a for _, a in held])
            for z in range(NONZEROS):
                total[:] += np.bincount(centre * DIMS + places[around, z], signs[around, z], BUCKETS * DIMS)
        n_held = 0
        for batch in batches:
            for words, counts in _texts(batch.column(0)):
                count += np.bincount(words, minlength=BUCKETS)
                doc = np.repeat(np.arange(len(counts) - 1), np.diff(counts))
                for d in range(1, WINDOW + 1):
                    same = doc[d:] == doc[:-d]
                    a, b = words[:-d][same], words[d:][same]
                    held += [(a, b), (b, a)]
                    n_held += 2 * len(a)
                if n_held > 4 * GATHERED:
                    add()
                    held, n_held = [], 0
        if n_held:
            add()
        whole = np.c_[total.reshape(BUCKETS, DIMS), count].astype(np.int64)
        whole = np.clip(whole, -2 ** 31, 2 ** 31 - 1).astype(np.int32).reshape(-1, STRIPE * (DIMS + 1))
        some = np.flatnonzero(whole.any(axis=1))
        task = np.full(len(some), TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(task, pa.int64()),
                                          pa.array([whole[i].astype(np.int64).tobytes() for i in some], pa.binary())],
                                         names=["stripe", "part", "sums"])
    return run


def _sum_stripes(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(STRIPE * (DIMS + 1), dtype=np.int64)
    for raw in pdf["sums"]:
        total += np.frombuffer(raw, np.int64)
    return pd.DataFrame({"stripe": pdf["stripe"].iloc[:1], "part": pdf["part"].iloc[:1], "sums": [total.tobytes()]})


def word_vectors(docs: DataFrame, text_col: str = "text", seed: int = 11) -> np.ndarray:
    """The word table of the whole corpus, BUCKETS x DIMS: each bucket's summed
    contexts at unit length plus half its own index vector.  The table's size is
    fixed; that is what the driver receives.  The tasks' sums are added up FAN_IN
    at a time, so however many tasks there are, none reads more than FAN_IN of them."""
    ship(docs.sparkSession)
    schema = "stripe int, part long, sums binary"
    sums = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_contexts(seed), schema)
    for _ in range(LEVELS):
        sums = (sums.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("stripe", "part")
                .applyInPandas(_sum_stripes, schema))
    sums = sums.collect()
    whole = np.zeros((BUCKETS, DIMS + 1))
    for r in sums:
        whole[r["stripe"] * STRIPE:(r["stripe"] + 1) * STRIPE] += np.frombuffer(r["sums"], np.int64).reshape(STRIPE, -1)
    context = whole[:, :DIMS]
    context = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    places, signs = index_vectors(seed)
    own = np.zeros((BUCKETS, DIMS))
    np.add.at(own, (np.arange(BUCKETS)[:, None], places), signs)
    return (context + 0.5 * own / np.sqrt(NONZEROS)).astype(np.float32)


def pool(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, number of words) per text: mean and spread of the vectors of
    all its words, whatever its length."""
    feats, sizes = [], []
    for words, counts in _texts(column):
        n = np.diff(counts)
        sums = np.zeros((len(n), 2 * DIMS))
        doc = np.repeat(np.arange(len(n)), n)
        for s in range(0, len(words), POOLED):
            v = table[words[s:s + POOLED]]
            d = doc[s:s + POOLED]
            head = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            sums[d[head], :DIMS] += np.add.reduceat(v, head, axis=0)
            sums[d[head], DIMS:] += np.add.reduceat(v * v, head, axis=0)
        mean = sums / np.maximum(n, 1)[:, None]
        spread = np.sqrt(np.maximum(mean[:, DIMS:] - mean[:, :DIMS] ** 2, 0))
        feats.append(np.c_[mean[:, :DIMS], spread])
        sizes.append(n)
    if not feats:
        return np.zeros((0, 2 * DIMS)), np.zeros(0, np.int64)
    return np.concatenate(feats), np.concatenate(sizes)


@dataclass
class QualityNet:
    """Two layers: tanh hidden units, then one logit divided by a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0
    prior: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return (np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 30, batch: int = 128,
            rate: float = 3e-3, decay: float = 1e-4, seed: int = 1) -> QualityNet:
        """Adam on four fifths of the rows; the temperature minimises the log
        loss on the last fifth.  With one class only (or no rows) the score is
        the share of label 1 (0.5)."""
        if len(np.unique(y)) < 2 or len(y) < 20:
            return cls(np.zeros(2 * DIMS), np.ones(2 * DIMS), prior=float(y.mean()) if len(y) else 0.5)
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        x, y = x[order], y[order].astype(float)
        n = len(y) * 4 // 5
        net = cls(x[:n].mean(axis=0), x[:n].std(axis=0) + 1e-6)
        net.weights = [rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
                       rng.standard_normal((hidden, 1)) / np.sqrt(hidden), np.zeros(1)]
        z = (x - net.centre) / net.scale
        m, v, t = [[np.zeros_like(w) for w in net.weights] for _ in range(2)] + [0]
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(n), max(1, n // batch)):
                w1, b1, w2, b2 = net.weights
                h = np.tanh(z[part] @ w1 + b1)
                p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -40, 40)))
                out = (p - y[part, None]) / len(part)
                back = out @ w2.T * (1 - h * h)
                t += 1
                for k, g in enumerate((z[part].T @ back + decay * w1, back.sum(axis=0), h.T @ out + decay * w2, out.sum(axis=0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    net.weights[k] = net.weights[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        left = net.logits(x[n:])

        def loss(temperature: float) -> float:
            s = left / temperature
            return float(np.mean(np.logaddexp(0, s) - y[n:] * s))
        net.temperature = min(np.geomspace(0.25, 8, 81), key=loss)
        return net


def _features(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = pool(batch.column(1), table.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()),
                                              pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary())],
                                             names=["quality", "n", "x"])
    return run


def _score(table, net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = pool(batch.column(1), table.value)
            score = np.where(n > 0, net.value.score(x), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])
    return run


def held_out(id_col):
    """crc32 of the id as text, modulo 5, is 0; such rows are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", most_rows: int = 20_000, threshold: float = 0.3,
                  seed: int = 11) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 if score >= ``threshold``).

    Word vectors are learnt from all texts, without labels.  The network is fit
    on the driver on at most ``most_rows`` labelled rows that are not held out,
    those first in the order of a hash of the id.  Only the words of the whole
    text enter a score.  Texts without words (null, empty) score 0.  Rows with a
    null id are scored, not learnt from; null labels are ignored; repeated rows
    get equal scores.  Other columns are ignored; empty tables give no rows, and
    without labels of both kinds the score is the share of label 1 (0.5 if none).
    """
    spark = docs.sparkSession
    ship(spark)
    table = spark.sparkContext.broadcast(word_vectors(docs, text_col, seed))
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("quality"))
             .where(f"__id is not null and quality is not null").where(~held_out(F.col("__id")))
             .orderBy(F.xxhash64("__id"), "__id").limit(most_rows))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    rows = (texts.join(F.broadcast(known), "__id").select("quality", "text")
            .mapInArrow(_features(table), "quality int, n long, x binary").where("n > 0").select("quality", "x").toPandas())
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, 2 * DIMS).astype(np.float64)
    order = np.lexsort(x.T[::-1]) if len(x) else []  # rows arrive in any order; fit in one
    net = spark.sparkContext.broadcast(QualityNet.fit(x[order], rows["quality"].to_numpy(np.int64)[order]))
    id_type = texts.schema["__id"].dataType.simpleString()
    scored = texts.mapInArrow(_score(table, net), f"id {id_type}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
