"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

1. **Word vectors.**  Every token hashes to one of ``rows`` rows and has a sparse random
   index vector (two signed positions of ``dim``).  A row's context vector is the sum of the
   index vectors of the neighbours of its tokens, over *all* documents.  Each task adds its
   share up in one matrix of fixed size; the matrices are summed by row block in two
   shuffles, so neither a task nor the driver holds more than one matrix.
2. **Pooling.**  A document is the mean and the deviation of its tokens' unit vectors.
3. **Network.**  Two layers in numpy, trained on at most ``sample`` labelled documents (the
   one bounded sample: those that come first in a random order), with a held-back part of
   them fitting the temperature that turns the output into a calibrated probability.
4. **Scoring** pools and scores each document in one pass over the texts.

The model (``rows x dim`` floats, 4 MiB, and the network) is broadcast; its size does not
depend on the data.

Defined cases: a null or empty text pools to zeros and is scored like any other; labels of
null ids and null labels are ignored, the lowest label of an id counts; repeated rows are
scored alike; without labels of both kinds every score is the share of ones (0.5 without
any); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.llm.common import handing_back, sample_order
from claimworks.plans.workspace import write_table

ROWS = 32_768
DIM = 32
WINDOW = 2  # neighbours on either side
BLOCK = 32  # matrix rows that travel together
SALTS = 16
SAMPLE = 20_000
CACHED_TOKENS = 200_000
PIECE = 200_000  # tokens handled at a time

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def index_vectors(rows: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs, two each, of every row's random index vector."""
    random = np.random.default_rng(7)
    return random.integers(0, dim, (rows, 2)), random.choice([-1, 1], (rows, 2))


class _Rows(dict):
    """Row of each token, remembered for the frequent ones."""

    def __init__(self, rows: int) -> None:
        self.rows = rows

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_TOKENS:
            self.clear()
        value = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.rows
        return value


def _rows_of(text: str | None, rows: _Rows) -> np.ndarray:
    tokens = TOKEN.findall(text) if text else []
    return np.fromiter(map(rows.__getitem__, tokens), np.int64, len(tokens))


def _add_contexts(total: np.ndarray, ids: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add the neighbours' index vectors to the rows of ``ids``; -1 separates texts."""
    rows, dim = total.shape
    for step in range(1, WINDOW + 1):
        for centre, other in ((ids[step:], ids[:-step]), (ids[:-step], ids[step:])):
            real = (centre >= 0) & (other >= 0)
            c, o = centre[real], other[real]
            for k in range(place.shape[1]):
                flat = np.bincount(c * dim + place[o, k], sign[o, k], rows * dim)
                total += flat.reshape(rows, dim).astype(np.int64)


def _contexts(rows: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors(rows, dim)
        total, seen = np.zeros((rows, dim), np.int64), _Rows(rows)
        waiting, count = [], 0
        gap = np.full(WINDOW, -1)
        for batch in batches:
            for text in batch.column(0):
                ids = _rows_of(text.as_py(), seen)
                waiting += [ids, gap]
                count += len(ids)
                if count >= PIECE:
                    _add_contexts(total, np.concatenate(waiting), place, sign)
                    waiting, count = [], 0
        if waiting:
            _add_contexts(total, np.concatenate(waiting), place, sign)
        yield from _blocks_out(total)

    return run


def _blocks_out(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The blocks of a matrix that are not all zero."""
    blocks = total.reshape(-1, BLOCK * total.shape[1])
    some = np.flatnonzero(blocks.any(axis=1))
    if len(some):
        sums = [blocks[k].astype("<i8").tobytes() for k in some]
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(some.astype(np.int32)), "sums": pa.array(sums, pa.binary())}
        )


def _sum_blocks(rows: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, dim), np.int64)
        blocks = total.reshape(-1, BLOCK * dim)
        for batch in batches:
            for block, sums in zip(batch.column("block").to_numpy(), batch.column("sums")):
                blocks[block] += np.frombuffer(sums.as_buffer(), "<i8")
        yield from _blocks_out(total)

    return run


def word_vectors(docs: DataFrame, rows: int = ROWS, dim: int = DIM) -> np.ndarray:
    """Unit context vectors (rows x dim) over all documents; zero where no token fell."""
    schema = "block int, sums binary"
    texts = docs.select(F.col("text").cast("string").alias("text"))
    parts = texts.mapInArrow(handing_back(_contexts(rows, dim)), schema)
    add = handing_back(_sum_blocks(rows, dim))
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = salted.repartition("block", "salt").select("block", "sums").mapInArrow(add, schema)
    whole = some.repartition("block").mapInArrow(add, schema)
    total = np.zeros((rows // BLOCK, BLOCK * dim))
    for row in write_table(whole, "word-vectors").collect():  # at most rows x dim numbers
        total[row.block] += np.frombuffer(bytes(row.sums), "<i8")
    total = total.reshape(rows, dim)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of the vectors of ``ids``, the mean's length and the row variety."""
    dim = vectors.shape[1]
    if not len(ids):
        return np.zeros(2 * dim + 2, np.float32)
    kinds, counts = np.unique(ids, return_counts=True)
    share = (counts / len(ids)).astype(np.float32)
    mean = share @ vectors[kinds]
    deviation = np.sqrt(np.maximum(share @ vectors[kinds] ** 2 - mean**2, 0))
    return np.concatenate([mean, deviation, [np.linalg.norm(mean), share @ share]]).astype(np.float32)


@dataclass
class Network:
    """Two layers, with the standardisation of the input and the output's temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.centre) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def _constant(width: int, share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(
        np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
        float(np.log(share / (1 - share))),
    )


def _log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(
    x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, batch: int = 256,
    rate: float = 5e-3, decay: float = 1e-4, seed: int = 3,
) -> Network:
    """Adam on the log loss; a fifth of the rows is held back to fit the temperature."""
    width = x.shape[1] if x.ndim == 2 else 0
    if len(y) < 10 or len(np.unique(y)) < 2:
        return _constant(width, float(np.mean(y)) if len(y) else 0.5)
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    scale = x[used].std(axis=0)
    net = Network(
        x[used].mean(axis=0), np.where(scale > 1e-6, scale, 1.0),
        random.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden),
        random.normal(0, hidden**-0.5, hidden), 0.0,
    )
    inputs = (x - net.centre) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for at in range(0, len(used), batch):
            rows = used[at : at + batch]
            h = np.tanh(inputs[rows] @ params[0] + params[1])
            out = h @ params[2] + params[3][0]
            error = (1 / (1 + np.exp(-np.clip(out, -60, 60))) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h**2)
            grads = [
                inputs[rows].T @ back + decay * params[0], back.sum(axis=0),
                h.T @ error + decay * params[2], np.array([error.sum()]),
            ]
            step += 1
            for k, (p, g) in enumerate(zip(params, grads)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        random.shuffle(used)
    net.b2 = float(params[3][0])
    logits = net.logits(x[held])
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    net.temperature = float(min(choices, key=lambda t: _log_loss(logits / t, y[held])))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def scores(self, texts: pa.Array, rows: _Rows) -> np.ndarray:
        x = np.stack([pooled(_rows_of(t.as_py(), rows), self.vectors) for t in texts])
        return self.network.probabilities(x)


def held_out(doc_id: Column) -> Column:
    """Whether no label of this id may be learned from; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _pool(vectors: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = vectors.value
        rows = _Rows(len(matrix))
        for batch in batches:
            pools = [pooled(_rows_of(t.as_py(), rows), matrix).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"quality": batch.column("quality"), "pool": pa.array(pools, pa.binary())}
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn word vectors from all documents and the network from at most ``sample`` labels."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    usable = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    # bounded by ``sample`` rows
    chosen = write_table(usable.orderBy(sample_order(F.col("doc_id"), 5), "doc_id").limit(sample), "label-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = texts.join(F.broadcast(chosen), "doc_id").select("quality", "text")
    shared = spark.sparkContext.broadcast(vectors)
    pools = write_table(labelled.mapInArrow(handing_back(_pool(shared)), "quality int, pool binary"), "label-pools")
    # an id may be in the documents several times: the bound holds for rows as well
    found = pools.limit(sample).toPandas()
    if not len(found):
        return Model(vectors, _constant(2 * vectors.shape[1] + 2, 0.5))
    x = np.array([np.frombuffer(p, np.float32) for p in found["pool"]], np.float64)
    order = np.lexsort(x.T)  # independent of row order
    return Model(vectors, train(x[order], found["quality"].to_numpy(np.float64)[order]))


def _scorer(model: Broadcast, at_least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(len(model.value.vectors))
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = model.value.scores(batch.column("text"), rows)
            if at_least is not None:
                yield batch.filter(pa.array(scores >= at_least))
            else:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores)})

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(handing_back(_scorer(shared, None)), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``at_least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return docs.mapInArrow(handing_back(_scorer(shared, at_least)), schema)
