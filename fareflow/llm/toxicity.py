"""Toxicity by a linear classifier on scaled character n-grams (operator 13).

A text is lower-cased, its white space runs become one blank, and it gets a
blank at both ends, so n-grams know where words begin and end.  Its features
are the distinct n-grams of 3 to 6 characters, hashed into ``2 ** BITS``
buckets.  A bucket's feature value is its naive Bayes log-count ratio

    r = log((p + 1) / (P + 2)) - log((q + 1) / (Q + 2))

(p of P toxic and q of Q other training texts hold the bucket), divided by the
root of the number of the text's buckets.  A logistic model over these values
gives the score; a toxic training row weighs sqrt(Q / P) times another one.

Learning, on Spark: labelled training rows are dealt into shards of about
``SHARD_ROWS`` rows; one job counts p and q per shard and sums them; each of
``ROUNDS`` jobs then trains every shard from the common weights (Adagrad, a
few passes over blocks of rows) and averages the shards' weights by rows.  The
driver sees one vector of ``2 ** BITS`` weights.  Scoring is one pass over all
documents with that vector, no shuffle.

Bounds: at most about ``train_rows`` labelled ids are learned from; beyond
that, ids are picked by their hash, whatever their label.  A task holds one
block of at most ``BLOCK_FEATURES`` features, or one text's.

Defined results: a null text counts as empty; an empty text scores the model's
intercept.  A null id counts as the empty string (held out, as its CRC is 0).
An id labelled more than once is toxic if any of its labels is; null labels
and null ids in the labels are left out; every row of a labelled id trains, so
repeated rows weigh more.  Without training rows of both kinds the score is
the smoothed share of toxic rows, (P + 0.5) / (P + Q + 2).  Very long texts
are hashed window by window, whole.  Labels, language, source and id are not
inputs of a score; extra columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import spread

FOLDS = 5
SIZES = (3, 4, 5, 6)
BITS = 19
TRAIN_ROWS = 65_536
SHARD_ROWS = 4_096
ROUNDS = 2
PASSES = 4
RATE = 0.3
SETTLED = 0.02
BLOCK_FEATURES = 8_000_000
WINDOW = 1 << 20

_SPACE = re.compile(r"\s+")
_A, _B, _C = np.uint32(0x01000193), np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SLOTS = 1 << 14  # weights travel in rows of this many


def fold(id_col: str) -> F.Column:
    """Fold number of a row; fold 0 is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


class Buckets:
    """Distinct n-gram buckets of texts; keeps two work vectors."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint32(32 - bits)
        self.last = np.zeros(1 << bits, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        points = np.frombuffer(f" {_SPACE.sub(' ', (text or '').lower())} ".encode(
            "utf-32-le", "surrogatepass"), "<u4")
        # Windows overlap by one n-gram less a character: no n-gram is lost.
        parts = [self._window(points[at:at + WINDOW + SIZES[-1] - 1])
                 for at in range(0, max(len(points), 1), WINDOW)]
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))

    def _window(self, points: np.ndarray) -> np.ndarray:
        mixed = points * _B
        h, found = mixed, []
        for n in range(2, min(SIZES[-1], len(points)) + 1):
            h = (h[:-1] * _A) ^ mixed[n - 1:]
            if n in SIZES:
                found.append(((h * _C) >> self.shift).astype(np.int32))
        if not found:
            return np.zeros(0, np.int32)
        b = np.concatenate(found)
        order = np.arange(len(b), dtype=np.int32)
        self.last[b] = order  # the last of equal buckets stays
        return b[self.last[b] == order]


def train_block(rows: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, w: np.ndarray,
                g: np.ndarray, seed: int, weight: float = 1.0, passes: int = PASSES) -> None:
    """Adagrad passes over a block; ``w`` and ``g`` hold the intercept last.

    ``weight`` is that of a toxic row.  A row whose score is within
    ``SETTLED`` of its label asks for no step.
    """
    rng = np.random.default_rng(seed)
    values = [ratio[f] * np.float32(1 / np.sqrt(max(len(f), 1))) for f in rows]
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], values[i]
            z = float(w[f] @ x) + float(w[-1])
            d = 1 / (1 + np.exp(-min(max(z, -30.0), 30.0))) - toxic[i]
            if abs(d) < SETTLED:
                continue
            d *= weight if toxic[i] else 1.0
            step = np.float32(d) * x
            sq = g[f] + step * step
            g[f] = sq
            w[f] -= np.float32(RATE) * step / np.sqrt(sq)
            g[-1] += d * d
            w[-1] -= RATE * d / np.sqrt(g[-1])


def _blocks(batches: Iterator[pa.RecordBatch], buckets: Buckets):
    """Blocks ``(shard, rows, toxic)`` of neighbouring rows of one shard."""
    shard, rows, toxic, held = None, [], [], 0
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(3)]
        for s, t, text in zip(*cols, strict=True):
            if rows and (s != shard or held > BLOCK_FEATURES):
                yield shard, rows, np.array(toxic)
                rows, toxic, held = [], [], 0
            shard = s
            rows.append(buckets(text))
            toxic.append(t)
            held += len(rows[-1])
    if rows:
        yield shard, rows, np.array(toxic)


def _vector_rows(v: np.ndarray, weight: float) -> pa.RecordBatch:
    at = range(0, len(v), _SLOTS)
    return pa.RecordBatch.from_pydict({
        "part": pa.array(list(range(len(at))), pa.int32()),
        "v": pa.array([v[a:a + _SLOTS].astype("<f8").tobytes() for a in at], pa.binary()),
        "weight": pa.array([float(weight)] * len(at), pa.float64())})


VECTORS = "part int, v binary, weight double"


def _sum_vectors(vectors: DataFrame) -> tuple[np.ndarray, float]:
    """Sum of the tasks' vectors, and of their weights; each part is summed by itself."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, weight = None, 0.0, 0.0

        def out():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "v": pa.array([total.tobytes()], pa.binary()),
                "weight": pa.array([weight], pa.float64())})
        for b in batches:
            for p, v, w in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if part is not None and p != part:
                    yield out()
                    total, weight = 0.0, 0.0
                part, total, weight = p, total + np.frombuffer(v, "<f8"), weight + w
        if part is not None:
            yield out()

    summed = (vectors.repartition("part").sortWithinPartitions("part").mapInArrow(add, VECTORS)
              .orderBy("part").collect())
    if not summed:
        return np.zeros(0), 0.0
    return np.concatenate([np.frombuffer(r["v"], "<f8") for r in summed]), summed[0]["weight"]


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic",
                  train_rows: int = TRAIN_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, toxic, text`` of the labelled rows outside fold 0, shard by shard."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                           & (fold(id_col) != 0))
             .groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic")))
    n = known.count()
    if n > train_rows:  # a share of the ids by hash: about train_rows of them
        known = known.filter(spread(known, "id", buckets=1 << 30) < int((1 << 30) * train_rows / n))
    shards = max(1, -(-min(n, train_rows) // shard_rows))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(known), "id"))
    shard = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(shards)).cast("int")
    return (rows.select(shard.alias("shard"), "toxic", "text")
            .repartitionById(shards, "shard").sortWithinPartitions("shard"))


def fit(train: DataFrame, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """``(weight per bucket, intercept)``: ratio times learned weight."""
    size = 1 << bits
    train = train.checkpoint()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, n = np.zeros(2 * size + 2), 0
        for _, rows, toxic in _blocks(batches, Buckets(bits)):
            for f, t in zip(rows, toxic, strict=True):
                c[f + size * int(t)] += 1
                c[2 * size + int(t)] += 1
            n += len(rows)
        if n:
            yield _vector_rows(c, n)

    counts, _ = _sum_vectors(train.mapInArrow(count, VECTORS))
    if not len(counts):
        return np.zeros(size), float(np.log(0.25 / 0.75))
    others, toxics = counts[2 * size:]
    if not others or not toxics:
        share = (toxics + 0.5) / (others + toxics + 2)
        return np.zeros(size), float(np.log(share / (1 - share)))
    ratio = (np.log((counts[size:2 * size] + 1) / (toxics + 2))
             - np.log((counts[:size] + 1) / (others + 2))).astype(np.float32)
    w = np.zeros(size + 1)
    weight = float(np.sqrt(others / toxics))
    w[-1] = np.log(weight * toxics / others)
    for k in range(rounds):
        start = w.astype(np.float32)

        def learn(batches: Iterator[pa.RecordBatch], start=start, k=k) -> Iterator[pa.RecordBatch]:
            shard, w, g, n = None, None, None, 0
            for s, rows, toxic in _blocks(batches, Buckets(bits)):
                if s != shard:
                    if n:
                        yield _vector_rows(w.astype(np.float64) * n, n)
                    shard, w, g, n = s, start.copy(), np.full(size + 1, 1e-2, np.float32), 0
                train_block(rows, toxic, ratio, w, g, 1000 * k + s, weight)
                n += len(rows)
            if n:
                yield _vector_rows(w.astype(np.float64) * n, n)

        total, n = _sum_vectors(train.mapInArrow(learn, VECTORS))
        w = total / n
    return w[:-1] * ratio, float(w[-1])


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS, bits: int = BITS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    weights, intercept = fit(training_rows(docs, labels, id_col, text_col, label_col, train_rows), bits)
    weights = weights.astype(np.float32)  # 2 ** bits weights travel with the job

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(bits)
        for b in batches:
            z = np.empty(b.num_rows)
            for i, text in enumerate(b.column(2)):
                f = buckets(text.as_py())
                z[i] = weights[f].sum(dtype=np.float64) / np.sqrt(max(len(f), 1)) + intercept
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p, pa.float64()),
                 pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long"), (fold(id_col) == 0).alias("held_out"),
                       F.col(text_col)).mapInArrow(run, SCORED)
