"""Log-bilinear language model trained with noise-contrastive estimation (operator 5).

Words are grouped into classes: the most frequent words and the end of text
are classes of their own, all others share classes by their last bytes.  A
log-bilinear model predicts the class of the next token from the classes of
the two before it: the context vectors (one table per position) add up to a
prediction, whose product with the class vectors plus a bias scores every
class.  Within a shared class words have their absolutely discounted shares;
the discounts are the share of all words that training has not seen, which
count as one outcome.  All outcomes together have probability one.

* Counts cover all training texts: tasks count, Spark sums per word.
* Training passes over every training token once.  Each round, every task
  starts from the current parameters, runs noise-contrastive estimation on
  its texts (noise words shared by a minibatch, so all products are matrix
  products) and returns its parameters; Spark averages them by token count.
* Scores are normalised: one batched matrix product per context pair gives
  all normalisers.  Counts of rare words reach the texts by a join.

Parameters have a fixed size (classes x dimensions), set by the constants
below and not by the corpus.

Defined results: a null or empty text is the end token alone; a row without an
id counts as the text ''; repeated rows are separate texts; if no training text
exists every count is zero; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import keep_table

WORD_CLASSES = 512
SHARED_CLASSES = 128
# Counts of at most so many words are sent to every task; the others come by a join.
KNOWN_WORDS = 100_000
DIMS = 16
BLOCK_ROWS = 128
FOLDS, HELD_OUT = 7, 2
END = b""
_LOG10 = np.log(10.0)


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, then the end token."""
    # bytes.lower and bytes.split work on ASCII alone.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def fold(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def shared_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SHARED_CLASSES


def _word_hash(word: bytes) -> int:
    x = xxhash.xxh3_64_intdigest(word)
    return x - (1 << 64) if x >> 63 else x


@dataclass(frozen=True)
class Training:
    """Rounds of parameter averaging; tokens and noise words per step; step size."""
    rounds: int = 2
    minibatch: int = 1024
    noise: int = 32
    rate: float = 0.3


COUNTED = "word binary, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            names=["word", "n"])
        seen.clear()
        return out

    for b in batches:
        for text in b.column(0).to_pylist():
            seen.update(tokens(text))
            if len(seen) > 500_000:
                yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all texts (one column), the end token as the empty word."""
    return (texts.mapInArrow(_count, COUNTED).groupBy("word")
            .agg(F.sum("n").cast("long").alias("n")))


@dataclass
class Vocabulary:
    """Fixed-size summary of the counts: classes, class totals, frequent counts."""
    classes: dict[bytes, int]
    known: dict[bytes, int]
    class_tokens: np.ndarray
    class_words: np.ndarray
    total: int
    distinct: int
    discount: float

    @property
    def unseen(self) -> np.ndarray:
        """Discounted mass of each class, in tokens (a class without words is all unseen)."""
        return np.where(self.class_tokens > 0, self.discount * self.class_words, 1.0)

    @property
    def size(self) -> int:
        return len(self.class_tokens)


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    # The smallest power of two that at most KNOWN_WORDS words reach: one pass,
    # and what is collected is bounded whatever the corpus.
    reach = [F.count_if(F.col("n") >= 1 << k) for k in range(63)]
    summary = counts.agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1),
                         F.count_if(F.col("n") == 2), *reach).first()
    least = next(1 << k for k in range(63) if summary[4 + k] <= KNOWN_WORDS)
    is_end = F.col("word") == F.lit(bytearray(END))
    known = {bytes(r["word"]): r["n"]
             for r in counts.filter((F.col("n") >= least) | is_end).collect()}
    common = sorted(known, key=lambda w: (-known[w], w))
    words = [END] + [w for w in common if w != END][:WORD_CLASSES - 1]
    classes = {w: i for i, w in enumerate(words)}
    own = len(classes)
    rest = counts.filter(~F.col("word").isin([bytearray(w) for w in words]))
    tail = F.substring("word", -3, 3)
    by_class = rest.groupBy((F.crc32(tail) % SHARED_CLASSES).alias("g")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n = np.zeros(own + SHARED_CLASSES, np.int64)
    v = np.zeros(own + SHARED_CLASSES, np.int64)
    for w, i in classes.items():
        n[i] = known.get(w, 0)
    for r in by_class:
        n[own + r["g"]], v[own + r["g"]] = r["n"], r["v"]
    once, twice = (summary[i] or 0 for i in (2, 3))
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
    return Vocabulary(classes, known, n, v, int(summary[0] or 0), int(summary[1]), discount)


class _Classes(dict):
    """Class of a word; words without a class of their own are looked up by rule."""

    def __init__(self, vocab: Vocabulary):
        super().__init__(vocab.classes)
        self._own = len(vocab.classes)

    def __missing__(self, word: bytes) -> int:
        c = self._own + shared_class(word)
        if len(self) < 300_000:
            self[word] = c
        return c


# -- the model --------------------------------------------------------------------

@dataclass
class Model:
    """Context tables (row ``size`` is the start of text), class vectors, biases."""
    before1: np.ndarray
    before2: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def pack(self) -> np.ndarray:
        start = np.zeros((1, self.target.shape[1]), np.float32)
        rows = np.concatenate([self.before1, self.before2, self.target, start])
        extra = np.zeros((len(rows), 1), np.float32)
        extra[-1 - len(self.bias):-1, 0] = self.bias
        return np.concatenate([rows, extra], axis=1)

    @staticmethod
    def unpack(rows: np.ndarray) -> Model:
        k = (len(rows) - 3) // 3
        a, b, c = rows[:k + 1, :-1], rows[k + 1:2 * k + 2, :-1], rows[2 * k + 2:3 * k + 2]
        return Model(a.copy(), b.copy(), c[:, :-1].copy(), c[:, -1].copy())


def new_model(vocab: Vocabulary) -> Model:
    """Starts as the class unigram model: the context vectors are zero."""
    k = vocab.size
    p = (vocab.class_tokens + 1.0) / (vocab.class_tokens.sum() + k)
    rng = np.random.default_rng(11)
    zero = np.zeros((k + 1, DIMS), np.float32)
    return Model(zero, zero.copy(), rng.normal(0, 0.3, (k, DIMS)).astype(np.float32),
                 np.log(p).astype(np.float32))


def contexts(classes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two tokens back; ``size`` stands for before the text."""
    one, two = np.roll(classes, 1), np.roll(classes, 2)
    one[starts] = size
    two[starts] = size
    inner = starts + 1
    two[inner[inner < len(classes)]] = size
    return one, two


class _Adagrad:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate = params, rate
        self.sums = [np.full_like(p, 1e-4) for p in params]

    def step(self, i: int, grad: np.ndarray) -> None:
        self.sums[i] += grad * grad
        self.params[i] += self.rate * grad / np.sqrt(self.sums[i])


def _by_class(index: np.ndarray, grad: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of ``grad`` per class."""
    out = np.empty((size, grad.shape[1]), np.float32)
    for d in range(grad.shape[1]):
        out[:, d] = np.bincount(index, weights=grad[:, d], minlength=size)
    return out


def train_steps(model: Model, opt: _Adagrad, noise: np.ndarray, word: np.ndarray, one: np.ndarray,
                two: np.ndarray, rng: np.random.Generator, how: Training) -> None:
    """Noise-contrastive estimation over shuffled minibatches of the given tokens."""
    k = len(model.bias)
    log_noise = np.log(noise * how.noise).astype(np.float32)
    edges = np.cumsum(noise)
    order = rng.permutation(len(word))
    for at in range(0, len(word), how.minibatch):
        pick = order[at:at + how.minibatch]
        w, a, b = word[pick], one[pick], two[pick]
        # The noise words are the same for the whole minibatch.
        u = np.minimum(np.searchsorted(edges, rng.random(how.noise)), k - 1)
        h = model.before1[a] + model.before2[b]
        rw, ru = model.target[w], model.target[u]
        data = np.einsum("ij,ij->i", h, rw) + model.bias[w] - log_noise[w]
        fake = h @ ru.T + (model.bias[u] - log_noise[u])
        gd = 1.0 / (1.0 + np.exp(np.clip(data, -30, 30)))
        gf = -1.0 / (1.0 + np.exp(-np.clip(fake, -30, 30)))
        scale = np.float32(1.0 / len(pick))
        gd, gf = gd * scale, gf * scale
        gh = gd[:, None] * rw + gf @ ru
        gt = _by_class(w, gd[:, None] * h, k)
        np.add.at(gt, u, gf.T @ h)
        gb = np.bincount(w, weights=gd, minlength=k).astype(np.float32)
        np.add.at(gb, u, gf.sum(axis=0))
        opt.step(0, _by_class(a, gh, k + 1))
        opt.step(1, _by_class(b, gh, k + 1))
        opt.step(2, gt)
        opt.step(3, gb)


def log_normalisers(model: Model) -> np.ndarray:
    """``log Z`` of every pair of context classes, one matrix product per first class."""
    k = len(model.bias)
    out = np.empty((k + 1, k + 1), np.float32)
    base = model.before2 @ model.target.T + model.bias
    for a in range(k + 1):
        s = base + (model.before1[a] @ model.target.T)[None, :]
        top = s.max(axis=1)
        out[a] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
    return out


PARTS = "block int, weight double, vals binary"


def _train_task(vocab, rows, start_noise, how: Training):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, model = _Classes(vocab.value), Model.unpack(rows.value)
        opt = _Adagrad([model.before1, model.before2, model.target, model.bias], how.rate)
        rng, total = np.random.default_rng(5), 0
        for b in batches:
            for cls, starts in _class_batches(b.column(0).to_pylist(), classes):
                one, two = contexts(cls, starts, len(model.bias))
                train_steps(model, opt, start_noise.value, cls, one, two, rng,
                            how)
                total += len(cls)
        if total:
            packed = model.pack()
            at = range(0, len(packed), BLOCK_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(at)), pa.int32()), pa.array([float(total)] * len(at)),
                 pa.array([packed[i:i + BLOCK_ROWS].tobytes() for i in at], pa.binary())],
                names=["block", "weight", "vals"])

    return run


def _class_batches(texts: list, classes: dict,
                   limit: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class numbers of several texts in a row, with each text's first position."""
    flat: list[int] = []
    starts: list[int] = []
    for t in texts:
        starts.append(len(flat))
        flat += map(classes.__getitem__, tokens(t))
        if len(flat) >= limit:
            yield np.array(flat, np.int64), np.array(starts, np.int64)
            flat, starts = [], []
    if starts:
        yield np.array(flat, np.int64), np.array(starts, np.int64)


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    w = pdf["weight"].to_numpy()
    vals = [np.frombuffer(v, np.float32).astype(np.float64) * x
            for v, x in zip(pdf["vals"], w, strict=True)]
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "weight": [w.sum()],
                         "vals": [(sum(vals) / w.sum()).astype(np.float32).tobytes()]})


def train(texts: DataFrame, key: F.Column, vocab: Vocabulary,
          how: Training = Training()) -> Model:
    """Train over all texts: each text belongs to one round by its key."""
    model = new_model(vocab)
    sc = texts.sparkSession.sparkContext
    p = (vocab.class_tokens + 1.0) / (vocab.class_tokens.sum() + vocab.size)
    voc, noise = sc.broadcast(vocab), sc.broadcast(p)
    for r in range(how.rounds):
        rows = sc.broadcast(model.pack())
        part = texts.filter(F.pmod(key, F.lit(how.rounds)) == r)
        out = (part.mapInArrow(_train_task(voc, rows, noise, how), PARTS)
               .groupBy("block").applyInPandas(_average, PARTS).collect())
        if out:
            flat = b"".join(bytes(x["vals"]) for x in sorted(out, key=lambda x: x["block"]))
            model = Model.unpack(np.frombuffer(flat, np.float32).reshape(-1, DIMS + 1).copy())
    return model


# -- scoring ----------------------------------------------------------------------

SCORED = ("row_key long, doc_id long, held_out boolean, n_tokens long, n_known long, "
          "base_sum double, score double, rare array<struct<h:long,n:int,c:int>>")


def _score_task(vocab, rows, normalisers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, model, logz = vocab.value, Model.unpack(rows.value), normalisers.value
        classes, known, own = _Classes(v), v.known, len(v.classes)
        share = np.log10(np.maximum(v.class_tokens, 1))
        share[:own] = 0.0
        kind = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32()), ("c", pa.int32())]))
        for b in batches:
            texts = b.column(3).to_pylist()
            n, n_known, base, in_class, rare = [], [], [], [], []
            for t in texts:
                c = Counter(tokens(t))
                hit = [(w, m, known[w]) for w, m in c.items() if w in known]
                rest = [(w, m) for w, m in c.items() if w not in known]
                f = np.array([m for _, m, _ in hit], np.float64)
                seen = np.array([x for _, _, x in hit], np.float64)
                word = np.array([w not in v.classes for w, _, _ in hit], bool)
                n.append(sum(c.values()))
                n_known.append(int(f.sum()))
                base.append(float((f * np.log10(seen + 1)).sum()))
                in_class.append(float((f * np.log10(seen - v.discount))[word].sum()))
                rare.append([{"h": _word_hash(w), "n": m, "c": shared_class(w)} for w, m in rest])
            model_sum = []
            for cls, starts in _class_batches(texts, classes):
                one, two = contexts(cls, starts, len(model.bias))
                h = model.before1[one] + model.before2[two]
                s = (np.einsum("ij,ij->i", h, model.target[cls]) + model.bias[cls]
                     - logz[one, two]).astype(np.float64) / _LOG10 - share[cls]
                model_sum.append(np.add.reduceat(s, starts))
            got = np.concatenate(model_sum) if model_sum else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()),
                 pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(got + np.array(in_class), pa.float64()), pa.array(rare, kind)],
                names=[x.split()[0] for x in SCORED.split(", ")])

    return run


HASHED = "h long, n long"


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([_word_hash(w) for w in b.column(0).to_pylist()], pa.int64()), b.column(1)],
            names=["h", "n"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          how: Training = Training()) -> DataFrame:
    """Token counts, add-one unigram score and model score of every text."""
    held = fold(id_col) == HELD_OUT
    train_rows = docs.filter(~held)
    counts = keep_table(word_counts(train_rows.select(F.col(text_col))), "counts")
    vocab = build_vocabulary(counts)
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    model = train(train_rows.select(F.col(text_col), key.alias("k")), F.col("k"), vocab, how)
    sc = docs.sparkSession.sparkContext
    voc, rows = sc.broadcast(vocab), sc.broadcast(model.pack())
    logz = sc.broadcast(log_normalisers(model))
    scored = keep_table(docs.select(
        key.alias("row_key"), F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
        F.col(text_col).alias("text")).mapInArrow(_score_task(voc, rows, logz), SCORED), "scored")
    table = counts.mapInArrow(_hash_words, HASHED).groupBy("h").agg(F.sum("n").alias("c"))
    # A rare word that training has not seen counts as its class's unseen outcome.
    unseen = F.array(*[F.lit(float(np.log10(x))) for x in vocab.unseen[len(vocab.classes):]])
    met = F.col("c").isNotNull()
    rare = (scored.dropDuplicates(["row_key"])
            .select("row_key", F.inline("rare").alias("h", "n", "cls"))
            .join(table, "h", "left").groupBy("row_key")
            .agg(F.sum(F.when(met, F.col("n")).otherwise(0)).cast("long").alias("rare_known"),
                 F.sum(F.when(met, F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0)).alias("rare_base"),
                 F.sum(F.col("n") * F.when(met, F.log10(F.col("c") - vocab.discount))
                       .otherwise(unseen[F.col("cls")])).alias("rare_sum")))
    zero, nothing = F.lit(0).cast("long"), F.lit(0.0)
    per_token = F.log10(F.lit(float(vocab.total + vocab.distinct + 1)))
    return scored.join(rare, "row_key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_sum") + F.coalesce("rare_base", nothing)
         - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("score") + F.coalesce("rare_sum", nothing)).alias("score"))
