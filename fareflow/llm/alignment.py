"""Cross-tokenizer alignment by whitespace-token anchors (operator 11).

Every text is tokenised whole by two tokenizers, A (byte-level BPE, over a
blank and the text) and B (SentencePiece with byte fallback, which adds the
blank).  Every token stands for bytes, and both sequences have to spell the
same bytes; a text that fails this has no tokens here.  Byte offsets at which
A and B tokens both end cut the document into groups; A and B tokens whose
byte ranges overlap are linked.

Method: a shared end (looked up, so verified, in both sequences' offsets)
before an A and a B token that both begin with a blank is an anchor.  Anchors
cut the document into short windows, each known by its A ids and B ids alone.
A window is aligned once per worker and kept in a bounded table by its id
tuples (packed); the document's result is its windows' results put together, since no
group and no link crosses an anchor.

Corpus counts, on Spark: each document keeps its distinct linked id pairs with
their counts, packed; partial sums per task are added up by pair; a pair's
count and whether it is its B id's highest go back to the documents in a
co-group of pair blocks and document shards, both of bounded size.  The pair
table is never broadcast or collected.

Defined results: null and empty texts, and texts whose joined A or B bytes are
not a blank and the text (B drops or replaces something), count zero and have
an empty digest.  Special tokens' strings inside texts are plain text.
Repeated rows and ids are rows of their own, each counted; null ids stay
null; an empty table gives an empty result.  Very long texts are tokenised
whole.  Ties for a B id's highest count are all best.  Extra columns are never
read.
"""

from __future__ import annotations

import gc
import hashlib
import json
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareflow.llm.common import keep_table

MEMO_WINDOWS = 250_000
PAIRS_PER_FLUSH = 2_000_000
PAIRS_PER_BLOCK = 1_000_000
PAIRS_PER_SHARD = 4_000_000
TEXTS_PER_STEP = 64

# Fixed value: the split pattern of the byte-level tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on whose classes all regular expression engines agree.
_PLAIN = regex.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ¡¿«»–—‘’“”…]*")


def _byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids of texts and bytes of ids."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items()}
        self.size = self.whole.get_vocab_size()
        self.pieces = [b""] * self.size
        for t, i in ranks.items():
            self.pieces[i] = t
        # Byte pairs merge by rank, that is by id of the same vocabulary.
        self.plain = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text; texts of unusual characters take the reference library."""
        out: list = [np.array(self.plain.encode_ordinary(t), np.uint32) if _PLAIN.fullmatch(t) else None
                     for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            found = self.whole.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, found, strict=True):
                out[i] = np.array(e.ids, np.uint32)
        return out


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.pieces = []
        for i in range(self.size):
            p = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.pieces.append(bytes([int(p[3:5], 16)]))
            else:
                self.pieces.append(p.replace("▁", " ").encode())

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


NO_TOKENS = (0, 0, 0, np.zeros(0, np.int64), "")

_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; made once per worker process."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(ByteLevel(a_path), Pieces(b_path))
    return _loaded[a_path, b_path]


class Aligner:
    def __init__(self, a, b):
        self.a, self.b = a, b
        self.a_len = np.array([len(p) for p in a.pieces], np.int64)
        self.b_len = np.array([len(p) for p in b.pieces], np.int64)
        self.a_mark = np.array([p[:1] == b" " for p in a.pieces])
        self.b_mark = np.array([p[:1] == b" " for p in b.pieces])
        self.a_piece, self.b_piece = a.pieces.__getitem__, b.pieces.__getitem__
        self.a_text = list(map(str, range(a.size))).__getitem__
        self.b_text = list(map(str, range(b.size))).__getitem__
        # Windows by their packed ids.  Those met first stay, which are the
        # frequent ones; others are aligned again when they return.
        self.memo: dict[bytes, tuple[str, int, bytes, bytes | None]] = {}

    def window(self, a: list[int], b: list[int]) -> tuple[str, int, bytes, bytes | None]:
        """Group text, number of groups, linked pairs (a * B size + b, packed) and
        the bytes of a window, None if A and B spell different ones."""
        of_b = self.b.size
        a_spelt, b_spelt = list(map(self.a_piece, a)), list(map(self.b_piece, b))
        a_text, b_text = list(map(self.a_text, a)), list(map(self.b_text, b))
        a_size, b_size = list(map(len, a_spelt)), list(map(len, b_spelt))
        groups, links, i, j, i0, j0, ahead = [], [], 0, 0, 0, 0, a_size[0] - b_size[0]
        while True:
            links.append(a[i] * of_b + b[j])
            if ahead == 0:
                i, j = i + 1, j + 1
                if i - i0 == 1 and j - j0 == 1:
                    groups.append(a_text[i0] + "|" + b_text[j0])
                else:
                    groups.append(",".join(a_text[i0:i]) + "|" + ",".join(b_text[j0:j]))
                i0, j0 = i, j
                if i >= len(a) or j >= len(b):
                    break
                ahead = a_size[i] - b_size[j]
            elif ahead < 0:
                i += 1
                if i == len(a):
                    break
                ahead += a_size[i]
            else:
                j += 1
                if j == len(b):
                    break
                ahead -= b_size[j]
        spelt = b"".join(a_spelt)
        same = spelt == b"".join(b_spelt)
        return ";".join(groups), len(groups), array("q", links).tobytes(), spelt if same else None

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        """Positions in ``a`` and ``b`` at which windows begin, and the ends."""
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        i = np.flatnonzero(self.a_mark[a[1:]]) + 1     # a marked token begins here
        at = a_end[i - 1]
        j = np.searchsorted(b_end, at)                 # the B token that ends there, if one does
        ok = (j < len(b) - 1) & (b_end[np.minimum(j, len(b) - 1)] == at)
        ok[ok] = self.b_mark[b[j[ok] + 1]]
        return [0, *i[ok].tolist(), len(a)], [0, *(j[ok] + 1).tolist(), len(b)]

    def documents(self, texts: Sequence[str | None]) -> Iterator[tuple]:
        """``(n_a, n_b, n_groups, links, sha256)`` per text; links are pair keys."""
        known = [t or "" for t in texts]
        a_ids, b_ids = self.a.encode([" " + t for t in known]), self.b.encode(known)
        get, memo = self.memo.get, self.memo
        for t, a_pack, b in zip(known, a_ids, b_ids, strict=True):
            if not t or not len(a_pack) or not b:
                yield NO_TOKENS
                continue
            b_pack = np.array(b, "<u4")
            i, j = self.cuts(a_pack, b_pack)
            # A key is the A ids and then the B ids, these moved above all A ids.
            a_key, b_key = a_pack.astype("<u4").tobytes(), (b_pack + self.a.size).astype("<u4").tobytes()
            i4, j4 = [4 * x for x in i], [4 * x for x in j]
            keys = [a_key[i0:i1] + b_key[j0:j1]
                    for i0, i1, j0, j1 in zip(i4, i4[1:], j4, j4[1:], strict=False)]
            found = list(map(get, keys))
            if None in found:
                a = a_pack.tolist()
                for n, hit in enumerate(found):
                    if hit is None:
                        found[n] = got = self.window(a[i[n]:i[n + 1]], b[j[n]:j[n + 1]])
                        if len(memo) < MEMO_WINDOWS:
                            memo[keys[n]] = got
            text, groups, links, spelt = zip(*found, strict=True)
            if None in spelt or b"".join(spelt) != (" " + t).encode("utf-8", "surrogatepass"):
                yield NO_TOKENS
                continue
            yield (len(a_pack), len(b), sum(groups), np.frombuffer(b"".join(links), np.int64),
                   hashlib.sha256(";".join(text).encode()).hexdigest())


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "n_pairs long, pairs binary, counts binary")


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per document its counts, its digest and its distinct pairs (packed longs and ints)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        gc.disable()  # no cycles arise here, and the memo is long to look through
        try:
            for b in batches:
                yield from step(al, b)
        finally:
            gc.enable()

    def step(al: Aligner, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts = b.column(0), b.column(1)
        for at in range(0, b.num_rows, TEXTS_PER_STEP):
            rows = []
            for n_a, n_b, groups, links, sha in al.documents(
                    texts.slice(at, TEXTS_PER_STEP).to_pylist()):
                pairs, counts = np.unique(links, return_counts=True)
                rows.append((n_a, n_b, groups, len(links), sha, len(pairs),
                             pairs.astype("<u8" if al.a.size * al.b.size >> 32 else "<u4").tobytes(),
                             counts.astype("<u4").tobytes()))
            cols = list(zip(*rows, strict=True))
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, TEXTS_PER_STEP),
                 *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                names=[c.split(" ")[0] for c in ALIGNED.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, ALIGNED)


def _unpack(pairs: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pairs, "<u4" if len(pairs) == 4 * n else "<u8").astype(np.int64)


def pair_counts(kept: DataFrame, b_size: int) -> DataFrame:
    """``pair, n, best``: corpus-wide link counts of id pairs."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out():
            k, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
            return k, n
        for b in batches:
            for n, p, c in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if n:
                    keys.append(_unpack(p, n))
                    counts.append(np.frombuffer(c, "<u4").astype(np.float64))
                    held += n
                if held > PAIRS_PER_FLUSH:
                    k, m = out()
                    keys, counts, held = [k], [m.astype(np.float64)], len(k)
                    if held > PAIRS_PER_FLUSH // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(m)], names=["pair", "n"])
                        keys, counts, held = [], [], 0
        if held:
            k, m = out()
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(m)], names=["pair", "n"])

    parts = kept.select("n_pairs", "pairs", "counts").mapInArrow(add, "pair long, n long")
    total = parts.groupBy("pair").agg(F.sum("n").alias("n"))
    of_b = W.partitionBy(F.col("pair") % b_size)
    return total.withColumn("best", F.col("n") == F.max("n").over(of_b))


def summed_links(kept: DataFrame, counts: DataFrame) -> DataFrame:
    """``row, n_best, count_sum`` per document, from shards of documents and
    blocks of the pair table that meet in co-groups of bounded size."""
    size = counts.agg(F.count("*")).first()[0]
    all_pairs = kept.agg(F.sum("n_pairs")).first()[0] or 0
    blocks = max(1, -(-size // PAIRS_PER_BLOCK))
    shards = max(1, -(-all_pairs // PAIRS_PER_SHARD))
    table = (counts.withColumn("block", F.pmod(F.xxhash64("pair"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    docs = (kept.filter("n_pairs > 0").select("row", "n_pairs", "pairs", "counts")
            .withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def meet(d: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if d.empty or t.empty:
            return pd.DataFrame({"row": [], "n_best": [], "count_sum": []}, dtype="int64")
        order = np.argsort(t["pair"].to_numpy())
        keys, n = t["pair"].to_numpy()[order], t["n"].to_numpy()[order]
        best = t["best"].to_numpy()[order]
        out = np.zeros((len(d), 2), np.int64)
        for i, (m, p, c) in enumerate(zip(d["n_pairs"], d["pairs"], d["counts"], strict=True)):
            own, times = _unpack(p, m), np.frombuffer(c, "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            here = keys[at] == own  # pairs of other blocks meet theirs elsewhere
            at, times = at[here], times[here]
            out[i] = times[best[at]].sum(), (times * n[at]).sum()
        return pd.DataFrame({"row": d["row"].to_numpy(), "n_best": out[:, 0], "count_sum": out[:, 1]})

    parts = (docs.groupBy("block", "shard").cogroup(table.groupBy("block", "shard"))
             .applyInPandas(meet, "row long, n_best long, count_sum long"))
    return parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document (see module text)."""
    kept = keep_table(aligned(docs, a_path, b_path, id_col, text_col)
                      .withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = keep_table(pair_counts(kept, aligner(a_path, b_path).b.size), "pair-counts")
    found = summed_links(kept, counts)
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return kept.drop("pairs", "counts", "n_pairs").join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"),
        "groups_sha256")
