"""N-gram Jaccard join by MinHash banding (operator 7).

1. A text's n-grams are its windows of five words (a shorter text is one
   n-gram), hashed to 64 bits.  Texts with the same n-gram set form one node,
   so copies are never paired with each other.
2. Each node gets a MinHash signature cut into bands; band and row counts are
   the ones with the most rows that still reach the target recall at the
   similarity threshold.  Nodes are shuffled on their band hashes; nodes that
   share a bucket are candidates.
3. Candidates are verified on their full n-gram sets.  Nodes connected through
   buckets are checked together, in blocks of bounded size, so a node's set
   travels once per block of its own group; a block pair returns per node its
   number of links and one link towards its group, never the pairs.
4. Verified links give the classes (connected components).

A hot bucket or a large group of near copies is spread over block pairs; all
of its links are still counted.

Defined results: a null, empty or white-space text has no n-grams, is in a
class of its own and has no links, as has a row without an id; repeated rows count as copies of each other;
classes are named by their smallest document id; an empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import few_rows, giving_back, keep_table, unpacked, whole_row
from fareflow.llm.components import connected_components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
MAX_HASHES = 160
BLOCK = 512
# Texts are hashed together up to this many bytes at a time.
BATCH_BYTES = 1_000_000
TEXTS_PER_STEP = 500

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_MULT = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT32 = (_rng.integers(1, 2**31, MAX_HASHES, dtype=np.uint32) * np.uint32(2)
           + np.uint32(1))
_XOR32 = _rng.integers(1, 2**32, MAX_HASHES, dtype=np.uint32)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL,
              max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: most rows per band that reach ``recall`` within the budget."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        hit = similarity ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word (run of non-white bytes) of a buffer."""
    b = np.frombuffer(raw, np.uint8)
    word = ~_IS_WHITE[b]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.flatnonzero(word)
    inside = at - np.repeat(starts, ends - starts)
    powers = np.ones(int((ends - starts).max()), np.uint64)
    powers[1:] = _POWER
    powers = np.multiply.accumulate(powers)
    offs = np.concatenate(([0], np.cumsum(ends - starts)[:-1]))
    return _mix(np.add.reduceat(_BYTE[b[at]] * powers[inside], offs)), starts


def gram_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text (empty without words)."""
    out: list[np.ndarray] = []
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) <= BATCH_BYTES):
            size += len(raws[end]) + 1
            end += 1
        group = raws[at:end]
        h, starts = _word_hashes(b" ".join(group))
        cuts = np.cumsum([0] + [len(r) + 1 for r in group])
        first = np.searchsorted(starts, cuts)
        grams = np.zeros(max(len(h) - n + 1, 0), np.uint64)
        for j in range(n):
            grams += h[j:len(h) - n + 1 + j] * _MULT[j]
        grams = _mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(grams[a:b - n + 1]))
            elif b > a:
                out.append(_mix((h[a:b] * _MULT[8:8 + b - a]).sum(dtype=np.uint64, keepdims=True)))
            else:
                out.append(np.zeros(0, np.uint64))
        at = end
    return out


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Signed 64-bit hash of each band of the MinHash signature."""
    k = bands * rows
    g = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(k, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(g), 2048):
        part = (g[at:at + 2048, None] ^ _XOR32[None, :k]) * _MULT32[None, :k]
        np.minimum(low, part.min(axis=0), out=low)
    sig = low.astype(np.uint64).reshape(bands, rows) * _MULT[None, 16:16 + rows]
    h = _mix(sig.sum(axis=1, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _POWER)
    return h.view(np.int64)


SIGNED = "row_id long, node long, n_grams int, bands array<long>"


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches, TEXTS_PER_STEP):
            node, size, band = [], [], []
            ids = b.column(0)
            for i, g in enumerate(gram_sets(b.column(1).to_pylist())):
                size.append(len(g))
                if len(g) and ids[i].is_valid:
                    x = xxhash.xxh3_64_intdigest(g.tobytes())
                    node.append(x - (1 << 64) if x >> 63 else x)
                    band.append(band_hashes(g, bands, rows))
                else:
                    node.append(None)
                    band.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(node, pa.int64()), pa.array(size, pa.int32()),
                 pa.array(band, pa.list_(pa.int64()))],
                names=["row_id", "node", "n_grams", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col)).mapInArrow(
        sign, SIGNED)


def similar(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> np.ndarray:
    """Boolean matrix: Jaccard similarity of each pair of sets is at least ``similarity``."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    ga, gb = np.concatenate(a), np.concatenate(b)
    da, db = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    # Only n-grams on both sides can add to an intersection.
    both = np.intersect1d(ga, gb)
    ka, kb = np.isin(ga, both), np.isin(gb, both)
    ca, cb = np.searchsorted(both, ga[ka]), np.searchsorted(both, gb[kb])
    da, db = da[ka], db[kb]
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, da, cb, db = ca[oa], da[oa], cb[ob], db[ob]
    common = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    for at in range(0, len(both), width):
        ma = np.zeros((len(a), width), np.float32)
        mb = np.zeros((len(b), width), np.float32)
        s, e = np.searchsorted(ca, (at, at + width))
        ma[da[s:e], ca[s:e] - at] = 1
        s, e = np.searchsorted(cb, (at, at + width))
        mb[db[s:e], cb[s:e] - at] = 1
        common += ma @ mb.T
    union = na[:, None] + nb[None, :] - common
    return common >= similarity * union - 1e-6


LINKED = "node long, links long, towards long"


def _verify(similarity: float):
    def block_pair(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
        # Repeated rows bring a node more than once.
        pdf = pdf.drop_duplicates("node").sort_values("node")
        a, b = pdf[pdf["block"] == p], pdf[pdf["block"] == q]
        if p == q:
            b = a
        if a.empty or b.empty:
            return pd.DataFrame({"node": [], "links": [], "towards": []}, dtype="int64")
        sets = lambda x: [np.frombuffer(g, np.uint64) for g in x["grams"]]
        link = similar(sets(a), sets(b), similarity)
        na, nb = a["node"].to_numpy(), b["node"].to_numpy()
        link &= na[:, None] != nb[None, :]
        root_a, root_b = _local_roots(na, nb, link)
        out = [_per_node(na, link, b["copies"].to_numpy(), root_a)]
        if p != q:
            out.append(_per_node(nb, link.T, a["copies"].to_numpy(), root_b))
        return pd.concat(out)

    return block_pair


def _local_roots(na: np.ndarray, nb: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest node of each node's component within a block pair."""
    ra, rb = na.copy(), nb.copy()
    top = np.iinfo(np.int64).max
    while True:
        a = np.minimum(ra, np.where(link, rb[None, :], top).min(axis=1))
        b = np.minimum(rb, np.where(link, a[:, None], top).min(axis=0))
        if (a == ra).all() and (b == rb).all():
            return ra, rb
        ra, rb = a, b


def _per_node(nodes: np.ndarray, link: np.ndarray, copies: np.ndarray,
              roots: np.ndarray) -> pd.DataFrame:
    """Linked nodes with their number of links and one edge that keeps them connected."""
    has = link.any(axis=1)
    return pd.DataFrame({"node": nodes[has], "links": (link @ copies)[has].astype("int64"),
                         "towards": roots[has]})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, recall: float = RECALL,
                    block: int = BLOCK) -> DataFrame:
    """``doc_id, node, class_id, n_links, n_copies`` of every document.

    ``class_id``: smallest document id of the connected class.  ``n_links``:
    other documents at or above the similarity, copies included.
    ``n_copies``: documents with the same n-gram set, the row itself included.
    """
    bands, rows = bands_for(similarity, recall)
    signed = keep_table(signatures(docs, id_col, text_col, bands, rows), "signed")
    # A text without n-grams has no node; it comes back in the final join.
    nodes = (signed.filter("node is not null").groupBy("node")
             .agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                  F.any_value("bands").alias("bands")))
    in_band = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    shared = (in_band.groupBy("band", "h").agg(F.min("node").alias("low"), F.max("node").alias("top"))
              .filter("low < top"))
    stars = (in_band.join(shared, ["band", "h"]).filter("node > low")
             .select(F.col("node").alias("a"), F.col("low").alias("b")))
    groups = keep_table(connected_components(stars), "groups")
    blocks = (groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
              .select("root", F.ceil(F.col("size") / block).cast("int").alias("n_blocks")))
    members = (groups.join(blocks, "root")
               .join(nodes.select("node", "copies"), "node")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")))
    # One text per node: any row with the node's smallest id and that n-gram set.
    chosen = (signed.filter("node is not null").groupBy("node").agg(F.min("row_id").alias("row_id"))
              .join(members, "node"))
    grams = _sets_of(docs, chosen, id_col, text_col)
    k = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    paired = (grams.withColumn("k", k)
              .withColumn("p", F.least("block", "k")).withColumn("q", F.greatest("block", "k"))
              .select("root", "p", "q", "block", "node", "copies", "grams"))
    found = keep_table(paired.groupBy("root", "p", "q").applyInPandas(
        giving_back(_verify(similarity)), LINKED),
                       "links")
    classes = connected_components(found.select(F.col("node").alias("a"),
                                                F.col("towards").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "first_id", "copies").join(classes, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = (named.join(ids, "root").join(links, "node", "left")
             .select("node", "class_id", "copies", F.coalesce("links", F.lit(0).cast("long"))
                     .alias("links")))
    return signed.select("row_id", "node").join(named, "node", "left").select(
        F.col("row_id").alias("doc_id"), "node",
        F.coalesce("class_id", "row_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("n_copies"))


def _sets_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The chosen nodes with their n-gram sets, read from the texts again."""
    joined = (chosen.join(docs.select(F.col(id_col).cast("long").alias("row_id"),
                                      F.col(text_col).alias("__t")),
                          "row_id")
              .select("root", "n_blocks", "block", "node", "copies", "__t"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches, TEXTS_PER_STEP):
            keep, found = [], []
            for i, g in enumerate(gram_sets(b.column(5).to_pylist())):
                x = xxhash.xxh3_64_intdigest(g.tobytes())
                # Rows that share an id but not the text belong to another node.
                if (x - (1 << 64) if x >> 63 else x) == b.column(3)[i].as_py():
                    keep.append(i)
                    found.append(g.tobytes())
            kept = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(i) for i in range(5)), pa.array(found, pa.binary())],
                names=["root", "n_blocks", "block", "node", "copies", "grams"])

    return joined.mapInArrow(
        sets, "root long, n_blocks int, block int, node long, copies long, grams binary")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class: the one with the smallest id.

    Of repeated rows (same id, same text) one stays; if their other columns
    differ, any one of them.
    """
    found = near_duplicates(docs, id_col, text_col)
    # Rows without an id or without words are classes of their own.
    best = (found.filter(F.col("doc_id") == F.col("class_id"))
            .select(F.col("doc_id").alias("id")).distinct())
    d = docs.select(whole_row(docs).alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.xxhash64(F.col(text_col)).alias("key"))
    kept = d.filter(F.col("id").isNotNull()).join(best, "id", "left_semi")
    return (kept.unionByName(d.filter(F.col("id").isNull())).dropDuplicates(["id", "key"])
            .select(*unpacked(docs, "row", {})))
