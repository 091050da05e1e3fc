"""Substring de-duplication by content-defined chunks (operator 2).

A gear rolling hash over the last 32 bytes is computed at every byte; a chunk
ends where the hash's low bits are zero, but not before ``MIN_BYTES`` and not
after ``MAX_BYTES`` bytes.  Because a cut depends on the bytes before it only,
an insertion shifts at most the chunks around it.  Chunks are compared by
128-bit digest; of equal chunks the first (by document id, then position)
stays, all others are removed.

Only digests and positions are shuffled, reduced to the first occurrence per
document before the shuffle.  A digest held by a third of all documents is a
partial minimum per task; the join that hands the winners back is a plain
equi-join that AQE may split.

Defined results: a null or empty text has no chunks; a row without an id is
left whole and removes nothing; repeated rows (same id) are equal: neither
removes the other's chunks, and within one text the first of equal chunks
stays; chunks cut inside a character are handled as bytes and rejoined, bytes
of characters that lose a part are dropped from the kept text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BYTES = 24
MAX_BYTES = 512
MASK_BITS = 6

_GEAR = np.random.default_rng(20240602).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(b: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of gear[b[i - j]] << j over the last 32 bytes."""
    h = _GEAR[b]
    for w in (1, 2, 4, 8, 16):
        # A window of 2w bytes is the last w bytes plus the w before, shifted by w.
        shifted = np.zeros_like(h)
        shifted[w:] = h[:-w] << np.uint32(w)
        h = h + shifted
    return h


def chunk_ends(raw: bytes, min_bytes: int = MIN_BYTES, max_bytes: int = MAX_BYTES,
               mask_bits: int = MASK_BITS) -> list[int]:
    """End of every chunk of a byte string."""
    if not raw:
        return []
    # The top bits depend on the whole window.
    h = gear_hashes(np.frombuffer(raw, np.uint8))
    cuts = (np.flatnonzero(h >> np.uint32(32 - mask_bits) == 0) + 1).tolist()
    ends, at, size = [], 0, len(raw)
    for c in cuts:
        while c - at > max_bytes:
            at += max_bytes
            ends.append(at)
        if c - at >= min_bytes:
            at = c
            ends.append(at)
    while size - at > max_bytes:
        at += max_bytes
        ends.append(at)
    if at < size:
        ends.append(size)
    return ends


CHUNKS = "row_key long, doc_id long, d1 long, d2 long, start long"


def _row_key(id_col: str, text_col: str) -> F.Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _first_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First occurrence of each distinct chunk of every document."""
    for b in batches:
        keys, ids, starts, count, digests = [], [], [], [], []
        for key, doc, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            seen: dict[bytes, int] = {}
            at = 0
            for end in chunk_ends(raw):
                seen.setdefault(xxhash.xxh3_128_digest(raw[at:end]), at)
                at = end
            keys.append(key)
            ids.append(doc)
            count.append(len(seen))
            digests += seen
            starts += seen.values()
        d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        n = np.array(count, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(keys, np.int64), n)),
             pa.array(np.repeat(np.array(ids, np.int64), n)),
             pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])),
             pa.array(np.array(starts, np.int64))],
            names=["row_key", "doc_id", "d1", "d2", "start"])


OUT = ("doc_id long, n_chunks long, n_dup_chunks long, n_bytes long, n_removed long, "
       "n_spans long, kept_sha256 string, text string")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {c.split()[0]: [] for c in OUT.split(", ")}
        for doc, text, taken in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            lost = set(taken or ())
            n = dup = spans = 0
            kept, at, gone, seen = [], 0, False, set()
            for end in chunk_ends(raw):
                part = raw[at:end]
                # Later equal chunks of this text go, whether or not the first one stays.
                drop = doc is not None and (part in seen or at in lost)
                seen.add(part)
                n += 1
                dup += drop
                spans += drop and not gone
                gone = drop
                if not drop:
                    kept.append(part)
                at = end
            left = b"".join(kept)
            for c, v in zip(out, (doc, n, dup, len(raw), len(raw) - len(left), spans,
                                  hashlib.sha256(left).hexdigest(),
                                  left.decode("utf-8", "ignore")), strict=True):
                out[c].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.string() if c in ("kept_sha256", "text") else pa.int64())
             for c, v in out.items()], names=list(out))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chunk counts, removed bytes and kept text of every document (see ``OUT``)."""
    d = docs.select(_row_key(id_col, text_col).alias("row_key"),
                    F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = (d.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
              .mapInArrow(_first_chunks, CHUNKS))
    # The smallest id keeps a chunk; only digests on several ids go back.
    owners = (chunks.groupBy("d1", "d2").agg(F.min("doc_id").alias("owner"),
                                             F.max("doc_id").alias("last"))
              .filter("owner < last").select("d1", "d2", "owner"))
    lost = (chunks.join(owners, ["d1", "d2"]).filter("doc_id > owner")
            .groupBy("row_key").agg(F.collect_set("start").alias("lost")))
    return (d.join(lost, "row_key", "left").select("doc_id", "text", "lost")
            .mapInArrow(_rebuild, OUT))
