"""Removal of byte strings repeated across documents by suffix sorting (operator 8).

A byte goes if some ``LENGTH``-byte string covering it also starts in a
document with a smaller id.  Strings never cross documents.

Which suffixes are worth sorting is found first.  Every ``LENGTH``-byte string
has an anchor: the 20-byte gram in it with the smallest hash.  Equal strings
have equal anchors, so only strings whose anchor occurs in two documents can
repeat.  Consecutive strings with one anchor form a segment (50 to 80 bytes).

1. Each task reduces its anchors to one entry per batch and sends them to
   hash buckets, four bytes each (a bucket holds about a million anchors at
   any corpus size).  Buckets report the recurring ones to the documents'
   chunks; an anchor seen twice within a batch is known to recur at once.
2. Each chunk cuts the segments of its recurring anchors and sorts them with
   deep-shallow sorting.  Of equal segments the one of the smallest id goes on
   to the anchor's bucket; the others are already decided.
3. Each bucket sorts the remaining segments, then the suffixes of those anchors
   that still have different segments, cut at ``LENGTH`` bytes.  In sorted
   order equal strings are neighbours, and all but those of the smallest id
   are removed.

Deep-shallow sorting: multikey quicksort on 8-byte characters down to a
shallow depth (all open groups of one depth are split by one vectorised
sort); what still shares its prefix there is ordered by a blind trie per group.

Groups sent onward hold distinct segments only, so copies of a passage, however
many, reach a bucket once per chunk.  Hash collisions only cost extra sorting.
Between steps a chunk sends each bucket one compressed block of arrays.

Defined results: a null or empty text has no bytes and the hash of nothing; a
row without an id removes nothing and loses nothing; repeated rows share their
id, so they do not remove each other's bytes, and each gets the same result;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import few_rows, giving_back

LENGTH = 50
GRAM = 20
# Text bytes per chunk and per bucket's share; sizes tasks, nothing else.
CHUNK_BYTES = 8_000_000
BUFFER_BYTES = 1_000_000
SHALLOW_CHARS = 3
SORT_ROWS = 200_000
CHAR_ROWS = 5_000
TEXTS_PER_STEP = 2_000

_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MASK64 = (1 << 64) - 1


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """Mixed hash of every GRAM-byte string, by doubling."""
    def join(x: np.ndarray, y: np.ndarray, width: int, shift: int) -> np.ndarray:
        n = len(y) - shift
        return x[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + y[shift:]

    h1 = _BYTE[b]
    h2 = join(h1, h1, 1, 1)
    h4 = join(h2, h2, 2, 2)
    h8 = join(h4, h4, 4, 4)
    h16 = join(h8, h8, 8, 8)
    h = join(h16, h4, 4, 16)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def segments(raws: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``doc, start, end, hash`` of every segment: its string starts are [start, end).

    ``doc`` indexes ``raws``; positions are in the document.
    """
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    b = np.frombuffer(b"".join(raws), np.uint8)
    none = np.zeros(0, np.int64)
    if len(b) < length:
        return none, none, none, none.astype(np.uint64)
    h = _gram_hashes(b)
    # Sliding minimum over the grams of a string; the position in the low bits
    # makes the leftmost of equal hashes win.
    bits = max(20, int(len(h)).bit_length())
    low = np.uint64((1 << bits) - 1)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width, span = length - GRAM + 1, 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    if span < width:
        v = np.minimum(v[:len(v) - (width - span)], v[width - span:])
    at = (v & low).astype(np.int64)
    starts = np.arange(len(at))
    doc = np.searchsorted(ends, starts, side="right")
    ok = starts + length <= ends[np.minimum(doc, len(ends) - 1)]
    new = np.empty(len(at), bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))
    keep = ok[first]
    first, last = first[keep], last[keep]
    doc = doc[first]
    return doc, first - begins[doc], last - begins[doc], h[at[first]] >> np.uint64(16)


def batches_of(raws: list[bytes], limit: int = BUFFER_BYTES) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) <= limit):
            size += len(raws[end])
            end += 1
        yield at, end
        at = end


# -- deep-shallow sorting -------------------------------------------------------

def blind_trie_order(strings: list[bytes]) -> list[list[int]]:
    """Indices of equal-length strings in sorted order, equal ones together.

    A blind trie keeps only branching positions.  A string first descends on
    those alone, is compared once with the leaf it meets to find its real
    branching position, and is then hung in there.
    """
    size = len(strings[0])
    root: list = [size, [0]]  # [branching position, children] or [size, indices]
    for i in range(1, len(strings)):
        s = strings[i]
        node, path = root, []
        while node[0] < size:
            path.append(node)
            child = node[1].get(s[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[1][0]]
        if s == other:
            node[1].append(i)
            continue
        diff = int.from_bytes(s) ^ int.from_bytes(other)
        at = size - (diff.bit_length() + 7) // 8
        parent, below = None, root
        while below[0] < at:
            parent, below = below, below[1][s[below[0]]]
        if below[0] == at:
            below[1][s[at]] = [size, [i]]
            continue
        fork = [at, {s[at]: [size, [i]], other[at]: below}]
        if parent is None:
            root = fork
        else:
            parent[1][s[parent[0]]] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] >= size:
            out.append(node[1])
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def deep_shallow(chars: np.ndarray, group: np.ndarray,
                 shallow: int = SHALLOW_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of 8-byte characters within ``group``.

    Returns the order and, per sorted row, whether it starts a new (group,
    string) class.
    """
    n, width = chars.shape
    order = np.argsort(group, kind="stable")
    g = group[order]
    new = np.ones(n, bool)
    new[1:] = g[1:] != g[:-1]
    for d in range(min(shallow, width)):
        # Rows alone in their class are in place; the rest is split by one character.
        last = np.append(new[1:], True)
        open_ = np.flatnonzero(~(new & last))
        if not len(open_):
            return order, new
        cls = np.cumsum(new[open_] | (np.diff(open_, prepend=-2) > 1))
        key = chars[order[open_], d]
        by = np.lexsort((key, cls))
        order[open_] = order[open_][by]
        cls, key = cls[by], key[by]
        starts = np.ones(len(open_), bool)
        starts[1:] = (cls[1:] != cls[:-1]) | (key[1:] != key[:-1])
        new[open_] = starts
    if width <= shallow:
        return order, new
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    head = np.repeat(first, size)
    same = (chars[order][:, shallow:] == chars[order[head]][:, shallow:]).all(axis=1)
    mixed = np.unique(head[~same])
    sizes = dict(zip(first.tolist(), size.tolist(), strict=True))
    for at in mixed.tolist():
        rows = order[at:at + sizes[at]].copy()
        tails = chars[rows][:, shallow:].astype(">u8")
        classes = blind_trie_order([r.tobytes() for r in tails])
        spot = at
        for members in classes:
            order[spot:spot + len(members)] = rows[members]
            new[spot:spot + len(members)] = False
            new[spot] = True
            spot += len(members)
    return order, new


def _chars(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` 8-byte big-endian characters, zero behind each size."""
    at = np.arange(width * 8)
    out = np.empty((len(starts), width), np.uint64)
    # An index takes eight times the bytes it looks up, so few rows at a time have one.
    for i in range(0, len(starts), CHAR_ROWS):
        here = slice(i, i + CHAR_ROWS)
        idx = np.minimum(starts[here, None] + at[None, :], len(buf) - 1)
        rows = np.where(at[None, :] < sizes[here, None], buf[idx], np.uint8(0))
        out[here] = rows.view(">u8")
    return out


def _class_min(doc: np.ndarray, order: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: smallest id in its class, and the class number."""
    cls = np.empty(len(doc), np.int64)
    cls[order] = np.cumsum(new) - 1
    low = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(doc) else doc
    return low[cls], cls


def _merge(keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of the intervals of each key (touching ones joined)."""
    by = np.lexsort((start, keys))
    keys, start, end = keys[by], start[by], end[by]
    if not len(keys):
        return keys, start, end
    # Running maximum of ends within a key: keys are made to dominate.
    rank = np.cumsum(np.append(True, keys[1:] != keys[:-1])) - 1
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * big)
    new = np.append(True, (start + rank * big)[1:] > reach[:-1])
    new |= np.append(True, rank[1:] != rank[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], start[first], reach[last] - rank[last] * big


def _row_key(doc_id: int, raw: bytes) -> int:
    x = xxhash.xxh3_64_intdigest(raw, seed=doc_id & _MASK64)
    return x - (1 << 64) if x >> 63 else x


# -- Spark steps ----------------------------------------------------------------

# kind 0: anchors of one document (reported if they recur), kind 1: recur within
# the batch, kind 2: report to a chunk, passed on as it is.
ANCHORS = "bucket int, kind int, chunk int, hashes binary"


def _pack(*arrays) -> bytes:
    """Arrays and byte strings as one compressed block."""
    return zstandard.compress(pickle.dumps(arrays, protocol=5), 3)


def _unpack(raw: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(raw))


def _short(h: np.ndarray, buckets: int) -> np.ndarray:
    """What distinguishes an anchor within its bucket: 32 bits of its hash."""
    return (h // np.uint64(buckets)).astype(np.uint32)


def _raws(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def _reduce_anchors(b: pa.RecordBatch, length: int, parts: list[tuple]) -> None:
    """Add the hash, kind and chunk of the anchors of some texts to ``parts``."""
    chunk = b.column(0).to_numpy(zero_copy_only=False)
    ids, raws = b.column(1).to_numpy(zero_copy_only=False), _raws(b.column(2).to_pylist())
    for s, e in batches_of(raws):
        doc, _, _, h = segments(raws[s:e], length)
        if not len(h):
            continue
        by = np.lexsort((ids[s:e][doc], h))
        h, doc = h[by], doc[by] + s
        one = np.append(True, h[1:] != h[:-1])
        cls = np.cumsum(one) - 1
        first = np.flatnonzero(one)
        top = np.maximum.reduceat(ids[doc], first)
        multi = (top != ids[doc[first]])
        # One entry per hash; each chunk that holds a recurring one is told.
        kind = multi.astype(np.int8)
        parts.append((h[first], kind, chunk[doc[first]]))
        again = multi[cls]
        tell = np.unique(np.stack([h[again], chunk[doc[again]].astype(np.uint64)]), axis=1)
        parts.append((tell[0], np.full(tell.shape[1], 2, np.int8), tell[1].astype(np.int32)))


def _send_anchors(buckets: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for few in few_rows([b], TEXTS_PER_STEP):
                _reduce_anchors(few, length, parts)
            if not parts:
                continue
            h, kind, to = (np.concatenate(x) for x in zip(*parts, strict=True))
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((h, to, kind, bucket))
            h, kind, to, bucket = _short(h, buckets)[by], kind[by], to[by], bucket[by]
            cut = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(kind) != 0)
                                           | (np.diff(to) != 0)))
            stop = np.append(cut[1:], len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut], pa.int32()), pa.array(kind[cut], pa.int32()),
                 pa.array(to[cut], pa.int32()),
                 pa.array([h[i:j].tobytes() for i, j in zip(cut, stop, strict=True)], pa.binary())],
                names=["bucket", "kind", "chunk", "hashes"])

    return run


TOLD = "chunk int, bucket int, hashes binary"


def _recurring(pdf: pd.DataFrame) -> pd.DataFrame:
    bucket = int(pdf["bucket"].iloc[0])
    asked = pdf[pdf["kind"] < 2]
    out = [pdf.loc[pdf["kind"] == 2, ["chunk", "bucket", "hashes"]]]
    if len(asked):
        each = [np.frombuffer(x, np.uint32) for x in asked["hashes"]]
        h = np.concatenate(each)
        n = [len(x) for x in each]
        kind, chunk = np.repeat(asked["kind"].to_numpy(), n), np.repeat(asked["chunk"].to_numpy(), n)
        _, inv, count = np.unique(h, return_inverse=True, return_counts=True)
        hot = (count > 1)[inv] & (kind == 0)
        h, chunk = h[hot], chunk[hot]
        for c in np.unique(chunk).tolist():
            out.append(pd.DataFrame({"chunk": [c], "bucket": [bucket],
                                     "hashes": [h[chunk == c].tobytes()]}))
    return pd.concat(out)


# kind 0: segments to compare; kind 1: decided spans of a chunk's rows.
FOUND = "bucket int, kind int, chunk int, payload binary"


def _ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices first[0], first[0] + 1, ... (n[0] of them), first[1], ..."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _cut_segments(buckets: int, length: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        rows: dict[str, list] = {c.split()[0]: [] for c in FOUND.split(", ")}

        def send(*row) -> None:
            for name, v in zip(rows, row, strict=True):
                rows[name].append(v)

        docs = docs[docs["doc_id"].notna()]
        if docs.empty or told.empty:
            return pd.DataFrame(rows)
        hot = np.unique(np.concatenate(
            [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(b << 32)
             for b, x in zip(told["bucket"].tolist(), told["hashes"], strict=True)]))
        chunk = int(docs["chunk"].iloc[0])
        ids = docs["doc_id"].to_numpy().astype(np.int64)
        raws = _raws(docs["text"])
        keys = np.array([_row_key(int(i), r) for i, r in zip(ids, raws, strict=True)], np.int64)
        parts, bufs, base = [], [], 0
        for s, e in batches_of(raws):
            doc, start, end, h = segments(raws[s:e], length)
            name = _short(h, buckets) | ((h % np.uint64(buckets)) << np.uint64(32))
            on = hot[np.minimum(np.searchsorted(hot, name), len(hot) - 1)] == name
            doc, start, end, h = doc[on] + s, start[on], end[on], h[on]
            if not len(doc):
                continue
            offs = np.cumsum([0] + [len(r) for r in raws[s:e]])[:-1] + base
            parts.append((doc, start, end, h, offs[doc - s] + start))
            bufs.append(np.frombuffer(b"".join(raws[s:e]), np.uint8))
            base += len(bufs[-1])
        if not parts:
            return pd.DataFrame(rows)
        doc, start, end, h, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        buf = np.concatenate(bufs)
        size = end - start + length - 1
        low, cls = _sorted_classes(buf, at, size, h, ids[doc], length)
        done = ids[doc] > low
        if done.any():
            send(chunk % buckets, 1, chunk,
                 _pack(*_merge(keys[doc[done]], start[done], (end + length - 1)[done])))
        # Of each class one row per row key of the smallest id goes on.
        left = np.flatnonzero(~done)
        by = left[np.lexsort((start[left], keys[doc[left]], cls[left]))]
        if len(by):
            first = np.flatnonzero(np.append(True, (np.diff(cls[by]) != 0)
                                             | (np.diff(keys[doc[by]]) != 0)))
            n = np.diff(np.append(first, len(by)))
            to = (h[by[first]] % np.uint64(buckets)).astype(np.int64)
            view = memoryview(buf)
            for b in np.unique(to).tolist():
                f, m = first[to == b], n[to == b]
                one = by[f]
                text = b"".join([view[a:z] for a, z in zip(
                    at[one].tolist(), (at[one] + size[one]).tolist(), strict=True)])
                send(b, 0, chunk, _pack(h[one], keys[doc[one]], ids[doc[one]], size[one], m,
                                        start[by[_ragged(f, m)]], text))
        return pd.DataFrame(rows)

    return run


def _sorted_classes(buf: np.ndarray, at: np.ndarray, size: np.ndarray, h: np.ndarray,
                    ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sort of the segments of each anchor, in blocks of whole anchors."""
    low, cls = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    by_hash = np.argsort(h, kind="stable")
    hs = h[by_hash]
    begin, number = 0, 0
    width = -(-(2 * length - GRAM) // 8)
    while begin < len(hs):
        end = min(begin + SORT_ROWS, len(hs))
        end = int(np.searchsorted(hs, hs[end - 1], side="right"))
        rows = by_hash[begin:end]
        chars = _chars(buf, at[rows], size[rows], width)
        # The size is the last character: a segment may be a prefix of another.
        chars = np.concatenate([chars, size[rows, None].astype(np.uint64)], axis=1)
        order, new = deep_shallow(chars, h[rows])
        low[rows], c = _class_min(ids[rows], order, new)
        cls[rows] = c + number
        number += int(new.sum())
        begin = end
    return low, cls


SPANS = "chunk int, payload binary"


def _compare(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        decided = pdf["kind"] == 1
        out = [pdf.loc[decided, ["chunk", "payload"]]]
        blocks = [(c, *_unpack(x)) for c, x in zip(pdf["chunk"][~decided], pdf["payload"][~decided],
                                                   strict=True)]
        if blocks:
            chunk = np.repeat([b[0] for b in blocks], [len(b[1]) for b in blocks])
            h, keys, ids, size, n, starts = (np.concatenate([b[i] for b in blocks])
                                             for i in range(1, 7))
            text = np.frombuffer(b"".join([b[7] for b in blocks]), np.uint8)
            row, s, e = _covered(text, size, h, ids, n, starts, length)
            for c in np.unique(chunk[row]).tolist():
                on = chunk[row] == c
                out.append(pd.DataFrame({"chunk": [c], "payload": [
                    _pack(*_merge(keys[row[on]], s[on], e[on]))]}))
        return pd.concat(out)

    return run


def _covered(buf: np.ndarray, size: np.ndarray, h: np.ndarray, ids: np.ndarray, n: np.ndarray,
             starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered intervals ``row, start, end`` of segment rows (``n`` starts each)."""
    at = np.cumsum(size) - size
    low, cls = _sorted_classes(buf, at, size, h, ids, length)
    whole = ids > low
    rows, first, last = [np.flatnonzero(whole)], [np.zeros(whole.sum(), np.int64)], [size[whole]]
    # Anchors that still have different segments: their strings one by one.
    one = np.unique(cls, return_index=True)[1]
    _, inv, count = np.unique(h[one], return_inverse=True, return_counts=True)
    one = one[(count > 1)[inv]]
    one = one[np.argsort(h[one], kind="stable")]
    begin, width = 0, -(-length // 8)
    strings = size[one] - length + 1
    total = np.cumsum(strings)
    hit_seg, hit_at = [], []
    while begin < len(one):
        goal = (total[begin - 1] if begin else 0) + SORT_ROWS
        end = max(begin + 1, int(np.searchsorted(total, goal, side="right")))
        end = int(np.searchsorted(h[one], h[one[min(end, len(one)) - 1]], side="right"))
        part, m = one[begin:end], strings[begin:end]
        seg, j = np.repeat(part, m), _ragged(np.zeros(len(m), np.int64), m)
        chars = _chars(buf, at[seg] + j, np.full(len(seg), length), width)
        order, new = deep_shallow(chars, h[seg])
        least, _ = _class_min(low[seg], order, new)
        on = least < low[seg]
        hit_seg.append(cls[seg[on]])
        hit_at.append(j[on])
        begin = end
    if hit_seg:
        # A class's covered strings hold for all of its rows with its smallest id.
        c, j = np.concatenate(hit_seg), np.concatenate(hit_at)
        c, s, e = _merge(c, j, j + length)
        rest = np.flatnonzero(~whole)
        rest = rest[np.argsort(cls[rest], kind="stable")]
        a, z = np.searchsorted(cls[rest], c), np.searchsorted(cls[rest], c, side="right")
        rows.append(rest[_ragged(a, z - a)])
        first.append(np.repeat(s, z - a))
        last.append(np.repeat(e, z - a))
    row, s, e = np.concatenate(rows), np.concatenate(first), np.concatenate(last)
    spots = starts[_ragged((np.cumsum(n) - n)[row], n[row])]
    times = n[row]
    return np.repeat(row, times), spots + np.repeat(s, times), spots + np.repeat(e, times)


def _apply(out_text: bool):
    def run(docs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        cuts: dict[int, slice] = {}
        if len(spans):
            keys, start, end = _merge(*(np.concatenate(x) for x in zip(
                *map(_unpack, spans["payload"]), strict=True)))
            edges = np.flatnonzero(np.append(True, np.diff(keys) != 0)).tolist() if len(keys) else []
            cuts = {int(keys[a]): slice(a, z)
                    for a, z in zip(edges, [*edges[1:], len(keys)], strict=True)}
        done: dict = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
        raws = _raws(docs["text"])
        for i, raw in zip(docs["doc_id"], raws, strict=True):
            own = cuts.get(_row_key(int(i), raw)) if not pd.isna(i) else None
            kept, removed, n = raw, 0, 0
            if own is not None:
                s, e = start[own], end[own]
                removed, n = int((e - s).sum()), len(s)
                edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            done["n_bytes"].append(len(raw))
            done["n_removed"].append(removed)
            done["n_spans"].append(n)
            done["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            done["kept_text"].append(kept.decode("utf-8", "ignore") if out_text else None)
        # A null text stays null.
        done["kept_text"] = [None if t is None else k
                             for t, k in zip(docs["text"], done["kept_text"], strict=True)]
        return docs.drop(columns=["chunk", "text"]).assign(**done)

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          length: int = LENGTH, with_text: bool = False,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    With ``with_text`` also ``row`` (the other columns as a struct) and
    ``kept_text``: the remaining bytes as text without cut characters.
    """
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    cols = [F.pmod(F.xxhash64(id_col, text_col), F.lit(n)).cast("int").alias("chunk"),
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    base = docs.select(*cols)
    rows = docs.select(*cols, F.struct(*[F.col(c) for c in docs.columns if c != text_col])
                       .alias("row")) if with_text else base
    sent = base.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).mapInArrow(
        _send_anchors(n, length), ANCHORS)
    told = sent.groupBy("bucket").applyInPandas(giving_back(_recurring), TOLD)
    found = base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        giving_back(_cut_segments(n, length)), FOUND)
    spans = found.groupBy("bucket").applyInPandas(giving_back(_compare(length)), SPANS)
    out = T.StructType([T.StructField("doc_id", T.LongType()),
                        *([rows.schema["row"]] if with_text else []),
                        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                        T.StructField("kept_sha256", T.StringType()),
                        T.StructField("kept_text", T.StringType())])
    done = rows.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInPandas(
        giving_back(_apply(with_text)), out)
    return done if with_text else done.drop("kept_text")
