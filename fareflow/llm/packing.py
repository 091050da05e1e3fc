"""Best-fit packing with certified bin counts (operator 10).

1. Every text is tokenized whole; a document is its ids followed by the end
   id.  Documents longer than a sequence are cut into full pieces and a rest.
2. Pieces are spread over partitions of bounded size by a hash of their key.
   Each partition runs best-fit decreasing and reports its bin count together
   with its sums under a family of dual feasible functions.  These sums add
   up over partitions, so any group of partitions has a certified lower bound.
3. Groups of 2, 4, 8, ... partitions whose bin count exceeds their bound
   exchange documents: the pieces in their loosest bins (at most one
   partition's worth of pieces) are pooled and run through best-fit decreasing
   again; the new packing is kept if it needs fewer bins.  Bins that do not fit
   the pool stay loose for the next level.  Groups that meet their bound are
   certified and stay put.

Defined results: a null or empty text is one document holding the end id
alone; repeated rows are packed once per row; an empty table gives an empty
result; columns other than the id and the text are ignored; the tokenizer's
special strings inside texts become their ids, as its plain call does; equal lengths are
ordered by (doc_id, piece) so the packing is the same on every run, up to the
order of fully equal rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareflow.llm.common import few_rows, keep_table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", part long, bin long, bin_fill long, offset long"
CAPACITY = 4096
END_ID = 1
ROWS_PER_PARTITION = 16_384
TEXTS_PER_STEP = 500
# Bins of equal fill are told apart by this many hash values.
_TIES = 256
# Words kept per worker.
CACHE_WORDS = 800_000

_tokenizers: dict[str, object] = {}
_words: dict[str, dict[bytes, bytes]] = {}
_parts: dict[str, dict[str, bytes]] = {}
# Printable ASCII and the letters from U+00C0 to U+017F but U+0130, whose lower case is two characters.
_LATIN = re.compile(rb"(?:[!-~]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])++")
# The tokenizer file's own split pattern, for these in lower case.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u017f]+|[0-9]|[^a-z\xdf-\xf6\xf8-\u017f0-9\n]+|\n")
# Byte-level characters: bytes from 0xA1 stand for themselves but 0xAD.
_BYTE_LEVEL = {**{b: 256 + 34 + b - 0x80 for b in range(0x80, 0xA1)}, 0xAD: 256 + 67}
# Stands for the end of a word among the ids of many words; no id is this large.
_WORD_END = np.array([0xFFFFFFFF], "<u4").tobytes()


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        _tokenizers[path] = t
        _words[path] = {}
    return _tokenizers[path], _words[path]


def _encode_words(tok, words: list[bytes], parts: dict[str, bytes]) -> dict[bytes, bytes]:
    """Ids of distinct words.

    For printable ASCII and Latin letters the tokenizer's normalisation is lower
    case alone, and its pre-tokens are runs of letters, single digits and runs of
    the rest (after the contractions), so those parts go to its model directly
    and common ones are looked up.  All other words, and those that may hold a
    special token's string, take the whole tokenizer.
    """
    plain = [w for w, m in zip(words, map(_LATIN.fullmatch, words), strict=True)
             if m is not None and b"<|" not in w]
    out: dict[bytes, bytes] = {}
    for at in range(0, len(plain), 20_000):
        part = plain[at:at + 20_000]
        # No part spans a line's end: the parts of all words, each word on its line.
        found = _PARTS.findall(b"\n".join(part).decode().lower() + "\n")
        met = list(set(found).difference(parts))
        for p in met:
            chars = p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_LEVEL)
            parts[p] = array("I", [x.id for x in tok.model.tokenize(chars)]).tobytes()
        parts["\n"] = _WORD_END
        raw = b"".join(map(parts.__getitem__, found))
        if len(parts) > CACHE_WORDS // 4:
            for p in met:
                del parts[p]
        ends = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == 0xFFFFFFFF)).tolist()
        out.update(zip(part, [raw[i:j] for i, j in zip([0, *[x + 4 for x in ends]], ends, strict=False)],
                       strict=True))
    rest = [w for w in words if w not in out]
    for at in range(0, len(rest), 20_000):
        part = rest[at:at + 20_000]
        enc = tok.encode_batch_fast([w.decode("utf-8", "replace") for w in part],
                                    add_special_tokens=False)
        out.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, enc, strict=True))
    return out


def encode_ids(path: str, texts: Sequence[str | None]) -> list[bytes]:
    """Little-endian uint32 ids of each text, without the end id.

    The tokenizer's pre-tokens never span ASCII white space, so a text's ids
    are those of its white-space-separated words in order.  Words met first are
    kept per worker, which are the frequent ones; the others are encoded again.
    """
    tok, known = _tokenizer(path)
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    room = len(known) < CACHE_WORDS
    new = _encode_words(tok, list(set().union(*split).difference(known)), _parts.setdefault(path, {}))
    known.update(new)
    out = [b"".join(map(known.__getitem__, ws)) for ws in split]
    if not room:
        for w in new:
            del known[w]
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens (see module text)."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches, TEXTS_PER_STEP):
            out: list[tuple] = []
            coded = encode_ids(tokenizer_path, b.column(1).to_pylist())
            for d, raw in zip(b.column(0).to_pylist(), coded, strict=True):
                raw += end
                out += [(d, k, k * capacity, len(x) // 4, zlib.crc32(x))
                        for k, x in enumerate(raw[s:s + step] for s in range(0, len(raw), step))]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                       pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length (given in decreasing order).

    Open bins are kept by free space; the set of occupied free-space values is
    one integer used as a bitmap, so the tightest bin is found by a shift.
    """
    open_bins: dict[int, list[int]] = {}
    mask, n_bins = 0, 0
    bins = np.empty(len(lengths), np.int64)
    offs = np.empty(len(lengths), np.int64)
    for i, x in enumerate(lengths.tolist()):
        fit = mask >> x
        if fit:
            free = x + (fit & -fit).bit_length() - 1
            stack = open_bins[free]
            b = stack.pop()
            if not stack:
                mask ^= 1 << free
        else:
            b, free = n_bins, capacity
            n_bins += 1
        bins[i], offs[i] = b, capacity - free
        left = free - x
        if left:
            stack = open_bins.setdefault(left, [])
            if not stack:
                mask |= 1 << left
            stack.append(b)
    return bins, offs


def dual_sums(lengths: np.ndarray, capacity: int) -> list[int]:
    """Sums of the lengths under dual feasible functions, scaled to integers.

    For a threshold t <= capacity / 2 a length over capacity - t counts as a
    whole bin and one under t as nothing.  For k >= 1 a length counts as
    floor((k + 1) x / capacity) / k bins, unless (k + 1) x / capacity is whole.
    Each entry divided by its unit (see ``bound``) bounds the bins from below.
    """
    x = lengths.astype(np.int64)
    out = []
    for t in thresholds(capacity):
        out.append(int(np.where(x > capacity - t, capacity, np.where(x < t, 0, x)).sum()))
    for k in range(1, 9):
        num = (k + 1) * x
        whole = num % capacity == 0
        out.append(int(np.where(whole, k * x, (num // capacity) * capacity).sum()))
    return out


def thresholds(capacity: int) -> list[int]:
    return sorted({capacity * j // 64 for j in range(33)})


def bound(sums: Sequence[int], capacity: int) -> int:
    units = [capacity] * len(thresholds(capacity)) + [k * capacity for k in range(1, 9)]
    return max(-(-s // u) for s, u in zip(sums, units, strict=True))


def _bound_column(capacity: int) -> F.Column:
    units = [capacity] * len(thresholds(capacity)) + [k * capacity for k in range(1, 9)]
    return F.greatest(*[F.ceil(F.sum(F.col("sums")[i]) / F.lit(u)) for i, u in enumerate(units)])


def _pack_frame(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True],
                          kind="stable", na_position="last")
    bins, offs = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
    fill = np.bincount(bins, weights=pdf["length"].to_numpy()).astype(np.int64)
    return pdf.assign(bin=bins, offset=offs, bin_fill=fill[bins] if len(bins) else bins)


def _exchange(level: int, capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Best-fit decreasing over a group's pooled loose pieces; kept if it saves bins."""

    def rerun(pdf: pd.DataFrame) -> pd.DataFrame:
        new = _pack_frame(pdf.drop(columns=["offset", "bin_fill"]), capacity)
        saved = pdf["seq"].nunique() - (int(new["bin"].max()) + 1)
        if saved <= 0:
            return pdf.assign(saved=0)
        g = int(pdf["grp"].iloc[0])
        return new.assign(seq=(level << 56) + (g << 28) + new["bin"],
                          saved=saved)[[*pdf.columns, "saved"]]

    return rerun


def pack(pieces: DataFrame, capacity: int = CAPACITY,
         rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Assign every piece a sequence and an offset in it.

    Returns the pieces with ``sequence_id`` and ``offset``.  All steps but
    the first touch only the loose bins of groups above their bound.
    """
    pieces = keep_table(pieces, "pieces")
    # The row count sets how many partitions there are, nothing else.
    parts = max(1, -(-pieces.count() // rows_per_partition))
    names = PIECES.replace(" long", "").replace(" int", "").split(", ")
    placed_cols = PLACED.replace(" long", "").replace(" int", "").split(", ")

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        return _pack_frame(pdf, capacity)[placed_cols]

    def sums_of(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf["length"].to_numpy()
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "n_bins": [int(pdf["bin"].max()) + 1],
                             "sums": [dual_sums(x, capacity)]})

    keyed = pieces.select(*names, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                         F.lit(parts)).alias("part"))
    placed = keep_table(keyed.groupBy("part").applyInPandas(first, PLACED), "packed0")
    stats = keep_table(placed.groupBy("part").applyInPandas(
        sums_of, "part long, n_bins long, sums array<long>"), "bounds")
    is_loose = F.col("bin_fill") < capacity
    # (level, group, bin) as one number: groups and bins are far below 2^28.
    seq = F.shiftleft("part", 28) + F.col("bin")
    done = placed.filter(~is_loose).select(*names, seq.alias("seq"), "offset")
    loose = placed.filter(is_loose).select(
        *names, "part", seq.alias("seq"), "offset", "bin_fill")
    zeros = F.array_repeat(F.lit(0).cast("long"), len(thresholds(capacity)) + 8)
    level, width = 0, 1
    while width < parts:
        level, width = level + 1, width * 2
        group = F.shiftright("part", level)
        gaps = (stats.groupBy(group.alias("grp"))
                .agg(F.sum("n_bins").alias("bins"), _bound_column(capacity).alias("bound"))
                .filter("bins > bound").select("grp"))

        # Each half of a group sends its loosest bins, half a partition of rows at
        # most; the others stay loose for the next level.  Only counts per
        # looseness are ranked, never rows.
        half = F.shiftright("part", level - 1)
        looseness = (F.col("bin_fill") * _TIES
                     + F.pmod(F.xxhash64("seq", F.lit(level)), F.lit(_TIES)))
        marked = loose.withColumn("half", half).withColumn("looseness", looseness)
        upto = (marked.groupBy("half", "looseness").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("total", F.sum("n").over(W.partitionBy("half").orderBy("looseness")))
                .filter(F.col("total") <= rows_per_partition // 2)
                .groupBy("half").agg(F.max("looseness").alias("upto")))
        marked = marked.join(upto, "half", "left")
        sent = F.coalesce(F.col("looseness") <= F.col("upto"), F.lit(False))
        shape = marked.filter(sent).withColumn("grp", group).select(
            *names, "part", "seq", "offset", "bin_fill", "grp")
        kept_back = marked.filter(~sent).select(*names, "part", "seq", "offset", "bin_fill")
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape.schema.fields)
        moved = keep_table(shape.join(gaps, "grp", "left_semi").groupBy("grp").applyInPandas(
            _exchange(level, capacity), fields + ", saved long"), f"packed{level}")
        rest = shape.join(gaps, "grp", "left_anti")
        stats = stats.unionByName(
            moved.groupBy("grp").agg(F.max("saved").alias("saved")).select(
                (F.col("grp") * width).cast("long").alias("part"),
                (-F.col("saved")).cast("long").alias("n_bins"),
                zeros.alias("sums")))
        now = moved.drop("saved").unionByName(rest)
        done = done.unionByName(now.filter(~is_loose).select(*names, "seq", "offset"))
        loose = keep_table(now.filter(is_loose).drop("grp").unionByName(kept_back),
                           f"loose{level}")
    done = done.unionByName(loose.select(*names, "seq", "offset"))
    return done.select(*names, F.col("seq").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_path, id_col, text_col, capacity), capacity)
