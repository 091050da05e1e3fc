"""Sampled SentencePiece segmentations without replacement (operator 4).

Gumbel top-k: every segmentation of a text gets its log-probability plus an
independent Gumbel variate, and the k largest are a sample of k distinct
segmentations without replacement.  They are found by best-first search on the
lattice with the perturbed values as exact bounds: the best value below a node
is one Gumbel variate at the node's total log-probability, and once the best
path below it is known, what branches off that path step by step has Gumbel
variates truncated at the node's value.  The search pops the largest branch,
completes it to a path, adds that path's own branches, and stops after k
paths; no segmentation is enumerated or seen twice.

The lattice: every way of spelling the text with pieces of the vocabulary, across
the bounds of the model's own segmentation too; a character without a piece is
its bytes.  No piece spans a word-start mark that follows other characters, so
the lattice falls into words.  A path's probability is proportional to
``exp(SHARPNESS * sum of log(1 / rank))`` of its pieces: at each place of a word
an arc's is its piece's weight times the sum over all spellings of what follows
it (one backward pass), so nothing is enumerated.  Places depend on the word and
the vocabulary alone, so they are built once per worker and word.

Every variate comes from a hash of (row key, path, place), so a row's sample
does not depend on partitioning or retries.

Inclusion score: the probability that a segmentation of this log-probability
is among the k, given the first value left out (1 if nothing is left).

Defined results: a null or empty text has the empty segmentation alone; a text
with fewer than k segmentations gives all of them; repeated rows give equal
samples; the word-start mark in a text reads as a space; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES = 3
SHARPNESS = 0.5
CACHE_UNITS = 300_000
# Places of known words kept by a worker.
CACHE_PLACES = 1_500_000
# Weights of longer words are summed as logarithms.
LINEAR_CHARS = 100
# No variate's Gumbel value differs from another's by more (53 bits).
_SPREAD = 42.0
# Words handled together by the vectorised search.
BATCH_WORDS = 80_000
MARK = "▁"
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")

_lattices: dict[tuple[str, float], Lattice] = {}


class _Grown:
    """An array that grows at its end; ``all`` is a view of what is there."""

    def __init__(self, kind: type):
        self.room, self.all = np.empty(1024, kind), np.empty(0, kind)

    def add(self, x: np.ndarray) -> None:
        n = len(self.all) + len(x)
        if n > len(self.room):
            room = np.empty(n + n // 4, self.room.dtype)
            room[:len(self.all)] = self.all
            self.room = room
        self.room[len(self.all):n] = x
        self.all = self.room[:n]

    def clear(self) -> None:
        """Nothing is there any more; the room stays."""
        self.all = self.room[:0]


class _Coded:
    """Arcs as little-endian bytes of their piece."""

    def __init__(self, lat: Lattice):
        self.lat = lat

    def __getitem__(self, i: int) -> bytes:
        return self.lat.piece[i:i + 1].astype("<u4").tobytes()


class Lattice:
    """Places of words with their arcs, built as words are met.

    A unit is a piece of the vocabulary (ids below its size: the ways to spell
    that piece) or a word of a text (ids above).
    """

    def __init__(self, path: str, sharpness: float):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.sharpness = sharpness
        size = self.sp.get_piece_size()
        self.pieces = [self.sp.id_to_piece(i) for i in range(size)]
        self.surface = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.encode()
                        for i, p in enumerate(self.pieces)]
        plain = [i for i in range(size) if not (self.sp.is_control(i) or self.sp.is_unknown(i)
                                                or self.sp.is_byte(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.longest = max(map(len, self.ids))
        # Rank of a piece by score: the log of its inverse stands for its weight.
        order = sorted(plain, key=lambda i: -self.sp.get_score(i))
        self.weight = dict(zip(order, -np.log(np.arange(2, len(order) + 2)), strict=True))
        self.units: dict[str, bytes] = {}
        self.size = size
        self.n_bytes = np.array([len(x) for x in self.surface], np.int64)
        # Bytes of pieces, eight to a number, and which of them count.
        most = 8 * max(1, -(-int(self.n_bytes.max()) // 8))
        self.eights = np.frombuffer(b"".join(x.ljust(most, b"\0") for x in self.surface), "<u8").reshape(size, -1)
        self.masks = np.frombuffer(b"".join((b"\xff" * len(x)).ljust(most, b"\0") for x in self.surface),
                                   "<u8").reshape(size, -1)
        self.first_eight, self.first_mask = self.eights[:, 0].copy(), self.masks[:, 0].copy()
        self._arcs = _Coded(self)
        self._tree()
        # Per unit: its first place (-1: not built) and the number of its places.
        self._root, self._places = _Grown(np.int64), _Grown(np.int64)
        # Per place: its first arc and the number of its arcs (none: the end).
        self._begin, self._n_arcs = _Grown(np.int32), _Grown(np.int32)
        # Per arc: log-probability, upper end among its place's arcs, places, piece.
        self._logp, self._upto = _Grown(np.float64), _Grown(np.float64)
        self._from, self._to, self._piece = _Grown(np.int32), _Grown(np.int32), _Grown(np.int32)
        self._then = _Grown(np.int32)  # first arc of the place it leads to (-1: the end)
        self._uses = _Grown(np.int32)  # per unit
        self._clear()

    def _tree(self) -> None:
        """Pieces as a tree of characters: sorted (node, character) keys with the node below."""
        self.code = np.zeros(0x110000, np.int16)
        for i, c in enumerate(sorted(set("".join(self.ids))), 1):
            self.code[ord(c)] = i
        self.alone = np.zeros(0x110000, bool)
        below: dict[tuple[int, int], int] = {}
        piece = {}
        for text, i in self.ids.items():
            node = 0
            for c in text:
                node = below.setdefault((node, int(self.code[ord(c)])), len(below) + 1)
            piece[node] = i
            if len(text) == 1:
                self.alone[ord(text)] = True
        steps = sorted((n << 16 | c, to) for (n, c), to in below.items())
        self.step, self.below = np.array(steps, np.int64).T.copy()
        self._table()
        self.node_piece = np.full(len(below) + 1, -1, np.int64)
        self.node_piece[list(piece)] = list(piece.values())
        self.log_weight = np.zeros(self.size)
        self.log_weight[list(self.weight)] = [self.sharpness * w for w in self.weight.values()]
        self.linear_weight = np.exp(self.log_weight)
        self.inner = np.zeros(len(below) + 1, bool)
        self.inner[self.step >> 16] = True
        # The node of each character alone; code 0 has none.
        self.head = self._down(np.zeros(int(self.code.max()) + 1, np.int64), np.arange(int(self.code.max()) + 1))

    def _table(self) -> None:
        """The steps of the tree again, by a hash of their key with linear probing."""
        self.bits = max(4, int(2 * len(self.step)).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_to = np.full(1 << self.bits, -1, np.int64)
        slot, left = self._slot(self.step), np.arange(len(self.step))
        while len(left):
            at, key = slot[left], self.step[left]
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = key[free]
            put = self.slot_key[at] == key
            self.slot_to[at[put]] = self.below[left[put]]
            left = left[~put]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _down(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node below each node by a character's code; -1: none."""
        key = node << 16 | code
        at = self._slot(key)
        seen = self.slot_key.take(at)
        out = np.where(seen == key, self.slot_to.take(at), -1)
        far = np.flatnonzero((seen != key) & (seen >= 0))
        while len(far):
            at[far] = (at[far] + 1) & ((1 << self.bits) - 1)
            seen = self.slot_key[at[far]]
            hit = seen == key[far]
            out[far[hit]] = self.slot_to[at[far[hit]]]
            far = far[~hit & (seen >= 0)]
        return out

    def _clear(self) -> None:
        # Units of words, by the word without its first mark; the last ``new`` are not built yet.
        self.words_: dict[str, int] = {}
        self.new = 0
        for grown in (self._root, self._places, self._begin, self._n_arcs, self._logp, self._upto, self._from,
                      self._to, self._piece, self._then, self._uses):
            grown.clear()
        self._root.add(np.full(self.size, -1))
        self._places.add(np.zeros(self.size))
        self._uses.add(np.zeros(self.size))

    def trim(self) -> None:
        """Once too many places are kept, forget words met once or seldom (between batches)."""
        if len(self._begin.all) <= CACHE_PLACES:
            return
        root, places, uses = self._root.all[self.size:], self._places.all[self.size:], self._uses.all[self.size:]
        uses = np.minimum(uses, 255)
        by_uses = np.cumsum(np.bincount(uses, places, 256)[::-1])[::-1]
        least = max(2, int(np.searchsorted(-by_uses, -CACHE_PLACES / 2)))
        kept = np.flatnonzero(uses >= least)
        words = list(self.words_)
        root, places = root[kept], places[kept]
        size = places.astype(np.int64)
        ends = np.cumsum(size)
        # Places of kept words in their new order, their arcs behind each other.
        place = np.repeat(root - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        to_place = np.full(len(self._begin.all), -1, np.int64)
        to_place[place] = np.arange(len(place))
        n_arcs = self._n_arcs.all.take(place)
        past = np.cumsum(n_arcs, dtype=np.int64)
        first = past - n_arcs
        arc = np.repeat(self._begin.all.take(place) - first, n_arcs) + np.arange(past[-1] if len(past) else 0)
        to = to_place.take(self._to.all.take(arc))
        arcs = [(grown, grown.all.take(arc)) for grown in (self._logp, self._upto, self._piece)]
        self._clear()
        for grown, x in ((self._begin, np.where(n_arcs > 0, first, 0)), (self._n_arcs, n_arcs), *arcs,
                         (self._from, np.repeat(np.arange(len(place)), n_arcs)), (self._to, to),
                         (self._then, np.where(n_arcs.take(to) > 0, first.take(to), -1))):
            grown.add(x)
        for i in kept.tolist():
            self.words_[words[i]] = self.size + len(self.words_)
        self._root.add(ends - size)
        self._places.add(size)
        self._uses.add(uses[kept] // 2)

    def arcs_of(self, cell: int) -> list[tuple[list[int], float]]:
        """Every spelling of a piece with its normalised log-probability, one by one.

        The search never lists them: see ``_build``."""
        text = self.pieces[cell]
        if text not in self.ids:
            return [([cell], 0.0)]
        ends: list[list[tuple[list[int], float]]] = [[([], 0.0)]] + [[] for _ in text]
        for at in range(len(text)):
            for end in range(at + 1, min(len(text), at + self.longest) + 1):
                i = self.ids.get(text[at:end])
                if i is not None:
                    w = self.sharpness * self.weight[i]
                    ends[end] += [([*p, i], s + w) for p, s in ends[at]]
        paths = ends[len(text)]
        s = np.array([x for _, x in paths])
        s -= s.max() + np.log(np.exp(s - s.max()).sum())
        return sorted(zip([p for p, _ in paths], s.tolist(), strict=True), key=lambda x: -x[1])

    def _build(self, texts: list[str], in_bytes: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of places of each string, all built together.

        A place stands before each character and at the end.  Characters without
        a piece are spelled in bytes, if ``in_bytes``, with places of their own."""
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        word = np.repeat(np.arange(len(texts)), size)
        lost = np.flatnonzero(~self.alone[chars]) if in_bytes else np.zeros(0, np.int64)
        spelled = [self._in_bytes(int(c)) for c in chars[lost]]
        more = np.bincount(word[lost], [len(x) - 1 for x in spelled], len(texts)).astype(np.int64)
        places = size + 1 + more
        ends = np.cumsum(places)
        root = ends - places
        # Places of characters, and how far each is from its word's end.
        at = np.arange(len(chars)) - (np.cumsum(size) - size)[word] + root[word]
        left = (root + size)[word] - at
        code = self.code[chars].astype(np.int64)
        # Down the tree from every character at once: an arc wherever a piece ends.
        here, node, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), []
        for depth in range(1, self.longest + 1):
            inside = left[here] >= depth
            here, node = here[inside], node[inside]
            node = self._down(node, code[here + depth - 1])
            ok = node >= 0
            here, node = here[ok], node[ok]
            if not len(here):
                break
            ends_here = self.node_piece[node] >= 0
            h = here[ends_here]
            found.append((h, np.full(len(h), depth), self.node_piece[node[ends_here]]))
        found.append((lost, np.ones(len(lost), np.int64), np.full(len(lost), -1)))
        h, depth, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        weight = np.where(piece >= 0, self.log_weight[piece], 0.0)
        # Backward over all words: the log of the weights of all spellings from a place on.
        order = np.argsort(left[h] * (len(chars) + 1) + h, kind="stable")
        h, depth, piece, weight = h[order], depth[order], piece[order], weight[order]
        frm, to = at[h], at[h] + depth
        total = np.full(int(ends[-1]) if len(ends) else 0, -np.inf)
        total[root + size] = 0.0
        far = left[h]
        first = np.flatnonzero(np.diff(frm, prepend=-1))
        bound = np.searchsorted(far, np.arange(1, (far[-1] if len(far) else 0) + 2))
        group = np.searchsorted(first, bound)
        for lo, hi, glo, ghi in zip(bound[:-1], bound[1:], group[:-1], group[1:], strict=True):
            if hi > lo:
                g = first[glo:ghi]
                total[frm[g]] = np.logaddexp.reduceat(weight[lo:hi] + total[to[lo:hi]], g - lo)
        with np.errstate(invalid="ignore"):
            lp = weight + total[to] - total[frm]
        # Bytes of one character follow each other through places after the word's end.
        spare = {}
        extra: list[tuple[int, int, int]] = []
        inner = {int(x): n for n, x in enumerate(lost)}
        for a in np.flatnonzero(piece < 0):
            ids, w = spelled[inner[int(h[a])]], int(word[h[a]])
            piece[a], last = ids[0], to[a]
            if len(ids) > 1:
                begin = spare.get(w, int(root[w] + size[w]) + 1)
                spare[w] = begin + len(ids) - 1
                to[a] = begin
                extra += [(begin + n, begin + n + 1 if n + 2 < len(ids) else last, i)
                          for n, i in enumerate(ids[1:])]
        keep = np.isfinite(lp)
        frm, to, piece, lp = frm[keep], to[keep], piece[keep], np.minimum(lp[keep], 0.0)
        if extra:
            f, t, i = (np.array(x, np.int64) for x in zip(*extra, strict=True))
            frm, to, piece = np.append(frm, f), np.append(to, t), np.append(piece, i)
            lp = np.append(lp, np.zeros(len(f)))
        # Long pieces first: most draws end at the first arc.
        order = np.argsort(frm * 64 + np.clip(63 - (to - frm), 0, 63), kind="stable")
        self._add(root, places, frm[order], to[order], piece[order], lp[order])
        return root + self._base, places

    def _build_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_build`` of new words, each after its first mark: plain ones (no bytes, not long) by ``_build_plain``."""
        chars = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le"), "<u4").astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        odd = size > LINEAR_CHARS
        odd[np.searchsorted(np.cumsum(size), np.flatnonzero(~self.alone[chars]), "right")] = True
        root, places = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        if odd.any():
            at = np.flatnonzero(odd)
            root[at], places[at] = self._build([MARK + words[i] for i in at.tolist()])
        if not odd.all():
            root[~odd], places[~odd] = self._build_plain(chars[~np.repeat(odd, size)], size[~odd])
        return root, places

    def _build_plain(self, chars: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``_build`` of words whose characters all have a piece.

        Nodes are numbered by their distance from the word's end, ends first,
        so the backward sums run over slices and arcs need no sorting."""
        n, places = len(size), size + 1
        ends = np.cumsum(places)
        root = ends - places
        order = np.argsort((LINEAR_CHARS - size).astype(np.uint8), kind="stable")  # long words first
        long_ = int(size[order[0]])
        wide = n - np.concatenate([[0], np.cumsum(np.bincount(size, minlength=long_ + 1))])[:long_ + 1]
        off = np.concatenate([[0], np.cumsum(wide)])
        left = np.repeat(np.arange(long_ + 1), wide)
        word = order[np.arange(off[-1]) - off[left]]
        place = ends.take(word) - 1 - left
        after = np.arange(off[-1]) - np.concatenate([[0], wide])[left]  # the next node; ends have none
        char = (np.cumsum(size).take(word) - left)[n:]
        code = np.zeros(off[-1], np.int64)
        code[n:] = self.code[chars[char]]
        # Down the tree from every node at once: an arc wherever a piece ends.
        here, node, found = np.arange(n, off[-1]), self.head[code[n:]], []
        at = after[here]
        while len(here):
            piece = self.node_piece.take(node)
            end = np.flatnonzero(piece >= 0)
            found.append((here.take(end), at.take(end), piece.take(end)))
            inside = np.flatnonzero((at >= n) & self.inner.take(node))
            here, at = here.take(inside), at.take(inside)
            node = self._down(node.take(inside), code.take(at))
            ok = np.flatnonzero(node >= 0)
            here, at, node = here.take(ok), after.take(at.take(ok)), node.take(ok)
        many = np.bincount(np.concatenate([h for h, _, _ in found]), minlength=off[-1])
        past = np.cumsum(many)
        first = past - many
        to, piece, free = np.empty(past[-1], np.int32), np.empty(past[-1], np.int32), first.copy()
        for h, t, p in reversed(found):  # long pieces first: most draws end at the first arc
            i = free.take(h)
            to[i], piece[i] = t, p
            free[h] = i + 1
        total, mass = np.ones(off[-1]), self.linear_weight.take(piece)
        for lo, hi in zip(off[1:-1].tolist(), off[2:].tolist(), strict=True):
            part = slice(first[lo], past[hi - 1])
            mass[part] *= total.take(to[part])
            total[lo:hi] = np.add.reduceat(mass[part], first[lo:hi] - first[lo])
        mass /= np.repeat(total, many)
        upto = np.cumsum(mass)
        upto -= np.repeat(np.concatenate([[0.0], upto]).take(first), many)
        upto[past[n:] - 1] = np.inf
        base, arcs = len(self._begin.all), len(self._logp.all)
        begin, n_arcs = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.int64)
        begin[place], n_arcs[place] = arcs + first, many
        for grown, x in ((self._begin, begin), (self._n_arcs, n_arcs), (self._logp, np.minimum(np.log(mass), 0.0)),
                         (self._upto, upto), (self._from, np.repeat(place + base, many)), (self._to, place.take(to) + base),
                         (self._then, np.where(to < n, -1, arcs + first.take(to))), (self._piece, piece)):
            grown.add(x)
        return root + base, places

    def _in_bytes(self, char: int) -> list[int]:
        ids = [self.sp.piece_to_id(f"<0x{x:02X}>") for x in chr(char).encode()]
        return [self.sp.unk_id()] if any(map(self.sp.is_unknown, ids)) else ids

    def _add(self, root: np.ndarray, places: np.ndarray, frm: np.ndarray, to: np.ndarray,
             piece: np.ndarray, lp: np.ndarray) -> None:
        """Append arcs, sorted by place; places count from 0."""
        self._base, arcs = len(self._begin.all), len(self._logp.all)
        n = np.bincount(frm, minlength=int(places.sum()))
        ends = np.cumsum(n)
        mass = np.cumsum(np.exp(lp))
        upto = mass - np.concatenate([[0.0], mass])[ends - n][frm]
        upto[ends[n > 0] - 1] = np.inf
        for grown, x in ((self._begin, arcs + ends - n), (self._n_arcs, n), (self._logp, lp),
                         (self._upto, upto), (self._from, frm + self._base), (self._to, to + self._base),
                         (self._then, np.where(n[to] > 0, (arcs + ends - n)[to], -1)), (self._piece, piece)):
            grown.add(x)

    def need(self, units: np.ndarray) -> None:
        """Build the new words, and the pieces among the units not met before."""
        if self.new:
            root, places = self._build_new([*islice(reversed(self.words_), self.new)][::-1])
            self._root.add(root)
            self._places.add(places)
            self._uses.add(np.zeros(len(root)))
            self.new = 0
        np.add.at(self._uses.all, units, np.int32(1))
        cells = units[units < self.size]
        cells = np.unique(cells[self._root.all[cells] < 0])
        plain = np.array([self.pieces[c] in self.ids for c in cells.tolist()], bool)
        if plain.any():
            built = self._build([self.pieces[c] for c in cells[plain].tolist()], False)
            self._root.all[cells[plain]], self._places.all[cells[plain]] = built
        if len(cells) and not plain.all():
            cells = cells[~plain]
            root, two = np.arange(len(cells)) * 2, np.full(len(cells), 2)
            self._add(root, two, root, root + 1, cells, np.zeros(len(cells)))
            self._root.all[cells], self._places.all[cells] = root + self._base, two
        self.root, self.places = self._root.all, self._places.all
        self.begin, self.n_arcs = self._begin.all, self._n_arcs.all
        self.logp, self.upto = self._logp.all, self._upto.all
        self.place, self.next, self.piece = self._from.all, self._to.all, self._piece.all
        self.then = self._then.all

    def words(self, text: str | None) -> np.ndarray:
        """The words of a text as units."""
        if not text:
            return np.zeros(0, np.int64)
        if text[0] == " " or "  " in text or MARK in text:
            found = [w[1:] for w in _UNIT.findall(MARK + text.replace(" ", MARK))]
        else:
            found = text.split(" ")
        known = self.words_
        units = list(map(known.get, found))
        if None in units:
            n = len(known)
            for i, unit in enumerate(units):
                if unit is None:
                    units[i] = known.setdefault(found[i], self.size + len(known))
            self.new += len(known) - n
        return np.fromiter(units, np.int64, len(units))

    def cells(self, texts: list[str | None]) -> list[np.ndarray]:
        """The model's own segmentation of each text, word by word.

        No piece of a model with word-start marks spans a mark that follows
        other characters, so words are encoded once each.
        """
        out = []
        for t in texts:
            units = _UNIT.findall(MARK + t.replace(" ", MARK)) if t else []
            try:
                coded = [self.units[u] for u in units]
            except KeyError:
                coded = [self._unit(u) for u in units]
            out.append(np.frombuffer(b"".join(coded), "<u4").astype(np.int64))
        return out

    def _unit(self, unit: str) -> bytes:
        known = self.units.get(unit)
        if known is None:
            # The model puts one mark in front by itself.
            ids = [self.ids[MARK]] if unit == MARK else self.sp.encode(unit[1:].replace(MARK, " "))
            known = np.array(ids, "<u4").tobytes()
            if len(self.units) >= CACHE_UNITS:
                self.units.clear()
            self.units[unit] = known
        return known

    def decode(self, ids: list[int]) -> str:
        """Text of a segmentation: surfaces and bytes joined, marks as spaces."""
        text = b"".join([self.surface[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def lattice(path: str, sharpness: float = SHARPNESS) -> Lattice:
    if (path, sharpness) not in _lattices:
        _lattices[path, sharpness] = Lattice(path, sharpness)
    return _lattices[path, sharpness]


_PLACE = np.uint64(0xD1B54A32D192ED03)


def _salted(key: np.ndarray, salt: int, at: np.ndarray) -> np.ndarray:
    return key + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1) + at * _PLACE


def _mixed(x: np.ndarray) -> np.ndarray:
    """Variates in (0, 1) from salted keys, which are overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    out = x.astype(np.float64)
    out += 0.5
    out *= 2.0 ** -53
    return out


def _uniform(key: np.ndarray, salt: int, at: np.ndarray) -> np.ndarray:
    """Variates in (0, 1) from a hash of (row key, salt, cell)."""
    return _mixed(_salted(key, salt, at))


def _leaving(before: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Log-probability of what leaves a path at a step of log-probability ``x``."""
    with np.errstate(divide="ignore"):
        return before + np.log(-np.expm1(np.minimum(x, -1e-300)))


def _truncated(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variates at ``phi`` given that they are below ``top``."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        # -log(exp(-top) + E / exp(phi)) with E standard exponential.
        out = -np.logaddexp(-top, np.log(-np.log(u)) - phi)
    return np.where(np.isneginf(phi), -np.inf, out)


class _Path:
    """One segmentation of each text: its steps, text after text."""

    def __init__(self, search: _Search, unit: np.ndarray, arc: np.ndarray):
        self.unit, self.arc = unit, arc
        self.size = np.bincount(search.doc.take(unit), minlength=search.n)
        self.start = np.cumsum(self.size) - self.size


class _Branches:
    """Perturbed values of what leaves a path: steps in order of their text."""

    def __init__(self, n: int, doc: np.ndarray, step: np.ndarray, value: np.ndarray):
        self.n, self.doc, self.step, self.value = n, doc, step, value
        self.first = np.flatnonzero(np.diff(doc, prepend=-1))

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Number and value of each text's largest branch (-1 and -inf without any)."""
        at, top = np.full(self.n, -1, np.int64), np.full(self.n, -np.inf)
        if len(self.doc):
            d = self.doc[self.first]
            top[d] = np.maximum.reduceat(self.value, self.first)
            hit = np.flatnonzero(self.value == top[self.doc])[::-1]
            at[self.doc[hit]] = hit  # the first of equals stays
        return at, top


class _Search:
    """Best-first search over several texts at once (one row of units each)."""

    def __init__(self, lat: Lattice, units: list[np.ndarray], keys: np.ndarray, k: int):
        self.lat, self.k, self.n = lat, k, len(units)
        size = np.array([len(c) for c in units], np.int64)
        flat = np.concatenate(units) if units else np.zeros(0, np.int64)
        lat.need(flat)
        self.doc = np.repeat(np.arange(self.n), size)
        self.keys = keys
        self.key = keys[self.doc]
        self.root = lat.root[flat]
        # Adding a place of a unit gives its number in the text.
        places = lat.places[flat]
        ends = np.cumsum(places)
        begin = np.concatenate([[0], ends])[np.cumsum(size) - size]
        self.shift = ends - places - begin[self.doc] - self.root

    def fresh(self, units: np.ndarray, places: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Independent steps from a place of each unit to its end: units and arcs, in order."""
        lat, rows, steps = self.lat, [], []
        key = _salted(self.key[units], 4 * salt, self.shift[units].astype(np.uint64))
        row, n = np.arange(len(units)), len(units)
        j = np.where(lat.n_arcs[places] > 0, lat.begin[places], -1)
        while True:
            open_ = np.flatnonzero(j >= 0)
            if len(open_) < len(j):
                row, places, key, j = row.take(open_), places.take(open_), key.take(open_), j.take(open_)
            if not len(row):
                break
            j = j.astype(np.int64)
            x = places.astype(np.uint64)
            x *= _PLACE
            x += key
            x = _mixed(x)
            late = np.flatnonzero(x > lat.upto.take(j))
            if len(late):
                i, above = j.take(late) + 1, x.take(late)
                while len(late):
                    j[late] = i
                    on = np.flatnonzero(above > lat.upto.take(i))
                    late, i, above = late.take(on), i.take(on) + 1, above.take(on)
            rows.append(row)
            steps.append(j)
            places, j = lat.next.take(j), lat.then.take(j)
        if not rows:
            return units[:0], np.zeros(0, np.int64)
        row, j = np.concatenate(rows), np.concatenate(steps)
        size = np.bincount(row, minlength=n)
        # Step s of a row comes s places after its first.
        at = (np.cumsum(size) - size).take(row)
        at += np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        arcs = np.empty(len(j), np.int64)
        arcs[at] = j
        return np.repeat(units, size), arcs

    def branches(self, path: _Path, value: np.ndarray, after: np.ndarray, prefix: np.ndarray,
                 salt: int) -> _Branches:
        """What leaves ``path`` at each step after ``after`` (``prefix``: log-probability up to there).

        Probabilities fall along a path, and Gumbel values differ by less than
        ``_SPREAD``, so steps far less likely than the first ``k`` with a choice
        cannot be among the ``k`` largest: a text is read as far as needed."""
        lat, reach, found = self.lat, 256, []
        begin = after + 1
        docs = np.flatnonzero(path.size > begin)
        while len(docs):
            many = np.minimum(path.size[docs] - begin[docs], reach)
            ends = np.cumsum(many)
            row = np.repeat(np.arange(len(docs)), many)
            step = np.arange(len(row)) - (ends - many)[row] + begin[docs][row]
            arc = path.arc[path.start[docs][row] + step]
            x = lat.logp[arc]
            sums = np.concatenate([[0.0], np.cumsum(x)])
            before = sums[:-1] - sums[ends - many][row] + prefix[docs][row]
            # The least likely of the first k choices, if they come early.
            early = np.flatnonzero(step - begin[docs][row] < 4 * self.k + 16)
            early = early[lat.n_arcs[lat.place[arc[early]]] > 1]
            r = row[early]
            n_early = np.bincount(r, minlength=len(docs))
            early = early[np.arange(len(r)) - (np.cumsum(n_early) - n_early)[r] < self.k]
            low = np.full(len(docs), np.inf)
            np.minimum.at(low, row[early], _leaving(before[early], x[early]))
            low = np.where(n_early >= self.k, low, -np.inf) - _SPREAD
            whole = (many == path.size[docs] - begin[docs]) | (before[ends - 1] + x[ends - 1] < low)
            spots = np.flatnonzero((before >= low[row]) & whole[row])
            place = lat.place[arc[spots]]
            choice = lat.n_arcs[place] > 1
            spots, place = spots[choice], place[choice]
            d, phi = docs[row[spots]], _leaving(before[spots], x[spots])
            number = self.shift[path.unit[path.start[d] + step[spots]]] + place
            u = _uniform(self.keys[d], 4 * salt + 2, number.astype(np.uint64))
            found.append((d, step[spots], _truncated(phi, value[d], u)))
            docs, reach = docs[~whole], reach * 4
        d, step, v = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.argsort(d, kind="stable")
        return _Branches(self.n, d[order], step[order], v[order])

    def paths(self) -> list[tuple[_Path, np.ndarray, np.ndarray]]:
        """Path, perturbed value and existence per text, best first; sets ``bound``."""
        lat, none = self.lat, np.zeros(self.n, np.uint64)
        units = np.arange(len(self.root))
        g = -np.log(-np.log(_uniform(self.keys, 3, none)))
        path = _Path(self, *self.fresh(units, self.root, 0))
        out = [(path, g, np.ones(self.n, bool))]
        vals = [self.branches(path, g, np.full(self.n, -1), np.zeros(self.n), 0)]
        gone: dict[tuple[int, int], list[int]] = {}  # (parent, branch) -> arcs already used there
        for s in range(1, self.k + 1):
            spots, top = (np.stack(x) for x in zip(*[v.best() for v in vals], strict=True))
            parent = np.argmax(top, axis=0)
            g = top[parent, np.arange(self.n)]
            if s == self.k:
                break
            ok = np.isfinite(g)
            docs = np.flatnonzero(ok)
            after, prefix = np.full(self.n, -1), np.zeros(self.n)
            places, branch = self.root.copy(), np.full(self.n, len(units))
            heads: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            picks = []
            for d in docs.tolist():
                p, c = int(parent[d]), int(spots[parent[d], d])
                old, at = out[p][0], int(vals[p].step[c])
                b = int(old.start[d])
                picks.append((d, p, c, at, b, int(old.unit[b + at]), int(lat.place[old.arc[b + at]])))
            unit, place = np.array([x[5:] for x in picks], np.int64).reshape(-1, 2).T
            number = self.shift[unit] + place
            draw = _uniform(self.keys[docs], 4 * s + 3, number.astype(np.uint64))
            left = np.full(len(docs), -np.inf)
            for i, ((d, p, c, at, b, unit, place), u) in enumerate(zip(picks, draw.tolist(), strict=True)):
                old = out[p][0]
                used = gone.setdefault((p, c), [int(old.arc[b + at])])
                lo, n = int(lat.begin[place]), int(lat.n_arcs[place])
                lp = lat.logp[lo:lo + n].copy()
                lp[[x - lo for x in used]] = -np.inf
                mass = np.exp(lp - lp.max())
                a = int(min(np.searchsorted(np.cumsum(mass), u * mass.sum(), "right"), n - 1))
                head = old.arc[b:b + at]
                before = float(lat.logp[head].sum())
                used.append(lo + a)
                heads[d] = old.unit[b:b + at + 1], np.append(head, lo + a)
                branch[d], places[unit], after[d] = unit, lat.next[lo + a], at
                prefix[d] = before + float(lp[a])
                # What is left at this step stays a branch of the parent.
                lp[a] = -np.inf
                if len(used) < n:
                    left[i] = before + np.logaddexp.reduce(lp)
            again = _truncated(left, g[docs], _uniform(
                self.keys[docs], 4 * s + 3, (number + (1 << 40)).astype(np.uint64)))
            for (_, p, c, *_), v in zip(picks, again.tolist(), strict=True):
                vals[p].value[c] = v
            walked = np.flatnonzero(units >= branch[self.doc])
            unit, arc = self.fresh(walked, places[walked], s)
            cut = np.searchsorted(self.doc[unit], np.arange(self.n + 1))
            us, arcs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for d, (head, steps) in heads.items():
                us += [head, unit[cut[d]:cut[d + 1]]]
                arcs += [steps, arc[cut[d]:cut[d + 1]]]
            path = _Path(self, np.concatenate(us), np.concatenate(arcs))
            out.append((path, g, ok))
            vals.append(self.branches(path, np.where(ok, g, 0.0), after, prefix, s))
        self.bound = g
        return out

    def run(self) -> list[list[tuple[np.ndarray, float, float]]]:
        """Per text: ``(arcs, log-probability, perturbed value)``, best first; then the bound."""
        out: list[list[tuple[np.ndarray, float, float]]] = [[] for _ in range(self.n)]
        for path, values, alive in self.paths():
            for d in np.flatnonzero(alive).tolist():
                arcs = path.arc[path.start[d]:path.start[d] + path.size[d]]
                out[d].append((arcs, float(self.lat.logp[arcs].sum()), float(values[d])))
        return out


SAMPLED = ("doc_id long, rank int, n_pieces long, log_prob double, perturbed double, "
           "inclusion double, ids_crc32 long, ids array<int>, round_trip boolean")


def sample(docs: DataFrame, model_path: str, k: int = SAMPLES, sharpness: float = SHARPNESS,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Up to ``k`` distinct segmentations of every text, best perturbed value first.

    ``ids`` is null unless ``with_ids``; ``ids_crc32`` is the checksum of the
    ids as little-endian 32-bit numbers; ``round_trip`` tells whether the ids
    decode to the text (word-start marks as spaces).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model_path, sharpness)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            docs_, texts = b.column(1).to_pylist(), b.column(2).to_pylist()
            at = 0
            while at < len(texts):
                lat.trim()
                units, end, size = [], at, 0
                while end < len(texts) and size < BATCH_WORDS:
                    units.append(lat.words(texts[end]))
                    size += len(units[-1])
                    end += 1
                yield _rows(lat, units, docs_[at:end], texts[at:end], keys[at:end], k, with_ids)
                at = end

    key = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.select(key, F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SAMPLED)


def _rows(lat: Lattice, units: list[np.ndarray], ids: list, texts: list[str | None],
          keys: np.ndarray, k: int, with_ids: bool) -> pa.RecordBatch:
    search = _Search(lat, units, keys, k)
    found = search.paths()
    plain = [(t or "").replace(MARK, " ") for t in texts]
    spelled = _Spelled(lat, [(MARK + p.replace(" ", MARK)).encode() if p else b"" for p in plain])
    out: list[list[pa.Array]] = []
    for r, (path, values, alive) in enumerate(found, 1):
        docs = np.flatnonzero(alive)
        size = path.size[docs]
        ends = np.cumsum(size)
        pieces = lat.piece.take(path.arc)
        lp = _sums(lat.logp.take(path.arc), size)
        lp_over = np.minimum(lp - search.bound[docs], 700.0)
        inside = np.where(np.isneginf(search.bound[docs]), 1.0, -np.expm1(-np.exp(lp_over)))
        raw = memoryview(pieces.astype("<u4", copy=False).view(np.uint8))
        begins, same = ends - size, spelled.by(docs, pieces, size)
        for i in np.flatnonzero(~same).tolist():
            same[i] = lat.decode(pieces[begins[i]:ends[i]].tolist()) == plain[docs[i]]
        crc = [zlib.crc32(raw[4 * begin:4 * end]) for begin, end in zip(begins.tolist(), ends.tolist(), strict=True)]
        listed = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(pieces, pa.int32())) \
            if with_ids else pa.nulls(len(docs), pa.list_(pa.int32()))
        out.append([pa.array([ids[d] for d in docs.tolist()], pa.int64()),
                    pa.array(np.full(len(docs), r), pa.int32()), pa.array(size, pa.int64()), pa.array(lp),
                    pa.array(values[docs]), pa.array(inside), pa.array(crc, pa.int64()), listed,
                    pa.array(same, pa.bool_())])
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*out, strict=True)],
                                      names=[c.split()[0] for c in SAMPLED.split(", ")])


class _Spelled:
    """Texts in bytes, to compare whole segmentations with, eight bytes at once."""

    def __init__(self, lat: Lattice, whole: list[bytes]):
        self.lat = lat
        self.size = np.array([len(w) for w in whole], np.int64)
        self.start = np.cumsum(self.size) - self.size
        raw = b"".join([*whole, bytes(8 * lat.eights.shape[1] + 8)])
        self.end = int(self.size.sum())
        # The eight bytes from every byte on.
        self.eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,)).copy()

    def by(self, docs: np.ndarray, pieces: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes of each text's pieces (``size`` of them) are the text's, all of them."""
        lat, n = self.lat, self.lat.n_bytes.take(pieces)
        ends = np.cumsum(size)
        past = np.concatenate([[0], np.cumsum(n)])
        begin = past[ends - size]
        same = past[ends] - begin == self.size[docs]
        at = past[:-1] + np.repeat(self.start[docs] - begin, size)
        if not same.all():
            at = np.minimum(at, self.end)
        wrong = [np.flatnonzero((self.eights.take(at) ^ lat.first_eight.take(pieces)) & lat.first_mask.take(pieces))]
        left = np.flatnonzero(n > 8)
        for c in range(1, lat.eights.shape[1]):
            if not len(left):
                break
            p = pieces[left]
            differs = (self.eights[at[left] + 8 * c] ^ lat.eights[p, c]) & lat.masks[p, c]
            wrong.append(left[np.flatnonzero(differs)])
            left = left[n[left] > 8 * c + 8]
        same[np.searchsorted(ends, np.concatenate(wrong), "right")] = False
        return same


def _sums(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``x`` (0 for an empty run)."""
    out, full = np.zeros(len(size), x.dtype), size > 0
    if full.any():
        out[full] = np.add.reduceat(x, (np.cumsum(size) - size)[full])
    return out


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the column ``decoded``: the text of each segmentation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model_path)
        for b in batches:
            at = b.schema.get_field_index(ids_col)
            texts = [None if x is None else lat.decode(x) for x in b.column(at).to_pylist()]
            yield b.append_column("decoded", pa.array(texts, pa.string()))

    from pyspark.sql import types as T
    plain = rows.drop("decoded")
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields,
                                               T.StructField("decoded", T.StringType())]))
