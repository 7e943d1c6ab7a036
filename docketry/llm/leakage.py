"""Evaluation passages inside training pages.

Both sides are read as word windows with a weighted SimHash each. Three blocks of the 64 bits are indexed, so every pair
within Hamming distance two shares a block; such pairs seed an exact alignment of the page's words with the item's,
which bridges damaged, split and merged words and interposed lines. A passage counts when enough consecutive item words
stand in the page and the weight of its words printed intact is large enough against the whole passage.

The item side is the query set: it is indexed in blocks of bounded size, each met by all pages.
"""

from __future__ import annotations

import functools
import math
import re
import string
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.lineage import cut
from docketry.llm.lookalikes import TO_LATIN, usual_form

#: words of a SimHash window; a passage of MIN_WORDS with scattered damage keeps intact windows of this size
WINDOW = 3
#: consecutive item words a page must print
MIN_WORDS = 12
#: bits of the three blocks; distance below the number of blocks is guaranteed
BLOCKS = (22, 21, 21)
RADIUS = len(BLOCKS) - 1
#: doc words an interposed advert or misplaced piece may have
MAX_INTERPOSED = 60
#: likeness (0.55 or more) at which a word between two standing neighbours still counts as the damaged item word
BADLY_DAMAGED = 0.55
#: share of a passage's word weight that must be printed intact
MIN_INTACT = 0.4
#: items indexed at once
ITEMS_PER_BLOCK = 4096

_DROP = str.maketrans({c: None for c in string.punctuation} | {c: None for c in "¬“”‘’«»£§©®°•·"} | {"—": " ", "–": " "})
#: token that marks the end of a line while a page is one list of tokens; no word can be it
LINE_END = "\x01"
_OCR = (("vv", "w"), ("rn", "m"), ("cl", "d"), ("li", "h"), ("ii", "u"), ("0", "o"), ("1", "l"), ("5", "s"), ("8", "s"))


@functools.lru_cache(maxsize=65536)
def _fold_char(ch: str) -> str:
    import unicodedata

    out = "".join(TO_LATIN.get(c, c) for c in usual_form(ch))
    return "".join(c for c in unicodedata.normalize("NFD", out) if not unicodedata.combining(c))


_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")


def _folded(text: str) -> str:
    """The text with its look-alikes in Latin letters; what is ASCII already costs one search."""
    return text if text.isascii() else _BEYOND_ASCII.sub(lambda m: "".join(map(_fold_char, m[0])), text)


def words_of(line: str) -> list[str]:
    """Comparable words of a line: look-alikes folded, lower case, punctuation dropped."""
    return _folded(line).lower().translate(_DROP).split()


def reading_order(text: str, xs, ys, ws, n_columns: int) -> list[str]:
    """Pieces of text in column order: by column, then from top to bottom.

    A line run together from several columns is parted at its wide gap. Where boxes and lines do not correspond, the
    scan order stays.
    """
    lines = text.split("\n")
    if len(xs) != len(lines):
        return [p for line in lines for p in line.split("  ")]
    xs, ys, ws = (np.asarray(v) for v in (xs, ys, ws))
    if n_columns <= 1:
        if (ys[1:] >= ys[:-1]).all():
            return lines
        return [lines[i] for i in sorted(range(len(lines)), key=lambda i: (ys[i], i))]
    xs, ys, ws = xs.tolist(), ys.tolist(), ws.tolist()
    left = min(xs)
    width = max(1.0, (max(x + w for x, w in zip(xs, ws)) - left) / n_columns)
    pieces = []
    for i, line in enumerate(lines):
        column = int((xs[i] - left) / width + 0.3)
        if "  " in line:
            parts = [p for p in line.split("  ") if p.strip()]
            pieces += [(column + k, ys[i], i, p) for k, p in enumerate(parts)]
        else:
            pieces.append((column, ys[i], i, line))
    pieces.sort()
    return [p[3] for p in pieces]


@functools.lru_cache(maxsize=200_000)
def alike(a: str, b: str) -> float:
    """1 for equal words, else one minus the edit distance over the longer length after undoing usual misreadings."""
    if a == b:
        return 1.0
    for x, y in _OCR:
        a, b = a.replace(x, y), b.replace(x, y)
    if a == b:
        return 0.99
    la, lb = len(a), len(b)
    if not la or not lb or abs(la - lb) > max(la, lb) * 0.45:
        return 0.0
    shared = sum(min(a.count(c), b.count(c)) for c in set(a))
    if shared < 0.5 * max(la, lb):  # no alignment can reach a likeness that is ever asked for
        return 0.0
    row = list(range(lb + 1))
    for i in range(1, la + 1):
        last, row[0] = row[0], i
        for j in range(1, lb + 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a[i - 1] != b[j - 1]))
    return 1 - row[lb] / max(la, lb)


def same_word(a: str, b: str, words) -> bool:
    """Whether page word ``b`` prints item word ``a``, damaged or not; another of the items' own words is no damage."""
    return a == b or (b not in words and alike(a, b) >= (0.6 if max(len(a), len(b)) > 4 else 0.5))


@dataclass
class ItemIndex:
    """SimHash windows of a block of items: each distinct one once, sorted per Hamming block."""

    ids: np.ndarray
    words: list[list[str]]
    weight: dict[str, float]
    prints: np.ndarray  # of the distinct windows
    sample: np.ndarray  # a place in flat of each distinct window
    first: np.ndarray  # where its places begin in ``places``; one more at the end
    places: np.ndarray  # numbers of windows, by distinct window
    where: np.ndarray  # (item, position) of each window
    order: list[np.ndarray]
    keys: list[np.ndarray]
    seen: list[np.ndarray]
    vocabulary: list[str]
    flat: np.ndarray  # the items' words as places in the vocabulary, between runs of len(vocabulary)
    offset: np.ndarray  # where each item begins in flat


def _vectors(vocabulary: list[str], weight: dict[str, float], other: float = 1.0) -> np.ndarray:
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], dtype=">u8")
    signs = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int16) * 2 - 1
    scale = np.array([max(1, round(8 * weight.get(w, other))) for w in vocabulary], dtype=np.int16)
    return signs * scale[:, None]


def _prints(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    v = vectors[ids]
    total = v[: len(v) - WINDOW + 1].copy()
    for k in range(1, WINDOW):
        total += v[k : len(v) - WINDOW + 1 + k]
    return _print(total)


def _print(total: np.ndarray) -> np.ndarray:
    return np.packbits(total > 0, axis=1).view(">u8").ravel().astype(np.uint64)


def _block(prints: np.ndarray, k: int) -> np.ndarray:
    return ((prints >> np.uint64(sum(BLOCKS[:k]))) & np.uint64((1 << BLOCKS[k]) - 1)).astype(np.int64)


def build_index(items: list[tuple[int, str]]) -> ItemIndex:
    """Index of every window of the items of at least MIN_WORDS words.

    In a fingerprint a word weighs by how few of the items hold it.
    """
    ids = np.array([i for i, _ in items], dtype=np.int64)
    words = [words_of(t) for _, t in items]
    held = Counter(w for ws in words for w in set(ws))
    weight = {w: 1 + math.log((1 + len(items)) / (1 + n)) / 8 for w, n in held.items()}
    vocabulary = sorted(weight)
    number = {w: n for n, w in enumerate(vocabulary)}
    where = []
    pad = np.full(MIN_WORDS, len(vocabulary), np.int64)
    spread, offset, length = [pad], [], len(pad)
    for k, ws in enumerate(words):
        offset.append(length)
        spread += [np.array([number[w] for w in ws], np.int64), pad]
        length += len(ws) + len(pad)
        if len(ws) >= MIN_WORDS:
            at = np.arange(len(ws) - WINDOW + 1)
            where.append(np.stack([np.full(len(at), k), at], axis=1))
    flat, offset = np.concatenate(spread), np.array(offset, np.int64)
    place = np.concatenate(where) if where else np.zeros((0, 2), np.int64)
    start = offset[place[:, 0]] + place[:, 1] if len(place) else np.zeros(0, np.int64)
    texts, sample, which = np.unique(np.stack([flat[start + k] for k in range(WINDOW)], axis=1), axis=0, return_index=True, return_inverse=True)
    which = which.ravel()
    vectors = _vectors(vocabulary, weight) if vocabulary else np.zeros((0, 64), np.int16)
    prints = _print(np.sum([vectors[texts[:, k]] for k in range(WINDOW)], axis=0)) if len(texts) else np.zeros(0, np.uint64)
    places = np.argsort(which, kind="stable")
    first = np.searchsorted(which[places], np.arange(len(texts) + 1))
    order = [np.argsort(_block(prints, k), kind="stable") for k in range(len(BLOCKS))]
    keys = [_block(prints, k)[o] for k, o in enumerate(order)]
    seen = []
    for k, bits in enumerate(BLOCKS):
        mask = np.zeros(1 << bits, bool)
        mask[keys[k]] = True
        seen.append(mask)
    return ItemIndex(ids, words, weight, prints, start[sample] if len(texts) else start, first, places, place, order, keys, seen, vocabulary, flat, offset)


def seeds(prints: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, np.ndarray]:
    """(page window, item window) pairs within RADIUS, found through a shared block."""
    left, right = [], []
    for k in range(len(BLOCKS)):
        block = _block(prints, k)
        at = np.flatnonzero(index.seen[k][block])
        lo, hi = np.searchsorted(index.keys[k], block[at], "left"), np.searchsorted(index.keys[k], block[at], "right")
        a, b = _spread(at, lo, hi)
        b = index.order[k][b]
        apart = prints[a] ^ index.prints[b]
        near = np.bitwise_count(apart) <= RADIUS
        for earlier in range(k):  # found there already
            near &= _block(apart, earlier) != 0
        left.append(a[near])
        right.append(b[near])
    return np.concatenate(left), np.concatenate(right)


def _spread(r: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each element of ``r`` with every number from its ``low`` to below its ``high``."""
    n = high - low
    return np.repeat(r, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


@functools.lru_cache(maxsize=200_000)
def _plain(word: str) -> str:
    """The word after undoing usual misreadings, as ``alike`` compares it."""
    for x, y in _OCR:
        word = word.replace(x, y)
    return word


@functools.lru_cache(maxsize=200_000)
def _shape(word: str) -> tuple[int, int, int, int, int, int]:
    """Length and letters of the plain word, first and last letter and length of the word as printed.

    Letters are bits for their first and second occurrence and a count of everything beyond.
    """
    plain = _plain(word)
    bits = beyond = 0
    for c in plain:
        k = ord(c) - 97
        if not 0 <= k < 26 or bits >> (26 + k) & 1:
            beyond += 1
        else:
            bits |= 1 << (26 + k if bits >> k & 1 else k)
    return len(plain), bits, beyond, ord(word[0]), ord(word[-1]), len(word)


#: letters at the end and start of two words that read as one letter once the words are joined
_JOINED = [(ord(x[0]), ord(x[1])) for x, _ in _OCR if len(x) == 2]
#: letters up to which many edit distances are worked out at once; longer words go one by one
_BATCH_LETTERS = 24


def _likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """``alike`` of many pairs of unequal words: one table of edit distances for all pairs, row by row."""
    plain = [(_plain(a), _plain(b)) for a, b in pairs]
    sizes = np.array([(len(a), len(b)) for a, b in plain], np.int64).reshape(-1, 2)
    out = np.zeros(len(pairs))
    many = np.flatnonzero((sizes.max(axis=1) <= _BATCH_LETTERS) & (sizes.min(axis=1) > 0)) if len(pairs) else np.zeros(0, int)
    one_by_one = np.ones(len(pairs), bool)
    one_by_one[many] = False
    for r in np.flatnonzero(one_by_one):
        out[r] = alike(*pairs[r])
    if not len(many):
        return out
    la, lb = sizes[many].T
    letters = lambda k: np.array([[*map(ord, plain[r][k].ljust(_BATCH_LETTERS))] for r in many], np.int32).T
    x, y = letters(0), letters(1)
    row = np.repeat(np.arange(lb.max() + 1, dtype=np.int16)[:, None], len(many), axis=1)
    last = row[lb, np.arange(len(many))].copy()
    for i in range(1, la.max() + 1):
        new = np.empty_like(row)
        new[0] = i
        step = np.minimum(row[1:] + 1, row[:-1] + (x[i - 1] != y[: lb.max()]))
        for j in range(1, lb.max() + 1):
            np.minimum(step[j - 1], new[j - 1] + 1, out=new[j])
        row = new
        here = np.flatnonzero(la == i)
        last[here] = row[lb[here], here]
    longest = np.maximum(la, lb)
    value = np.where(last == 0, 0.99, 1 - last / longest)
    value[np.abs(la - lb) > longest * 0.45] = 0.0
    out[many] = value
    return out


#: bits of a pair of words: the page word prints the item word; it is like enough between two standing neighbours
_SAME, _NEAR = 1, 2
#: pairs of an item word and a page word whose likeness is kept, one byte each
TABLE_BYTES = 1 << 27


class _Lexicon:
    """Page words met so far, each with its likeness to every word of the items, worked out once."""

    def __init__(self, index: ItemIndex):
        self.index, self.own = index, len(index.vocabulary)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.number[LINE_END]  # is 0
        self.shapes = np.array([_shape(w) for w in self.index.vocabulary], np.int64).reshape(-1, 6)
        self.table = np.zeros((0, self.own), np.uint8)
        self.rows = 0
        self.known = np.zeros(0, bool)
        self.memo: dict[float, dict[int, bool]] = {0.7: {}, 0.8: {}}

    def grow(self) -> None:
        """Shapes and likenesses of the words that are new since the last call."""
        names = list(self.number)[self.rows :]
        if not names:
            return
        mine = self.shapes[: self.own]
        fresh = np.array([_shape(w) for w in names], np.int64)
        place = {w: n for n, w in enumerate(self.index.vocabulary)}
        equal = np.array([place.get(w, -1) for w in names], np.int64)
        table = np.zeros((len(names), self.own), np.uint8)
        at = np.flatnonzero(equal >= 0)
        table[at, equal[at]] = _SAME | _NEAR
        unknown = np.flatnonzero(equal < 0)
        for part in np.array_split(unknown, max(1, len(unknown) * max(1, self.own) // 2_000_000)):
            shared = np.bitwise_count(fresh[part, None, 1] & mine[None, :, 1]) + np.minimum(fresh[part, None, 2], mine[None, :, 2])
            r, a = np.nonzero(shared >= 0.5 * np.maximum(fresh[part, None, 0], mine[None, :, 0]) - 1e-9)
            r = part[r]
            value = _likeness([(self.index.vocabulary[k], names[n]) for k, n in zip(a, r)])
            least = np.where(np.maximum(mine[a, 5], fresh[r, 5]) > 4, 0.6, 0.5)
            table[r, a] = np.where(value >= least, _SAME, 0) | np.where((value >= BADLY_DAMAGED) | (value >= least), _NEAR, 0)
        if self.rows + len(names) > len(self.table):  # doubling, so that growing costs little
            room = np.zeros((2 * (self.rows + len(names)), self.own), np.uint8)
            room[: self.rows] = self.table[: self.rows]
            self.table = room
        self.table[self.rows : self.rows + len(names)] = table
        self.rows += len(names)
        self.known = np.concatenate([self.known, equal >= 0])
        self.shapes = np.concatenate([self.shapes, fresh])

    def name(self, k: int) -> str:
        return self.index.vocabulary[k] if k < self.own else self.names[k - self.own]

    def ready(self) -> None:
        self.grow()
        self.names = list(self.number)
        self.size, _, self.beyond, self.first, self.last, self.letters = (c.astype(np.int32) for c in self.shapes.T)
        self.bits = np.ascontiguousarray(self.shapes[:, 1])
        self.flat = np.ascontiguousarray(self.table[: self.rows]).ravel()


class _Reach:
    """How far an alignment through a seed goes, for many seeds at once: ``_walk`` step by step over arrays of places."""

    def __init__(self, page: np.ndarray, ends: np.ndarray, starts: np.ndarray, lexicon: _Lexicon):
        self.page, self.ends, self.lexicon, self.index = page, ends, lexicon, lexicon.index
        self.own = lexicon.own
        self.starts = np.unique(starts)
        self.is_start = np.zeros(len(page) + 2, bool)
        self.is_start[self.starts] = True
        self.lines: dict[int, np.ndarray] = {}
        size, letters = lexicon.size, lexicon.letters
        self.page_size, self.page_long = size[page + self.own], letters[page + self.own] > 3
        item = np.minimum(self.index.flat, max(self.own - 1, 0))
        self.item_size, self.item_long = size[item], letters[item] > 3

    def _bit(self, a: np.ndarray, b: np.ndarray, bit: int) -> np.ndarray:
        """Whether item words ``a`` and page words ``b`` (-1 or ``own``: none) have the bit."""
        out = (b >= 0) & (a < self.own)
        at = np.flatnonzero(out)
        out[at] = self.lexicon.flat[b[at] * self.own + a[at]] & bit != 0
        return out

    @staticmethod
    def _fit(total: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
        """Whether two words of ``total`` letters can be like one of ``other``; joined they may read shorter by one."""
        return np.abs(total - other) <= (1 - least) * np.maximum(total, other) + 1

    def joined(self, one: np.ndarray, first: np.ndarray, second: np.ndarray, least: float) -> np.ndarray:
        """Whether the words ``first`` and ``second`` run together are like ``one``; item words first, then page words."""
        lex = self.lexicon
        out = np.zeros(len(one), bool)
        total, other = lex.size[first] + lex.size[second], lex.size[one]
        bits, beyond = lex.bits[one], lex.beyond[one]
        shared = np.bitwise_count(bits & lex.bits[first]) + np.minimum(beyond, lex.beyond[first]) + np.bitwise_count(bits & lex.bits[second]) + np.minimum(beyond, lex.beyond[second])
        maybe = np.minimum(shared, np.minimum(total, other)) >= least * np.maximum(total, other) - 1e-9
        for p, q in _JOINED:
            maybe |= (lex.last[first] == p) & (lex.first[second] == q)
        at = np.flatnonzero(maybe & self._fit(total, other, least))
        every, back = np.unique(one[at] << 42 | first[at] << 21 | second[at], return_inverse=True)  # words are below TABLE_BYTES >> 6
        hit, memo, name = np.zeros(len(every), bool), lex.memo[least], lex.name
        for n, key in enumerate(every.tolist()):
            if (got := memo.get(key)) is None:
                got = memo[key] = alike(name(key >> 21 & 0x1FFFFF) + name(key & 0x1FFFFF), name(key >> 42)) >= least
            hit[n] = got
        out[at] = hit[back]
        return out

    def _line_words(self, step: int) -> np.ndarray:
        """Sorted (item word, line start) as one number each: lines that begin, or end where going back, with the word."""
        if step not in self.lines:
            at = self.starts - (step < 0)
            line = np.flatnonzero((at >= 0) & (at < len(self.page)))
            words, which = np.unique(self.page[at[line]], return_inverse=True)
            n, a = np.nonzero(self.lexicon.table[words] & _SAME)
            low, high = np.searchsorted(n, which), np.searchsorted(n, which, "right")
            each, k = _spread(line, low, high)
            self.lines[step] = np.sort(a[k] * len(self.starts) + each)
        return self.lines[step]

    def _jump(self, j, lo, hi, a, a2, b, here, after, step: int) -> np.ndarray:
        """Page place at which the walk goes on beyond something interposed, -1 where nowhere."""
        page, lex = self.page, self.lexicon
        if step > 0:
            first, stop = np.searchsorted(self.starts, j + 2), np.searchsorted(self.starts, np.minimum(j + 2 + MAX_INTERPOSED, hi))
        else:
            first, stop = np.searchsorted(self.starts, np.maximum(j - MAX_INTERPOSED, lo + 1)), np.searchsorted(self.starts, j)
        stop = np.maximum(stop, first)
        # lines that begin with the item's next word, and go on with the word behind it
        r, keys = np.flatnonzero(here), self._line_words(step)
        low = np.searchsorted(keys, a[r] * len(self.starts) + first[r])
        r, k = _spread(r, low, np.searchsorted(keys, a[r] * len(self.starts) + stop[r]))
        line = keys[k] - a[r] * len(self.starts)
        f = self.starts[line] - (step < 0) + step
        f = np.where((f >= lo[r]) & (f < hi[r]), page[np.clip(f, 0, len(page) - 1)], -1)
        hit = (a2[r] == self.own) | self._bit(a2[r], f, _SAME)
        r, line = r[hit], line[hit]
        # lines whose first word is the other half of the broken word ``b``, which must hold hardly any letter beyond it
        s = np.flatnonzero(after)
        x, y = a[s], b[s] + self.own
        shared = np.bitwise_count(lex.bits[x] & lex.bits[y]) + np.minimum(lex.beyond[x], lex.beyond[y])
        s = s[(lex.size[y] <= 1.25 * lex.size[x] + 1) & (shared >= lex.size[y] - 0.25 * lex.size[x] - 1)]
        s, more = _spread(s, first[s], stop[s])
        e = page[self.starts[more] - (step < 0)]
        y, z = (b[s], e) if step > 0 else (e, b[s])
        hit = self.joined(a[s], y + self.own, z + self.own, 0.8)
        r, line = np.concatenate([r, s[hit]]), np.concatenate([line, more[hit]])
        nearest = np.full(len(j), 1 << 60, np.int64)
        np.minimum.at(nearest, r, line * step)
        out = np.full(len(j), -1, np.int64)
        found = np.flatnonzero(nearest < 1 << 60)
        out[found] = self.starts[nearest[found] * step] - (step < 0)
        return out

    def _side(self, q: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int, need: np.ndarray) -> np.ndarray:
        """Item words an alignment gains beyond item place ``q`` and page place ``p``, up to ``need``."""
        item, page, lex = self.index.flat, self.page, self.lexicon
        gained = np.zeros(len(q), np.int64)
        live = np.flatnonzero(gained < need)
        i, j = q[live], p[live]
        while len(live):
            a = item[i + step]
            some = np.flatnonzero(a != self.own)
            live, i, j, a = live[some], i[some], j[some], a[some]
            low, high = lo[live], hi[live]
            at = j + step
            b = np.where((at >= low) & (at < high), page[np.clip(at, 0, len(page) - 1)], -1)
            di, dj = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
            on = self._bit(a, b, _SAME)
            di[on] = dj[on] = step
            r = np.flatnonzero(~on)
            if len(r):
                ra, rb, rj = a[r], b[r], j[r]
                a2 = item[i[r] + 2 * step]
                at = rj + 2 * step
                c = np.where((rb >= 0) & (at >= low[r]) & (at < high[r]), page[np.clip(at, 0, len(page) - 1)], -1)
                qi, pj = i[r] + step, np.clip(rj + step, 0, len(page) - 1)
                long, one, other = self.item_long[qi], self.item_size[qi], self.page_size[pj]
                gi, gj = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
                s = np.flatnonzero((rb >= 0) & (a2 != self.own) & self.page_long[pj] & self._fit(one + self.item_size[qi + step], other, 0.7))
                x, y = (ra[s], a2[s]) if step > 0 else (a2[s], ra[s])
                s = s[self.joined(rb[s] + self.own, x, y, 0.7)]  # two words run together
                gi[s], gj[s] = 2 * step, step
                s = np.flatnonzero((gi == 0) & (c >= 0) & long & self._fit(other + self.page_size[np.clip(pj + step, 0, len(page) - 1)], one, 0.7))
                x, y = (rb[s], c[s]) if step > 0 else (c[s], rb[s])
                s = s[self.joined(ra[s], x + self.own, y + self.own, 0.7)]  # one word broken
                gi[s], gj[s] = step, 2 * step
                edge = rj + (1 if step > 0 else 0)
                here = (gi == 0) & self.is_start[edge]
                after = (gi == 0) & (rb >= 0) & long & self.is_start[np.clip(edge + step, 0, len(self.is_start) - 1)]
                s = np.flatnonzero(here | after)
                to = self._jump(rj[s], low[r[s]], high[r[s]], ra[s], a2[s], rb[s], here[s], after[s], step)
                s, to = s[to >= 0], to[to >= 0]
                gi[s], gj[s] = step, to - rj[s]
                s = np.flatnonzero((gi == 0) & (c >= 0) & (a2 != self.own))
                s = s[~lex.known[rb[s]]]
                s = s[self._bit(ra[s], rb[s], _NEAR) & self._bit(a2[s], c[s], _SAME)]
                a3 = item[i[r[s]] + 3 * step]
                at = rj[s] + 3 * step
                d = np.where((at >= low[r[s]]) & (at < high[r[s]]), page[np.clip(at, 0, len(page) - 1)], -1)
                s = s[(a3 == self.own) | self._bit(a3, d, _SAME)]  # badly damaged, but its neighbours stand
                gi[s] = gj[s] = step
                di[r], dj[r] = gi, gj
            go = np.flatnonzero(di != 0)
            live, i, j = live[go], i[go] + di[go], j[go] + dj[go]
            gained[live] += np.abs(di[go])
            more = np.flatnonzero(gained[live] < need[live])
            live, i, j = live[more], i[more], j[more]
        return gained

    def stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of a page window and a distinct item window of which all words but one are printed.

        A fingerprint knows no order, so others are no stretch.
        """
        q = self.index.sample[b]
        printed, left = np.zeros(len(a), np.int64), np.arange(len(a))
        for k in range(WINDOW):
            printed[left] += self._bit(self.index.flat[q[left] + k], self.page[a[left] + k], _SAME)
            left = left[printed[left] >= k]  # one word may be missing
        return printed >= WINDOW - 1

    def leading(self, a: np.ndarray, b: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Seeds that do not only continue another one.

        Where the word before and all words but the last are equal letter for letter, the window before is a seed too,
        and where the last word is printed as well its alignment is the same.
        """
        lo = np.concatenate([[0], self.ends])[own]
        q = self.index.offset[self.index.where[b, 0]] + self.index.where[b, 1]
        left = np.flatnonzero((a > lo) & (self.index.flat[q - 1] != self.own))
        for k in range(-1, WINDOW - 1):
            w = self.page[a[left] + k]
            x = self.index.flat[q[left] + k]
            left = left[self.lexicon.known[w] & self._bit(x, w, _SAME)]  # a known word prints itself only
        left = left[self._bit(self.index.flat[q[left] + WINDOW - 1], self.page[a[left] + WINDOW - 1], _SAME)]
        out = np.ones(len(a), bool)
        out[left] = False
        return out

    def enough(self, a: np.ndarray, b: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Which seeds reach MIN_WORDS words."""
        lo, hi = np.concatenate([[0], self.ends])[own], self.ends[own]
        q = self.index.offset[self.index.where[b, 0]] + self.index.where[b, 1]
        need = np.full(len(a), MIN_WORDS - WINDOW, np.int64)
        right = self._side(q + WINDOW - 1, a + WINDOW - 1, lo, hi, 1, need)
        return right + self._side(q, a, lo, hi, -1, need - right) >= MIN_WORDS - WINDOW


def _walk(item: list[str], page: list[str], lines: list[int], words, i: int, j: int, step: int) -> list[tuple[int, int, float]]:
    """Aligned (item position, page position, likeness) beyond (i, j) in one direction, until the texts part."""
    out: list[tuple[int, int, float]] = []

    def it(k):
        return item[i + step * k] if 0 <= i + step * k < len(item) else None

    def pg(k, base=None):
        at = (j if base is None else base) + step * k
        return page[at] if 0 <= at < len(page) else None

    def glue(a, b):
        return (a + b) if step > 0 else (b + a)

    def boundary(at):  # a line ends between at and the word before it in walking direction
        edge = at if step > 0 else at + 1
        k = bisect_left(lines, edge)
        return k < len(lines) and lines[k] == edge

    def ahead(at):  # the words just beyond the next line ends, up to MAX_INTERPOSED words away
        if step > 0:
            return (x for x in lines[bisect_left(lines, at + 2) : bisect_left(lines, at + 2 + MAX_INTERPOSED)] if x < len(page))
        return (x - 1 for x in reversed(lines[bisect_left(lines, at - MAX_INTERPOSED) : bisect_left(lines, at)]) if x > 0)

    while it(1) is not None:
        a, b = it(1), pg(1)
        if b is not None and same_word(a, b, words):
            i, j = i + step, j + step
            out.append((i, j, alike(a, b)))
            continue
        if b is not None and it(2) is not None and len(b) > 3 and alike(glue(a, it(2)), b) >= 0.7:  # two words run together
            out += [(i + step, j + step, 0.9), (i + 2 * step, j + step, 0.9)]
            i, j = i + 2 * step, j + step
            continue
        if b is not None and pg(2) is not None and len(a) > 3 and alike(a, glue(b, pg(2))) >= 0.7:  # one word broken
            i, j = i + step, j + 2 * step
            out.append((i, j, 0.9))
            continue
        jump = None
        here, after = boundary(j + step), b is not None and boundary(j + 2 * step) and len(a) > 3
        for at in (ahead(j) if here or after else ()):
            c, d = page[at], pg(1, at)
            if here and same_word(a, c, words) and (it(2) is None or (d is not None and same_word(it(2), d, words))):
                jump = at
            elif after and alike(a, glue(b, c)) >= 0.8:  # broken about the advert
                jump = at
            if jump is not None:
                break
        if jump is not None:
            i, j = i + step, jump
            out.append((i, j, 0.9))
            continue
        if b is not None and it(2) is not None and pg(2) is not None and b not in words and alike(a, b) >= BADLY_DAMAGED and same_word(it(2), pg(2), words) and (it(3) is None or (pg(3) is not None and same_word(it(3), pg(3), words))):
            i, j = i + step, j + step  # badly damaged, but its neighbours stand
            out.append((i, j, 0.0))
            continue
        break
    return out


def passage(item: list[str], page: list[str], lines: list[int], words, i: int, j: int) -> list[tuple[int, int, float]]:
    """Longest alignment through the seed (i, j), without doubtful words at its ends."""
    core = [(i + k, j + k, alike(item[i + k], page[j + k])) for k in range(WINDOW) if i + k < len(item) and j + k < len(page)]
    path = _walk(item, page, lines, words, i, j, -1)[::-1] + core + _walk(item, page, lines, words, i + WINDOW - 1, j + WINDOW - 1, 1)

    def doubtful(p):
        return p[2] < 0.5 or (p[2] < 0.9 and len(item[p[0]]) < 3)

    while path and doubtful(path[0]):
        path.pop(0)
    while path and doubtful(path[-1]):
        path.pop()
    return path


def find_in_page(page: list[str], lines: list[int], pairs: list[tuple[int, int]], index: ItemIndex, least: int = MIN_WORDS):
    """(item number, words, item words of the stretch, whether each is intact) of every stretch of at least ``least`` words."""
    by_item: dict[int, list[tuple[int, int]]] = {}
    for j, w in pairs:
        k, i = index.where[w]
        by_item.setdefault(int(k), []).append((j, int(i)))
    for k, places in by_item.items():
        item, done, seen = index.words[k], set(), set()
        for j, i in places:
            if (i, j) in done:
                continue
            path = passage(item, page, lines, index.weight, i, j)
            if not path or path[-1][0] - path[0][0] + 1 < least or tuple(path) in seen:
                continue
            done.update((a, b) for a, b, s in path if s >= 0.99)
            seen.add(tuple(path))
            yield k, path[-1][0] - path[0][0] + 1, [item[a] for a, _, _ in path], [s >= 0.99 for _, _, s in path]


#: pages whose windows are computed at once
PAGES_AT_ONCE = 400


def _tokens(text: str, xs, ys, ws, n: int) -> list[str]:
    """Words of a page in reading order, LINE_END between its lines."""
    pieces = _folded("\n".join(reading_order(text, xs, ys, ws, n)))
    return pieces.lower().replace("\n", f" {LINE_END} ").translate(_DROP).split()


def scan_pages(pages, index: ItemIndex, lexicon: _Lexicon | None = None, tally: Counter[str] | None = None):
    """(page number, item number, words, their texts, intact or not) over pages given as (text, xs, ys, ws, n_columns)."""
    lexicon = lexicon or _Lexicon(index)
    for first in range(0, len(pages), PAGES_AT_ONCE):
        if len(lexicon.number) * max(1, lexicon.own) > TABLE_BYTES:
            lexicon.clear()
        tokens_of = [_tokens(*page) for page in pages[first : first + PAGES_AT_ONCE]]
        if tally is not None:  # pages that hold each word of the items, and all pages
            for tokens in tokens_of:
                tally.update(index.weight.keys() & tokens)
            tally[""] += len(tokens_of)
        yield from _scan_chunk(tokens_of, first, lexicon)


def _scan_chunk(tokens_of: list[list[str]], first: int, lexicon: _Lexicon):
    index, ids = lexicon.index, []
    for tokens in tokens_of:
        ids.extend(map(lexicon.number.__getitem__, tokens))
    marked = np.array(ids, np.int64)
    word = marked != 0
    flat = marked[word]
    if len(flat) < WINDOW:
        return
    ends = np.concatenate([[0], np.cumsum(word)])[np.cumsum([len(t) for t in tokens_of])]
    used = np.flatnonzero(np.bincount(flat))
    here, names = np.zeros(len(lexicon.number), np.int64), list(lexicon.number)
    here[used] = np.arange(len(used))
    a, b = seeds(_prints(here[flat], _vectors([names[k] for k in used], index.weight)), index)
    inside = a + WINDOW <= ends[np.minimum(np.searchsorted(ends, a, "right"), len(ends) - 1)]
    a, b = a[inside], b[inside]
    if not len(a):
        return
    lexicon.ready()
    reach = _Reach(flat, ends, np.concatenate([[0], np.cumsum(word)[~word], ends]), lexicon)
    stands = reach.stand(a, b)
    a, b = _spread(a[stands], index.first[b[stands]], index.first[b[stands] + 1])
    b, own = index.places[b], np.searchsorted(ends, a, "right")
    for test in (reach.leading, reach.enough):
        kept = test(a, b, own)
        a, b, own = a[kept], b[kept], own[kept]
    # every seed of a run is tried; those on a stretch that is already aligned cost a look-up
    order = np.lexsort((a, index.where[b, 1] - a, index.where[b, 0], own))
    a, b, own = a[order], b[order], own[order]
    for p in np.unique(own):
        base = ends[p - 1] if p else 0
        mine = own == p
        page, starts = [], [0]
        for t in tokens_of[p]:
            if t == LINE_END:
                starts.append(len(page))
            else:
                page.append(t)
        starts.append(len(page))
        for found in find_in_page(page, starts, list(zip((a[mine] - base).tolist(), b[mine].tolist())), index):
            yield first + int(p), *found


def intact_enough(words: list[str], intact: list[bool], pages_with: dict[str, int], n_pages: int) -> bool:
    """Whether the words printed intact hold MIN_INTACT of the stretch's weight; a word weighs by how few pages hold it."""
    weight = [1 + math.log((1 + n_pages) / (1 + pages_with.get(w, 0))) / 8 for w in words]
    return sum(w for w, s in zip(weight, intact) if s) >= MIN_INTACT * sum(weight)


def _slices(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists of an Arrow column as slices of one array; a null list is empty, a null number is 0."""
    flat = lists.values.fill_null(0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    known = lists.is_valid().to_numpy(zero_copy_only=False)
    return [flat[a:b] if k else flat[:0] for a, b, k in zip(offsets, offsets[1:], known)]


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", boxes: str = "boxes", columns: str = "n_columns") -> DataFrame:
    """(doc_id, item_id, words): every page that prints at least MIN_WORDS consecutive words of an item.

    Null and empty texts match nothing, neither do items shorter than MIN_WORDS. Repeated documents give one row per
    pair and text copies of the same id count once. One pass over the pages finds the aligned stretches and counts, task
    by task, the pages that hold each word of the items; then the stretches are weighed by the counts of all pages.
    Only stretches and one row per task and word leave the scan.
    """
    held = items.where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()
    pages = documents.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias(key), text, F.col(f"{boxes}.x").alias("xs"), F.col(f"{boxes}.y").alias("ys"), F.col(f"{boxes}.w").alias("ws"), F.coalesce(F.col(columns), F.lit(1)).alias("n")
    )
    schema = pa.schema([(key, pa.int64()), (item_key, pa.int64()), ("words", pa.int64()), ("texts", pa.list_(pa.string())), ("intact", pa.list_(pa.bool_()))])
    context, found = documents.sparkSession.sparkContext, None

    def blocks():  # the query set comes to the driver block by block; toLocalIterator holds one partition at a time
        own, some = [], False
        for row in held.toLocalIterator():
            own.append((row["i"], row["t"]))
            if len(own) == ITEMS_PER_BLOCK:
                yield sorted(own)
                own, some = [], True
        if own or not some:
            yield sorted(own)

    for own in blocks():
        shared = context.broadcast(own)

        def scan(batches, shared=shared):
            index, tally = build_index(shared.value), Counter()
            lexicon = _Lexicon(index)

            def rows(columns):
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

            for batch in batches:
                keys, texts, n_columns = (batch.column(i).to_pylist() for i in (0, 1, 5))
                places = [_slices(batch.column(i)) for i in (2, 3, 4)]
                hits = [(keys[p], int(index.ids[k]), *x) for p, k, *x in scan_pages(list(zip(texts, *places, n_columns)), index, lexicon, tally) if keys[p] is not None]
                if hits:
                    yield rows(zip(*hits))
            yield rows([[None] * len(tally), [None] * len(tally), list(tally.values()), [[w] for w in tally], [None] * len(tally)])

        kind = f"{key} bigint, {item_key} bigint, words bigint, texts array<string>, intact array<boolean>"
        # read twice: the counts, then the stretches; a few rows for each leaked page and each task
        scanned = cut(pages.mapInArrow(scan, kind))
        # one row per word of at most ITEMS_PER_BLOCK items, whatever the size of the corpus
        counts = {r["w"]: r["n"] for r in scanned.where(F.col("intact").isNull()).groupBy(F.col("texts")[0].alias("w")).agg(F.sum("words").alias("n")).collect()}
        weighed = context.broadcast((counts, counts.pop("", 0)))

        @F.udf("boolean", useArrow=True)
        def holds(texts, intact, weighed=weighed):
            return intact_enough(texts, intact, *weighed.value)

        part = scanned.where(F.col("intact").isNotNull()).where(holds("texts", "intact")).select(key, item_key, F.col("words").cast("int").alias("words"))
        found = part if found is None else found.unionByName(part)
    return found.groupBy(key, item_key).agg(F.max("words").alias("words"))
