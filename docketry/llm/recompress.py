"""Removal of word windows that occur earlier, by recompression.

A text is a sequence of words, each with a name. Every round first names runs of one symbol, then
pairs: a bit of each symbol's name says whether it can open or close a pair, and a closer right
after an opener forms a new symbol with it. Names come from the symbols' content alone, so they
agree over all documents without an exchange; so do borders of symbols away from the ends of equal
substrings. With each symbol goes the stretch of words that decides it. A window takes as its anchor
the highest symbol that the window's own words decide, so equal windows share it. Spark rounds then
find the symbols that occur again, verify runs of windows around them, and at last single windows
by names of all their words; see docketry.llm.repeats. A window's name has 64 bits from its two halves and
32 bits from its words one by one."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from docketry.llm.repeats import NONE, PLACE, PLACE_BITS, Batch, Scheme, doubled, least_of, pair_name, without_repeats
from docketry.llm.suffixes import runs_of

#: Stands for an end of the stretch that lies outside the piece.
FAR = 1 << 40
ROUNDS = 3


#: What is left of eight bytes if only so many belong to a word.
_HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of text whose words are named at once, if blanks allow.
STRETCH = 1 << 18
#: Words with more bytes are named one by one.
LONG = 64


def word_names(text: bytes) -> np.ndarray:
    """A 64-bit name of each word: its length mixed with eight of its bytes after the other.

    A step is one-to-one, so words of up to eight bytes have names of their own but for their length.
    Long words have their XXH64."""
    out, at = [], 0
    while at < len(text):
        end = at + STRETCH
        if end < len(text):  # cut after a blank, beyond the stretch if it has none
            end = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t")) + 1
            if not end:
                found = [k for c in b" \t\n\v\f\r" if (k := text.find(c, at)) >= 0]
                end = min(found, default=len(text)) + 1
        out.append(_named(text[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def names_of_texts(texts: list[bytes]) -> Iterator[np.ndarray]:
    """word_names of each text; short texts are named together, up to a stretch of them."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > STRETCH:
            yield from _together(held)
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield from _together(held)


def _together(texts: list[bytes]) -> Iterator[np.ndarray]:
    if len(texts) == 1:
        yield word_names(texts[0])
        return
    begin, name = _named(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    yield from np.split(name, np.searchsorted(begin, ends[:-1]))


def _named(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the piece begins, and its name."""
    data = np.frombuffer(b"".join((b" ", piece, b" " * 9)), np.uint8)
    space = (data == 32) | (data - np.uint8(9) < 5)
    border = np.flatnonzero(space[1:] != space[:-1])
    begin, stop = border[::2], border[1::2]
    size = stop - begin
    # the eight bytes from each place of the piece on as one number
    eight = np.ndarray((len(piece) + 1,), "<u8", data, offset=1, strides=(1,))
    name = _mixed(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (eight[begin] & _HEAD[np.minimum(size, 8)]))
    open_, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(open_):
        left = np.minimum(size[open_] - done, 8)
        name[open_] = _mixed(name[open_] ^ (eight[begin[open_] + done] & _HEAD[left]))
        done += 8
        open_ = open_[size[open_] > done]
    for k in np.flatnonzero(size > LONG).tolist():
        name[k] = xxhash.xxh64_intdigest(piece[begin[k] : stop[k]])
    return begin, name


def _mixed(x: np.ndarray) -> np.ndarray:
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return x


def _shifted(values: np.ndarray, by: int, end) -> np.ndarray:
    """The neighbour of each value, after it (by 1) or before it (by -1); the last or first has `end`."""
    out = np.empty_like(values)
    if by > 0:
        out[:-1], out[-1:] = values[1:], end
    else:
        out[1:], out[:1] = values[:-1], end
    return out


class Symbols:
    """Symbols of a batch: name, first word, the stretch low..high (end exclusive) that decides the
    symbol, and whether a piece starts with it."""

    def __init__(self, name, begin, low, high, edge):
        self.name, self.begin, self.low, self.high, self.edge = name, begin, low, high, edge

    def before(self) -> np.ndarray:
        """Where the stretch of the symbol before starts."""
        out = _shifted(self.low, -1, -FAR)
        out[self.edge] = -FAR
        return out

    def after(self) -> np.ndarray:
        out = _shifted(self.high, 1, FAR)
        out[:-1][self.edge[1:]] = FAR
        return out

    def runs(self) -> "Symbols":
        """Runs of one symbol become one, and each knows that its neighbours differ."""
        head = self.edge.copy()
        head[1:] |= self.name[1:] != self.name[:-1]
        low, high = np.minimum(self.before(), self.low), np.maximum(self.after(), self.high)
        at = np.flatnonzero(head)
        if len(at) == len(head):
            return Symbols(self.name, self.begin, low, high, self.edge)
        end = np.append(at[1:], len(head)) - 1
        name = self.name[at]
        many = np.flatnonzero(end > at)
        name[many] = pair_name(name[many], (end - at + 1)[many].astype(np.uint64))
        return Symbols(name, self.begin[at], low[at], high[end], self.edge[at])

    def pairs(self, round_: int) -> "Symbols":
        """An opener followed by a closer becomes one symbol."""
        closes = (pair_name(self.name, np.uint64(round_ + 1)) >> np.uint64(63)).astype(bool)
        opens = ~closes & _shifted(closes & ~self.edge, 1, False)
        second = _shifted(opens, -1, False)
        low = np.where(closes & ~second, self.before(), self.low)
        high = np.where(~closes & ~opens, self.after(), self.high)
        at = np.flatnonzero(opens)
        high[at] = self.high[at + 1]
        name = self.name.copy()
        name[at] = pair_name(self.name[at], self.name[at + 1])
        keep = np.flatnonzero(~second)
        return Symbols(name[keep], self.begin[keep], low[keep], high[keep], self.edge[keep])


def best_in_windows(s: Symbols, n: int, window: int) -> np.ndarray:
    """For each of n windows the least (name, place) of the symbols that its words decide."""
    fits = np.flatnonzero((s.low >= 0) & (s.high - s.low <= window) & (s.high < FAR))
    value = s.name[fits] >> PLACE_BITS << PLACE_BITS | s.begin[fits].astype(np.uint64)
    first, last = np.maximum(s.high[fits] - window, 0), np.minimum(s.low[fits], n - 1)
    ok = first <= last
    value, first, last = value[ok], first[ok], last[ok]
    power = np.frexp(last - first + 1)[1] - 1
    top = int(window).bit_length()
    held = [np.full(n, NONE) for _ in range(top)]
    for p in range(top):
        mine = power == p
        np.minimum.at(held[p], first[mine], value[mine])
        np.minimum.at(held[p], last[mine] - (1 << p) + 1, value[mine])
    for p in range(top - 1, 0, -1):
        half = 1 << (p - 1)
        np.minimum(held[p - 1], held[p], out=held[p - 1])
        np.minimum(held[p - 1][half:], held[p][:-half], out=held[p - 1][half:])
    return held[0]


def word_scheme(window: int, rounds: int = ROUNDS) -> Scheme:
    """Windows of `window` words, 16 to 32."""
    if not 16 <= window <= 32:
        raise ValueError("the window must be 16 to 32 words")

    def batch(pieces: list) -> Batch:
        names = np.concatenate([p[2] for p in pieces])
        size = np.array([len(p[2]) for p in pieces])
        edge = np.zeros(len(names), bool)
        edge[np.cumsum(size) - size] = True
        words = np.arange(len(names), dtype=np.int64)
        n = len(names) - window + 1
        level = Symbols(names, words, words, words + 1, edge)
        name_at = np.empty(len(names), np.uint64)
        # every word by itself is decided, so each window has an anchor
        anchor = (least_of(names >> PLACE_BITS << PLACE_BITS | words.astype(np.uint64), window) & PLACE).astype(np.int64)
        name = names[anchor]
        anchor *= rounds + 1
        for r in range(rounds):
            level = level.runs().pairs(r)
            found = best_in_windows(level, n, window)
            hit = found != NONE
            at = (found[hit] & PLACE).astype(np.int64)
            name_at[level.begin] = level.name
            name[hit] = name_at[at]
            anchor[hit] = at * (rounds + 1) + r + 1
        first, last, row, start = runs_of(pieces, anchor, window)
        return Batch(doubled(names, 4), window - 16, names, window, first, last, anchor[first], name[first], row, start)

    return Scheme(window, 1 << 14, True, False, word_names, batch, names_of_texts)


def finish(text: bytes, gone: np.ndarray) -> tuple[int, int, str, str]:
    words = text.split()
    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
    return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()


def without_earlier_words(docs: DataFrame, window: int = 20, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row of docs (doc_id, text).

    Words are separated by blanks and the characters 9 to 13. Removed is each word that a window of
    `window` words covers which also starts earlier, in a document with a smaller doc_id or before in
    the same document, judged on the texts as given. kept are the other words, joined by one blank.
    A null text has no words; a null doc_id counts as larger than all others; rows with equal doc_id
    are not earlier than one another, so repeated rows get equal results. No rows give no rows; other
    columns are not read. Texts are processed whole, long ones in overlapping pieces. Without `texts`
    the column kept is left out."""
    columns = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string()}
    return without_repeats(docs, word_scheme(window), finish, columns if texts else dict(list(columns.items())[:-1]))
