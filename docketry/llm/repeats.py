"""Windows of texts that occur again, for the suffix-array and the recompression operator.

Documents are dealt into buckets of bounded size, names of positions into ranges of names. Four
rounds narrow down the positions at which a repeated window can start:

1. Anchors. Each window picks one position inside it from its own content, so equal windows pick the
   same anchor. Short names of anchors go to their ranges; those that occur once drop out.
2. Runs. Consecutive windows with one anchor are named by the pair (name of the first, name of the
   last window). A run whose content is known from an earlier document is wholly repeated.
3. Windows. Short names of what is left; windows that occur once drop out. Texts of few elements a
   byte do without this round.
4. Windows by full names, which are pairs of the names of their parts.

A round sends a name once per bucket with the bucket's smallest document, so a line that is in every
document is one entry per bucket; it gets one bit back per name it sent. Texts are shuffled once:
all rounds use the same exchange of the documents. There is no checkpoint; a lost executor's part is
made again from the input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import LAST, parts_of, picked, text_bytes

BUCKET_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
LEAST_PARTS = 128
#: Bits of a position within a batch; a batch has at most half as many elements.
PLACE_BITS = np.uint64(21)
PLACE = np.uint64((1 << 21) - 1)
NONE = np.uint64((1 << 64) - 1)

_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_THREE, _FOUR = np.uint64(0x243F6A8885A308D3), np.uint64(0xFF51AFD7ED558CCD)
_SENT = "to long, home long, round int, part int, names binary, docs binary, flags binary"
_BACK = "bucket long, round int, part int, bits binary"
_SENT_TYPES = pa.schema([("to", pa.int64()), ("home", pa.int64()), ("round", pa.int32()), ("part", pa.int32()), ("names", pa.binary()), ("docs", pa.binary()), ("flags", pa.binary())])


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for the pair of two names."""
    x = a * _ONE
    x += b
    x ^= x >> np.uint64(31)
    x *= _TWO
    x ^= x >> np.uint64(29)
    return x


def doubled(names: np.ndarray, times: int) -> np.ndarray:
    """Names of 2**times consecutive elements, from the names of one."""
    for t in range(times):
        names = pair_name(names[: -(1 << t)], names[1 << t :])
    return names


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


@dataclass
class Batch:
    """Pieces of documents, their windows gathered into runs with one anchor.

    base: names of 16 consecutive elements; second: where the second of the two parts starts that
    name a window; elements: what a window consists of, and how many. Per run: the first and the last window (places in the batch), the anchor's place
    and name, the row, and the first window's place within its document."""

    base: np.ndarray
    second: int
    elements: np.ndarray
    size: int
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    row: np.ndarray
    start: np.ndarray

    def window(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name of the window at each place: 64 bits from its parts, and 32 bits from its elements
        that do not depend on the parts' names. So windows that have a part in common, or two parts
        with one name, still differ in what the rest of them gives."""
        return pair_name(self.part(at), self.part(at + self.second)), self.check(at)

    def part(self, at: np.ndarray) -> np.ndarray:
        return self.base[at]

    def check(self, at: np.ndarray) -> np.ndarray:
        """32 bits from all elements of each window, in their order."""
        return fold(self.elements, at, range(self.size))


def fold(values: np.ndarray, at: np.ndarray, steps) -> np.ndarray:
    x = np.full(len(at), _THREE)
    for k in steps:
        x ^= values[at + k]
        x *= _FOUR
        x ^= x >> np.uint64(32)
    return (x >> np.uint64(32)).astype(np.uint32)


def eights(data: bytes | np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, without a copy; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


@dataclass
class Scheme:
    """What differs between the operators. window: elements of a window. elements: a text's elements.
    batch: makes a Batch of pieces (row, place of the piece in its document, elements, number of
    windows that start in the piece). within: a window may also repeat within its own document. sieve:
    round 3 is worth its pass over the texts. several: the elements of each of many texts, if they are
    made for less together."""

    window: int
    piece: int
    within: bool
    sieve: bool
    elements: Callable[[bytes], np.ndarray | bytes]
    batch: Callable[[list[tuple[int, int, object, int]]], Batch]
    several: Callable[[list[bytes]], Iterator] | None = None

    def batches(self, texts: list, sizes: list[int]) -> Iterator[Batch]:
        """Batches of all texts; the number of elements of each is added to sizes."""
        pieces, held = [], 0
        for row, own in enumerate(self.several(texts) if self.several else map(self.elements, texts)):
            sizes.append(len(own))
            n = len(own) - self.window + 1
            for at in range(0, n, self.piece):
                many = min(self.piece, n - at)
                pieces.append((row, at, own[at : at + many + self.window - 1], many))
                held += many + self.window
                if held >= self.piece:
                    yield self.batch(pieces)
                    pieces, held = [], 0
        if pieces:
            yield self.batch(pieces)


def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)


def spread_out(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..last, and the range of each."""
    many = last - first + 1
    of = np.repeat(np.arange(len(first)), many)
    return np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + first[of], of


class Bucket:
    """The documents of one bucket and what the rounds so far say about them."""

    def __init__(self, scheme: Scheme, table: pa.Table, parts: int, bits: dict[int, dict[int, bytes]]):
        self.scheme, self.parts, self.bits = scheme, parts, bits
        ids = table["doc_id"]
        self.ids = ids.to_pylist()
        self.doc = ids.fill_null(LAST).to_numpy().astype(np.int64)
        self.texts = table["text"].cast(pa.binary()).to_pylist()
        self.sizes: list[int] = []
        self.batches = list(scheme.batches([x or b"" for x in self.texts], self.sizes))
        self.batch_of = np.repeat(np.arange(len(self.batches)), [len(b.first) for b in self.batches])
        for c in ("first", "last", "anchor", "name", "row", "start"):
            setattr(self, c, joined([getattr(b, c) for b in self.batches], np.uint64 if c == "name" else np.int64))

    def short(self, name: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Short names in order, which of them are known to repeat, and each given name's.

        where tells places apart between which a repeat counts. Short names are a range and 32 bits;
        two names that share one are only kept for longer."""
        part = (name >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)
        short = part << np.uint64(32) | (name & np.uint64(0xFFFFFFFF))
        order = np.argsort(short, kind="stable")
        short, where = short[order], where[order]
        new = np.ones(len(short), bool)
        new[1:] = short[1:] != short[:-1]
        group = np.cumsum(new) - 1
        multi = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        multi[group[1:][~new[1:] & (where[1:] != where[:-1])]] = True
        of = np.empty(len(group), np.int64)
        of[order] = group
        return short[new], multi, of

    def anchors(self):
        return self.short(self.name, (self.batch_of << 42) + self.anchor if self.scheme.within else self.doc[self.row])

    def shared(self, round_: int, names: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which of the names given to short() occur again."""
        return self.unpacked(round_, (names >> np.uint64(32)).astype(np.int64))[of] if len(of) else np.empty(0, bool)

    def candidates(self) -> np.ndarray:
        """Runs whose anchor occurs again."""
        names, _, of = self.anchors()
        return np.flatnonzero(self.shared(1, names, of))

    def judged(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs whose anchor occurs again: those known as a whole from earlier, and the others."""
        at = self.candidates()
        known = self.runs(at).repeated(2)
        return at[known], at[~known]

    def left(self) -> "Places":
        """Windows of the runs that occur again and are not known as a whole from earlier."""
        return self.windows(self.judged()[1])

    def unpacked(self, round_: int, part: np.ndarray) -> np.ndarray:
        """One bit for each name sent, given the names' parts in order."""
        out, got = np.zeros(len(part), bool), self.bits.get(round_, {})
        for p, s in by_part(part):
            out[s] = np.unpackbits(np.frombuffer(got[p], np.uint8), count=s.stop - s.start)
        return out

    def runs(self, at: np.ndarray) -> "Named":
        high, low = np.empty(len(at), np.uint64), np.empty(len(at), np.uint32)
        for k, b in enumerate(self.batches):
            mine = np.flatnonzero(self.batch_of[at] == k)
            first, last = self.first[at[mine]], self.last[at[mine]]
            (h0, l0), (h1, l1) = b.window(first), b.window(last)
            size = (last - first).astype(np.uint64)
            high[mine] = pair_name(pair_name(h0, h1), size)
            low[mine] = (pair_name(l0.astype(np.uint64) + (size << np.uint64(32)), l1.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        return Named(self, high, low, self.row[at], self.start[at])

    def windows(self, at: np.ndarray) -> "Places":
        """All windows of the given runs, in their order."""
        high, low, row, start = [], [], [], []
        for k, b in enumerate(self.batches):
            mine = at[self.batch_of[at] == k]
            place, of = spread_out(self.first[mine], self.last[mine])
            own = mine[of]
            h, lo = b.window(place)
            high.append(h)
            low.append(lo)
            row.append(self.row[own])
            start.append(self.start[own] + place - self.first[own])
        return Places(self, joined(high, np.uint64), joined(low, np.uint32), joined(row, np.int64), joined(start, np.int64))


@dataclass
class Places:
    """Windows of a bucket by row and start."""

    bucket: Bucket
    high: np.ndarray
    low: np.ndarray
    row: np.ndarray
    start: np.ndarray

    def short(self):
        within = self.bucket.scheme.within
        return self.bucket.short(self.high, (self.row << 40) + self.start if within else self.bucket.doc[self.row])

    def again(self) -> "Named":
        """Those whose short name occurs again, sorted."""
        if not self.bucket.scheme.sieve:
            return Named(self.bucket, self.high, self.low, self.row, self.start)
        names, _, of = self.short()
        keep = self.bucket.shared(3, names, of)
        return Named(self.bucket, self.high[keep], self.low[keep], self.row[keep], self.start[keep])


class Named:
    """Named places of a bucket, sorted by range, name, document, row and place."""

    def __init__(self, bucket: Bucket, high: np.ndarray, low: np.ndarray, row: np.ndarray, start: np.ndarray):
        """Rows and starts are given in order."""
        self.bucket, self.row, self.start, self.n = bucket, row, start, len(high)
        doc = bucket.doc[row]
        order = np.argsort(high, kind="stable")
        if np.any((np.diff(high[order]) == 0) & (np.diff(low[order].astype(np.int64)) != 0)):
            order = np.lexsort((low, high))
        self.order = order
        high, low, doc, row = high[order], low[order], doc[order], row[order]
        new = np.ones(self.n, bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.group = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        self.high, self.low = high[head], low[head]
        self.least = np.minimum.reduceat(doc, head) if self.n else doc
        self.part = ((self.high >> np.uint64(32)) * np.uint64(bucket.parts) >> np.uint64(32)).astype(np.int64)
        self.later = doc > self.least[self.group]
        if bucket.scheme.within:
            self.later[1:] |= ~new[1:] & (row[1:] == row[:-1])

    def repeated(self, round_: int) -> np.ndarray:
        """Which places, as given, have the same name at an earlier place."""
        out = np.empty(self.n, bool)
        out[self.order] = self.later | (self.bucket.unpacked(round_, self.part)[self.group] if self.n else self.later)
        return out


def sent(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_SENT_TYPES.names, r, strict=True)) for r in rows], schema=_SENT_TYPES)


def by_part(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each part and where it lies; parts are in order."""
    borders = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(borders, [*borders, len(part)][1:], strict=True):
        yield int(part[a]), slice(a, b)


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second: of sorted ones the high bytes compress."""
    return values.view(np.uint8).reshape(len(values), -1).T[::-1].tobytes()


def unplaned(data: bytes, kind: type, n: int, offset: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * size, offset).reshape(size, n)[::-1].T.copy().view(kind).ravel()


def packed(ids: np.ndarray) -> bytes:
    """Document numbers as differences to the least of them, in as few bytes as hold all."""
    low = ids.min()
    width = 4 if int(ids.max()) - int(low) < 1 << 32 else 8
    return bytes([width]) + low.tobytes() + planes((ids - low).astype(f"u{width}"))


def unpacked(data: bytes, n: int) -> np.ndarray:
    return unplaned(data, np.dtype(f"u{data[0]}"), n, 9).astype(np.int64) + np.frombuffer(data, np.int64, 1, 1)[0]


def short_rows(home: int, round_: int, names: np.ndarray, multi: np.ndarray) -> list[tuple]:
    part = (names >> np.uint64(32)).astype(np.int64)
    return [(p, home, round_, p, planes(names[s].astype(np.uint32)), None, np.packbits(multi[s]).tobytes()) for p, s in by_part(part)]


def ask(bucket: Bucket, home: int, round_: int) -> pa.Table:
    """What a bucket sends in a round, and what it was told so far, which it sends to itself."""
    rows = [(-1 - home, home, r, part, bits, None, None) for r, got in bucket.bits.items() for part, bits in got.items()]
    if round_ == 1:
        names, multi, _ = bucket.anchors()
        return sent(rows + short_rows(home, 1, names, multi))
    if round_ == 3:
        names, multi, _ = bucket.left().short()
        return sent(rows + short_rows(home, 3, names, multi))
    named = bucket.runs(bucket.candidates()) if round_ == 2 else bucket.left().again()
    rows += [(p, home, round_, p, planes(named.high[s]) + planes(named.low[s]), packed(named.least[s]), None) for p, s in by_part(named.part)]
    return sent(rows)


def back(rows: list[dict], bits: list[bytes]) -> pa.Table:
    return pa.table({"bucket": pa.array([r["home"] for r in rows], pa.int64()), "round": pa.array([r["round"] for r in rows], pa.int32()), "part": pa.array([r["part"] for r in rows], pa.int32()), "bits": pa.array(bits, pa.binary())})


def answer(table: pa.Table) -> pa.Table:
    """One range's names from all buckets: a bit for each, whether a short name repeats or a name is
    in a smaller document of another bucket. What a bucket sent to itself goes back as it is."""
    rows = table.to_pylist()
    if rows[0]["to"] < 0:
        return back(rows, [r["names"] for r in rows])
    return back(rows, bits_of(rows))


def bits_of(rows: list[dict]) -> list[bytes]:
    short = rows[0]["flags"] is not None
    sizes = [len(r["names"]) // (4 if short else 12) for r in rows]
    each = list(zip(rows, sizes, strict=True))
    if short:
        name = np.concatenate([unplaned(r["names"], np.uint32, n) for r, n in each])
        multi = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=n) for r, n in each])
        _, of, many = np.unique(name, return_inverse=True, return_counts=True)
        bits = ((many > 1) | (np.bincount(of, multi) > 0))[of]
    else:
        high = np.concatenate([unplaned(r["names"], np.uint64, n) for r, n in each])
        low = np.concatenate([unplaned(r["names"], np.uint32, n, 8 * n) for r, n in each])
        doc = np.concatenate([unpacked(r["docs"], n) for r, n in each])
        order = np.lexsort((low, high))
        h, lo, d = high[order], low[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
        bits = np.empty(len(order), bool)
        bits[order] = d > np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
    out, at = [], 0
    for n in sizes:
        out.append(np.packbits(bits[at : at + n]).tobytes())
        at += n
    return out


def told(table: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for r in table.to_pylist():
        out.setdefault(r["round"], {})[r["part"]] = r["bits"]
    return out


def repeated_starts(bucket: Bucket) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every window of the bucket that occurs earlier."""
    whole, others = bucket.judged()
    place, of = spread_out(bucket.start[whole], (bucket.start + bucket.last - bucket.first)[whole])
    named = bucket.windows(others).again()
    hit = named.repeated(4)
    return np.concatenate([bucket.row[whole][of], named.row[hit]]), np.concatenate([place, named.start[hit]])


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n elements lie in a window that starts at one of the places."""
    if not len(starts):
        return np.zeros(n, bool)
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:n]) > 0


def without_repeats(docs: DataFrame, scheme: Scheme, finish: Callable[[bytes, np.ndarray], tuple], columns: dict[str, pa.DataType], bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, columns) of every row: what finish(text, removed elements) says of its whole text.

    See the module for how the rounds are laid out."""
    docs = picked(docs, "doc_id", "text")
    total = text_bytes(docs)
    buckets, parts = parts_of(total, bucket_bytes, LEAST_PARTS), parts_of(total, RANGE_BYTES, LEAST_PARTS)
    bucket_of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).alias("bucket")
    dealt = docs.select(bucket_of, F.col("doc_id").cast("long"), "text").groupBy("bucket")
    schema = pa.schema([("doc_id", pa.int64()), *columns.items()])

    def go_on(round_: int):
        def run(table: pa.Table, bits: pa.Table) -> pa.Table:
            return ask(Bucket(scheme, table, parts, told(bits)), table["bucket"][0].as_py(), round_)

        return run

    def end(table: pa.Table, bits: pa.Table) -> pa.Table:
        bucket = Bucket(scheme, table, parts, told(bits))
        row, place = repeated_starts(bucket)
        order = np.argsort(row, kind="stable")
        row, place = row[order], place[order]
        out = []
        for k, text in enumerate(bucket.texts):
            a, b = np.searchsorted(row, [k, k + 1])
            out.append((bucket.ids[k], *finish(text or b"", covered(bucket.sizes[k], place[a:b], scheme.window))))
        made = zip(*out, strict=True)
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(made, schema, strict=False)], schema=schema)

    begin = lambda table: ask(Bucket(scheme, table, parts, {}), table["bucket"][0].as_py(), 1)
    bits = dealt.applyInArrow(begin, _SENT).groupBy("to").applyInArrow(answer, _BACK)
    for round_ in (2, 3, 4) if scheme.sieve else (2, 4):
        asked = dealt.cogroup(bits.groupBy("bucket")).applyInArrow(go_on(round_), _SENT)
        bits = asked.groupBy("to").applyInArrow(answer, _BACK)
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return dealt.cogroup(bits.groupBy("bucket")).applyInArrow(end, ", ".join(f"{f.name} {names[f.type]}" for f in schema))
