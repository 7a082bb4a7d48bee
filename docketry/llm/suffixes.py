"""Removal of byte strings that an earlier document has, by distributed prefix doubling.

The rank of a position by its first 2h bytes is the rank of the pair (rank by h bytes here, rank by
h bytes at h further on). Names, equal for equal strings only, take the place of ranks: which of two
strings is smaller never matters here, whether they are equal does. Names of 1, 2, 4, 8 and 16 bytes
come from the text alone. At the next offset, 24 bytes, one position of every window of 50 bytes
(the least name in it) is sorted over all documents, and positions with a unique name drop out. Then
come pairs of the names of two overlapping windows, and at last pairs of 25 bytes and 25 bytes, which
are the threshold. At each offset Spark deals the pairs out by ranges of names; a range is sorted and
what is unique drops out.

Names of the sorted pairs have 96 bits: 64 from the pair and 32 from the window's bytes themselves,
so two of a million million different windows share one with a chance of 1 in 100,000, also if they
have a half in common."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docketry.llm.repeats import PLACE, PLACE_BITS, Batch, Scheme, doubled, eights, fold, least_of, pair_name, without_repeats

_BYTES = pair_name(np.arange(1, 257, dtype=np.uint64), np.arange(257, 513, dtype=np.uint64))


#: Bytes of an anchor.
ANCHOR = 24


class HalfNames(Batch):
    """Windows named by their halves; a half's name is that of two strings of 16 bytes in it."""

    def part(self, at: np.ndarray) -> np.ndarray:
        return pair_name(self.base[at], self.base[at + self.second - 16])

    def check(self, at: np.ndarray) -> np.ndarray:
        return fold(self.elements, at, [*range(0, self.size - 7, 8), self.size - 8])


def runs_of(pieces: list, anchor: np.ndarray, window: int):
    """First and last place, row and start of the runs of windows with one anchor in one piece."""
    size = np.array([len(p[2]) for p in pieces])
    base = np.cumsum(size) - size
    many = np.array([p[3] for p in pieces])
    inside = np.zeros(len(anchor), bool)
    piece = np.repeat(np.arange(len(pieces)), size)[: len(anchor)]
    for b, m in zip(base, many, strict=True):
        inside[b : b + m] = True
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    edge = np.flatnonzero(new | np.r_[False, inside[1:] != inside[:-1]])
    first, last = edge, np.r_[edge[1:], len(anchor)] - 1
    keep = inside[first] if len(first) else np.empty(0, bool)
    first, last = first[keep], last[keep]
    of = piece[first]
    row, at = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    return first, last, row[of], at[of] + first - base[of]


def byte_scheme(window: int) -> Scheme:
    """Windows of `window` bytes, 32 to 64; their anchors are strings of 24 bytes."""
    if not 32 <= window <= 64 or window % 2:
        raise ValueError("the window must be an even number of 32 to 64 bytes")

    def batch(pieces: list) -> Batch:
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sixteen = doubled(_BYTES[data], 4)
        anchors = pair_name(sixteen[: 16 - ANCHOR], sixteen[ANCHOR - 16 :])
        place = np.arange(len(anchors), dtype=np.uint64)
        place |= anchors >> PLACE_BITS << PLACE_BITS
        anchor = (least_of(place, window - ANCHOR + 1) & PLACE).astype(np.int64)
        first, last, row, start = runs_of(pieces, anchor, window)
        return HalfNames(sixteen, window // 2, eights(data), window, first, last, anchor[first], anchors[anchor[first]], row, start)

    return Scheme(window, 1 << 16, False, True, lambda text: text, batch)


def finish(text: bytes, gone: np.ndarray) -> tuple[int, int, int, str, bytes]:
    """Digests and text of what stays."""
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
    return len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept


def without_earlier_bytes(docs: DataFrame, window: int = 50, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of docs (doc_id, text).

    Removed is each byte that a string of `window` bytes covers which also starts in a document with
    a smaller doc_id, judged on the texts as given. kept are the remaining bytes, which may cut a
    character. A null text is empty; a null doc_id counts as larger than all others; rows with equal
    doc_id are not smaller than one another, so repeated rows get equal results. No rows give no
    rows; other columns are not read. Texts are processed whole, long ones in overlapping pieces.
    Without `texts` the column kept is left out."""
    columns = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary()}
    return without_repeats(docs, byte_scheme(window), finish, columns if texts else dict(list(columns.items())[:-1]))
