"""Byte-level BPE encoding and decoding by a file of ranks.

Each match of the split pattern is encoded by itself: its bytes are folded, always joining the
adjacent parts whose union has the lowest rank, until no union has one. A task does so once per
distinct word and keeps the ids; a word that is a token is looked up whole. Decoding concatenates
the bytes of the ids."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from docketry.llm.common import picked

#: Words that a task remembers; beyond it forgets all and goes on.
MOST_WORDS = 400_000
#: The most ranks that are broadcast.
MOST_RANKS = 1_000_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank per line, read by Spark."""
    rows = spark.read.text(path if "://" in path else f"file://{path}").where("value != ''").limit(MOST_RANKS + 1).collect()
    if len(rows) > MOST_RANKS:
        raise ValueError(f"over {MOST_RANKS} ranks in {path}")
    split = (r["value"].split() for r in rows)
    return {base64.b64decode(a): int(b) for a, b in split}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: ranked merges over its bytes, the leftmost of equal ranks first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = [ranks.get(word[i : i + 2], MOST_RANKS) for i in range(len(word) - 1)]
    while rank:
        best = min(rank)
        if best == MOST_RANKS:
            break
        i = rank.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del rank[i]
        if i:
            rank[i - 1] = ranks.get(parts[i - 1] + parts[i], MOST_RANKS)
        if i < len(rank):
            rank[i] = ranks.get(parts[i] + parts[i + 1], MOST_RANKS)
    return [ranks[p] for p in parts]


#: Above this many bytes a word is folded with a heap of its pairs, with the same result.
LONG = 256


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As `fold`, in time that grows little faster than the word."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            r = ranks.get(word[i : end[end[i]]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[i], end[end[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not (alive[i] and end[i] == j and j < n and alive[j] and end[j] == k):
            continue
        alive[j], end[i] = False, k
        if k < n:
            before[k] = i
        offer(i)
        offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts in a task, remembering the ids of distinct words as packed arrays."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find, self.known = ranks, regex.compile(pattern).findall, {}

    def word(self, word: str) -> array:
        data = word.encode("utf-8", "replace")
        ids = array("i", (fold_long if len(data) > LONG else fold)(data, self.ranks))
        if len(data) <= LONG:
            if len(self.known) >= MOST_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def ids(self, text: str | None) -> array:
        known, out = self.known, array("i")
        for w in self.find(text or ""):
            got = known.get(w)
            out.extend(self.word(w) if got is None else got)
        return out

    def count(self, text: str) -> int:
        return len(self.ids(text))


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = {i: b for b, i in ranks.items()}

    def data(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def with_tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of docs (doc_id, text): the token ids of its whole text.

    A null or empty text has no ids. Repeated rows stay repeated, no rows give no rows, a null doc_id
    stays null, other columns are not read. The ranks, bounded in number, are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))

    def run(batches):
        encode = Encoder(shared.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                ids = [encode.ids(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), lists(ids)], ["doc_id", "ids"])

    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str, data: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, data) of rows (doc_id, ids).

    data are the bytes of the ids one after the other, left out without `data`; null ids count as
    none. An id that the ranks do not have is an error."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(rows.sparkSession, path))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["data"] * data]

    def run(batches):
        decode = Decoder(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                ids = [x or [] for x in part.column(1).to_pylist()]
                got = [decode.data(x) for x in ids]
                text = [",".join(map(str, x)).encode() for x in ids]
                sha = [pa.array([hashlib.sha256(x).hexdigest() for x in some], pa.string()) for some in (text, got)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, ids), pa.int64()), *sha, *[pa.array(got, pa.binary())] * data], names)

    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", data binary" * data
    return picked(rows, "doc_id", "ids").select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, columns)


def encoded_and_decoded(docs: DataFrame, path: str, pattern: str, ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row of docs, in one pass; without
    `ids` that column is left out. Rows are treated as in `with_tokens`."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))

    def run(batches):
        encode, decode = Encoder(shared.value, pattern), Decoder(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                got = [encode.ids(x) for x in part.column(1).to_pylist()]
                text = [",".join(map(str, x)).encode() for x in got]
                sha = [pa.array([hashlib.sha256(x).hexdigest() for x in some], pa.string()) for some in (text, map(decode.data, got))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, got), pa.int64()), *sha, *[lists(got)] * ids], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, columns)


def lists(ids: list[array]) -> pa.ListArray:
    flat = np.concatenate([np.frombuffer(x, np.int32) for x in ids])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(flat))
