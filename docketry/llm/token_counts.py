"""Token counts as a library's byte-level BPE gives them, huge texts in overlapping chunks.

A text of more than `chunk` characters is cut into chunks that overlap. Each is encoded by itself, with
offsets, wherever Spark puts it. Two neighbours are spliced at a border that is proven stable, that
is one from which on both must go on alike, whatever lies before:

- a place at which a split of the text ends in both. The split pattern looks ahead but never back, so
  from there on the splits are the same, and so are the tokens.
- a place inside a split at which in both a token with the same id ends. A row of tokens is the
  encoding of its text if every two neighbours are the encoding of theirs; all neighbours of the
  spliced row stand beside one another in one of the two encodings. The split has to start four or
  more characters before, so it is a run of one kind of character and not a contraction, and such a
  run ends at the same place in both.

Borders close to the end of the left chunk or the start of the right one do not count: a longer split
or an added token may be cut there. What a seam counts twice is taken off the sum. If a text has a
seam without such a border, for instance within a run of one sign whose tokens fall out of step, its
pieces are encoded one after the other, each starting at a border of the one before, and the overlap
is doubled until the two align or the text ends."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from docketry.llm.common import parts_of, picked
from docketry.session import cut_lineage

#: Characters of a chunk without its overlap, and of the overlap.
CHUNK, OVERLAP = 1 << 15, 512
#: The most that the split pattern looks ahead, and the longest contraction.
AHEAD = 4
#: Characters of texts that are encoded at once.
BATCH = 1 << 20
#: Fixed value: how the library's byte-level split cuts a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here (Latin, Greek, Cyrillic) all characters are of one kind in any version.
LAST_PLAIN = "\u04ff"
#: Distinct pieces that a task remembers; beyond it forgets all and goes on.
MOST_PIECES = 500_000
#: Bytes of chunks in one task.
TASK_BYTES = 8 << 20
_SHIFT = 20


def loaded(data: str) -> Tokenizer:
    """The tokenizer of a JSON text, on one thread: Spark runs as many tasks as there are cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_str(data)


def margin(data: str) -> int:
    """How close to a cut a border may lie; an error if the tokenizer is of a kind that is not covered."""
    given = json.loads(data)
    split, model = given.get("pre_tokenizer") or {}, given["model"]
    plain = not given.get("normalizer") and not given.get("truncation") and not given.get("padding")
    if not (plain and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")):
        raise ValueError("only byte-level BPE with its own split pattern and no normalizer is covered")
    added = [t["content"] for t in given.get("added_tokens") or []]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in given.get("added_tokens") or []):
        raise ValueError("added tokens that take in what is around them are not covered")
    for a in added:
        for b in added:
            if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"the added tokens {a!r} and {b!r} may overlap")
    return max([AHEAD, *map(len, added)]) + AHEAD


@dataclass
class Piece:
    """The encoding of text[start:stop]. at: places at which a token ends and the next one starts,
    in order, as indices of tokens; end: their places in the text; mark: what has to agree."""

    start: int
    stop: int
    n: int
    at: np.ndarray
    end: np.ndarray
    mark: np.ndarray

    @classmethod
    def of(cls, tokenizer: Tokenizer, text: str, start: int) -> "Piece":
        encoded = tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(encoded.ids, np.int64)
        if not len(ids):
            return cls(start, start + len(text), 0, *[np.empty(0, np.int64)] * 3)
        offsets = np.array(encoded.offsets, np.int64)
        split = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
        begin, end = offsets[:, 0], offsets[:, 1]
        first = np.r_[True, split[1:] != split[:-1]]
        opened = begin[np.flatnonzero(first)][np.cumsum(first) - 1]
        over = np.r_[split[1:] != split[:-1], True]
        # a character may be spread over tokens; places inside one are no borders
        fits = np.r_[begin[1:] >= end[:-1], True] & (over | (end - opened >= AHEAD))
        at = np.flatnonzero(fits)
        mark = (end[at] + start << _SHIFT) + np.where(over[at], 0, ids[at] + 1)
        return cls(start, start + len(text), len(ids), at, end[at] + start, mark)

    def between(self, low: int, high: int) -> slice:
        return slice(*np.searchsorted(self.end, [low, high + 1]))


def spliced(left: Piece, right: Piece, near: int) -> tuple[int, int, int] | None:
    """The first common border: its mark, and how many tokens of either piece lie before it."""
    low, high = right.start + near, left.stop - near
    a, b = left.between(low, high), right.between(low, high)
    _, x, y = np.intersect1d(left.mark[a], right.mark[b], assume_unique=True, return_indices=True)
    if not len(x):
        return None
    return int(left.mark[a][x[0]]), int(left.at[a][x[0]]) + 1, int(right.at[b][y[0]]) + 1


def in_steps(tokenizer: Tokenizer, text: str, near: int, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text whose pieces are encoded one after the other.

    Not more than two pieces are held; the overlap is doubled wherever two do not align."""
    piece = lambda start, size: Piece.of(tokenizer, text[start : start + size], start)
    wide, size = overlap, chunk + overlap
    left, total, before, mark = piece(0, size), 0, 0, None
    while left.stop < len(text):
        # the next piece starts at a border of this one, so runs of one sign stay in step
        fit = left.end[left.between(left.start + 1, left.stop - wide)]
        start = int(fit[-1]) if len(fit) else left.stop - wide
        right = piece(start, max(size, 2 * wide))
        seam = spliced(left, right, near)
        if seam:
            mark, end, begin = seam
            total += end - before
            left, before, wide = right, begin, overlap
            continue
        wide *= 2
        left = piece(left.start, max(left.stop - left.start, chunk) + wide)
        if mark is not None:
            here = np.flatnonzero(left.mark == mark)
            if not len(here):  # not seen; then nothing is taken over
                return len(tokenizer.encode(text, add_special_tokens=False))
            before = int(left.at[here[0]]) + 1
    return total + left.n - before


class Counter:
    """Numbers of tokens of whole texts.

    The split pattern cuts a text into pieces that are encoded by themselves, so a piece has the same
    number of tokens wherever it stands. The library encodes each distinct piece of a task once. A text
    with an added token, or with characters on whose kind two versions of Unicode may differ, is
    encoded by the library as it is."""

    def __init__(self, data: str):
        self.tokenizer, self.known = loaded(data), {}
        added = [regex.escape(t["content"]) for t in json.loads(data).get("added_tokens") or []]
        self.odd = regex.compile("|".join([f"[^\\x00-{LAST_PLAIN}]", *added]))
        self.split = regex.compile(SPLIT).findall

    def of(self, texts: list[str]) -> list[int]:
        whole = [k for k, t in enumerate(texts) if self.odd.search(t)]
        pieces = [self.split(t) for t in texts] if not whole else [[] if self.odd.search(t) else self.split(t) for t in texts]
        if len(self.known) > MOST_PIECES:
            self.known.clear()
        self.learn(set().union(*pieces) - self.known.keys())
        many = [sum(map(self.known.__getitem__, p)) for p in pieces]
        for k, n in zip(whole, self.encoded([texts[k] for k in whole]), strict=True):
            many[k] = n
        return many

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: set[str]) -> None:
        """Words after a blank are encoded in a row, which the pattern cuts into just these words."""
        words = [w for w in new if len(w) > 1 and w[0] == " " and w[1].isalpha()]
        rest = list(new.difference(words))
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            many = np.bincount(np.array(self.tokenizer.encode("".join(some), add_special_tokens=False).word_ids, np.int64), minlength=len(some))
            if len(many) == len(some):
                self.known.update(zip(some, many.tolist(), strict=True))
            else:
                rest += some
        self.known.update(zip(rest, self.encoded(rest), strict=True))


def short_counts(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of rows with short texts."""

    def run(batches):
        counter = Counter(shared.value)
        for b in batches:
            texts, at = b.column(2).to_pylist(), 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to]) <= BATCH):
                    held += len(texts[to])
                    to += 1
                yield pa.RecordBatch.from_arrays([*b.slice(at, to - at).columns[:2], pa.array(counter.of(texts[at:to]), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
                at = to

    return docs.select("doc_id", "n_bytes", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, last, text) of every chunk of texts (key, text)."""

    def run(batches):
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                for k in range(0, len(starts), 32):
                    some = starts[k : k + 32]
                    cut = [text[s : s + chunk + overlap] for s in some]
                    last = [s == starts[-1] for s in some]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(cut)), pa.array(range(k, k + len(cut)), pa.int64()), pa.array(last), pa.array(cut)], ["key", "k", "last", "text"])

    return texts.mapInArrow(run, "key string, k long, last boolean, text string")


def sides(cut: DataFrame, shared, near: int, chunk: int, overlap: int) -> DataFrame:
    """(key, seam, side, n, marks, extra): of each chunk what the seams on its two sides need.

    Side 0 is the chunk before the seam, with its number of tokens; extra are its tokens after each
    mark. Side 1 is the chunk behind; extra are its tokens before each mark."""

    def run(batches):
        tokenizer = loaded(shared.value)
        for b in batches:
            for key, k, last, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                piece, begin = Piece.of(tokenizer, text, k * chunk), k * chunk
                seam = begin + chunk
                tail = slice(0, 0) if last else piece.between(seam + near, seam + overlap - near)
                rows = [(key, k, 0, piece.n, piece.mark[tail], piece.n - 1 - piece.at[tail])]
                if k:
                    head = piece.between(begin + near, begin + overlap - near)
                    rows.append((key, k - 1, 1, 0, piece.mark[head], piece.at[head] + 1))
                columns = zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 2], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in columns], ["key", "seam", "side", "n", "marks", "extra"])

    return cut.mapInArrow(run, "key string, seam long, side int, n long, marks array<long>, extra array<long>")


def long_counts(rows: DataFrame, shared, near: int, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens, open) of every key of rows (key, text); open says that a seam has no border."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    cut = chunks(rows, chunk, overlap).repartition(parts_of(size, TASK_BYTES, 16), "key", "k")
    left, right = (lambda c: F.first(F.when(F.col("side") == 0, F.col(c)), True)), (lambda c: F.first(F.when(F.col("side") == 1, F.col(c)), True))
    seams = sides(cut, shared, near, chunk, overlap).groupBy("key", "seam").agg(left("n").alias("n"), left("marks").alias("l"), left("extra").alias("after"), right("marks").alias("r"), right("extra").alias("before"))
    border = F.get(F.array_intersect("l", "r"), F.lit(0))
    twice = F.element_at(F.map_from_arrays("l", "after"), F.col("border")) + F.element_at(F.map_from_arrays("r", "before"), F.col("border"))
    return seams.withColumn("border", border).groupBy("key").agg(
        (F.sum("n") - F.sum(F.coalesce(twice, F.lit(0)))).alias("n_tokens"),
        F.bool_or(F.col("r").isNotNull() & F.col("border").isNull()).alias("open"),
    )


def stepped(rows: DataFrame, shared, near: int, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of rows (key, text), each text piece by piece."""

    def run(batches):
        tokenizer = loaded(shared.value)
        for b in batches:
            many = [in_steps(tokenizer, text.as_py(), near, chunk, overlap) for text in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(many, pa.int64())], ["key", "n_tokens"])

    return rows.mapInArrow(run, "key string, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs (doc_id, text).

    tokenizer is the JSON text of a byte-level BPE of the `tokenizers` library, which is broadcast. No
    special tokens are added; strings of added tokens inside a text count as those tokens, as is the
    library's default. A null text is empty and has no tokens, a null doc_id stays null, repeated
    rows stay repeated, no rows give no rows, and other columns are not read. over_limit says that
    there are more than `limit` tokens. Texts with more characters than `chunk` are encoded in chunks
    by tasks of about 8 MB; equal long texts share a name, so they get one count."""
    near = margin(tokenizer)
    if overlap < 4 * near or chunk < 2 * overlap:
        raise ValueError(f"the overlap must be {4 * near} characters at least and half a chunk at most")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    text = F.coalesce(F.col("text"), F.lit(""))
    given = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    huge = F.length("text") > chunk + overlap
    long = given.where(huge).withColumn("key", F.sha2("text", 256))
    found = cut_lineage(long_counts(long.select("key", "text"), shared, near, chunk, overlap))
    apart = found.where("open").select("key")
    known = found.where("not open").select("key", "n_tokens")
    if not apart.isEmpty():
        known = known.unionAll(stepped(long.join(apart, "key", "left_semi").dropDuplicates(["key"]).select("key", "text"), shared, near, chunk, overlap))
    rows = short_counts(given.where(~huge), shared).unionAll(long.select("doc_id", "n_bytes", "key").join(known, "key").select("doc_id", "n_bytes", "n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
