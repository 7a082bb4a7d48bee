"""Secrets in texts: fixed forms, and strings that a tokenizer finds hard.

The fixed forms are assignments to names such as password or token, access keys, and long hex
strings. The token-efficiency test then takes every other run of key characters: words of any
language a vocabulary covers come in few tokens, random strings in many, so a run with few
characters per token is reported, whether it has digits or not. Runs that are known to be harmless
are left out: digests (hex of the usual lengths), UUIDs, numbers, and identifiers, which are words
joined by signs or capitals, unless they have as few characters per token as random ones.

Random strings found, of 1,000 each of 16, 24, 32 and 64 characters: letters of both cases 98, 99, 100 and
100 %, with digits 100 %, the signs of base64 100 %, small letters with digits 99 to 100 %. Letters of one case look
like a word, so these are measured from 20 characters on and against a lower ratio: capitals 99 % or more,
small letters 89 % at 20, 77 % at 24, 90 % at 32, 94 % at 64. Runs of under 16 characters are not measured."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import by_place, picked
from docketry.llm.tokens import Encoder, read_ranks

#: The kinds in order, their patterns, and the least length of what is measured.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile("|".join(rf"(?:[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}})" for n in DIGEST_LENGTHS))
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Parts of a run: a word in lower case or with one capital, capitals, digits, signs.
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[-_/+=]+")
NUMBER = re.compile(r"[0-9]{3,}|[a-z][0-9]|[0-9][a-z]", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Runs with fewer characters per token are random. Random base64 has about 1.1 to 1.4, letters of both
#: cases 1.1 to 1.6, words of most languages over 2.
RATIO = 1.9
#: What an identifier needs at least; what a word of one case may have at most, and its least length.
IDENTIFIER_RATIO, WORD_RATIO, WORD_LENGTH = 1.5, 1.7, 20


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed forms as (start, end, kind), in order."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found, key=in_order)


def in_order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def identifier(run: str) -> bool:
    """Joined words of two letters or more and numbers, with no long number and no digit in a word.

    The parts are read once from left to right, so the time is linear in the run."""
    return not NUMBER.search(run) and all(len(p) > 2 or len(p) == 2 and (p.isupper() or p.islower()) or not p[-1].isalpha() for p in PART.findall(run))


def harmless(run: str) -> bool:
    """A known digest, a UUID, a number, or few different characters."""
    core = run.strip("=-_/+")
    return bool(DIGEST.fullmatch(core) or UUID.fullmatch(core) or len(set(core)) < 8 or not any(map(str.isalpha, core)))


def is_random(run: str, tokens: int, ratio: float) -> bool:
    """Whether a run has so few characters per token that it is no word, identifier or known form."""
    if len(run) >= ratio * tokens or harmless(run):
        return False
    if WORD.fullmatch(run):
        return len(run) >= WORD_LENGTH and len(run) < WORD_RATIO * tokens
    return len(run) < IDENTIFIER_RATIO * tokens or not identifier(run)


def random_spans(text: str, encode: Encoder, ratio: float) -> list[tuple[int, int, str]]:
    """Runs of key characters that have few characters per token."""
    return [(m.start(), m.end(), "random") for m in RUN.finditer(text) if is_random(m.group(), encode.count(m.group()), ratio)]


def all_spans(text: str | None, encode: Encoder, ratio: float = RATIO) -> list[tuple[int, int, str]]:
    """Spans of the fixed forms and, apart from those, of the token-efficiency test."""
    text = text or ""
    found = base_spans(text)
    starts, ends = [], []  # of the stretches that fixed forms cover
    for a, b, _ in found:
        if starts and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for span in random_spans(text, encode, ratio):
        k = bisect_left(starts, span[1]) - 1  # the last that starts before the span ends
        if k < 0 or ends[k] <= span[0]:
            found.append(span)
    return sorted(found, key=in_order)


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def masked(text: str | None, spans: list[tuple[int, int, str]], mask: str) -> str | None:
    """The text with each stretch of overlapping spans replaced."""
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def found_secrets(docs: DataFrame, path: str, pattern: str, ratio: float = RATIO, mask: str | None = "<secret>") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans, masked) of every row of docs.

    spans are kind:start:end by start and kind, in code points, end exclusive; base_sha256 is of the
    spans of the fixed forms alone. A run of the token test that overlaps a fixed form is not
    reported again. masked is the text with its spans replaced, null without a mask. A null text has no spans and stays
    null, a null doc_id stays null, repeated rows stay repeated, no rows give no rows, and other
    columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))

    def run(batches):
        encode = Encoder(shared.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                spans = [all_spans(x, encode, ratio) for x in texts]
                base = [[s for s in x if s[2] != "random"] for x in spans]
                many = [pa.array([sum(s[2] == kind for s in x) for x in spans], pa.int64()) for kind in KINDS]
                sha = pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in base])
                new = pa.array([mask and masked(x, s, mask) for x, s in zip(texts, spans, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *many, sha, pa.array(map(written, spans), pa.string()), new], names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked"]
    columns = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, masked string"
    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, columns)


def with_masked(docs: DataFrame, path: str, pattern: str, ratio: float = RATIO, mask: str = "<secret>") -> DataFrame:
    """All columns of docs, with secrets in text replaced and n_chars, if there, the new length.

    Rows without secrets stay as they are, a null text and its n_chars too. Of repeated column names
    other than text and n_chars nothing is assumed."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))
    names, placed = docs.columns, by_place(docs)
    placed_names = placed.columns

    def run(batches):
        encode = Encoder(shared.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                old = part.column(names.index("text")).to_pylist()
                new = [masked(x, all_spans(x, encode, ratio), mask) for x in old]
                columns = list(part.columns)
                columns[names.index("text")] = pa.array(new, pa.string())
                if "n_chars" in names:
                    many = part.column(names.index("n_chars"))
                    sizes = [n if x == y else len(y) for n, x, y in zip(many.to_pylist(), old, new, strict=True)]
                    columns[names.index("n_chars")] = pa.array(sizes, many.type)
                yield pa.RecordBatch.from_arrays(columns, placed_names)

    return placed.mapInArrow(run, placed.schema).toDF(*names)
