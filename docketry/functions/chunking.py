"""Splitting of text into overlapping pieces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.rows import bind, exploded
from docketry.functions.text import words

# Separators tried in this order, the empty one cuts anywhere.
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", " ", "")
# Kinds of source that are split; the rest pass whole.
SPLIT_KINDS = ("text", "html", "mp3", "docx")
#: Characters whose pieces by a user's tokenizer are held at once.
CUT_CHARS = 1 << 19


def window_starts(n: Column, size: int, overlap: int) -> Column:
    """Start offsets of token windows; no window lies inside the one before it."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the window size")
    last = F.greatest(n - overlap - 1, F.lit(0))
    return F.when(n > 0, F.sequence(F.lit(0), last, F.lit(size - overlap))).otherwise(
        F.array().cast("array<int>")
    )


def _windows(tok: Column, size: int, overlap: int) -> Column:
    """Token windows as an array of struct<chunk_text,n_tokens>."""

    def window(start: Column) -> Column:
        part = F.slice(tok, start + 1, size)
        return F.struct(F.array_join(part, " ").alias("chunk_text"), F.size(part).alias("n_tokens"))

    return F.transform(window_starts(F.size(tok), size, overlap), window)


def _window_rows(df: DataFrame, tok: Column, windows: Column) -> DataFrame:
    # windows are cut before they become rows, so no row carries the whole token list
    cut = df.withColumn("window_tokens", tok).withColumn("windows", windows).drop("window_tokens")
    return exploded(cut, "windows", "window", "chunk_no").select(*df.columns, "chunk_no", "window.*")


def split_tokens(
    df: DataFrame, text: str = "text", size: int = 1024, overlap: int = 150, tokenize=words
) -> DataFrame:
    """One row per token window: adds chunk_no, chunk_text, n_tokens."""
    return _window_rows(df, tokenize(F.col(text)), _windows(F.col("window_tokens"), size, overlap))


def word_pieces(text: Column) -> Column:
    """A text cut before each word but the first, so that the pieces joined give it back; none if it has
    no word."""
    return F.regexp_extract_all(text, F.lit(r"(?:^\s+)?\S+\s*"), F.lit(0))


def pieces_by(cut: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """Pieces by a tokenizer of the user's, in Arrow batches: `cut` gives for each text the list of its
    pieces, which joined have to give the text back. Null texts have none.

    Pieces take many times the room of their text, so those of CUT_CHARS characters, or of one longer
    text, are held at once, however many rows a batch has."""

    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield from (_cut(some, cut) for some in _of_size(texts))

    return F.pandas_udf(pieces, "array<string>")


def _of_size(texts: pd.Series) -> Iterator[pd.Series]:
    """A series in stretches of CUT_CHARS characters, or of one text with more."""
    lo = held = 0
    for k, text in enumerate(texts):
        size = 0 if text is None else len(text)
        if k > lo and held + size > CUT_CHARS:
            yield texts.iloc[lo:k]
            lo, held = k, 0
        held += size
    yield texts.iloc[lo:]


def _cut(texts: pd.Series, cut: Callable[[pd.Series], pd.Series]) -> pd.Series:
    given = texts[texts.notna()]
    found = dict(zip(given.index, cut(given), strict=True)) if len(given) else {}
    for k, t in given.items():
        if "".join(found[k]) != t:
            raise ValueError(f"the pieces do not give the text back: {t[:80]!r}")
    return pd.Series([list(found[k]) if k in found else None for k in texts.index], index=texts.index, dtype=object)


def split_offsets(
    df: DataFrame, text: str = "text", size: int = 1024, overlap: int = 150, pieces=word_pieces
) -> DataFrame:
    """One row per window of `size` tokens: adds chunk_no, start, stop, chunk_text, n_tokens.

    A window is the slice start..stop (code points, end exclusive) of the text, with its blanks and
    line breaks; windows less their overlaps give the text back. `pieces` is a column function that
    cuts a text into its tokens, see `word_pieces` and `pieces_by`. Texts without tokens give no row."""
    found, step = F.col("window_pieces"), size - overlap
    starts = window_starts(F.size(found), size, overlap)

    def windows(steps: Column) -> Column:
        def window(start: Column, number: Column) -> Column:
            part = F.slice(found, start + 1, size)
            return F.struct(
                F.array_join(part, "").alias("chunk_text"), F.size(part).alias("n_tokens"),
                F.aggregate(F.slice(steps, 1, number), F.lit(0), lambda a, x: a + x).alias("start"),
            )

        return F.transform(starts, window)

    # a column of the steps would be put into the windows' own function, and computed again for each window
    steps = F.transform(starts, lambda at: F.length(F.array_join(F.slice(found, at + 1, step), "")))
    cut = df.withColumn("window_pieces", pieces(F.col(text))).withColumn("windows", bind(steps, windows)).drop("window_pieces")
    rows = exploded(cut, "windows", "window", "chunk_no")
    stop = F.col("window.start") + F.length("window.chunk_text")
    return rows.select(*df.columns, "chunk_no", "window.start", stop.alias("stop"), "window.chunk_text", "window.n_tokens")


def split_by_kind(
    df: DataFrame, kind: str, text: str = "text", size: int = 1024, overlap: int = 150,
    split_pdf: bool = False, tokenize=words,
) -> DataFrame:
    """Split the kinds that are split, pass the others as one chunk each."""
    kinds = [*SPLIT_KINDS, "pdf"] if split_pdf else list(SPLIT_KINDS)
    is_split = F.coalesce(F.col(kind).isin(kinds), F.lit(False))
    tok = F.col("window_tokens")
    whole = F.array(F.struct(F.col(text).alias("chunk_text"), F.size(tok).alias("n_tokens")))
    windows = F.when(is_split, _windows(tok, size, overlap)).when(F.col(text) != "", whole)
    return _window_rows(df, tokenize(F.col(text)), windows)


def split_separators(text: str, limit: int, overlap: int, separators=SEPARATORS) -> list[str]:
    """Pieces of at most `limit` characters, cut at the coarsest separator that fits.

    Separators stay at the head of the part that follows them, so joining the
    parts gives the text back; up to `overlap` characters of whole parts are
    carried from one piece into the next.
    """
    if len(text) <= limit:
        return [text.strip()] if text.strip() else []
    sep = next(s for s in separators if s == "" or s in text)
    finer = separators[separators.index(sep) + 1 :]
    if sep == "":
        last = max(len(text) - overlap, 1)
        return [text[at : at + limit] for at in range(0, last, limit - overlap)]
    parts = [p for p in re.split(f"(?={re.escape(sep)})", text) if p]
    pieces: list[str] = []
    held: list[str] = []
    held_len = 0

    def flush() -> None:
        piece = "".join(held).strip()
        if piece:
            pieces.append(piece)

    for part in parts:
        if len(part) > limit:
            if held:
                flush()
                held, held_len = [], 0
            pieces.extend(split_separators(part, limit, overlap, finer))
            continue
        if held_len + len(part) > limit:
            flush()
            while held and (held_len > overlap or held_len + len(part) > limit):
                held_len -= len(held.pop(0))
        held.append(part)
        held_len += len(part)
    flush()
    return pieces


def split_long_text(
    df: DataFrame, text: str = "text", limit: int = 50_000, overlap: int = 200
) -> DataFrame:
    """One row per piece of each text: adds piece_no, piece.

    Only texts over the limit reach Python; the others are sent as null and pass as they are.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")

    @F.pandas_udf("array<string>")
    def pieces(col: pd.Series) -> pd.Series:
        return col.map(lambda t: None if t is None else split_separators(t, limit, overlap))

    long = pieces(F.when(F.length(text) > limit, F.col(text)))
    whole = F.when(F.col(text) != "", F.array(text))
    cut = df.withColumn("pieces", long).withColumn("pieces", F.coalesce("pieces", whole))
    return exploded(cut, "pieces", "piece", "piece_no").drop("pieces")
