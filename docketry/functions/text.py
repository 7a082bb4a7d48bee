"""Column functions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.rows import bind

# Model replies that mean "no filter".
NO_FILTER_PREFIXES = ("NO_FILTER", "UNSUPPORTED")
# Roles a message may have.
ROLES = ("user", "assistant", "system")
# File kinds whose extension is not added to a truth name.
DOCUMENT_SUFFIXES = (".pdf", ".txt")


def trim_all(text: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension; a leading dot is not one."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.](\.[^.]*)$", 1))


def strip_think(text: Column) -> Column:
    """Remove closed think spans, then an unclosed one up to the end."""
    closed = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    return F.regexp_replace(closed, r"(?s)<think>.*", "")


def collapse_blank_lines(text: Column) -> Column:
    return trim_all(F.regexp_replace(text, r"\n\s*\n", "\n"))


def filter_reply(text: Column) -> Column:
    """A model's filter reply, or null where it declines or says nothing."""

    def accepted(cleaned: Column) -> Column:
        declined = F.lit(False)
        for prefix in NO_FILTER_PREFIXES:
            declined = declined | F.upper(cleaned).startswith(prefix)
        return F.when(~declined & (cleaned != ""), cleaned)

    return bind(collapse_blank_lines(strip_think(trim_all(text))), accepted)


def numbered_items(text: Column) -> Column:
    """Array of items of a numbered list: lines holding a digit, after the first ". "."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit("[0-9]")))
    return F.transform(
        F.transform(lines, trim_all),
        lambda x: F.when(
            F.contains(x, F.lit(". ")), F.regexp_replace(x, r"(?s)^.*?\. ", "")
        ).otherwise(x),
    )


def follow_up(text: Column) -> Column:
    """A follow-up question without quotes; null if nothing is left."""
    return F.nullif(F.translate(trim_all(text), "'\"", ""), F.lit(""))


def escape_braces(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("{"), F.lit("{{")), F.lit("}"), F.lit("}}"))


def strip_html(text: Column) -> Column:
    """Remove comments and tags, keep the text between them."""
    return F.regexp_replace(text, r"(?s)<!--.*?-->|<[^>]*>", "")


def role_name(role: Column) -> Column:
    """Lower-cased role without tags; null for a role that is not allowed."""
    cleaned = F.lower(strip_html(role))
    return F.when(cleaned.isin(*ROLES), cleaned)


def preview(text: Column, limit: int = 500) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("... [content truncated]"))
    ).otherwise(text)


def score_reply(text: Column) -> Column:
    """Grade in a judge's reply: the highest of 2, 1, 0 it contains, 0 if none."""
    return (
        F.when(F.contains(text, F.lit("2")), 2).when(F.contains(text, F.lit("1")), 1).otherwise(0)
    )


def tokens(text: Column) -> Column:
    """Lower-cased words: runs of letters and digits."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda t: t != "")


def words(text: Column) -> Column:
    """White-space separated words, case kept."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def element_key(collection: Column, file_name: Column, page: Column, location: Column) -> Column:
    """Key of a stored picture: collection, file, page and the box to four places, in decimals."""
    plain = lambda x: F.regexp_replace(F.round(x, 4).cast("decimal(38,4)").cast("string"), r"(\.\d+?)0+$", "$1")
    box = F.array_join(F.transform(location, plain), "_")
    return F.concat(
        collection, F.lit("_::_"), file_name, F.lit("_::_"), page.cast("string"), F.lit("_"), box
    )
