"""Column functions on text.  Lengths and positions are in code points."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from commitloom import fixed_values as fv


def _ranges(ranges: Iterable[tuple[int, int]]) -> str:
    """Inside of a character class; ranges that follow on each other become one."""
    merged: list[list[int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    return "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in merged)


# Runs of code points that a normalisation form leaves alone count from this many on.
SHORTEST_RUN = 16

_WHITESPACE = "".join(map(chr, fv.WHITESPACE_CODE_POINTS))
_WHITESPACE_CLASS = _ranges((point, point) for point in fv.WHITESPACE_CODE_POINTS)
# Runs to collapse: all but a lone plain space, which would only be replaced by
# itself.  Visible ASCII is ruled out first, as that is nearly all there is.
_WHITESPACE_RUN = (
    rf"(?![\x21-\x7E])(?: [{_WHITESPACE_CLASS}]+|[{_WHITESPACE_CLASS}&&[^ ]][{_WHITESPACE_CLASS}]*)"
)


def py_strip(text: Column) -> Column:
    """Strip Unicode whitespace from both ends (plain ``trim`` only knows U+0020)."""
    return F.btrim(text, F.lit(_WHITESPACE))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def subject_line(message: Column) -> Column:
    """First line of the stripped message, stripped itself."""
    return py_strip(first_line(F.ltrim(message, F.lit(_WHITESPACE))))


def message_head(message: Column) -> Column:
    """The start of a message that history, subject and noise rule look at.

    It ends with the first character after the first line that is not blank, so
    that what follows the subject is still seen to follow it.
    """
    head = rf"^[{_WHITESPACE_CLASS}]*[^\n]*(?:\n[{_WHITESPACE_CLASS}]*[^{_WHITESPACE_CLASS}])?"
    return F.regexp_extract(message, head, 0)


def truncate_marked(text: Column, size: int) -> Column:
    """Cut to ``size`` code points and say so; shorter text is unchanged."""
    cut = F.concat(F.substring(text, 1, size), F.lit(fv.TRUNCATION_MARKER))
    return F.when(F.length(text) > size, cut).otherwise(text)


def unicode_pattern(pattern: str, ignore_case: bool = False) -> str:
    """Java form of a pattern: word borders and ``\\s`` as Unicode has them, separators U+001C-1F included."""
    flags = "(?iuU)" if ignore_case else "(?U)"
    return flags + pattern.replace(r"\s", f"[{_WHITESPACE_CLASS}]")


def clean_message(message: Column) -> Column:
    """Subject line without issue references and outer punctuation; null becomes empty."""
    subject = subject_line(F.coalesce(message, F.lit("")))
    without = F.regexp_replace(subject, unicode_pattern(fv.ISSUE_PHRASE, ignore_case=True), "")
    without = F.regexp_replace(without, unicode_pattern(fv.ISSUE_IN_PARENTHESES), "")
    without = F.regexp_replace(without, unicode_pattern(fv.ISSUE_GLUED), "")
    # Few subjects name an issue; the others skip three searches.
    subject = F.when(F.contains(subject, F.lit("#")), without).otherwise(subject)
    subject = F.regexp_replace(subject, _WHITESPACE_RUN, " ")
    return F.btrim(py_strip(subject), F.lit(fv.SUBJECT_PUNCTUATION))


def is_noise(message: Column) -> Column:
    """Merge, revert, squash and fixup subjects; a null message is none of them."""
    return py_strip(F.coalesce(message, F.lit(""))).rlike(unicode_pattern(fv.NOISE_SUBJECT))


def is_bot(author: Column) -> Column:
    """The whole word bot or robot, or the literal ``[bot]``; null is neither."""
    return F.coalesce(author, F.lit("")).rlike(unicode_pattern(fv.BOT_AUTHOR, ignore_case=True))


@cache
def _settled_ranges(form: str) -> tuple[tuple[int, int], ...]:
    """Long runs of code points that the form leaves alone whatever stands beside them.

    A code point is left alone if the form maps it to itself, it has no
    combining class, and no composed character goes on with it.  The planes from
    the fourth on, where hardly anything is assigned, are not looked at.
    """
    points = [p for p in range(0x30000) if not 0xD800 <= p <= 0xDFFF]
    follows = {ord(c) for p in points for c in unicodedata.normalize("NFD", chr(p))[1:]}
    kept = [p for p in points if p not in follows and not unicodedata.combining(chr(p)) and unicodedata.normalize(form, chr(p)) == chr(p)]
    runs: list[list[int]] = []
    for p in kept:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return tuple((low, high) for low, high in runs if high - low >= SHORTEST_RUN)


def may_change(text: Column, form: str = "NFC") -> Column:
    """Whether the form can change a text: a quick check that reads it and keeps it where it is.

    Most text lies below the first code point that can change at all; other
    text is held against the runs that never do.  A class of many ranges tries
    them one after the other, so low code points are ruled out before it there too.
    """
    first = fv.FIRST_UNSTABLE[form]
    settled = _ranges(r for r in _settled_ranges(form) if r[1] >= first)
    high = rf"[\x{{{first:X}}}-\x{{10FFFF}}]"
    return text.rlike(high) & text.rlike(f"[{high}&&[^{settled}]]")


def unicode_normalize(text: Column, form: str = "NFC") -> Column:
    """Unicode normalisation: the one function Spark has no built-in for.

    Text that the form cannot change, by ``may_change``, never leaves the JVM.
    """
    if form not in fv.FIRST_UNSTABLE:
        raise ValueError(f"unknown normalisation form {form!r}")

    def normalise(values: pd.Series) -> pd.Series:
        return values.map(lambda v: unicodedata.normalize(form, v), na_action="ignore")

    as_column = F.pandas_udf(normalise, "string")
    return F.coalesce(as_column(F.when(may_change(text, form), text)), text)


def to_halfwidth(text: Column) -> Column:
    """Full-width forms to their plain counterparts, with all other compatibility forms."""
    return unicode_normalize(text, "NFKC")


def strip_unlisted_chars(text: Column, extra_ranges: tuple[tuple[int, int], ...] = ()) -> Column:
    """Delete every code point outside the kept ranges.

    The kept ASCII is ruled out first: on most text that decides nearly every
    character without a look at the long list of ranges.
    """
    kept = [*fv.KEPT_RANGES, *extra_ranges]
    ascii_kept = _ranges(r for r in kept if r[1] < 0x80)
    other_kept = _ranges(r for r in kept if r[1] >= 0x80)
    return F.regexp_replace(text, f"[[^{ascii_kept}]&&[^{other_kept}]]+", "")


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def squeeze_spaces(text: Column) -> Column:
    """Runs of U+0020 become one; the ends are stripped."""
    return py_strip(F.regexp_replace(text, " {2,}", " "))


def normalize_text(
    text: Column,
    form: str = "NFC",
    halfwidth: bool = False,
    clean_invisible: bool = True,
    extra_ranges: tuple[tuple[int, int], ...] = (),
) -> Column:
    """The normalisation chain; null and blank text pass unchanged."""
    # Compatibility composition after any other form equals it alone: one pass is enough.
    chain = unicode_normalize(text, "NFKC" if halfwidth else form)
    if clean_invisible:
        chain = strip_unlisted_chars(chain, extra_ranges)
    chain = squeeze_spaces(unify_newlines(chain))
    return F.when(F.length(py_strip(text)) == 0, text).otherwise(chain)


def long_enough(text: Column, min_length: int = fv.MIN_TARGET_LENGTH) -> Column:
    """Not blank and, stripped, at least ``min_length`` code points; null is too short."""
    return F.coalesce(F.length(py_strip(text)) >= max(min_length, 1), F.lit(False))


def code_point_trigrams(text: Column) -> Column:
    """All overlapping three-code-point substrings, in one linear pass."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(...))."), 1)


def code_points(text: Column) -> Column:
    """Code point numbers of ``text``."""
    return F.transform(F.regexp_extract_all(text, F.lit("(?s)."), 0), F.ascii)
