"""Licence notices in text, exact and with a bounded number of edits."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.llm.decontaminate import folded_words

# Stretches of text whose verification a task remembers.
KNOWN_WINDOWS = 20_000
# Phrases whose words make a base label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Notice:
    """A short notice in folded words, and how many edits of characters it may have suffered."""

    label: str
    words: str
    edits: int

    @cached_property
    def seeds(self) -> list[tuple[str, int]]:
        """``edits + 1`` pieces and where they begin: a text with no more edits holds one of them unchanged."""
        n, parts = len(self.words), self.edits + 1
        cuts = [n * i // parts for i in range(parts + 1)]
        return [(self.words[a:b], a) for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(f"(?e)(?:{regex.escape(self.words, literal_spaces=True)}){{e<={self.edits}}}")


# Names of three letters are told apart, so notices with one allow two edits only.
NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "licensed under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "under the terms of the gnu general public license", 4),
    Notice("lgpl", "under the terms of the gnu lesser general public license", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("bsd", "licensed under the bsd license", 2),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 1),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", 1),
)


def notices_from(table: DataFrame, label: str = "label", words: str = "text", edits: str = "edits") -> list[Notice]:
    """Notices held as rows, each different one once; those without a label or a word are left out.

    Their text is folded to words.  Every worker holds all notices, so the
    table is meant to be one of notices, not of documents.
    """
    found = {
        Notice(row["l"], b" ".join(folded_words(row["w"])).decode("utf-8", "surrogatepass"), max(0, row["e"] or 0))
        for row in table.select(F.col(label).alias("l"), F.col(words).alias("w"), F.col(edits).alias("e")).distinct().collect()
        if row["l"]
    }
    return sorted((n for n in found if n.words), key=lambda n: (n.label, n.words, n.edits))


class NoticeSearch:
    """Finds phrases and notices in folded, single-spaced words."""

    def __init__(self, notices: Sequence[Notice], phrases: Sequence[tuple[str, str]]) -> None:
        self.notices, self.phrases = notices, phrases
        self.known: dict[tuple[int, str], list[tuple[int, int, int]]] = {}
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for seed, at in notice.seeds:
                seeds.setdefault(seed, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for seed, where in seeds.items():
            self.automaton.add_word(seed, (len(seed), where))
        if seeds:
            self.automaton.make_automaton()

    def places(self, joined: str, begins: list[int]) -> list[tuple[int, str]]:
        """Word number and label of every place of a phrase; ``begins`` says where each word begins."""
        framed, found = f" {joined} ", []
        for phrase, label in self.phrases:
            at = framed.find(f" {phrase} ")
            while at >= 0:
                found.append((bisect_right(begins, at) - 1, label))
                at = framed.find(f" {phrase} ", at + 1)
        return sorted(found)

    def matches(self, joined: str, begins: list[int]) -> list[tuple[str, int, int, int]]:
        """Label, first and last word and edits of each notice found near a seed."""
        near: dict[int, list[int]] = {}
        if not len(self.automaton):
            return []
        for end, (size, where) in self.automaton.iter(joined):
            for number, at in where:
                near.setdefault(number, []).append(end + 1 - size - at)
        found = []
        for number, places in near.items():
            notice = self.notices[number]
            spans: set[tuple[int, int, int]] = set()
            for low, high in _windows(places, notice, len(joined)):
                spans.update((low + a, low + b, edits) for a, b, edits in self._verified(number, joined[low:high]))
            for a, b, edits in _apart(spans):
                first, last = a + (joined[a] == " "), b - 1 - (joined[b - 1] == " ")
                words = (bisect_right(begins, at) - 1 for at in (first, last))
                found.append((notice.label, *words, edits))
        return sorted(set(found), key=lambda m: (m[1], m[0], m[2], m[3]))

    def _verified(self, number: int, window: str) -> list[tuple[int, int, int]]:
        """Begin, end and edits of what the notice's pattern finds in a stretch of text; a stretch that comes again is known."""
        key = (number, window)
        if key not in self.known:
            if len(self.known) >= KNOWN_WINDOWS:
                self.known.clear()
            found = self.notices[number].pattern.finditer(window)
            self.known[key] = [(*m.span(), sum(m.fuzzy_counts)) for m in found if m.end() > m.start()]
        return self.known[key]

    def scan(self, text: str | None) -> tuple:
        words = b" ".join(folded_words(text)).decode("utf-8", "surrogatepass").split(" ") if text else []
        words = words if words != [""] else []
        joined = " ".join(words)
        begins = [0, *accumulate(len(w) + 1 for w in words)][: len(words)]
        base, fuzzy = self.places(joined, begins), self.matches(joined, begins)
        exact = {label for _, label in base}
        best = max((1 - m[3] / sum(map(len, words[m[1] : m[2] + 1])) for m in fuzzy), default=0.0)
        return (
            len(words),
            len(base),
            base[0][0] if base else None,
            base[-1][0] if base else None,
            sorted(exact),
            sorted(exact | {m[0] for m in fuzzy}),
            1.0 if base else max(0.0, best),
            [{"label": m[0], "first": m[1], "last": m[2], "edits": m[3]} for m in fuzzy],
        )


def _windows(places: list[int], notice: Notice, size: int) -> Iterator[tuple[int, int]]:
    """Where the notice can stand, by the places that its seeds give it; those that edits may part are one."""
    places = sorted(set(places))
    first = last = places[0]
    for place in [*places[1:], None]:
        if place is not None and place <= first + 2 * notice.edits:
            last = place
            continue
        yield max(0, first - notice.edits), min(size, last + len(notice.words) + notice.edits)
        first = last = place


def _apart(spans: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans that overlap, the one with the fewest edits, then the first."""
    kept: list[tuple[int, int, int]] = []
    group: list[tuple[int, int, int]] = []
    for span in [*sorted(spans), None]:
        if group and (span is None or span[0] >= max(b for _, b, _ in group)):
            for one in sorted(group, key=lambda s: (s[2], s)):
                if all(one[1] <= a or b <= one[0] for a, b, _ in kept[-len(group) :]):
                    kept.append(one)
            group = []
        if span is not None:
            group.append(span)
    return kept


RESULT = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "array<string>",
    "labels": "array<string>",
    "score": "double",
    "matches": "array<struct<label: string, first: int, last: int, edits: int>>",
}


def scan_licenses(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    notices: Sequence[Notice] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """``doc_id`` and the columns of ``RESULT`` of every row.

    A label comes from a phrase that stands word for word, or from a notice
    found with no more edits than it allows.  Seeds, exact pieces of the
    notices, are found by one automaton over the whole text; the fuzzy pattern
    runs only on the few characters around them.  Time is linear in the text.
    ``score`` is 1 with a phrase, else the best notice's share of unedited
    characters, else 0.  Null and empty texts have no words and no labels.
    Repeated rows and rows with a null id are scanned each by its own text; an
    empty table gives an empty result.
    """

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = NoticeSearch(notices, phrases)
        for batch in batches:
            out = pd.DataFrame([search.scan(t) for t in batch], columns=list(RESULT))
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    scan.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    scanner = F.pandas_udf(scan, ", ".join(f"{name} {kind}" for name, kind in RESULT.items()))
    return documents.select(doc_id, scanner(F.col(text)).alias("_found")).select(doc_id, "_found.*")


def shown(found: DataFrame) -> DataFrame:
    def joined(column: str) -> Column:
        return F.array_join(column, ",").alias(column)

    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"), "score"
    )
