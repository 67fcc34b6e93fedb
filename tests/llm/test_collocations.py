import re
from collections import Counter

import numpy as np
import pytest
from helpers import collected, documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from commitloom.llm import collocations as co


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def phrases(text, most=5):
    for words in pieces(text):
        for i in range(len(words)):
            for n in range(1, min(most, len(words) - i) + 1):
                yield tuple(words[i : i + n])


def from_chunks(texts, trigger):
    found = Counter()
    for number, chunk, own in co.chunks([co.folded(t) for t in texts], trigger):
        words = co.Words(chunk)
        letters = [chunk[a:b].decode() for a, b in zip(words.starts, words.ends)]
        for i in range(own):
            for n in range(1, 6):
                if i + n <= len(letters) and words.piece[i] == words.piece[i + n - 1]:
                    found[number, tuple(letters[i : i + n])] += 1
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abAB \t\n.,é𝒳", max_size=60), max_size=5), st.sampled_from([1, 2, 5, 64]))
def test_every_phrase_belongs_to_one_chunk(texts, trigger):
    assert from_chunks(texts, trigger) == Counter((i, p) for i, t in enumerate(texts) for p in phrases(t))


def test_equal_passages_are_cut_alike():
    rng = np.random.default_rng(1)
    passage = " ".join(f"w{i}" for i in rng.integers(0, 500, 400)).encode()
    one, two = ({c for _, c, _ in co.chunks([t], 16)} for t in (b"some words before. " + passage, passage + b" and others after it"))
    assert len(one & two) > 0.8 * len(one)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: b.replace(b" ", b"x").replace(b".", b"y")), min_size=1, max_size=30))
def test_hashes_tell_words_apart(words):
    words += [words[0] + b"\0", b"z" * 1023, b"z" * 1024, b"z" * 1025, b"z" * 1025 + b"a"]
    for lane in (0, 1):
        found = co.Words(b" ".join(words)).hashes(lane).tolist()
        alone = [co.Words(w).hashes(lane).tolist() for w in words]
        assert [[h] for h in found] == alone and len(set(found)) == len(set(words))


def plain(rows, min_count, top):
    counts, totals = {}, Counter()
    for _, text, lang in ((*r, None)[:3] for r in rows):
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        own.update(phrases(text))
        totals[lang] += sum(map(len, pieces(text)))
    out = []
    for lang, own in counts.items():
        found = []
        for p, a in own.items():
            if len(p) < 2 or a < min_count:
                continue
            if any(len(q) > len(p) and b >= min_count and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in own.items()):
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def check(spark, rows, min_count=3, top=2000, trigger=8):
    found = co.collocations(documents(spark, rows), min_count=min_count, top=top, trigger=trigger)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r[n] for n in names) for r in collected(found))
    assert got == plain(rows, min_count, top)
    return got


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "neural", "Net", "é", "machine", "learning", "x", "𝒳y", "new", "york", "#1", "\x00"]
    shared = "The machine learning of new york, neural net"
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words, rng.integers(0, 60)))
        text = re.sub(" (of|x) ", lambda m: f"{m[1]}. ", text) if i % 2 else text
        rows.append((i, text + (" " + shared if i % 3 == 0 else ""), [None, "en", "ne", "und"][i % 4]))
    return rows


@pytest.mark.parametrize("trigger", [1, 8, 64])
def test_against_plain_counts(llm, trigger):
    assert len(check(llm, random_rows(60, 3), 4, trigger=trigger)) > 20


def test_top_and_ties(llm):
    rows = [(i, f"a{k} b{k}. c{k} d{k}") for k in range(12) for i in range(5)]
    assert len(check(llm, rows, 5, top=7)) == 7


def test_a_full_table_only_counts_more(llm, monkeypatch):
    rows = random_rows(40, 5)
    want = check(llm, rows, 4)
    monkeypatch.setattr(co, "HELD_PHRASES", 50)
    monkeypatch.setattr(co, "BYTES_AT_ONCE", 500)
    dictionary = co.chunk_dictionary(documents(llm, rows), trigger=8)
    few = {(r["lang"], r["phrase"], r["a"]) for r in collected(co.frequent_phrases(dictionary, 5, 4, bits=64))}
    usual = {(r["lang"], r["phrase"], r["a"]) for r in collected(co.frequent_phrases(dictionary, 5, 4, bits=2**20))}
    assert few == usual and check(llm, rows, 4) == want


def test_copies_are_one_entry(llm):
    text = " ".join(f"w{i % 53}" for i in range(500))
    dictionary = co.chunk_dictionary(documents(llm, [(i, text, "en") for i in range(200)]))
    assert dictionary.count() == len(set(co.chunks([text.encode()]))) and {r["n"] % 200 for r in dictionary.collect()} == {0}
    check(llm, [(i, text, "en") for i in range(20)], 20)


def test_long_monotone_and_awkward_texts(llm):
    rows = [*odd_rows(), (30, "na " * 3000), (31, "na " * 3000, "en"), (32, ".,;:!? \t\n", "en"), (33, "x" * 5000, "en")]
    check(llm, rows, 2)
    assert co.collocations(documents(llm, rows).limit(0)).count() == 0
    assert co.collocations(documents(llm, odd_rows()), min_count=10**6).count() == 0


@pytest.mark.parametrize("min_count", [4, 300])
def test_rare_phrases_are_not_exchanged(llm, monkeypatch, min_count):
    """Of three words between frequent pairs, those that are frequent are marked and hardly any other."""
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 30, 400)) + " one two three", "en") for i in range(max(30, min_count))]
    monkeypatch.setattr(co, "HELD_PHRASES", 500)
    monkeypatch.setattr(co, "RANGE_PHRASES", 100)
    dictionary = co.chunk_dictionary(documents(llm, rows), trigger=8)
    seen = Counter(p for _, text, _ in rows for p in phrases(text) if len(p) == 3)
    table = co.often(dictionary, (3,), None, 0, min_count)
    batch = co.Batch(dictionary.toPandas())
    at = np.flatnonzero(batch.begins(3))
    marks = dict(zip((tuple(batch.phrase(i, 3).split()) for i in at.tolist()), co.marked(table, batch.hashes(3)[at]).tolist()))
    assert set(marks) == set(seen) and all(marks[p] for p, n in seen.items() if n >= min_count)
    assert sum(marks[p] for p, n in seen.items() if n < min_count) <= 2 < sum(n < min_count for n in seen.values())
