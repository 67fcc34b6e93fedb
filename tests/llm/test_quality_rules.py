import re
from collections import Counter

import numpy as np
from helpers import collected, documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from commitloom.llm import quality_rules as qr


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if triples[tuple(words[k : k + 3])] > 1 for d in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n\t#| ", max_size=60))
def test_counts(text):
    assert qr.count_text(text)[:5] == slow_counts(text)


def test_rules_find_planted_conditions():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 1000, (3000, len(qr.FEATURES)))
    names = list(qr.FEATURES)
    symbols, upper, repeats = (table[:, names.index(n)] for n in ("symbols", "upper", "repeats"))
    bad = (symbols >= 800) | ((upper >= 600) & (repeats < 300))
    rules = qr.learn_rules(table, bad, np.arange(3000) % 3 == 0)
    judged = np.any([r.covers(table) for r in rules], axis=0)
    assert (judged == bad).mean() > 0.98 and len(rules) <= 6


def test_no_rule_from_noise():
    rng = np.random.default_rng(2)
    table = rng.integers(0, 1000, (2000, len(qr.FEATURES)))
    assert qr.learn_rules(table, rng.random(2000) < 0.2, np.arange(2000) % 3 == 0) == []


def test_judge(llm):
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(i, clean + f" x{i}") for i in range(60)] + [(100 + i, clean + " # & | * $" * 20 + f" y{i}") for i in range(60)]
    labels = llm.createDataFrame([(i, 1) for i in range(50)] + [(100 + i, 0) for i in range(50)] + [(1, 1), (55, None)], "doc_id long, quality int")
    judged, rules = qr.judge(documents(llm, rows), labels)
    kept = {r["doc_id"]: r["kept"] for r in collected(judged)}
    assert rules and all(kept[i] == (i < 100) for i in kept)


def test_awkward_rows_and_no_labels(llm):
    labels = llm.createDataFrame([], "doc_id long, quality int")
    judged, rules = qr.judge(documents(llm, odd_rows()), labels)
    found = collected(judged)
    assert rules == [] and len(found) == len(odd_rows())
    assert all(r["kept"] != r["base_failed"] for r in found)
    assert {r["n_words"] for r in found if r["doc_id"] in (1, 2, 3)} == {0}
    assert qr.judge(documents(llm, odd_rows()).limit(0), labels)[0].count() == 0


def test_more_than_a_dozen_kinds_are_all_learned():
    """Fifteen kinds of bad row, each its own value range of one feature: no cap on rules or conditions."""
    rng = np.random.default_rng(3)
    n, names = 9000, list(qr.FEATURES)
    table = rng.integers(0, 1000, (n, len(names)))
    kind, own = rng.integers(0, 30, n), names.index("symbols")
    table[:, own] = kind * 30 + rng.integers(0, 30, n)
    bad = kind % 2 == 1
    rules = qr.learn_rules(table, bad, np.arange(n) % 3 == 0)
    judged = np.any([r.covers(table) for r in rules], axis=0)
    assert len(rules) > 12 and (judged == bad).mean() > 0.98
    deep = np.all(table[:, [i for i in range(6) if i != own]] >= 350, axis=1)
    rules = qr.learn_rules(table, deep, np.arange(n) % 3 == 0)
    assert max(len(r.conditions) for r in rules) > 4


def test_a_repeated_id_comes_once(llm):
    rows = [(1, f"text number {i} " * 30) for i in range(500)] + [(i, "other text " * 40) for i in range(2, 40)]
    labels = llm.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    counts = qr.text_counts(documents(llm, rows))
    seen, learn = [], qr.learn_rules
    try:
        qr.learn_rules = lambda table, *rest: seen.append(len(table)) or learn(table, *rest)
        qr.fit_rules(counts, labels)
    finally:
        qr.learn_rules = learn
    assert seen == [39]
