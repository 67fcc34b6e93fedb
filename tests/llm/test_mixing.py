import numpy as np
from helpers import collected, documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from commitloom.llm import mixing


def sums_of(counts):
    sums = {0}
    for length, times in counts.items():
        sums = {s + length * k for s in sums for k in range(times + 1)}
    return sums


LENGTHS = st.one_of(st.integers(0, 40), st.integers(60_000, 700_000))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(LENGTHS, st.integers(1, 4), min_size=1, max_size=5), st.floats(0, 1))
def test_no_choice_is_nearer(counts, share):
    lengths, n = np.array(list(counts)), np.array(list(counts.values()))
    budget = round(int((lengths * n).sum()) * share)
    taken = mixing.fill_budget(lengths, n, budget)
    assert ((taken >= 0) & (taken <= n)).all()
    assert abs(int((lengths * taken).sum()) - budget) == min(abs(s - budget) for s in sums_of(counts))


def test_one_long_document_over_the_budget():
    assert mixing.fill_budget(np.array([600_000]), np.array([2]), 1_100_000).tolist() == [2]
    assert mixing.fill_budget(np.array([100_000]), np.array([1]), 80_000).tolist() == [1]
    assert mixing.fill_budget(np.array([7, 90_001]), np.array([3, 5]), 180_010).tolist() == [1, 2]


def test_many_documents_of_even_lengths():
    """An odd budget is out of reach; one word off is then nearest, and found without looking at every sum."""
    lengths, n = np.array([100, 3000, 40_000]), np.array([900_000, 40_000, 3000])
    taken = mixing.fill_budget(lengths, n, 123_456_789)
    assert abs(int((lengths * taken).sum()) - 123_456_789) == 11


def test_fill_is_exact_on_many_lengths():
    rng = np.random.default_rng(0)
    lengths, n = np.arange(1, 4000), rng.integers(1, 50, 3999)
    for budget in (1, 77, 10_000, 12_345_678):
        assert int((lengths * mixing.fill_budget(lengths, n, budget)).sum()) == budget


def slow_targets(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    full, total = {}, 1.5 * sum(sizes.values())
    while True:
        weight = sum(w for s, w in weights.items() if s not in full)
        rest = total - sum(full.values())
        target = {s: full[s] if s in full else rest * w / weight for s, w in weights.items()}
        over = [s for s in target if s not in full and target[s] > 2 * sizes[s]]
        if not over:
            return target
        full |= {s: 2 * sizes[s] for s in over}


def test_mix(llm):
    rows = [(i, "w " * (i % 37 + 1), None, s) for i, s in enumerate([None, "b", "a", "c", "é", "hot", "hot", "hot"] * 60)]
    docs = documents(llm, rows)
    found = collected(mixing.shown(mixing.mix(docs)))
    again = collected(mixing.shown(mixing.mix(docs.repartition(7))))
    key = lambda r: r["doc_id"]
    assert sorted(found, key=key) == sorted(again, key=key)
    source, size = {r[0]: r[3] for r in rows}, {r[0]: r[0] % 37 + 1 for r in rows}
    sizes, taken = {}, {}
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[source[r["doc_id"]]] = sizes.get(source[r["doc_id"]], 0) + r["size"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
    targets = slow_targets(sizes)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 * targets[s] + 1e-9
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(copies.get(r["doc_id"], 0) * r["size"] == r["taken"] for r in found)


def test_equal_rows_share_what_is_left(llm):
    """Rows equal in id and text, many of them, in many parts: some are taken once more than others."""
    rows = [(None, "one two three", None, "a")] * 90 + [(1, "one two three", None, "a")] * 7 + [(i, "x y", None, "b") for i in range(2, 9)]
    docs = documents(llm, rows).repartition(5)
    mixed = mixing.mix(docs)
    found = collected(mixing.shown(mixed))
    assert len(found) == len(rows)
    taken = {s: sum(r["taken"] for r in found if r["source_size"] == size) for s, size in (("a", 291), ("b", 14))}
    assert abs(taken["a"] - next(r["target"] for r in found if r["source_size"] == 291)) <= 1.5
    copies = {r["doc_id"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    size = {None: 3, 1: 3} | {i: 2 for i in range(2, 9)}
    want = {}
    for r in found:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"] // size[r["doc_id"]]
    assert copies == {d: n for d, n in want.items() if n}


def test_awkward_rows(llm):
    docs = documents(llm, odd_rows())
    found = collected(mixing.shown(mixing.mix(docs)))
    assert len(found) == len(odd_rows()) and all(r["taken"] <= 2 * r["size"] for r in found)
    given = mixing.mix(docs).agg({"copies": "sum"}).first()[0]
    assert mixing.mixed_documents(docs).count() == given
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("doc_id < 3")).count() == 2
