import random
import re
from itertools import combinations

import pytest
import xxhash
from helpers import collected, documents, odd_rows

from commitloom.llm import simhash as sh
from commitloom.llm.components import component_labels


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, radius=3):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(values), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {v: top(v) for v in values}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = sh.covering_masks(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in combinations(range(64), radius):
        flipped = sum(1 << b for b in bits)
        assert any(not mask & flipped for mask in masks)


def test_links_keep_components_also_when_buckets_are_cut(llm):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            values.add(value - 2**64 if value >= 2**63 else value)
    expected = slow_components(values)
    frame = llm.createDataFrame([(v,) for v in values], "fp long")
    for size in (1000, 3):
        labels = {r["node"]: r["label"] for r in component_labels(sh.near_links(frame, 3, size)).collect()}
        assert {v: labels.get(v, v) for v in values} == expected


def test_components_of_long_chains_and_hubs(llm):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7)]
    labels = {r["node"]: r["label"] for r in component_labels(llm.createDataFrame(links, "a long, b long")).collect()}
    assert {labels[i] for i in range(61)} == {0} and {labels[i] for i in range(100, 300)} == {100}
    assert component_labels(llm.createDataFrame([], "a long, b long")).count() == 0


def slow_kept(rows):
    """Id and text of the first row of every component: the smallest id, then the smallest hash of the text."""
    components, best = slow_components({slow_fingerprint(t) for _, t, *_ in rows}), {}
    for d, t, *_ in rows:
        # The hash that Spark takes of a text; of none it is the seed.
        value = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
        key = (2**63 - 1 if d is None else d, value - 2**64 if value >= 2**63 else value)
        c = components[slow_fingerprint(t)]
        best[c] = min(best.get(c, (key, None, None)), (key, str(d), t), key=lambda b: b[0])
    first = {c: key for c, (key, *_) in best.items()}
    out = set()
    for d, t, *_ in rows:
        value = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
        key = (2**63 - 1 if d is None else d, value - 2**64 if value >= 2**63 else value)
        if first[components[slow_fingerprint(t)]] == key:
            out.add((str(d), t))
    return sorted(out)


def test_unlike_texts_without_an_id_all_stay(llm):
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"]
    rows = [*zip([None, None, None, 5, 5, 6], texts), (None, texts[0]), (5, texts[3])]
    kept = sh.drop_near_duplicates(documents(llm, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted(zip(["None"] * 3 + ["5", "5", "6"], texts))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == slow_kept(rows)


def test_documents(llm):
    base = " ".join(f"W{i}" for i in range(400))
    rows = [*odd_rows(), (20, base), (21, base.lower()), (22, base + " extra"), (23, "quite another text of some words")]
    found = collected(sh.shown(sh.near_duplicates(documents(llm, rows))))
    assert len(found) == len(rows)
    prints = sorted((str(d), f"{slow_fingerprint(t):016x}") for d, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in found) == prints
    components = slow_components({slow_fingerprint(t) for _, t, *_ in rows})
    smallest = {}
    for d, t, *_ in rows:
        c = components[slow_fingerprint(t)]
        smallest[c] = min(smallest.get(c, 2**63), 2**63 - 1 if d is None else d)
    for r in found:
        want = smallest[components[int(r["fingerprint"], 16)]]
        assert r["component_id"] == (None if want == 2**63 - 1 else want)
    kept = sh.drop_near_duplicates(documents(llm, rows))
    assert kept.columns == documents(llm, rows).columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == slow_kept(rows)
    assert sh.near_duplicates(documents(llm, rows).limit(0)).count() == 0
