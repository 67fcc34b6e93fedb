import random
import re
import sys
import time

import numpy as np
import pytest
from helpers import collected, documents, odd_rows

from commitloom.llm import decontaminate as dc

BENCH = "item_id long, text string, doc_id string, extra int"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def slow(rows, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for d, text, *_ in rows:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[w]
        out.append((str(d), len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(2)
    items = [(i, " ".join(f"b{i}_{k}" for k in range(rng.randint(20, 40)))) for i in range(12)]
    items += [(50, items[0][1] + " more words"), (51, "Short, item!"), (52, None), (53, " .. "), (None, "no id for this one"), (0, items[0][1])]
    rows = list(odd_rows())
    for d in range(20, 60):
        words = items[rng.randrange(12)][1].split()
        a, n = rng.randint(0, 10), rng.choice([5, 12, 13, 14, 30])
        filler = [f"f{d}_{k}" for k in range(rng.choice([0, 10, 300]))]
        rows.append((d, " ".join(filler + words[a : a + n] + filler)))
    rows += [(70, "SHORT item short-item"), (71, "no id for this one " + items[3][1].upper().replace(" ", "--"))]
    return items, rows


@pytest.mark.parametrize("most_built", [dc.BUILT_BYTES, 400])
def test_against_brute_force(llm, cases, most_built):
    items, rows = cases
    bench = llm.createDataFrame([(i, t, "z", 1) for i, t in items], BENCH)
    docs = documents(llm, rows)
    found = collected(dc.find_contamination(docs, bench, most_built=most_built))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found)
    assert got == slow(rows, items)
    kept = dc.drop_contaminated(docs, bench, most_built=most_built)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(d for d, *_, bad in slow(rows, items) if not bad)


def test_removed_words_leave_no_window(llm, cases):
    items, rows = cases
    bench = llm.createDataFrame([(i, t, "z", 1) for i, t in items], BENCH)
    shorter = dc.drop_hit_words(documents(llm, rows), bench)
    gaps = {d: n - hit for d, n, hit, *_ in slow(rows, items)}
    for r in shorter.collect():
        if str(r["doc_id"]) != "5":
            assert len(words_of(r["text"])) == gaps[str(r["doc_id"])]


def test_empty_tables(llm, cases):
    items, rows = cases
    docs, bench = documents(llm, rows), llm.createDataFrame([], BENCH)
    assert dc.find_contamination(docs, bench).filter("n_hit > 0").count() == 0
    full = llm.createDataFrame([(i, t, "z", 1) for i, t in items], BENCH)
    assert dc.find_contamination(docs.limit(0), full).count() == 0


def test_a_passage_in_many_items_is_one_window(llm):
    """Twenty thousand items share a passage: it is held once, with its items, and a document pays for it once."""
    passage = " ".join(f"p{k}" for k in range(20))
    built = dc.WindowSet.of([(f"i{i:05d}", f"{passage} own{i}") for i in range(20_000)], 13)
    hashes, places, begins, items = built.windows[13]
    assert len(hashes) == 8 + 20_000 and len(places) == len(hashes) and begins[-1] == len(items)
    began = time.time()
    mask, found = built.hits(dc.folded_words(f"a b {passage} c"))
    assert time.time() - began < 1 and mask.sum() == 20 and len(found) == 20_000


def test_windows_that_share_a_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(dc, "_hash_at", lambda columns: np.zeros(len(columns[0]), np.uint64))
    items = [("1", "a b c d"), ("2", "b c d e"), ("3", "a b c x")]
    built = dc.WindowSet.of(items, 3)
    for text, hit, names in (("z a b c z", 3, ["1", "3"]), ("c d e", 3, ["2"]), ("b c d", 3, ["1", "2"]), ("a c b", 0, [])):
        mask, found = built.hits(dc.folded_words(text))
        assert (mask.sum(), found) == (hit, names)


def test_what_is_built_is_within_its_bound(llm):
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(60)), "z", 1) for i in range(300)]
    bench = llm.createDataFrame(rows, BENCH)
    bound = dc.built_bytes(dc.benchmark_items(bench, "item_id", "text"))
    built = dc.WindowSet.of([(str(r[0]), r[1]) for r in rows], 13)
    arrays = sum(a.nbytes for w in built.windows.values() for a in w) + built.words.nbytes
    words = sum(sys.getsizeof(w) + sys.getsizeof(n) for w, n in built.vocabulary.items()) + sys.getsizeof(built.vocabulary)
    assert arrays + words <= bound
