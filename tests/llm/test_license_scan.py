import re
import time
from itertools import accumulate

from helpers import collected, documents, odd_rows

from commitloom.llm import license_scan as ls


def test_pieces_make_up_the_notice():
    for notice in ls.NOTICES:
        assert "".join(s for s, _ in notice.seeds) == notice.words and len(notice.seeds) == notice.edits + 1
        assert all(notice.words[at : at + len(s)] == s and s for s, at in notice.seeds)


def begins_of(joined):
    return [0, *accumulate(len(w) + 1 for w in joined.split(" "))][:-1]


def slow_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = sorted(
        (i, label)
        for phrase, label in ls.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    labels = sorted({label for _, label in places})
    return (len(words), len(places), *((places[0][0], places[-1][0]) if places else (None, None)), labels)


ROWS = [
    (20, "MIT License, MIT-license. The Apache?License! general public license mit license"),
    (21, "Released under the M1T Licence. Nothing more"),
    (22, "Work licensed under teh Apache Licence, Versjon 2.0 here"),
    (23, "this is licensed under the GNU Genera1 Pub1ic License; general  Public\nLICENSE"),
    (24, "released under the bst licence and emit license, permit license"),
    (25, "mit licenses amit license mitlicense"),
    (26, "x " * 5000 + "Permission is hereby granted, free of charge, to any persn obtaining a copy"),
]


def test_labels(llm):
    rows = [*odd_rows(), *ROWS]
    found = collected(ls.scan_licenses(documents(llm, rows)))
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(str(r["doc_id"]), []).append(r)
    for d, text, *_ in rows:
        base = [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in by_id[str(d)]]
        assert slow_base(text) in base
    labels = {r["doc_id"]: r["labels"] for r in found if r["doc_id"] and r["doc_id"] >= 20}
    assert labels[21] == ["mit"] and labels[22] == ["apache"] and labels[23] == ["gpl"]
    assert labels[24] == [] and labels[25] == [] and labels[26] == ["mit"]
    scores = {r["doc_id"]: r["score"] for r in found if r["doc_id"]}
    assert scores[20] == 1.0 and 0.9 < scores[21] < 1.0 and scores[24] == 0.0
    (match,) = [r["matches"] for r in found if r["doc_id"] == 26]
    assert [(m["label"], m["first"], m["last"]) for m in match] == [("mit", 5000, 5012)]
    assert ls.scan_licenses(documents(llm, rows).limit(0)).count() == 0


def test_every_bounded_edit_is_found():
    """Any text with no more edits than allowed keeps a seed, so the search agrees with matching everywhere."""
    import random

    rng = random.Random(8)
    search = ls.NoticeSearch(ls.NOTICES, ls.PHRASES)
    for notice in ls.NOTICES:
        for _ in range(30):
            text = list(notice.words)
            for _ in range(notice.edits):
                at = rng.randrange(1, len(text) - 1)
                change = rng.choice("sdi")
                if change == "d":
                    del text[at]
                elif change == "s":
                    text[at] = rng.choice("qzx")
                else:
                    text.insert(at, rng.choice("qzx"))
            joined = " ".join(("qq " + "".join(text) + " zz").split())
            assert notice.label in {m[0] for m in search.matches(joined, begins_of(joined))}


def test_long_texts_take_linear_time():
    """Ten megabytes of phrases in seconds; twice as many edited notices in about twice the time."""
    search = ls.NoticeSearch(ls.NOTICES, ls.PHRASES)
    began = time.time()
    found = search.scan("MIT license, and the General Public License of some kind; " * 175_000)
    assert found[1] == 350_000 and time.time() - began < 60
    took = []
    for n in (4000, 8000):
        began = time.process_time()
        found = search.scan("licensed under teh apache license version 2.0 or so. " * n)
        took.append(time.process_time() - began)
        assert len(found[7]) == n
    assert took[1] < 3 * took[0]


def test_notices_of_a_table(llm):
    table = llm.createDataFrame(
        [("x", "All Rights, Reserved by X!", 1, 5), ("x", "All Rights, Reserved by X!", 1, 6), (None, "a", 1, 0), ("y", " ..", 1, 0), ("z", "of z", None, 0)],
        "label string, text string, edits int, extra int",
    )
    notices = ls.notices_from(table)
    assert [(n.label, n.words, n.edits) for n in notices] == [("x", "all rights reserved by x", 1), ("z", "of z", 0)]
    (row,) = collected(ls.scan_licenses(documents(llm, [(1, "all rihgts? all right reserved by x")]), notices=notices))
    assert row["labels"] == ["x"] and row["matches"][0]["edits"] == 1
