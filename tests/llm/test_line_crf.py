import itertools
import re

import numpy as np
import pandas as pd
import pytest
from helpers import collected, documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from commitloom.llm import line_crf as crf


def worth(good, changes, labels):
    return sum(g for g, y in zip(good, labels) if y) + sum(changes[a, b] for a, b in zip(labels, labels[1:]))


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 0, 5, 1, 4])
    good, changes = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    sums, marginals, expected = crf.forward_backward(good, lengths, changes)
    ends = np.cumsum(lengths)
    for i, (begin, end) in enumerate(zip(ends - lengths, ends)):
        own = good[begin:end]
        all_labels = list(itertools.product((0, 1), repeat=len(own)))
        weights = np.exp([worth(own, changes, y) for y in all_labels])
        assert sums[i] == pytest.approx(np.log(weights.sum()) if len(own) else 0.0)
        share = weights / weights.sum()
        for k in range(len(own)):
            assert marginals[begin + k] == pytest.approx(sum(p for p, y in zip(share, all_labels) if y[k]))
        for a, b in itertools.product((0, 1), repeat=2):
            want = sum(p * sum((c, d) == (a, b) for c, d in zip(y, y[1:])) for p, y in zip(share, all_labels))
            assert expected[i, a, b] == pytest.approx(want)


def test_gradient_against_differences():
    rng = np.random.default_rng(6)
    tables = [rng.normal(size=(n, len(crf.FEATURES))).astype(np.float32) for n in (1, 4, 0, 3)]
    frame = pd.DataFrame({"label": [1, 0, 1, 1], "lines": [t.tobytes() for t in tables]})
    at = rng.normal(size=len(crf.FEATURES) + 4) / 3

    def loss(flat):
        (found,) = crf._loss(iter([frame]), flat)
        return found["loss"][0], np.frombuffer(found["gradient"][0])

    _, gradient = loss(at)
    for i in range(len(at)):
        step = np.zeros(len(at))
        step[i] = 1e-5
        assert gradient[i] == pytest.approx((loss(at + step)[0] - loss(at - step)[0]) / 2e-5, abs=1e-4)


def test_minimise_finds_the_bottom():
    centre = np.array([3.0, -2.0, 0.5])
    scale = np.array([1.0, 30.0, 0.1])
    found = crf.minimise(lambda x: (float((scale * (x - centre) ** 2).sum()), 2 * scale * (x - centre)), np.zeros(3), 80)
    assert np.allclose(found, centre, atol=0.02)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB é\n\t#1.!𝒳", max_size=60))
def test_lines(text):
    table, chars = crf.line_features(text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    words = [re.findall(r"[^\x20\x09-\x0D]+", line) for line in lines]
    assert chars.tolist() == [sum(map(len, w)) for w in words] and len(table) == len(lines)
    if not lines:
        return

    def column(name):
        return table[:, crf.FEATURES.index(name)]

    def share(parts, wholes):
        return pytest.approx([(p / w) ** 0.5 for p, w in zip(parts, wholes)], rel=1e-5)

    assert column("words").tolist() == pytest.approx([np.log1p(len(w)) / 6 for w in words], rel=1e-5)
    assert column("upper").tolist() == share([line.count("B") for line in lines], chars)
    assert column("symbol").tolist() == share([line.count("#") for line in lines], chars)
    assert column("foreign").tolist() == share([line.count("é") + line.count("𝒳") for line in lines], chars)
    assert column("same_words").tolist() == share([len(w) - len(set(w)) for w in words], map(len, words))
    keys = [line.strip(" \t") for line in lines]
    assert column("seen_line").tolist() == [float(k in keys[:i]) for i, k in enumerate(keys)]
    flat, owner = [w for ws in words for w in ws], [i for i, ws in enumerate(words) for _ in ws]
    triples = list(zip(flat, flat[1:], flat[2:]))
    again = {k + d for k, t in enumerate(triples) if triples.count(t) > 1 for d in range(3)}
    assert column("seen_windows").tolist() == share([sum(owner[k] == i for k in again) for i in range(len(lines))], map(len, words))
    assert column("before_words").tolist() == [0.0, *column("words").tolist()[:-1]]
    assert column("after_words").tolist() == [*column("words").tolist()[1:], 0.0]
    assert column("first").tolist() == [1.0] + [0.0] * (len(lines) - 1) and column("last")[-1] == 1


GOOD = "A calm sentence of plain words stands here, number {}.\nAnother quiet line follows it and ends well."
BAD = "BUY!! NOW!! {} ### $$$\nWIN!! WIN!! %%% CLICK!!"


@pytest.fixture(scope="module")
def model(llm):
    rows = [(i, (BAD if i % 3 == 0 else GOOD).format(f"w{i}")) for i in range(240)]
    labels = llm.createDataFrame([(i, int(i % 3 != 0)) for i in range(240)], "doc_id long, quality int")
    return crf.train(crf.training_documents(documents(llm, rows), labels))


def test_scores(llm, model):
    mixed = GOOD.format("x") + "\n" + BAD.format("y")
    rows = [(1, GOOD.format("other")), (2, BAD.format("other")), (3, mixed), (4, "\n\n" + GOOD.format("other") + "\n  \n")]
    found = {r["doc_id"]: r for r in collected(crf.score_documents(documents(llm, rows), model))}
    assert found[1]["predicted"] == 1 and found[2]["predicted"] == 0
    assert found[1]["score"] > 0.9 and found[2]["score"] < 0.1 and len(found[3]["lines"]) == 4
    assert found[4]["score"] == found[1]["score"] and len(found[4]["lines"]) == 2
    _, chars = crf.line_features(mixed)
    assert found[3]["score"] == pytest.approx(np.average(found[3]["lines"], weights=chars))


def test_batches_do_not_matter(llm, model, monkeypatch):
    texts = [(GOOD if i % 2 else BAD).format(i) * (i % 4) for i in range(30)]
    whole = crf.text_scores(texts, model)
    monkeypatch.setattr(crf, "LINES_AT_ONCE", 3)
    assert [s for s, _ in crf.text_scores(texts, model)] == pytest.approx([s for s, _ in whole])


def test_a_repeated_id_teaches_once(llm):
    docs = documents(llm, [(1, f"text {i}") for i in range(40)] + [(2, "same")] * 40 + [(None, "none")])
    labels = llm.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (4, 0), (4, 1), (None, 1)], "doc_id long, quality int")
    found = collected(crf.training_documents(docs, labels))
    assert sorted(r["label"] for r in found) == [0, 1]
    sampled = crf.training_documents(
        documents(llm, [(i, "t") for i in range(600)]), llm.range(600).selectExpr("id as doc_id", "1 as quality"), train_docs=200
    ).count()
    assert 120 < sampled < 280


def test_awkward_rows_and_no_labels(llm, model):
    docs = documents(llm, odd_rows())
    found = collected(crf.score_documents(docs, model))
    assert len(found) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["score"] for r in found if r["doc_id"] in (1, 2, 3)} == {model.empty}
    assert crf.score_documents(docs.limit(0), model).count() == 0
    nothing = crf.train(crf.training_documents(docs, llm.createDataFrame([], "doc_id long, quality int")))
    assert {round(r["score"], 9) for r in collected(crf.score_documents(docs, nothing))} == {0.5}
    wide = docs.selectExpr("*", "score as lines", "1 as quality", "2 as label")
    assert crf.score_documents(wide, model).columns == ["doc_id", "score", "predicted", "lines"]
    assert crf.training_documents(wide, llm.createDataFrame([(4, 1), (7, None)], "doc_id long, quality int")).count() == 1


def test_held_out_accuracy(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = crf.train(crf.training_documents(docs.filter(~crf.held_out()), labels))
    found = crf.score_documents(docs.filter(crf.held_out()), model).join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) / len(found) > 0.95
    good = [r["score"] for r in found if r["quality"] == 1]
    bad = [r["score"] for r in found if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.98
