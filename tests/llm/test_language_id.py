import numpy as np
import pytest
from helpers import collected, documents, odd_rows

from commitloom.llm import language_id as li

EN = "the quick brown fox jumps over the lazy dog and then the other thing with that which was there"
FR = "le renard brun saute par dessus le chien paresseux et puis les autres choses avec celles qui étaient là"
RU = "быстрая коричневая лиса прыгает через ленивую собаку и потом другие вещи"


@pytest.fixture(scope="module")
def model(llm):
    rows = [(i, " ".join(w for w in text.split() if (len(w) + i) % 4), lang) for i in range(12) for text, lang in ((EN, "en"), (FR, "fr"), (RU, "ru"))]
    return li.train(documents(llm, rows))


def test_whole_texts(llm, model):
    rows = [(1, EN), (2, FR), (3, RU), (4, "12 34 ++"), (5, None), (6, "")]
    found = {r["doc_id"]: r for r in collected(li.detect(documents(llm, rows), model))}
    assert [found[i]["lang_pred"] for i in range(1, 7)] == ["en", "fr", "ru", "und", "und", "und"]
    assert found[1]["score"] == 1.0 and found[5]["score"] == 0.0 and found[5]["spans"] == []


def test_spans_of_mixed_text(llm, model):
    text = f"{EN}. {RU} {EN}"
    (found,) = collected(li.detect(documents(llm, [(1, text)]), model))
    parts = [(s["lang"], text[s["start"] : s["end"]].strip(" .")) for s in found["spans"]]
    assert parts == [("en", EN), ("ru", RU), ("en", EN)]
    assert found["lang_pred"] == "en" and 0.5 < found["score"] < 1


def test_best_paths_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([5, 4, 4, 1])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    labels, at = li.best_paths(scores, lengths, 0.8), 0
    for n in lengths:
        own, path = scores[at : at + n].astype(float), labels[at : at + n]

        def worth(p):
            return sum(own[i, p[i]] for i in range(n)) - 0.8 * sum(a != b for a, b in zip(p, p[1:]))

        best = max(worth(p) for p in np.ndindex(*[3] * n))
        assert worth(path) == pytest.approx(best)
        at += n


def test_scripts_narrow_the_languages(llm, model):
    (found,) = collected(li.detect(documents(llm, [(1, "zzz qqq")]), model))
    assert found["lang_pred"] in ("en", "fr")
    assert li.word_units("abcгде") == [("latin", "abc"), ("cyrillic", "где")]


def test_awkward_rows_and_no_labels(llm, model):
    rows = documents(llm, odd_rows())
    assert li.detect(rows, model).count() == len(odd_rows())
    kept = li.keep_determined(rows, model)
    assert kept.columns == rows.columns and kept.filter("doc_id in (1, 2, 3)").count() == 0
    nothing = li.train(rows.filter("lang = 'xx'"))
    assert {r["lang_pred"] for r in collected(li.detect(rows, nothing))} == {"und"}
    assert li.detect(rows.limit(0), model).count() == 0


def test_held_out_accuracy(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.train(docs.filter(~li.held_out()))
    found = li.detect(docs.filter(li.held_out()), model).join(docs.select("doc_id", "lang"), "doc_id")
    right = [r["lang"] == r["lang_pred"] for r in found.collect()]
    assert sum(right) / len(right) > 0.98


def test_one_language_agrees_with_paths():
    rng = np.random.default_rng(9)
    for _ in range(40):
        lengths = np.array(sorted(rng.integers(1, 9, 6), reverse=True))
        scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
        top, alone = li.one_language(scores, lengths, 1.5)
        labels = np.split(li.best_paths(scores, lengths, 1.5), np.cumsum(lengths)[:-1])
        for own, lang, constant in zip(labels, top, alone):
            assert not constant or set(own.tolist()) == {lang}


LATIN = (EN, FR)


@pytest.fixture(scope="module")
def latin_model(llm):
    rows = [(i, " ".join(w for w in text.split() if (len(w) + i) % 4), lang) for i in range(12) for text, lang in zip(LATIN, ("en", "fr"))]
    return li.train(documents(llm, rows))


def test_numeric_signs_are_no_letters(llm, model):
    found = collected(li.detect(documents(llm, [(1, "½ ² Ⅳ ①"), (2, "½ der ²")]), model))
    assert [(r["lang_pred"], r["score"]) for r in sorted(found, key=lambda r: r["doc_id"])][0] == ("und", 0.0)
    assert li.word_units("½x²") == [("latin", "x")] and li.word_units("①") == []


def test_a_foreign_script_is_no_evidence(llm, latin_model):
    thai = "ภาษาไทย เป็น ภาษา"
    found = {r["doc_id"]: r for r in collected(li.detect(documents(llm, [(1, thai), (2, f"{EN} {thai}")]), latin_model))}
    assert found[1]["lang_pred"] in ("en", "fr") and found[1]["score"] == 0.0
    assert found[2]["lang_pred"] == "en" and found[2]["score"] == pytest.approx(len(EN.split()) / (len(EN.split()) + 3))
    kept = li.keep_determined(documents(llm, [(1, thai), (2, f"{EN} {thai}"), (3, "123"), (4, FR)]), latin_model)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4]


@pytest.mark.parametrize("text, russian", [(f"{EN} лиса {EN}", ["лиса"]), (f"{EN} лиса прыгает {EN}", ["лиса прыгает"]), (f"{EN} лиса", ["лиса"]), (f"лиса {EN}", ["лиса"])])
def test_a_word_of_another_script_is_a_span(llm, model, text, russian):
    """Scripts exclude languages: however short, what only Russian can write is Russian."""
    (found,) = collected(li.detect(documents(llm, [(1, text)]), model))
    spans = [text[s["start"] : s["end"]].strip() for s in found["spans"] if s["lang"] == "ru"]
    assert spans == russian and found["lang_pred"] == "en" and found["score"] < 1


def test_mixed_texts_and_all_texts_without_a_model_stay(llm, model):
    third = " ".join(f"{EN} {FR} {RU}".split())
    rows = documents(llm, [(1, third), (2, None), (3, "words")])
    assert [r["doc_id"] for r in li.keep_determined(rows, model).collect()] == [1, 3]
    nothing = li.train(rows.filter("lang = 'xx'"))
    assert li.keep_determined(rows, nothing).count() == 3


def test_too_many_languages_are_refused(llm, monkeypatch):
    monkeypatch.setattr(li, "TABLE_CELLS", 2 * li.MIN_BUCKETS)
    rows = documents(llm, [(i, "some text", f"l{i}") for i in range(3)])
    with pytest.raises(ValueError, match="more than 2 languages"):
        li.train(rows)
    assert len(li.train(rows.limit(2)).langs) == 2


def plain_grams(word):
    framed = f"<{word}>"
    return [framed[i : i + n] for n in (2, 3, 4) for i in range(len(framed) - n + 1)] + [framed]


def test_training_and_scores_against_plain_counts(llm, model):
    """With room for every gram, the model's weights are smoothed shares of plain counts, and words score their sums."""
    texts = {"en": [], "fr": [], "ru": []}
    for i in range(12):
        for text, lang in ((EN, "en"), (FR, "fr"), (RU, "ru")):
            texts[lang].append(" ".join(w for w in text.split() if (len(w) + i) % 4))
    buckets = len(model.weights)
    for at, lang in enumerate(model.langs):
        counts = {}
        for text in texts[lang]:
            for word in text.split():
                hashed, _ = li.gram_buckets([word.lower()], buckets)
                assert len(hashed) == len(plain_grams(word.lower()))
                for b in hashed.tolist():
                    counts[b] = counts.get(b, 0) + 1
        total = sum(counts.values())
        want = [np.log((counts.get(b, 0) + li.SMOOTHING) / (total + li.SMOOTHING * buckets)) * li.GRAM_WEIGHT for b in range(buckets)]
        assert np.allclose(model.weights[:, at], want, atol=1e-4)
    assert {s: [model.langs[i] for i in np.flatnonzero(uses)] for s, uses in model.in_script.items() if uses.any()} == {"latin": ["en", "fr"], "cyrillic": ["ru"]}
    scores = li._WordScores(model)
    scores.learn({"renard", "лиса"})
    for word, allowed in (("renard", [0, 1]), ("лиса", [2])):
        hashed, _ = li.gram_buckets([word], buckets)
        row = scores.table[scores.rows[word]]
        for lang in range(3):
            want = model.weights[hashed, lang].sum() if lang in allowed else li.EXCLUDED
            assert row[lang] == pytest.approx(want, rel=1e-4)


def test_predictions_against_plain_paths(llm, model):
    """Language, score and spans of mixed texts from a plain search over all paths of their words."""
    rng = np.random.default_rng(12)
    pool = [*EN.split(), *FR.split(), *RU.split(), "ไทย", "7"]
    texts = [" ".join(rng.choice(pool, rng.integers(1, 7))) for _ in range(60)]
    found = {r["doc_id"]: r for r in collected(li.detect(documents(llm, list(enumerate(texts))), model))}
    scores = li._WordScores(model)
    for i, text in enumerate(texts):
        words = [t for t in text.split() if t != "7"]
        scores.learn(set(words))
        rows = [scores.table[scores.rows[w]].astype(float) for w in words]
        if not words:
            assert found[i]["lang_pred"] == "und"
            continue

        def worth(path):
            return sum(r[p] for r, p in zip(rows, path)) - li.SWITCH_PENALTY * sum(a != b for a, b in zip(path, path[1:]))

        best = max(np.ndindex(*[3] * len(words)), key=worth)
        told = [p for p, w in zip(best, words) if w != "ไทย"]
        counts = [told.count(k) for k in range(3)]
        top = max(counts)
        assert found[i]["score"] == pytest.approx(top / len(words))
        near = [p for p in np.ndindex(*[3] * len(words)) if worth(p) > worth(best) - 1e-3]
        if len(near) == 1 and counts.count(top) == 1:
            assert found[i]["lang_pred"] == model.langs[counts.index(top)]
