"""The pipeline's stages against plain Python, by ids and texts."""

import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F
from test_decontaminate import slow as slow_contamination
from test_mixing import slow_targets
from test_sharding import signed_hash
from test_simhash import slow_kept

import corpus_pipeline
from commitloom.llm import language_id, mixing

LANGUAGES = {
    "en": "the quick brown fox jumps over the lazy dog and then the other thing with that which was there before us all".split(),
    "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом другие вещи которые были там раньше нас всех".split(),
}


def sample(rng, lang, n):
    return " ".join(f"{rng.choice(LANGUAGES[lang])}{rng.choice('abcdefg') * rng.randrange(2) if lang == 'en' else ''}" for _ in range(n))


@pytest.fixture(scope="module")
def tables(llm, tmp_path_factory):
    """Documents with copies, near copies, benchmark passages, foreign scripts, null and repeated ids, in uneven sources."""
    rng = random.Random(13)
    folder = tmp_path_factory.mktemp("tables")
    items = [(i, " ".join(f"q{i}x{k}" for k in range(30))) for i in range(5)]
    rows = []
    for d in range(60):
        lang = "ru" if d % 4 == 0 else "en"
        text = sample(rng, lang, rng.randrange(20, 200))
        if d % 9 == 0:
            text += " " + items[d % 5][1]
        rows.append((d, text, lang, rng.choice(["hot", "hot", "b", None])))
    rows += [(100 + i, rows[1][1], "en", "b") for i in range(12)]  # copies
    rows += [(120, rows[2][1] + " tail", "en", "hot"), (None, sample(rng, "en", 80), None, "hot"), (None, sample(rng, "en", 90), None, "b")]
    rows += [(7, sample(rng, "en", 70), "en", "hot"), (7, rows[7][1], "en", "hot"), (130, "ภาษาไทย เป็น ภาษา", None, "b"), (131, "12 ½", "en", "b")]
    rows += odd_rows()[:3]
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    documents(llm, rows).write.parquet(f"{folder}/documents.parquet")
    return str(folder), items, [(*r, *[None] * (4 - len(r))) for r in rows]


def shape(df):
    return sorted((str(r["doc_id"]), str(r["text"]), str(r["source"])) for r in df.collect())


def plain(rows):
    return sorted((str(d), str(t), str(s)) for d, t, _, s in rows)


def with_a_told_word(rows):
    """Rows with a word in a script that a labelled document's language uses."""
    letters = {}
    for _, text, lang, _ in rows:
        if lang is not None and text is not None:
            for token in text.split():
                for script, word in language_id.word_units(token):
                    letters.setdefault(lang, Counter())[script] += len(word)
    used = {s for c in letters.values() for s, n in c.items() if n >= language_id.SCRIPT_SHARE * sum(c.values())}
    return [r for r in rows if any(s in used for token in (r[1] or "").split() for s, _ in language_id.word_units(token))]


def first_of_near_copies(rows):
    """One row per component; of rows equal in id and text any one, so sources are compared apart."""
    kept = Counter((d, t) for d, t in slow_kept([r[:2] for r in rows]))
    return [r for r in {(str(d), t): (d, t, lang, s) for d, t, lang, s in rows}.values() if (str(r[0]), r[1]) in kept]


def uncontaminated(rows, items):
    bad = {(d, t) for d, t, _, _ in rows if slow_contamination([(d, t)], items)[0][4]}
    return [r for r in rows if r[:2] not in bad]


def test_every_stage(llm, tables):
    folder, items, rows = tables
    stages = dict(corpus_pipeline.STAGES)

    def run(name, given):
        return stages[name](llm, documents(llm, given), folder)

    told = with_a_told_word(rows)
    assert shape(run("language", rows)) == plain(told) and len(told) < len(rows)
    firsts = first_of_near_copies(told)
    assert shape(run("near_duplicates", told)) == plain(firsts) and len(firsts) < len(told)
    clean = uncontaminated(firsts, items)
    assert shape(run("benchmark", firsts)) == plain(clean) and len(clean) < len(firsts)
    mixed = [r for r in run("mixture", clean).collect()]
    assert sorted((str(r["doc_id"]), r["text"], str(r["source"])) for r in mixed) == plain_mix(llm, clean)
    again = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in mixed]
    check_shards(run("shards", again).collect(), again)
    out = corpus_pipeline.run(llm, folder).collect()
    assert sorted((str(r["doc_id"]), r["text"], str(r["source"])) for r in out) == plain(again)


def plain_mix(llm, rows):
    """Whole passes, then for each length the documents with the least marks, as many as the fill takes."""
    size = {i: len((t or "").split()) for i, (_, t, _, _) in enumerate(rows)}
    sizes = Counter()
    for i, (*_, source) in enumerate(rows):
        sizes[source] += size[i]
    targets = slow_targets(dict(sizes))
    marks = llm.createDataFrame([(i, 2**63 - 1 if d is None else d, t) for i, (d, t, _, _) in enumerate(rows)], "i int, d long, t string")
    marks = {r["i"]: r["m"] for r in marks.select("i", F.xxhash64(F.lit(mixing.SEED), "d", F.xxhash64("t")).alias("m")).collect()}
    copies = {}
    for source, target in targets.items():
        own = [i for i, r in enumerate(rows) if r[3] == source]
        passes = int(target // sizes[source]) if sizes[source] else 0
        lengths = sorted({size[i] for i in own})
        groups = [sorted((i for i in own if size[i] == n), key=lambda i: marks[i] % 2**64) for n in lengths]
        more = mixing.fill_budget(np.array(lengths), np.array([len(g) for g in groups]), round(target - passes * sizes[source]))
        for group, extra in zip(groups, more.tolist()):
            copies |= {i: passes + (k < extra) for k, i in enumerate(group)}
    return sorted((str(rows[i][0]), rows[i][1], str(rows[i][3])) for i, n in copies.items() for _ in range(n))


def check_shards(found, rows):
    assert sorted((str(r["doc_id"]), r["text"]) for r in found) == sorted((str(r[0]), r[1]) for r in rows)
    highest = (-(2**63), -(2**63))
    for shard in range(8):
        own = [r for r in found if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        ids = (2**63 - 1 if r["doc_id"] is None else r["doc_id"] for r in own)
        keys = [(signed_hash(r["text"].encode()), signed_hash(d.to_bytes(8, "little"))) for r, d in zip(own, ids)]
        assert not keys or min(keys) >= highest
        highest = max(keys, default=highest)
        share = sum(r["size"] for r in found) / 8
        assert abs(sum(r["size"] for r in own) - share) <= 2 * max(r["size"] for r in found)


def test_all_rows_stay_without_labels(llm, tables):
    folder, _, rows = tables
    bare = [(d, t, None, s) for d, t, _, s in rows]
    kept = dict(corpus_pipeline.STAGES)["language"](llm, documents(llm, bare), folder)
    assert shape(kept) == plain(bare)
