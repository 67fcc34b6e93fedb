import random
import zlib

import pytest
import xxhash
from helpers import collected, documents, odd_rows

from commitloom.llm import sharding


def check(rows, found, shards=8, spread=None):
    assert len(found) == len(rows)
    sizes = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sizes
    assert {r["law"] for r in found} <= {"bytes"} and {r["grown_shard"] for r in found} <= {None}
    total = [0] * shards
    for shard in range(shards):
        own = [r for r in found if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        total[shard] = sum(r["size"] for r in own)
    share = sum(total) / shards
    if spread:
        assert all(abs(t - share) <= spread + 0.002 * share for t in total)


def test_even_sizes(llm):
    rows = [(i, "x" * (i * 7919 % 400)) for i in range(3000)]
    check(rows, collected(sharding.placements(documents(llm, rows))), spread=400)


def test_a_hot_text_is_cut_by_id(llm):
    rows = [(i, "same text for all of these" if i % 2 else f"text {i}") for i in range(2000)]
    found = collected(sharding.placements(documents(llm, rows)))
    check(rows, found, spread=40)
    again = collected(sharding.placements(documents(llm, rows).repartition(9)))
    assert sorted(map(str, found)) == sorted(map(str, again))


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_other_counts(llm, shards):
    rows = [(i, "y" * (i % 50)) for i in range(400)]
    check(rows, collected(sharding.placements(documents(llm, rows), shards=shards)), shards, spread=51)


def test_awkward_rows(llm):
    rows = odd_rows()
    check(rows, collected(sharding.placements(documents(llm, rows))))
    check([], collected(sharding.placements(documents(llm, rows).limit(0))))
    same = [(1, "a")] * 40
    check(same, collected(sharding.placements(documents(llm, same))))
    whole = sharding.shard(documents(llm, rows))
    assert whole.count() == len(rows) and whole.columns[-3:] == ["size", "shard", "slot"]
    assert len(set(whole.columns)) == len(whole.columns)


def test_files(llm, tmp_path):
    rows = [(i, "z" * (i % 30)) for i in range(300)]
    sharding.write_shards(documents(llm, rows), str(tmp_path / "out"), shards=3)
    assert llm.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3


def plain_placement(keyed, shards):
    """Shard and slot of each row from a sorted list: a cut falls on the border of equal keys that is nearest to its share."""
    keyed = sorted(keyed)
    total, borders, below, at = sum(size for _, _, size, _ in keyed), [(0, 0)], 0, 0
    while at < len(keyed):
        end = at
        while end < len(keyed) and keyed[end][:2] == keyed[at][:2]:
            below += keyed[end][2]
            end += 1
        borders.append((below, end))
        at = end
    cuts = []
    for i in range(1, shards):
        target = total * i / shards
        over = next(k for k, (bytes_below, _) in enumerate(borders) if bytes_below >= target)
        nearer = over if target - borders[over - 1][0] > borders[over][0] - target else over - 1
        cuts.append(borders[nearer][1])
    placed = []
    for shard, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(keyed)])):
        # Rows are numbered by stretches of the first key (32 of so few rows), then slices of the second.
        own = sorted(keyed[low:high], key=lambda r: (r[0] >> 59, r[1] >> 64 - sharding.SLICE_BITS, r[0], r[1]))
        placed += [(name, size, shard, slot) for slot, (_, _, size, name) in enumerate(own)]
    return sorted(placed)


def signed_hash(data):
    value = xxhash.xxh64_intdigest(data, 42)
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("shards", [2, 8])
def test_against_a_sorted_list(llm, shards):
    rng = random.Random(shards)
    texts = [f"text {i} " * rng.randrange(1, 60) for i in range(40)] + ["hot " * 30] * 30 + ["é" * 5000]
    rows = [(i, rng.choice(texts)) for i in range(600)]
    keyed = [(signed_hash(t.encode()), signed_hash(i.to_bytes(8, "little")), len(t.encode()) + 1, i) for i, t in rows]
    found = collected(sharding.placements(documents(llm, rows), shards=shards, tolerance=0.0))
    assert sorted((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in found) == plain_placement(keyed, shards)
