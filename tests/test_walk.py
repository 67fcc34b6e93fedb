import heapq
import random
from datetime import datetime, timedelta

import pytest

from commitloom import session
from commitloom.operators import walk

START = datetime(2020, 1, 1)
SCHEMA = "repo string, commit_id string, committed_at timestamp, parents array<string>"


def frames(spark, commits, heads):
    rows = [(repo, c, None if t is None else START + timedelta(hours=t), parents) for repo, c, t, parents in commits]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(heads, "repo string, commit_id string")


def plain_walk(commits, heads):
    """A queue of known commits, the newest first."""
    out = {}
    known = {(repo, c): (t, parents) for repo, c, t, parents in reversed(commits)}
    for repo in {h[0] for h in heads}:
        queue, seen, order = [], set(), []

        def put(c):
            if c is not None and (repo, c) in known and c not in seen:
                seen.add(c)
                t = known[repo, c][0]
                heapq.heappush(queue, (float("inf") if t is None else -t, c))

        for _, c in sorted(h for h in heads if h[0] == repo and h[1]):
            put(c)
        while queue:
            c = heapq.heappop(queue)[1]
            order.append(c)
            for parent in known[repo, c][1] or []:
                put(parent)
        for place, c in enumerate(order, 1):
            out[repo, c] = place
    return out


def found_walk(df):
    return {(r["repo"], r["commit_id"]): r["position"] for r in df.collect()}


def random_history(rng, repo, n, skew):
    commits = []
    for i in range(n):
        parents = [f"c{i - 1:04d}"] if i else []
        if i > 5 and rng.random() < 0.3:
            parents = rng.sample([f"c{k:04d}" for k in range(max(0, i - 9), i)], rng.choice([1, 2, 3]))
        commits.append((repo, f"c{i:04d}", i + (rng.randint(-40, 40) if rng.random() < skew else 0), parents))
    return commits


@pytest.mark.parametrize("skew", [0.0, 0.6])
def test_order_of_random_histories(spark, skew):
    rng = random.Random(11)
    commits, heads = [], []
    for k in range(6):
        commits += random_history(rng, f"r{k}", 45, skew)
        heads.append((f"r{k}", f"c{rng.choice([44, 44, 30]):04d}"))
    assert found_walk(walk.walk_order(*frames(spark, commits, heads))) == plain_walk(commits, heads)


def test_a_parent_with_a_fast_clock_waits_for_its_child(spark):
    commits = [("r", "head", 10, ["slow", "usual"]), ("r", "slow", 1, ["fast"]), ("r", "fast", 50, []), ("r", "usual", 5, [])]
    order = found_walk(walk.walk_order(*frames(spark, commits, [("r", "head")])))
    assert sorted(order, key=order.get) == [("r", "head"), ("r", "usual"), ("r", "slow"), ("r", "fast")]


def test_long_lines_and_branches(spark):
    line = [("long", f"{i:05d}", i, [f"{i - 1:05d}"] if i else None) for i in range(1500)]
    side = [("long", f"s{i:03d}", i, [f"s{i - 1:03d}"] if i else ["00600"]) for i in range(60)]
    merge = ("long", "merge", 6000, ["01200", "s059", None, "gone"])
    commits, refs = frames(spark, [*line, *side, merge], [("long", "merge")])
    reached = {r["commit_id"] for r in walk.reachable_commits(commits, refs).collect()}
    assert reached == {f"{i:05d}" for i in range(1201)} | {f"s{i:03d}" for i in range(60)} | {"merge"}
    assert found_walk(walk.walk_order(commits, refs)) == plain_walk([*line, *side, merge], [("long", "merge")])


def test_cycles_end(spark):
    commits = [("r", "a", 3, ["b"]), ("r", "b", 2, ["c", "a"]), ("r", "c", 9, ["a", "c"]), ("r", "lone", 1, ["lone"])]
    commits, refs = frames(spark, commits, [("r", "a")])
    assert {r["commit_id"] for r in walk.reachable_commits(commits, refs).collect()} == {"a", "b", "c"}
    assert found_walk(walk.walk_order(commits, refs)) == {("r", "a"): 1, ("r", "b"): 2, ("r", "c"): 3}


def test_awkward_rows(spark):
    commits = [("r", "a", None, None), ("r", "b", 4, ["a"]), ("r", "b", 4, ["a"]), ("q", "b", 4, ["a"]), (None, "x", 1, []), ("r", None, 1, [])]
    heads = [("r", "b"), ("r", "b"), ("r", "a"), ("q", None), ("z", "none")]
    commits, refs = frames(spark, commits, heads)
    assert found_walk(walk.walk_order(commits, refs)) == {("r", "b"): 1, ("r", "a"): 2}
    assert walk.walk_order(commits.limit(0), refs).count() == 0 and walk.walk_order(commits, refs.limit(0)).count() == 0


def test_integrity_of_what_heads_reach(spark):
    commits = [
        ("fine", "a", 1, []), ("fine", "b", 2, ["a"]), ("fine", "stray", 3, ["gone"]),
        ("broken", "a", 1, ["gone"]), ("broken", "b", 2, ["a"]),
        ("headless", "a", 1, []), ("lost", "a", 1, []), ("null", "a", 1, []),
    ]
    commits, refs = frames(spark, commits, [("fine", "b"), ("broken", "b"), ("lost", "zzz"), ("null", None)])
    repos = spark.createDataFrame([(r, 1) for r in ("fine", "broken", "headless", "lost", "null", "empty")], "repo string, extra int")
    judged = {r["repo"]: r["reason"] for r in walk.judge_reachable(repos, commits, refs).collect()}
    assert judged == {
        "fine": None, "broken": "missing parent", "headless": "no HEAD", "lost": "missing HEAD", "null": "no HEAD", "empty": "no HEAD",
    }


def test_only_numbers_travel_along_the_edges(spark, monkeypatch):
    """Names and ids stay with the commits: what is written and shuffled in each round has none."""
    written, settle = {}, walk.settle
    monkeypatch.setattr(walk, "settle", lambda df, label: written.setdefault(label, df.schema.simpleString()) and settle(df, label))
    commits, refs = frames(spark, [("r", "a", 1, []), ("r", "b", 2, ["a"]), ("q", "b", 1, [])], [("r", "b"), ("q", "b")])
    assert found_walk(walk.walk_order(commits, refs)) == {("r", "b"): 1, ("r", "a"): 2, ("q", "b"): 1}
    assert {"edges", "first-parents", "keys"} <= set(written)
    assert not [label for label, schema in written.items() if label != "commits" and "string" in schema]


def test_many_keys_are_not_broadcast(spark, monkeypatch):
    """However little their files take: reached commits share one key, and numbers that rise are packed to next to nothing."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", -1, raising=False)
    plans, settle = [], walk.settle

    def kept(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return settle(df, label)

    monkeypatch.setattr(walk, "settle", kept)
    rows = [("r", f"{i:03d}", i, [f"{i - 1:03d}"] if i else []) for i in range(100)] + [("r", "top", 200, ["099", "050"])]
    commits, refs = frames(spark, rows, [("r", "top")])
    found = walk.reachable_commits(commits, refs)
    last = found._jdf.queryExecution().executedPlan().toString()
    joins = [plan for label, plan in [*plans, ("last", last)] if label in ("first-parents", "keys", "reached", "last") and "Join" in plan]
    assert len(joins) > 5 and not any("BroadcastHashJoin" in plan for plan in joins)
    assert found.count() == 101


def test_commits_of_one_instant_go_by_id_in_every_repository(spark):
    commits = [(repo, c, t, ["z"] if c != "z" else []) for repo in ("p", "q", "r") for c, t in (("z", None), ("y", 1), ("x", 1), ("w", 1))]
    heads = [(repo, c) for repo in ("p", "q", "r") for c in ("w", "x", "y")]
    assert found_walk(walk.walk_order(*frames(spark, commits, heads))) == plain_walk(commits, heads)
