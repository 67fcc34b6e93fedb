"""Which commits a repository's HEAD reaches, and in which order a walk from it meets them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.operators.ranking import CHUNK_ROWS, number_in_group
from commitloom.session import settle, sized

_NODE = ["repo", "id"]
# What stands for an age where there is none, and lies above all numbers of commits.
_OLDEST, _ABOVE = 2**63 - 1, 2**62


def _joined(path: Column, after: Column) -> Column:
    """The key of a path that goes on with another: later entries outdo those that a walk would take after them."""
    return F.concat(F.filter(path, lambda entry: entry > after[0]), after)


def _kept(path: Column, _: Column) -> Column:
    return path


def _levels(firsts: DataFrame, join: Callable[[Column, Column], Column]) -> list[DataFrame]:
    """Jumps of 1, 2, 4, ... first parents: ``node``, ``to`` and the ``way``, from after ``node`` to ``to``.

    Each level is made of two jumps of the one before, so a line of n commits
    needs log2(n) levels; a level holds only the commits that have as many
    first parents before them.  Cycles have all levels, of which there are no
    more than the commits allow.
    """
    level = sized(settle(firsts, "first-parents"))
    left, levels = level.count(), []
    reach = 1
    while not level.isEmpty():
        levels.append(level)
        if reach > left:
            break
        reach *= 2
        here, there = level.alias("a"), level.alias("b")
        way = join(F.col("a.way"), F.col("b.way")).alias("way")
        met = here.join(there, F.col("a.to") == F.col("b.node"))
        level = sized(settle(met.select("a.node", F.col("b.to").alias("to"), way), "first-parents"))
    return levels


def _best(reached: DataFrame, moved: DataFrame) -> DataFrame:
    """Each commit with the least key known; keys are combined before the shuffle."""
    return reached.unionByName(moved).groupBy("node").agg(F.min("key").alias("key"))


def _moved(keys: DataFrame, steps: DataFrame, join: Callable[[Column, Column], Column]) -> DataFrame:
    return keys.join(steps, "node").select(F.col("to").alias("node"), join(F.col("key"), F.col("way")).alias("key"))


def _spread(
    seeds: DataFrame, firsts: list[DataFrame], others: DataFrame, join: Callable[[Column, Column], Column]
) -> DataFrame:
    """The least key of every commit that the seeds reach.

    A round carries keys down the lines of first parents, twice as far with
    each level, and then over one edge to another parent.  Only commits whose
    key got better start the next round, so there are as many rounds as a best
    path leaves its line, however long the lines are, and cycles end.
    """
    reached, fresh = None, seeds
    while True:
        for level in firsts:
            # Whoever has a key has passed it on to less than this jump: passing it on again reaches twice as far.
            fresh = sized(settle(_best(fresh, _moved(fresh, level, join)), "keys"))
        if reached is not None:
            known = reached.withColumnRenamed("key", "_known")
            better = F.col("_known").isNull() | (F.col("key") < F.col("_known"))
            fresh = sized(settle(fresh.join(known, "node", "left").filter(better).drop("_known"), "keys"))
            reached = sized(settle(_best(reached, fresh), "reached"))
        else:
            reached = fresh
        side = _moved(fresh, others, join).groupBy("node").agg(F.min("key").alias("key"))
        known = reached.withColumnRenamed("key", "_known")
        better = F.col("_known").isNull() | (F.col("key") < F.col("_known"))
        fresh = sized(settle(side.join(known, "node", "left").filter(better).drop("_known"), "keys"))
        if fresh.isEmpty():
            return reached


def _nodes(commits: DataFrame, age: Column) -> DataFrame:
    """``repo``, ``id``, ``age`` and ``parents`` of each commit, with the ``node`` that stands for it from here on.

    A repository's nodes rise with their ids, so they tell commits of one
    instant apart as the ids do.  A commit that stands twice is one; ranges of
    (repository, id) bring its rows together and give the numbers their order.
    """
    parts = max(int(commits.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-commits.count() // CHUNK_ROWS))
    named = commits.select("repo", F.col("commit_id").alias("id"), age.alias("_age"), "parents").dropna(subset=_NODE)
    once = (
        named.repartitionByRange(parts, *_NODE)
        .groupBy(*_NODE)
        .agg(F.min(F.struct("_age", "parents")).alias("c"))
        .sortWithinPartitions(*_NODE)
    )
    parents = F.array_compact("c.parents").alias("parents")
    return settle(once.select(*_NODE, F.col("c._age").alias("age"), parents, F.monotonically_increasing_id().alias("node")), "commits")


def _graph(
    nodes: DataFrame, refs: DataFrame, entry: Column, join: Callable[[Column, Column], Column], lead: Column | None = None
) -> DataFrame:
    """``node`` and ``key`` of the commits that the heads reach; a commit's own key is [``entry``].

    ``lead`` of a repository's ``_first`` head comes before that in all its keys.
    """
    # Edges to what is not a commit lead nowhere.
    target = nodes.select("repo", F.col("id").alias("_parent"), F.col("node").alias("to"), F.array(entry).alias("way"))
    named = nodes.select(*_NODE, "node", F.posexplode("parents").alias("nth", "_parent")).filter("id <> _parent").drop("id")
    edges = settle(named.join(target, ["repo", "_parent"]).select("node", "nth", "to", "way"), "edges")
    first = edges.filter("nth = 0").select("node", "to", "way")
    others = sized(settle(edges.filter("nth > 0").select("node", "to", "way").distinct(), "other-parents"))
    heads = refs.select("repo", F.col("commit_id").alias("id")).distinct()
    heads = heads.join(nodes.select(*_NODE, "node", F.array(entry).alias("key")), _NODE)
    if lead is not None:
        heads = heads.join(heads.groupBy("repo").agg(F.min("node").alias("_first")), "repo")
        heads = heads.withColumn("key", F.concat(F.array(lead), "key"))
    return _spread(sized(settle(heads.select("node", "key"), "heads")), _levels(first, join), others, join)


def reachable_commits(commits: DataFrame, refs: DataFrame) -> DataFrame:
    """``repo`` and ``commit_id`` of the commits that a repository's ``refs(repo, commit_id)`` reach.

    Parents are followed whatever their number; parents that are no commits,
    null parents and null heads are passed over, and cycles end.  A commit that
    stands twice counts once.  Work grows with the logarithm of a line's length
    and with how often histories branch off inside branches, not with the
    number of generations.
    """
    nodes = _nodes(commits, F.lit(0))
    found = _graph(nodes, refs, F.lit(0), _kept)
    return nodes.join(found.select("node"), "node").select("repo", F.col("id").alias("commit_id"))


def walk_order(commits: DataFrame, refs: DataFrame, position: str = "position") -> DataFrame:
    """``repo``, ``commit_id`` and the ``position``, from 1, at which a walk by time from HEAD meets each commit.

    The walk always takes the newest commit that it knows of, and comes to know
    a commit by one of its children; so where clocks are out of order a commit
    stands where its path lets it, not where its own time would.  Commits of one
    instant are taken by id; one without a time comes after those that have one.

    A path's key lists its entries that no later one outdoes, the slowest first;
    the best key over all paths, compared entry by entry, is the commit's place.
    With clocks in order it is the commit's own entry alone.
    """
    age = F.coalesce(-F.unix_micros(F.col("committed_at").cast("timestamp")), F.lit(_OLDEST))
    nodes = _nodes(commits, age)
    # No entry outdoes a repository's own, so all its keys begin with it and those of no other do.
    lead = F.struct(F.lit(_OLDEST).alias("age"), (F.col("_first") + _ABOVE).alias("node"))
    keys = _graph(nodes, refs, F.struct("age", "node"), _joined, lead)
    numbered = number_in_group(keys.withColumn("_first", F.col("key")[0]["node"]), ["_first"], [F.col("key")], position)
    return nodes.select(*_NODE, "node").join(numbered.select("node", position), "node").select("repo", F.col("id").alias("commit_id"), position)


def judge_reachable(repos: DataFrame, commits: DataFrame, refs: DataFrame) -> DataFrame:
    """``repos`` with the ``reason`` for which a repository fails, null where it passes.

    A repository fails without a HEAD, with one that is not among its commits,
    or when a commit that HEAD reaches names a parent that is not among them.
    What is missing elsewhere, in commits that nothing leads to, does not count.
    """
    reached = settle(reachable_commits(commits, refs), "reachable")
    parents = F.explode(F.array_compact("parents")).alias("commit_id")
    named = commits.join(reached, ["repo", "commit_id"], "left_semi").select("repo", parents)
    broken = named.join(reached, ["repo", "commit_id"], "left_anti").select("repo").distinct().withColumn("_broken", F.lit(True))
    heads = refs.filter(F.col("commit_id").isNotNull()).select("repo", "commit_id").distinct()
    headed = (
        heads.join(reached.withColumn("_known", F.lit(True)), ["repo", "commit_id"], "left")
        .groupBy("repo")
        .agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias("_known"))
    )
    reason = (
        F.when(F.col("_known").isNull(), "no HEAD").when(~F.col("_known"), "missing HEAD").when(F.col("_broken"), "missing parent")
    )
    judged = repos.join(headed, "repo", "left").join(broken, "repo", "left")
    return judged.select(*repos.columns, reason.alias("reason"))
