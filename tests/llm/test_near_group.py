"""Near-dedup of one large group of copies, each edited in its own way, down to the later rounds."""

import random

import pytest

from sparkloom.llm import minmax_dedup
from tests.llm import brute


@pytest.fixture(scope="module")
def group():
    """Copies with one to nine words replaced, some of them cut at the end, some edited twice over; the central text itself is left out."""
    pick = random.Random(5)
    base = [f"w{pick.randrange(900)}" for _ in range(240)]
    docs = []
    for i in range(90):
        words = list(docs[-1][1].split()) if i % 7 == 6 else list(base)
        for _ in range(1 + i % 9):
            words[pick.randrange(len(words))] = f"own{pick.randrange(10**6)}"
        if i % 5 == 4:
            words = words[: pick.randrange(205, 240)]
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("percent", [80, 85])
def test_components_of_the_group(spark, group, percent):
    frame = spark.createDataFrame(group, "doc_id long, text string")
    got = {(r.id, r.n_shingles, r.component_id) for r in minmax_dedup.near_components(frame, percent).collect()}
    assert got == {tuple(r[:3]) for r in brute.near([(i, t) for i, t in group], percent)}


def test_slices_never_rule_out_what_is_shared(spark, group):
    texts = spark.createDataFrame([(i, t.encode()) for i, t in group], "id long, text binary")
    counted = minmax_dedup.private_counts(texts).collect()
    assert len(counted) == len(group)
    sets = {i: set(minmax_dedup.shingles(t.encode()).tolist()) for i, t in group}
    for r in counted:
        others = set().union(*(s for i, s in sets.items() if i != r.id))
        assert r.own == len(sets[r.id] - others) and sum(r.slices) == len(sets[r.id]) - r.own
    by_id = {r.id: r.slices for r in counted}
    pairs = [(x, y, by_id[x], by_id[y]) for x in sets for y in sets if x < y]
    most = spark.createDataFrame(pairs, "x long, y long, a array<int>, b array<int>").select("x", "y", minmax_dedup.most_common("a", "b").alias("most")).collect()
    assert all(len(sets[r.x] & sets[r.y]) <= r.most for r in most)
    assert sum(r.most - len(sets[r.x] & sets[r.y]) for r in most) < 12 * len(most)  # and close to it


def test_members_are_compared_with_their_bucket_once(spark):
    """The join of _open makes a row for each member at most, in all plans that read it together."""
    rows = [(b, i, 100, i % 3, 100, 0) for b in range(4) for i in range(150)] + [(9, 1, 100, 7, 100, 0), (9, 2, 100, 7, 100, 0), (9, 3, 100, 7, 10, 0)]
    members = spark.createDataFrame(rows, "bucket long, id long, n long, c long, shared long, extra long")
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    old = store.executionsList().size()
    left = minmax_dedup._open(members, 80).collect()
    bus.waitUntilEmpty(30_000)
    assert {(r.bucket, r.id) for r in left} == {(r[0], r[1]) for r in rows if r[0] < 9}  # bucket 9 has one component
    made = 0
    for i in range(old, store.executionsList().size()):
        run = store.executionsList().apply(i).executionId()
        nodes, metrics = store.planGraph(run).allNodes(), store.executionMetrics(run)
        for node in (nodes.apply(k) for k in range(nodes.size())):
            if "Join" in node.name() and ">=" in node.desc():
                found = [node.metrics().apply(k) for k in range(node.metrics().size())]
                made += sum(int(metrics.apply(m.accumulatorId()).replace(",", "")) for m in found if m.name() == "number of output rows")
    assert 600 <= made <= len(rows)
