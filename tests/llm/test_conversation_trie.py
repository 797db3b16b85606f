"""The trie of conversation prefixes against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from prospectra.llm import conversation_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, name string, n long, depth string"


def brute(rows, branch=True):
    """Nodes by the contract, straight from its words."""
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    paths = {}
    for c in turns:
        order = {k: [x[2:] for x in sorted(turns.get(k, []), key=lambda x: (x[0], x[1], digest(*x[2:])))] for k in {c, int(c - (abs(c) % 20) * (1 if c >= 0 else -1))}}
        h = zlib.crc32(str(c).encode()) % 4 if branch else 0
        trunk = int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        paths[c] = tuple(order[trunk][:h] + order[c][h:]) if h else tuple(order[c])
    members = collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved, ends = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for k, own in members.items():
        value = (len(own) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += value
    for c in sorted(paths):
        ends[paths[c]].append(str(c))
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(ends[k]).encode()).hexdigest()) for k, m in members.items())


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def made(seed, convs=120):
    pick = random.Random(seed)
    texts = ["", "hi", "a b", "tell me more", "é  ü", "x\ty\nz"]
    rows = []
    for c in [*range(-30, convs), 5000, 5001, 10**12]:
        if pick.random() < 0.1:
            continue
        n = pick.choice([1, 1, 2, 3, 5, 9]) if c != 17 else 300
        hot = pick.random() < 0.4
        for t in range(n):
            text = texts[t % 3] if hot else pick.choice([*texts, None])
            rows.append((c, pick.choice([t, t, t, t // 2, None]), pick.choice(["user", "user", None]), text))
    rows += [(None, 1, "user", "lost"), (3, 1, "user", "hi"), (3, 1, "user", "hi")]
    return rows


def nodes(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed, shard", [(1, (20_000, 4096)), (2, (7, 3)), (3, (40, 1000))])
def test_nodes_of_rebuilt_conversations(spark, seed, shard):
    rows = made(seed)
    got = conversation_trie.trie(conversation_trie.branched(conversation_trie.listed(frame(spark, rows))), *shard)
    assert nodes(got) == brute(rows)


def test_nodes_of_conversations_as_they_stand(spark):
    rows = made(4, 40)
    assert nodes(conversation_trie.prefix_trie(frame(spark, rows))) == brute(rows, branch=False)


def test_one_conversation_with_most_turns_and_a_hot_first_turn(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(21, t, "user", f"word {t // 2}") for t in range(900)] + [(c, 0, "system", "the same") for c in range(300)]
        got = conversation_trie.trie(conversation_trie.branched(conversation_trie.listed(frame(spark, rows))), 100, 16)
        assert nodes(got) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tasks_of_a_table_with_many_partitions(spark):
    """Every shuffle that is not needed costs a task per partition."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(21, t, "user", f"word {t // 2}") for t in range(300)] + [(c, t, "user", f"{c % 7} {t}") for c in range(200) for t in range(3)]
        df = frame(spark, rows)
        context.setJobGroup("trie", "trie")
        got = nodes(conversation_trie.trie(conversation_trie.branched(conversation_trie.listed(df)), 100, 16))
        tracker = context.statusTracker()
        stages = {k for job in tracker.getJobIdsForGroup("trie") for k in tracker.getJobInfo(job).stageIds}
        done = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute(rows)
    assert 0 < done < 350  # 472 with an aggregate and joins for each figure of a node


def test_no_conversations(spark):
    for rows in ([], [(None, 1, "user", "a")]):
        df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
        assert nodes(conversation_trie.trie(conversation_trie.branched(conversation_trie.listed(df)))) == []
        assert nodes(conversation_trie.prefix_trie(df)) == []
