import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.llm import prefix_trie as trie
from casewatch.llm.slots import SlotTable
from tests.llm.helpers import tuples

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The nodes, from whole prefixes in a dict."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], leaves[path],
             saved[path], hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest())
            for path, convs in members.items()
        ),
        key=repr,
    )


def awkward():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 3 if t < 4 else c} é😀") for c in range(90, 330, 7) for t in range(c % 9)]
    rows += [(c, t, "user", f"copy {t}") for c in (100, 200, 700, 701, 702, 703) for t in range(7)]
    rows += [(400, t, "user", f"long {t}") for t in range(400)] + [(403, t, "user", f"long {t}") for t in range(390)]
    rows += [(None, 0, "user", "lost"), (500, None, None, None), (500, None, "a", None), (500, 1, None, ""), (500, 1, None, "")]
    rows += [(501, 2, "x", "1:y"), (502, 2, "x1:", "y"), (-105, 1, "user", "minus"), (-100, 1, "user", "minus"), (900, 0, "u", "z" * 40_000)]
    return rows


@pytest.mark.parametrize("shard_turns", [7, 100_000])
def test_equals_brute_force_also_over_many_shards(spark, shard_turns):
    rows = awkward()
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(5).withColumn("node", F.lit("x")).withColumn("shard", F.lit(1))
    assert tuples(trie.prefix_trie(frame, shard_turns=shard_turns), *COLUMNS) == brute(rows)


def test_one_shape_of_conversation_held_by_most(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1800) for t in range(3)] + [(5, 0, "user", "other")]
    assert tuples(trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS), shard_turns=100), *COLUMNS) == brute(rows)


def test_empty_table_and_only_null_ids(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], CONVERSATIONS)).count() == 0


def test_slots_are_minimal_and_verified():
    keys = np.random.default_rng(3).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    table = SlotTable(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))
    assert (table.slots(keys + np.uint64(1)) == -1).all()
    assert len(SlotTable(keys[:0]).slots(keys)) == 5000 and (SlotTable(keys[:0]).slots(keys) == -1).all()
    with pytest.raises(ValueError):
        SlotTable(np.concatenate([keys, keys[:1]]))
