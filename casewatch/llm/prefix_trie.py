"""The trie of conversation prefixes, from conversations that share their first turns.

A turn becomes a digest and a length; texts are read once and never shuffled. Turns are
sorted over ranges of (conversation, turn), so that a conversation of any length is
spread over tasks. A prefix's digest is a polynomial in its turns' digests modulo a
127-bit prime: digests of parts are joined by one multiplication, which carries them
over the borders of ranges and lets a conversation's own turns follow borrowed ones.

Distinct prefixes are the trie's nodes. What is summed over subtrees starts at the
conversation with a node's smallest id, and goes up that conversation's path: each shard
(a range of conversations) holds whole paths, gives its prefixes slots of a minimal
perfect hash table, scatters the numbers into flat arrays and adds them up through
parent slots, the deepest first. What shards find for a node adds up to its total. A
conversation over several shards hands the sums of its deeper turns to its last turn in
each shard above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from casewatch.llm.common import checkpoint
from casewatch.llm.slots import SlotTable, keys_of

GROUP, HEAD = 100, 6  # conversations a base lends turns to; a borrowed head is shorter than HEAD
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
ROOT = bytes(16)
SHARD_TURNS = 100_000
_IDS_AT_ONCE = 1 << 16


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big")


def _digest(number: int) -> bytes:
    return (number % PRIME).to_bytes(16, "big")


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, item (the turn's digest), chars."""
    who, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    return conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("item"),
        F.length(said).cast("bigint").alias("chars"),
    )


def _scanned(turns: DataFrame, shard_turns: int) -> DataFrame:
    """conv_id, shard, first, place, upto, item, chars: turns in order, counted within conversation and shard.

    A shard is a run of up to `shard_turns` turns; shards are numbered in the turns' order.
    `first` marks the turns of a shard's first conversation, which may have begun before.
    `upto` is the digest of the conversation's turns in this shard up to this one.
    """
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("item")]
    ranges = turns.repartitionByRange(*by).sortWithinPartitions(*by)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, seen, place, power, total = None, True, 0, 0, 1, 0
        shard = (TaskContext.get().partitionId() + 1) << 32
        for batch in batches:
            shards, firsts, places, upto = [], [], [], []
            for conv, item in zip(batch.column("conv_id").to_pylist(), batch.column("item").to_pylist()):
                if seen == shard_turns:
                    shard, first, seen, place, power, total, now = shard + 1, True, 0, 0, 1, 0, conv
                elif conv != now:
                    first, place, power, total, now = seen == 0, 0, 1, 0, conv
                seen += 1
                place += 1
                power = power * BASE % PRIME
                total = (total + power * _number(item)) % PRIME
                shards.append(shard)
                firsts.append(first)
                places.append(place)
                upto.append(_digest(total))
            columns = [batch.column("conv_id"), pa.array(shards, pa.int64()), pa.array(firsts, pa.bool_())]
            columns += [pa.array(places, pa.int64()), pa.array(upto, pa.binary()), batch.column("item"), batch.column("chars")]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["conv_id", "shard", "first", "place", "upto", "item", "chars"]
    return ranges.mapInArrow(
        scan, "conv_id bigint, shard bigint, first boolean, place bigint, upto binary, item binary, chars bigint"
    )


@pandas_udf(T.BinaryType())
def _joined(before: pd.Series, count: pd.Series, upto: pd.Series) -> pd.Series:
    """The digest of `count` turns with digest `before`, followed by turns with digest `upto`."""
    found = []
    for b, n, u in zip(before, count, upto):
        moved = u if not n else _digest(_number(b) + pow(BASE, int(n), PRIME) * _number(u))
        found.append(bytes(moved))
    return pd.Series(found, dtype=object)


@pandas_udf(T.BinaryType())
def _spliced(base: pd.Series, own: pd.Series, moved: pd.Series, upto: pd.Series) -> pd.Series:
    """The digest of a borrowed head and a conversation's turns up to `upto` without its first, digest `own`.

    `moved` is how many places those turns move, which is 0 or less.
    """
    back = [pow(BASE, -m, PRIME) for m in range(HEAD)]
    found = [_digest(_number(b) + back[-m] * (_number(u) - _number(o))) for b, o, m, u in zip(base, own, moved, upto)]
    return pd.Series(found, dtype=object)


@pandas_udf(T.BinaryType())
def _without_last(whole: pd.Series, length: pd.Series, item: pd.Series) -> pd.Series:
    """The digest of a prefix of `length` turns without its last turn."""
    found = [_digest(_number(w) - pow(BASE, int(n), PRIME) * _number(i)) for w, n, i in zip(whole, length, item)]
    return pd.Series(found, dtype=object)


def _carried(parts: pd.DataFrame) -> pd.DataFrame:
    """Number and digest of the turns before each shard of one conversation."""
    rows, count, total = [], 0, 0
    for row in parts.sort_values("shard").itertuples(index=False):
        rows.append((row.conv_id, row.shard, count, _digest(total)))
        total += pow(BASE, count, PRIME) * _number(row.upto)
        count += row.turns
    return pd.DataFrame(rows, columns=["conv_id", "shard", "turns_before", "digest_before"])


def _numbered(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with `at` (from 1) and `upto` over the whole conversation, and the parts of long ones.

    A conversation in several shards crosses a border between shards, so its parts are at
    most as many as the shards. Parts that continue a conversation get shards of their own,
    with numbers below zero, so that they meet no other conversation there.
    """
    ends = scanned.groupBy("conv_id", "shard").agg(F.max(F.struct("place", "upto")).alias("end"))
    parts = checkpoint(ends.select("conv_id", "shard", F.col("end.place").alias("turns"), F.col("end.upto").alias("upto")))
    split = parts.groupBy("conv_id").agg(F.count("*").alias("shards")).filter("shards > 1")
    long = parts.join(split, "conv_id").groupBy("conv_id").applyInPandas(
        _carried, "conv_id bigint, shard bigint, turns_before bigint, digest_before binary"
    )
    long = checkpoint(long)
    same = scanned.filter("not first").select("conv_id", "shard", F.col("place").alias("at"), "upto", "item", "chars")
    placed = scanned.filter("first").join(long, ["conv_id", "shard"], "left")
    before = F.coalesce("turns_before", F.lit(0))
    own_shard = F.when(before > 0, -F.col("shard")).otherwise(F.col("shard"))
    moved = placed.select(
        "conv_id", own_shard.alias("shard"), (F.col("place") + before).alias("at"),
        _joined(F.coalesce("digest_before", F.lit(ROOT)), before, F.col("upto")).alias("upto"), "item", "chars",
    )
    own_shard = F.when(F.col("turns_before") > 0, -F.col("shard")).otherwise(F.col("shard"))
    return checkpoint(same.union(moved)), long.select("conv_id", own_shard.alias("shard"), "turns_before")


def _plans(numbered: DataFrame) -> DataFrame:
    """Per conversation: its base's first turns as `lent`, how many own turns they replace, digests of both."""
    head = F.when(F.col("at") < HEAD, F.struct("at", "upto", "item", "chars"))
    own = numbered.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(head)).alias("head"), F.count("*").alias("turns"), F.min_by("shard", "at").alias("shard")
    )
    own = checkpoint(own.withColumn("base_id", F.expr(f"conv_id - conv_id % {GROUP}")))
    base = own.filter("conv_id = base_id").select("base_id", F.col("head").alias("lent"))
    both = own.join(base, "base_id", "left")
    replaced = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD)).cast("int")
    both = both.withColumn("replaced", replaced)
    lent = F.slice(F.coalesce("lent", F.slice("head", 1, 0)), 1, F.col("replaced"))

    def upto(turns: Column) -> Column:
        return F.coalesce(F.try_element_at(turns, F.lit(-1))["upto"], F.lit(ROOT))

    plans = both.select("conv_id", "shard", "turns", "replaced", lent.alias("lent"), F.slice("head", 1, F.col("replaced")).alias("gone"))
    return plans.select(
        "conv_id", "shard", "replaced", "lent",
        (F.size("lent") + F.greatest(F.col("turns") - F.col("replaced"), F.lit(0))).cast("bigint").alias("length"),
        upto(F.col("lent")).alias("lent_digest"), upto(F.col("gone")).alias("gone_digest"),
    )


def _paths(numbered: DataFrame, plans: DataFrame) -> DataFrame:
    """A row per conversation and prefix: conv_id, shard, depth, node, item, parent, chars, ends."""
    moved = (F.size("lent") - F.col("replaced")).alias("moved")
    known = plans.select("conv_id", "replaced", "length", "lent_digest", "gone_digest", moved)
    own = numbered.join(known, "conv_id").filter("at > replaced")
    own = own.select(
        "conv_id", "shard", (F.col("at") + F.col("moved")).alias("depth"),
        _spliced("lent_digest", "gone_digest", "moved", "upto").alias("node"), "item", "chars", "length",
    )
    borrowed = plans.select("conv_id", "shard", F.explode("lent").alias("turn"), "length").select(
        "conv_id", "shard", F.col("turn.at").alias("depth"), F.col("turn.upto").alias("node"), "turn.item", "turn.chars", "length"
    )
    turns = own.union(borrowed).withColumn("parent", _without_last("node", "depth", "item"))
    root = plans.select(
        "conv_id", "shard", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("node"), F.lit(ROOT).alias("item"),
        F.lit(0).cast("bigint").alias("chars"), "length", F.lit(None).cast("binary").alias("parent"),
    )
    paths = turns.select(root.columns).union(root)
    return paths.select("conv_id", "shard", "depth", "node", "item", "chars", "parent", (F.col("depth") == F.col("length")).alias("ends"))


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per distinct prefix, with the conversation and shard that it starts from.

    Prefixes with one digest must have one last turn and one parent, so all their turns
    are equal; else the run fails.
    """
    first = F.min(F.struct("conv_id", "shard")).alias("first")
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("depth", "item", "parent", "chars")]
    verified = F.when(same[0] & same[1] & same[2] & same[3], F.count("*"))
    found = paths.groupBy("node").agg(
        first, F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("chars").alias("chars"),
        F.coalesce(verified, F.raise_error(F.lit("two prefixes have one digest")).cast("bigint")).alias("n_convs"),
    )
    found = checkpoint(found)
    children = found.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    counted = found.join(children.withColumnRenamed("parent", "node"), "node", "left")
    return checkpoint(
        counted.select(
            "node", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("first.conv_id").alias("conv_id"), F.col("first.shard").alias("shard"),
            F.when(F.col("n_children") > 0, 0).otherwise(1).cast("bigint").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )
    )


def _subtree_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the part of the trie that one shard holds; rows of one node are added."""
    keys = keys_of(rows["node"].map(bytes).tolist())
    _, firsts = np.unique(np.ascontiguousarray(keys).view("V16").ravel(), return_index=True)
    table = SlotTable(keys[firsts])
    slot = table.slots(keys)
    depth, parent = np.zeros(len(table), dtype=np.int64), np.full(len(table), -1, dtype=np.int64)
    depth[slot] = rows["depth"].to_numpy()
    above = rows["parent"].iloc[firsts]
    has = above.notna().to_numpy()
    parent[slot[firsts[has]]] = table.slots(keys_of(above[has].map(bytes).tolist()))
    sums = np.zeros((len(table), 2), dtype=np.int64)
    np.add.at(sums, slot, rows[["leaves", "saved"]].to_numpy(dtype=np.int64))
    order = np.argsort(-depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[order])) + 1
    for same in np.split(order, levels):
        up = same[parent[same] >= 0]
        np.add.at(sums, parent[up], sums[up])
    digests = rows["node"].iloc[firsts]
    return pd.DataFrame({"node": digests, "leaves": sums[slot[firsts], 0], "saved": sums[slot[firsts], 1]})


def _deposits(paths: DataFrame, nodes: DataFrame, long: DataFrame) -> DataFrame:
    """For conversations over several shards: their sums in deeper shards, at their last turn in each.

    Where all of a conversation's turns in its first shard are replaced, the root is its last node there.
    """
    mine = nodes.join(long.select("conv_id", "shard"), ["conv_id", "shard"], "left_semi")
    starts = mine.groupBy("conv_id", "shard").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    lasts = paths.join(long.select("conv_id", "shard"), ["conv_id", "shard"], "left_semi")
    lasts = lasts.groupBy("conv_id", "shard").agg(F.max(F.struct("depth", "node", "parent")).alias("last"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("turns_before")).rowsBetween(Window.unboundedPreceding, -1)
    both = long.join(lasts, ["conv_id", "shard"]).join(starts, ["conv_id", "shard"], "left")
    return both.select(
        "shard", "last.node", "last.depth", "last.parent",
        F.sum("leaves").over(deeper).alias("leaves"), F.sum("saved").over(deeper).alias("saved"),
    ).fillna(0, ["leaves", "saved"])


def _ends(paths: DataFrame) -> DataFrame:
    """node, ends: the SHA-256 of the ids of conversations that end in a node, in order, joined by commas.

    Ids are joined over ranges of (node, conversation), some thousand at a time, so a node
    in which very many end reaches the task that hashes it as few rows, which it streams.
    """
    by = ["node", "conv_id"]
    ranges = checkpoint(paths.filter("ends").select(by)).repartitionByRange(*by).sortWithinPartitions(*by)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, done = None, [], []

        def flush(*rows):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["node", "first", "ids"])

        for batch in batches:
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if (node != now or len(ids) == _IDS_AT_ONCE) and ids:
                    done.append((now, ids[0], ",".join(map(str, ids))))
                    ids = []
                now = node
                ids.append(conv)
            if done:
                yield flush(*done)
                done = []
        if ids:
            yield flush((now, ids[0], ",".join(map(str, ids))))

    chunks = ranges.mapInArrow(join, "node binary, first bigint, ids string")

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == now:
                    state.update(b"," + ids.encode())
                else:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["node", "ends"])

    spread = chunks.repartition("node").sortWithinPartitions("node", "first")
    return spread.mapInArrow(hash_all, "node binary, ends string")


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations: node, conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first h turns of conversation c - c % 100 (h is
    crc32(c) % 6) and its own turns after its first h. Turns follow their number, null first;
    turns with one number follow the digest of role and text, repeated rows stay. Null roles
    and texts are empty. Rows without a conv_id belong to no conversation and are left out;
    a table without conversations has no nodes, not even a root. Only the named columns are
    read, so other columns may have any name.
    """
    turns = checkpoint(_turns(conversations, conv_id, turn, role, text))
    scanned = checkpoint(_scanned(turns, shard_turns))
    numbered, long = _numbered(scanned)
    plans = checkpoint(_plans(numbered))
    paths = checkpoint(_paths(numbered, plans))
    nodes = _nodes(paths)

    own = nodes.select("shard", "node", "depth", "parent", "leaves", "saved")
    zero = F.lit(0).cast("bigint")
    held = paths.select("shard", "node", "depth", "parent", zero.alias("leaves"), zero.alias("saved"))
    shards = held.union(own).union(_deposits(paths, nodes, long).select(own.columns))
    sums = shards.groupBy("shard").applyInPandas(_subtree_sums, "node binary, leaves bigint, saved bigint")
    totals = sums.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    described = nodes.join(parents, "parent", "left").join(totals, "node").join(_ends(paths), "node", "left")
    return described.select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
