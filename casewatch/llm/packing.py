"""Best-fit packing of documents into sequences of bounded length, with certified counts.

Documents become pieces of at most a sequence's length. Full pieces are sequences; the
others are dealt to partitions by a hash, and each partition packs its own best-fit
decreasing. Dual feasible functions give a lower bound of the sequences that a partition
needs. Where the count meets it, only the emptiest sequence is opened again; a partition
with a gap opens its emptiest ones, enough to close it. The documents opened are dealt
to fewer partitions and packed again, until one partition holds all of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from casewatch.llm.bpe import Encoder, encoder
from casewatch.llm.common import checkpoint

LENGTH, END = 1024, 2
PARTITION_PIECES, MAX_ROUNDS = 1 << 15, 12
_ROWS_AT_ONCE, _FAST_LENGTH = 128, 1 << 18


class FastEncoder:
    """Packed ids as `bpe.Encoder` gives them; common texts go through compiled code.

    That code merges any two neighbours whose bytes are a token, the lowest id first. It is
    used only where ids rise with the merges' ranks, and for texts of common characters and
    moderate length, for which its character classes are the same.
    """

    def __init__(self, path: str) -> None:
        self._exact: Encoder = encoder(path)
        ranks, specials, pattern = self._exact.ranks()
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials) if ranks else None

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self._fast is None or len(text) > _FAST_LENGTH or not self._exact.is_common(text):
            return self._exact.encode(text)
        return self._fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


@lru_cache(maxsize=2)
def fast_encoder(path: str) -> FastEncoder:
    """The encoder of a vocabulary file, kept in this worker process for later tasks."""
    return FastEncoder(path)


def pieces(
    documents: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", most: int = LENGTH, end: int = END
) -> DataFrame:
    """doc_id, piece, start, length, ids: each document's ids and the id `end`, in pieces of at most `most`.

    Only longer documents are cut, from their end, so that the first piece may be shorter.
    `ids` holds little-endian unsigned 32-bit numbers. Null and empty texts are the id `end`
    alone. Repeated rows and null ids are documents like any other. Only the named columns
    are read.
    """
    tail, schema = struct.pack("<I", end), "doc_id bigint, piece int, start bigint, length bigint, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = fast_encoder(vocabulary).encode
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                some = batch.slice(at, _ROWS_AT_ONCE)
                rows = []
                for doc, body in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = encode(body) + tail
                    n = len(ids) // 4
                    starts = [0, *range(n % most or most, n, most)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                        rows.append((doc, piece, a, b - a, ids[4 * a : 4 * b]))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])
        pa.default_memory_pool().release_unused()

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, schema)


@lru_cache(maxsize=4)
def _feasible(most: int) -> np.ndarray:
    """Dual feasible functions as rows over lengths 0 to `most`, as shares of a sequence.

    Values of any lengths that fit a sequence add up to at most 1: the length itself; small
    lengths dropped and the large ones that exclude them rounded up to 1; and lengths
    rounded to k-ths of a sequence.
    """
    x = np.arange(most + 1)
    rows = [x / most]
    for k in range(1, most // 2 + 1):
        rows.append(np.where(x > most - k, 1.0, np.where(x < k, 0.0, x / most)))
    for k in range(1, 100):
        rows.append(np.where(x * (k + 1) % most == 0, x / most, (x * (k + 1) // most) / k))
    return np.array(rows)


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that counts[length] pieces need at least; counts has the longest length's place."""
    if not counts.any():
        return 0
    return int(np.ceil((_feasible(len(counts) - 1) @ counts).max() - 1e-6))


def best_fit_decreasing(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and how full each bin is.

    The longest come first, each into the fullest bin with room. Bins are kept by the room
    that they have left; a bit set tells which rooms exist.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms, count = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            held = by_room[room]
            number = held.pop()
            if not held:
                rooms &= ~(1 << room)
        else:
            room, number, count = most, count, count + 1
        bins[i], offsets[i] = number, most - room
        left = room - length
        if left:
            by_room[left].append(number)
            rooms |= 1 << left
    return bins, offsets, np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)


def _reopened(fill: np.ndarray, gap: int, most: int) -> np.ndarray:
    """The emptiest bins, so many that their free room is twice the gap and one more bin, at least one."""
    order = np.argsort(fill, kind="stable")
    room = np.cumsum(most - fill[order])
    n = 1 if gap <= 0 else int(np.searchsorted(room, (2 * gap + 1) * most)) + 1
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[order[:n]] = True
    return chosen & (fill < most)


def _packer(turn: int, last: bool, most: int):
    """A function that packs one partition's rows and marks those whose bins are opened again."""

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid", ignore_index=True)  # a lost task packs the same way again
        lengths = rows["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, most)
        gap = len(fill) - lower_bound(np.bincount(lengths, minlength=most + 1))
        opened = np.zeros(len(fill), dtype=bool) if last else _reopened(fill, gap, most)
        sequence = (turn << 58) + (rows["part"].to_numpy().astype(np.int64) << 24) + bins
        columns = {"rid": rows["rid"], "length": lengths, "sequence_id": sequence, "offset": offsets, "open": opened[bins]}
        return pd.DataFrame(columns)

    return packed


@dataclass(frozen=True)
class Packing:
    """placed: row, sequence_id, offset. sequences: how many; bound: how many are needed at least."""

    placed: DataFrame
    sequences: int
    bound: int


def pack(items: DataFrame, length: str = "length", most: int = LENGTH, partition_pieces: int = PARTITION_PIECES) -> Packing:
    """Packs rows with lengths from 1 to `most` into as few sequences of `most` as it can.

    A sequence's rows follow each other without gaps from offset 0. Sequence ids are any
    numbers. Rows, repeated ones too, are placed one by one; an empty table gives no rows.
    A null length or one outside the range fails. All columns are kept in `row`.
    """
    fits = F.when(F.col(length).between(1, most), F.col(length))
    checked = F.coalesce(fits, F.raise_error(F.lit(f"lengths are 1 to {most}")).cast("bigint")).cast("bigint")
    numbered = items.select(F.struct("*").alias("row"), checked.alias("length"))
    numbered = checkpoint(numbered.withColumn("rid", F.monotonically_increasing_id()))
    counts = np.zeros(most + 1, dtype=np.int64)
    for row in numbered.groupBy("length").agg(F.count("*").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]

    full = numbered.filter(F.col("length") == most)
    done = [full.select("rid", (-F.col("rid") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    left, n_left = numbered.filter(F.col("length") < most).select("rid", "length"), int(counts[:-1].sum())
    for turn in range(MAX_ROUNDS):
        if not n_left:
            break
        partitions = -(-n_left // partition_pieces)
        last = partitions == 1 or turn == MAX_ROUNDS - 1
        dealt = left.withColumn("part", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(partitions)))
        result = dealt.groupBy("part").applyInPandas(
            _packer(turn, last, most), "rid bigint, length bigint, sequence_id bigint, offset bigint, open boolean"
        )
        result = checkpoint(result)
        done.append(result.filter("not open").select("rid", "sequence_id", "offset"))
        left = result.filter("open").select("rid", "length")
        n_left = 0 if last else left.count()
    places = done[0]
    for more in done[1:]:
        places = places.union(more)
    places = checkpoint(places)
    sequences = places.filter("offset = 0").count()
    placed = numbered.join(places, "rid").select("row", "sequence_id", "offset")
    return Packing(placed, sequences, lower_bound(counts))


def sequences(packing: Packing, ids: str = "ids") -> DataFrame:
    """sequence_id, ids: the packed ids of each sequence, for rows that carry theirs."""
    part = F.struct("offset", F.col(f"row.{ids}").alias("ids"))
    whole = packing.placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda so_far, part: F.concat(so_far, part["ids"]))
    return whole.select("sequence_id", joined.alias("ids"))
