import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casewatch.llm import packing
from casewatch.llm.queries import vocabulary_file
from tests.llm.helpers import awkward_documents, documents, tuples


def _library():
    found = Tokenizer.from_file(vocabulary_file())
    found.no_truncation(), found.no_padding()
    return found


def _no_overlap(placed, most):
    """Sequences are filled from 0 without gaps and never beyond their length."""
    by_sequence = {}
    for row in placed.select("row.length", "sequence_id", "offset").collect():
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(by_sequence)


def test_pieces_are_the_librarys_ids(spark):
    texts = {r[0]: r[1] for r in awkward_documents() if r[0] not in (None, 9)}
    frame = documents(spark, extra=("ids", "piece", "length"))
    found = [r for r in packing.pieces(frame, vocabulary_file()).collect() if r.doc_id in texts]
    library = _library()
    for doc, text in texts.items():
        want = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        mine = sorted((r for r in found if r.doc_id == doc), key=lambda r: r.piece)
        ids = [i for r in mine for i in struct.unpack(f"<{r.length}I", r.ids)]
        assert ids == want
        assert [r.start for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))]
        assert all(r.length == 1024 for r in mine[1:]) and 1 <= mine[0].length <= 1024
        assert [r.piece for r in mine] == list(range(len(mine)))


def test_common_texts_take_the_compiled_way_to_the_same_ids():
    library, mine = _library(), packing.fast_encoder(vocabulary_file())
    rng = random.Random(5)
    parts = ["the", " it's", "'LL", "  ", "\n\n", " 12", "éà", "—", "…", "<|endoftext|>", "\t x", "ſt", "日本", "͸", "ß", ". ", "aaaaaa"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        ids = np.frombuffer(mine.encode(text), dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("partition_pieces", [60, 1 << 15])
def test_near_the_bound_and_well_formed(spark, partition_pieces):
    rng = random.Random(11)
    rows = [(k, rng.choice([rng.randrange(1, 200), rng.randrange(300, 700), 1024, 512])) for k in range(3000)] + [(7, 600)] * 3
    items = spark.createDataFrame(rows, "rid long, length long").withColumn("offset", F.lit("x"))
    done = packing.pack(items, partition_pieces=partition_pieces)
    assert _no_overlap(done.placed, 1024) == done.sequences
    assert tuples(done.placed, "row.rid", "row.length") == sorted(rows, key=repr)
    assert done.bound <= done.sequences <= done.bound * 1.01 + 1
    assert tuples(done.placed, "row.rid", "offset") is not None


def test_large_pieces_need_a_sequence_each(spark):
    items = spark.range(500).select((F.lit(513) + F.col("id") % 100).alias("length"))
    done = packing.pack(items, partition_pieces=50)
    assert done.bound == done.sequences == 500


def test_empty_null_and_wrong_lengths(spark):
    empty = packing.pack(spark.createDataFrame([], "length long"))
    assert (empty.placed.count(), empty.sequences, empty.bound) == (0, 0, 0)
    for wrong in (None, 0, 1025):
        with pytest.raises(Exception):
            packing.pack(spark.createDataFrame([(wrong,), (5,)], "length long"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=9))
def test_bound_never_exceeds_the_least_count(lengths):
    def least(rest, bins):
        if not rest:
            return len(bins)
        best = 99
        for k in {b: i for i, b in enumerate(bins)}.values():
            if bins[k] + rest[0] <= 24:
                best = min(best, least(rest[1:], bins[:k] + [bins[k] + rest[0]] + bins[k + 1 :]))
        return min(best, least(rest[1:], bins + [rest[0]]))

    array = np.array(lengths, dtype=np.int64)
    _, _, fill = packing.best_fit_decreasing(array, 24)
    bound = packing.lower_bound(np.bincount(array, minlength=25))
    assert bound <= least(sorted(lengths, reverse=True), []) <= len(fill)
    assert (fill <= 24).all() and fill.sum() == array.sum()


def test_sequences_hold_the_pieces(spark):
    frame = documents(spark)
    cut = packing.pieces(frame, vocabulary_file())
    done = packing.pack(cut)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(done).collect()}
    assert len(whole) == done.sequences and all(len(w) <= 4096 for w in whole.values())
    for r in done.placed.select("row.ids", "sequence_id", "offset").collect():
        assert whole[r.sequence_id][4 * r.offset :].startswith(bytes(r.ids))
    crc = {(r.doc_id, r.piece): r.crc for r in cut.select("doc_id", "piece", F.crc32("ids").alias("crc")).collect()}
    assert crc[(5, 0)] == zlib.crc32(struct.pack("<I", 2))
