import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from casewatch.llm import bpe
from casewatch.llm.queries import vocabulary_file

from .helpers import awkward_documents, documents, prose, tuples

PATH = vocabulary_file()


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(PATH)


def same(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    packed = own.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids, text
    assert own.decode(packed) == library.decode(ids, skip_special_tokens=False), text


@given(st.text(max_size=80))
@settings(max_examples=500, deadline=None)
def test_any_text(library, own, text):
    same(library, own, text.encode("utf-8", "ignore").decode())


@given(st.text(alphabet="ab A'stlldm  \n\t 　\x85\x1c12é!?<|endoftext|>", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_spaces_contractions_and_special_tokens(library, own, text):
    same(library, own, text)


def test_repeats_and_long_pieces(library, own):
    rng = random.Random(2)
    for n in (1, 2, 3, 5, 8, 100, 3001):
        for unit in ("a", "ab", " ", "\n", "é", "\U0001F600", "aab"):
            same(library, own, unit * n)
    for _ in range(3000):
        same(library, own, "".join(rng.choice("aAo. \n") for _ in range(rng.randrange(60))))
    same(library, own, prose(3, 20_000))
    same(library, own, "x" * 60_000)
    same(library, own, prose(4, 200_000))


def test_each_token_encodes_to_itself_or_is_never_used(library, own):
    rng = random.Random(5)
    for i in rng.sample(range(50_256), 4000):
        text = own.bytes_of[i].decode("utf-8", "ignore")
        same(library, own, text)


def test_table(spark, library):
    rows = awkward_documents()
    found = bpe.token_counts(documents(spark, rows, ("ids", "row", "source_")), PATH)
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert tuples(found) == sorted(expected, key=repr)
    whole = bpe.decode(bpe.encode(documents(spark, rows), PATH).select("row.text", "ids"), PATH)
    assert all((r[0] or "") == r[1] for r in tuples(whole, "row.text", "text"))
    assert tuples(bpe.token_counts(documents(spark, []), PATH)) == []


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    stored = json.load(open(PATH, encoding="utf-8"))
    stored["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "v.json").write_text(json.dumps(stored))
    with pytest.raises(ValueError):
        bpe.Encoder(str(tmp_path / "v.json"))


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED_PIECES", 50)
    monkeypatch.setattr(bpe, "_CACHED_PAIRS", 50)
    encoder = bpe.Encoder(PATH)
    text = prose(8, 3000)
    assert encoder.decode(encoder.encode(text)) == text
    assert max(len(encoder._pieces), len(encoder._pairs)) <= 50
