"""Exact byte-pair encoding by dynamic programming over prefixes.

For each prefix of a piece there is just one token that can end its encoding: the
vocabulary token that ends there and is compatible with the last token of the prefix
before it. A suffix automaton over the vocabulary tells which tokens end at each place.
Two tokens are compatible if merging their joint bytes would never merge across the
boundary; this is read off the merges along the boundary and no text is merged.
Back-pointers from the end give the ids.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

# The pre-tokeniser's pattern, with its white space written out.
_WHITE = r"\t-\r \x85\xa0  -     　"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


def _common_pieces() -> tuple[re.Pattern, re.Pattern]:
    """PIECES for texts of Latin letters and usual punctuation only, and what finds other characters.

    The standard library's patterns are twice as fast, but know no character properties,
    so letters and digits are written out for the characters below U+0250.
    """
    known = [chr(c) for c in range(0x250)]
    letters, numbers = ("".join(c for c in known if unicodedata.category(c)[0] == kind) for kind in "LN")
    pieces = (
        rf" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?(?:[{numbers}]+|[^{_WHITE}{letters}{numbers}]+)"
        rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
    )
    return re.compile(pieces), re.compile("[^\\x00-\u024F\u2010-\u2027]")


NEVER = 1 << 62
#: Bounds of what a worker keeps from one task to the next: some 150 MB at most.
_CACHED_PIECES, _CACHED_LENGTH, _CACHED_PAIRS, _CACHED_STEPS = 300_000, 32, 400_000, 100_000
_ROWS_AT_ONCE = 256  # bounds what a worker holds besides its input
_LISTED_LENGTH = 1 << 20  # the pieces of longer texts are not put into a list


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class _Pairs(dict):
    """Whether two tokens (as first * size + second) may stand side by side; emptied when full."""

    def __init__(self, meet, size: int) -> None:
        super().__init__()
        self._meet, self._size = meet, size

    def __missing__(self, pair: int) -> bool:
        if len(self) >= _CACHED_PAIRS:
            self.clear()
        fits = self[pair] = self._meet(*divmod(pair, self._size))
        return fits


class SuffixAutomaton(dict):
    """From (state * 256 + byte) to the state of the longest suffix that starts a token.

    ending[state] holds the tokens that end in a state, longest first. Steps that are no
    step of the trie follow suffix links; a bounded number of them is remembered.
    """

    def __init__(self, tokens: dict[bytes, int]) -> None:
        super().__init__()
        own, levels = [-1], []
        for data, token in tokens.items():
            state = 0
            for depth, byte in enumerate(data):
                key = state << 8 | byte
                state = self.get(key, 0)
                if not state:
                    state = self[key] = len(own)
                    own.append(-1)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append((state, key))
            own[state] = token
        self._links = links = [0] * len(own)
        self.ending: list[tuple[int, ...]] = [()] * len(own)
        for state, key in (x for level in levels for x in level):
            parent, byte = key >> 8, key & 255
            link = links[parent]
            while link and (link << 8 | byte) not in self:
                link = links[link]
            links[state] = self.get(link << 8 | byte, 0) if parent else 0
            shorter = self.ending[links[state]]
            self.ending[state] = (own[state], *shorter) if own[state] >= 0 else shorter
        self._most = len(self) + _CACHED_STEPS

    def __missing__(self, key: int) -> int:
        state = key >> 8
        to = self[self._links[state] << 8 | key & 255] if state else 0
        if len(self) < self._most:
            self[key] = to
        return to


class _Pieces(dict):
    """Packed ids by piece, computed when missing. When full, pieces not met since it was last full go."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            found = self._encode(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_PIECES:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes and decodes with a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self._refuse_unknown(stored)
        model, to_byte = stored["model"], byte_alphabet()
        ids: dict[str, int] = model["vocab"]
        specials = {t["content"]: t["id"] for t in stored["added_tokens"]}
        size = max([*ids.values(), *specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        for content, i in specials.items():
            self.bytes_of[i] = content.encode()
        self._specials = specials
        self._special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")
        self._rank: dict[int, int] = {}
        self._size = size
        # the merge that makes a token: its parts and rank, -1 for single bytes
        self._left, self._right, self._made = [-1] * size, [-1] * size, [-1] * size
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = ids[left], ids[right]
            self._rank[a * size + b] = rank
            made = ids[left + right]
            self._left[made], self._right[made], self._made[made] = a, b, rank
        self._whole: dict[bytes, int] = {}
        reached: set[int] = set()
        for i in sorted(set(ids.values()), key=self._made.__getitem__):
            # a token that merging its own bytes doesn't give is never part of an encoding
            a, b, rank = self._left[i], self._right[i], self._made[i]
            if rank < 0 or ({a, b} <= reached and self._meet(a, b, rank)):
                reached.add(i)
                self._whole[self.bytes_of[i]] = i
        self._automaton = SuffixAutomaton(self._whole)
        self._lengths = [len(b) for b in self.bytes_of]
        self._pairs = _Pairs(self._meet, size)
        self._pieces = _Pieces(self._encode_piece)
        self._pattern = regex.compile(PIECES)
        self._common, self._other = _common_pieces()

    @staticmethod
    def _refuse_unknown(stored: dict) -> None:
        before, model = stored["pre_tokenizer"] or {}, stored["model"]
        plain = (
            model["type"] == "BPE"
            and stored["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before["use_regex"]
            and not before["add_prefix_space"]
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t[k] for t in stored["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError("only plain byte-level BPE files are understood")

    def _meet(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether no merge of a rank below `before` joins a part of a with a part of b.

        The merges that made a and b are undone along the boundary, the latest first. At
        equal rank the right one is the later, as merging goes from left to right. Each
        pair that met on the boundary would have merged, had its rank come before the
        merges that ended its parts.
        """
        rank, made, size = self._rank, self._made, self._size
        a_ends = b_ends = NEVER
        while True:
            merge = rank.get(a * size + b)
            if merge is not None and merge < before and merge < a_ends and merge <= b_ends:
                return False
            if made[a] > made[b]:
                a, a_ends = self._right[a], made[a]
            elif made[b] >= 0:
                b, b_ends = self._left[b], made[b]
            else:
                return True

    def _encode_piece(self, piece: bytes) -> list[int]:
        whole = self._whole.get(piece)
        if whole is not None:
            return [whole]
        last, state = [0] * (len(piece) + 1), 0
        step, ending = self._automaton, self._automaton.ending
        lengths, fits, size = self._lengths, self._pairs, self._size
        for end, byte in enumerate(piece, 1):
            state = step[state << 8 | byte]
            for token in ending[state]:
                start = end - lengths[token]
                if not start or fits[last[start] * size + token]:
                    last[end] = token
                    break
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= lengths[last[at]]
        return ids[::-1]

    def _encode_plain(self, text: str) -> bytes:
        pattern = self._common if self.is_common(text) else self._pattern
        if len(text) <= _LISTED_LENGTH:
            return b"".join(map(self._pieces.__getitem__, pattern.findall(text)))
        return b"".join(self._pieces[m[0]] for m in pattern.finditer(text))

    def is_common(self, text: str) -> bool:
        """Whether a text consists of Latin letters and usual punctuation only."""
        return self._other.search(text) is None

    def ranks(self) -> tuple[dict[bytes, int], dict[str, int], str]:
        """Bytes and ids of the tokens that merging gives, special tokens, and the pattern of pieces.

        No tokens if ids do not rise with the merges' ranks.
        """
        merged = sorted((self._made[i], i) for i in self._whole.values() if self._made[i] >= 0)
        rising = all(a[1] < b[1] for a, b in zip(merged, merged[1:]))
        singles = max((i for i in self._whole.values() if self._made[i] < 0), default=-1)
        rising = rising and (not merged or singles < merged[0][1]) and len(self._whole) == len(set(self._whole.values()))
        return (dict(self._whole) if rising else {}), dict(self._specials), PIECES

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers; null is empty."""
        text, found, at = text or "", [], 0
        for special in self._special.finditer(text):
            found.append(self._encode_plain(text[at : special.start()]))
            found.append(struct.pack("<I", self._specials[special[0]]))
            at = special.end()
        return b"".join([*found, self._encode_plain(text[at:])])

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; byte sequences that are no UTF-8 give U+FFFD."""
        tokens = np.frombuffer(ids or b"", dtype="<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, kept in this worker process for later tasks."""
    return Encoder(path)


def _mapped(rows: DataFrame, source: str, target: T.StructField, make) -> DataFrame:
    """`rows` packed in a column `row`, with `target` computed from the column `source`."""
    packed = rows.select(F.struct("*").alias("row"), F.col(source).alias("source"))
    ids_of = F.pandas_udf(make, target.dataType).asNondeterministic()  # so that it runs once for all its uses
    return packed.select("row", ids_of("source").alias(target.name))


def encode(documents: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(row, ids) per document: the input's columns, and the token ids of the whole text.

    `ids` holds little-endian unsigned 32-bit numbers, exactly what the tokenizers library
    returns for add_special_tokens=False without truncation. Null and empty texts have
    no ids. Texts may be of any length: time and memory grow with the longest piece.
    """

    def make(texts: pd.Series) -> pd.Series:
        use = encoder(vocabulary)
        return pd.Series([use.encode(t) for t in texts], dtype=object)

    return _mapped(documents, text, T.StructField("ids", T.BinaryType()), make)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """(row, text) for packed ids; special tokens are not skipped. Null ids give an empty text."""

    def make(packed: pd.Series) -> pd.Series:
        use = encoder(vocabulary)
        return pd.Series([use.decode(None if p is None else bytes(p)) for p in packed], dtype=object)

    return _mapped(rows, ids, T.StructField("text", T.StringType()), make)


def token_counts(documents: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a digest of encoding and round trip.

    Both directions run in one worker, so that ids do not travel back to be decoded.
    """

    def trip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                some = batch.slice(at, _ROWS_AT_ONCE)
                ids = [use.encode(t) for t in some.column("text").to_pylist()]
                columns = [some.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(use.decode, ids), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])
        pa.default_memory_pool().release_unused()

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    trips = rows.mapInArrow(trip, "doc_id bigint, ids binary, decoded string")
    return trips.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
