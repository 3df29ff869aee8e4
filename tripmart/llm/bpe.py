"""Byte-level BPE with a segment tree over byte positions.

The tree holds, per byte position, the rank of the pair that starts there; its
root is the smallest rank, the leftmost position first.  A merge changes three
leaves (the pair itself, its left and its right neighbour), each in logarithmic
time, so a piece of n bytes costs O(n log n) whatever it looks like.

Texts are numbered by their distinct words, a slice of an Arrow batch at a time.  Pieces
that no word before had are merged together: the trees of all short ones are the rows of
one matrix, and a step merges one pair in each of them.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns, by_position, cut_binary

# Pieces and words kept per Python worker and generation, and the longest one kept.
CACHE_PIECES = 1 << 15
CACHE_CHARS = 64
# Bytes of text that are numbered together; a longer text is numbered alone.
SLICE_BYTES = 1 << 20

# Fixed value: the pattern whose matches never go from one blank-separated word into the
# next, and for which a blank and ASCII letters are one match.  Others are matched in full.
WORDWISE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Runs of letters and numbers younger than Unicode 16.  The tokenizer's own
# pattern engine knows none of them; the regex module here does.
YOUNGER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2),
    (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
_YOUNGER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in YOUNGER) + "]")
# An unassigned code point: neither letter, number nor white space.
_UNASSIGNED = dict.fromkeys((c for a, b in YOUNGER for c in range(a, b + 1)), "\u0378")

_POSITION_BITS = 40
_POSITION = (1 << _POSITION_BITS) - 1
_NO_PAIR = 1 << 80
# Children of a tree node: the least of so many numbers takes one call.
_FAN = 16
_NO_LEAF = np.int64(1 << 62)
# Pieces merged together.
_MERGED = 1 << 12

# White space and what follows it up to the next: no match of the pattern goes from one
# such chunk into the next.  What ``re`` alone takes for white space is left to the pattern.
_CHUNK = re.compile(r"\s*\S+|\s+")
_NOT_SPACE = re.compile("[\x1c-\x1f]")
# What needs a search for chunks: blanks that aren't single or end the text, a blank behind
# a line feed, white space other than blanks and line feeds (for ``re``, that is).
_SEARCHED = (
    "[ \n] | $|^ $|[\t\x0b\f\r\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece; a piece that is a token itself is that token.

    ``levels[0]`` holds (rank, position) of the pair at each position in one number,
    and each further level the smallest of every 16 numbers below: the root is the
    leftmost of the pairs of smallest rank.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank_of = len(piece), ranks.get
    pairs = [
        _NO_PAIR if (rank := rank_of(piece[i : i + 2])) is None else rank << _POSITION_BITS | i
        for i in range(n - 1)
    ]
    levels = [pairs]
    while len(levels[-1]) > _FAN:
        below = levels[-1]
        levels.append([min(below[i : i + _FAN]) for i in range(0, len(below), _FAN)])
    top = levels[-1]
    end = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n))  # where the token left of this start begins
    while (best := min(top)) != _NO_PAIR:
        at = best & _POSITION
        middle = end[at]
        stop = end[at] = end[middle]
        if middle < n - 1:
            pairs[middle] = _NO_PAIR
        pairs[at] = _NO_PAIR
        if stop < n:
            before[stop] = at
            rank = rank_of(piece[at : end[stop]])
            if rank is not None:
                pairs[at] = rank << _POSITION_BITS | at
        left = before[at]
        if at:
            rank = rank_of(piece[left:stop])
            pairs[left] = _NO_PAIR if rank is None else rank << _POSITION_BITS | left
        if len(levels) > 1:
            changed = {max(0, left), at, min(middle, n - 2)}
            for below, above in zip(levels, levels[1:]):
                changed = {i // _FAN for i in changed}
                for i in changed:
                    above[i] = min(below[i * _FAN : (i + 1) * _FAN])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Merger:
    """Token ids of many pieces at once.

    A piece of up to 16 bytes is a row of a matrix, one leaf a byte: (rank, position) of the
    pair of tokens that starts there in one number, so that a row's least number, the root
    over its 16 leaves, is its leftmost pair of smallest rank.  A step merges that pair in
    every row that still has one, and changes the same three leaves as ``merge_piece``.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.complete = min(single) >= 0
        self.single = np.array(single, np.int64)
        # Every way in which two tokens make a third, by both their ids.
        pairs, made = array("q"), array("q")
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.frombuffer(pairs, np.int64) if pairs else np.zeros(0, np.int64))
        self.pairs = np.append(np.array(pairs, np.int64)[order], 1 << 62)
        self.made = np.append(np.array(made, np.int64)[order], 0)

    def leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves of pairs of ids that start at ``at``."""
        pair = left << 32 | right
        found = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[found] == pair, self.made[found] << 8 | at, _NO_LEAF)

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        out = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = struct.pack("<I", whole)
            elif len(piece) <= _FAN and self.complete:
                short.append(i)
            else:
                ids = merge_piece(piece, self.ranks)
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
        # Pieces of like length together: a row is as wide as its longest piece.
        short.sort(key=lambda i: len(pieces[i]))
        for start in range(0, len(short), _MERGED):
            group = short[start : start + _MERGED]
            for i, packed in zip(group, self._merge([pieces[i] for i in group]), strict=True):
                out[i] = packed
        return out

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        n = np.array([len(p) for p in pieces])
        rows, width = len(pieces), int(n.max())
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.single[flat].reshape(rows, width)
        place = np.arange(width)
        inside = place < n[:, None]
        leaves = np.full((rows, width), _NO_LEAF)
        leaves[:, :-1] = self.leaf(ids[:, :-1], ids[:, 1:], place[:-1])
        leaves[:, :-1][~inside[:, 1:]] = _NO_LEAF
        # Where the token that starts here ends, and where the one left of it begins.
        end = np.tile(place + 1, (rows, 1))
        before = np.tile(np.arange(-1, width), (rows, 1))
        live = np.arange(rows)
        while True:
            least = leaves[live].min(axis=1)
            live = live[least != _NO_LEAF]
            if not len(live):
                break
            least = least[least != _NO_LEAF]
            at, merged = least & 255, least >> 8
            middle = end[live, at]
            stop = end[live, middle]
            end[live, at], ids[live, at], before[live, stop] = stop, merged, at
            inside[live, middle] = False
            leaves[live, middle] = _NO_LEAF
            follows = stop < n[live]
            right = ids[live, np.where(follows, stop, 0)]
            leaves[live, at] = np.where(follows, self.leaf(merged, right, at), _NO_LEAF)
            some = np.flatnonzero(at)
            row, here = live[some], at[some]
            left = before[row, here]
            leaves[row, left] = self.leaf(ids[row, left], merged[some], left)
        tokens = ids[inside].astype("<u4").tobytes()
        ends = 4 * np.cumsum(inside.sum(axis=1))
        return [tokens[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Recent:
    """A bounded cache by text: a full generation becomes the older one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value: bytes) -> None:
        if len(key) <= CACHE_CHARS:
            if len(self.young) >= self.limit:
                self.young, self.old = {}, self.young
            self.young[key] = value


class Codec:
    """Packed ids (little-endian unsigned 32 bit) of texts, and the way back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merge = Merger(ranks)
        self.pattern = regex.compile(pattern)
        self.wordwise = pattern == WORDWISE
        self.tokens = pa.array(_by_id(ranks), pa.binary())
        self.by_piece, self.by_chunk = Recent(CACHE_PIECES), Recent(CACHE_PIECES)

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern in any text."""
        if text.isascii() or not _YOUNGER.search(text):
            return self.pattern.findall(text)
        older = text.translate(_UNASSIGNED)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(older)]

    def chunk_pieces(self, chunk: str) -> list[str]:
        """The matches in a chunk; a blank and ASCII letters, and a sign behind, need no search."""
        if self.wordwise and chunk[0] == " " and chunk.isascii():
            if chunk[1:].isalpha():
                return [chunk]
            if chunk[1:-1].isalpha() and chunk[-1] in ",.":
                return [chunk[:-1], chunk[-1]]
        return self.pieces(chunk)

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of distinct chunks; the pieces new to the cache are merged together."""
        out = [self.by_chunk.get(c) for c in chunks]
        missing = [i for i, known in enumerate(out) if known is None]
        split = [self.chunk_pieces(chunks[i]) for i in missing]
        known: dict[str, bytes | None] = {}
        for pieces in split:
            for piece in pieces:
                if piece not in known:
                    known[piece] = self.by_piece.get(piece)
        fresh = [piece for piece, ids in known.items() if ids is None]
        for piece, ids in zip(fresh, self.merge([p.encode() for p in fresh]), strict=True):
            known[piece] = ids
            self.by_piece.put(piece, ids)
        for i, pieces in zip(missing, split, strict=True):
            out[i] = b"".join([known[p] for p in pieces])
            self.by_chunk.put(chunks[i], out[i])
        return out

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text; null and empty texts have none."""
        texts = texts.cast(pa.string()).fill_null("")
        if not len(texts):
            return pa.array([], pa.binary())
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        done, start = [], 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            done.append(self._encode(texts.slice(start, stop - start)))
            start = stop
        return pa.concat_arrays(done)

    def _encode(self, texts: pa.Array) -> pa.Array:
        """Each text as numbers of distinct chunks, whose ids are then put side by side."""
        words = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(words).to_numpy()
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        number = numbered.indices.to_numpy().astype(np.int64)
        stops = np.cumsum(lengths)
        heads = stops - lengths
        # Behind a blank a word starts a chunk; a text's first word has no blank before it.
        # Where blanks aren't single, or other white space is about, chunks are searched for.
        extra: dict[str, int] = {}
        spread = None
        if self.wordwise:
            plain = pc.invert(pc.match_substring_regex(texts, _SEARCHED)).to_numpy(zero_copy_only=False)
        else:
            plain = np.zeros(len(texts), bool)
        number[heads] = [
            len(distinct) + extra.setdefault(distinct[i], len(extra)) for i in number[heads].tolist()
        ]
        if not plain.all():
            spread = []
            for i in np.flatnonzero(~plain).tolist():
                text = texts[i].as_py()
                found = _CHUNK.findall(text) if self.wordwise and not _NOT_SPACE.search(text) else [text]
                spread.append([len(distinct) + extra.setdefault(c, len(extra)) for c in found])
            number, stops = _replaced(number, heads, stops, np.flatnonzero(~plain), spread)
        used = np.zeros(len(distinct) + len(extra), bool)
        used[number] = True
        chunks = [f" {w}" if use else "" for w, use in zip(distinct, used.tolist(), strict=False)]
        chunks += extra
        wanted = [i for i, c in enumerate(chunks) if c and used[i]]
        coded = [b""] * len(chunks)
        for i, ids in zip(wanted, self.chunks([chunks[i] for i in wanted]), strict=True):
            coded[i] = ids
        ids, ends = by_position(coded, number)
        return cut_binary(ids, np.concatenate([[0], ends])[np.concatenate([[0], stops])])

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].as_py()

    def decode_all(self, packed: pa.Array) -> pa.Array:
        """The bytes of each row of packed ids, by one lookup for all of them; null stays null."""
        ids = np.frombuffer(b"".join(p.as_buffer() for p in packed if p.is_valid), "<u4")
        # An id beyond the table would be an index error, one between its tokens a null.
        found = self.tokens.take(pa.array(ids))
        if found.null_count:
            raise ValueError(f"id {ids[found.is_null().to_numpy(zero_copy_only=False)][0]} is no token")
        lengths = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy().astype(np.int64))])
        per_row = pc.binary_length(packed).fill_null(0).to_numpy() // 4
        whole = np.frombuffer(b"".join(found.to_pylist()), np.uint8) if found.offset else _data(found)
        decoded = cut_binary(whole, lengths[np.concatenate([[0], np.cumsum(per_row)])])
        return pc.if_else(packed.is_valid(), decoded, pa.scalar(None, pa.binary()))

    def decode(self, ids: bytes | memoryview) -> bytes:
        return self.decode_all(pa.array([bytes(ids)], pa.binary()))[0].as_py()


def _by_id(ranks: dict[bytes, int]) -> list[bytes | None]:
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _data(found: pa.BinaryArray) -> np.ndarray:
    """The bytes of all values of an array that starts at its buffers' beginning."""
    data = found.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _replaced(
    number: np.ndarray, heads: np.ndarray, stops: np.ndarray, rows: np.ndarray, by: list[list[int]]
) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, stops) with other numbers for some rows."""
    parts, lengths, at = [], stops - heads, 0
    for row, numbers in zip(rows.tolist(), by, strict=True):
        parts += [number[at : heads[row]], np.array(numbers, np.int64)]
        at = stops[row]
    lengths[rows] = [len(numbers) for numbers in by]
    return np.concatenate([*parts, number[at:]]), np.cumsum(lengths)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file; one per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    to: str = "token_ids",
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of whole texts, packed as little-endian 32-bit integers.

    ``path`` is a rank file that every worker has installed.  Each match of
    ``pattern`` is merged on its own; there are no special tokens.  With ``decoded``, a
    column of that name has the bytes that the ids stand for, as ``decode`` gives them.
    Null and empty texts give empty ids; repeated rows are encoded each; columns named like
    the results are replaced and all others stay.  Map-only: memory is one Arrow
    batch and bounded caches of short pieces and words.
    """
    fields = [T.StructField(c, T.BinaryType()) for c in (to, decoded) if c]

    def make():
        one = codec(path, pattern)

        def columns(texts: pa.Array) -> list[pa.Array]:
            packed = one.encode_all(texts)
            return [packed, one.decode_all(packed)] if decoded else [packed]

        return columns

    return append_columns(docs, fields, [text], make)


def decode(
    tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", to: str = "decoded"
) -> DataFrame:
    """The bytes that packed ids stand for; null ids give null."""

    def make():
        run = codec(path, pattern).decode_all
        return lambda packed: [run(packed)]

    return append_columns(tokens, [T.StructField(to, T.BinaryType())], [ids], make)
