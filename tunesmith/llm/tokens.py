"""Token ids of whole texts by a public tokenizer file, with remembered segments.

The byte-level pre-tokenizer never joins a space that stands before a non-space
character with what is left of it, so a text may be cut there and its segments
encoded alone. Most segments repeat: Arrow makes a dictionary of those of some MB of text, each worker
remembers the ids of a bounded number of them, cuts the others into the pre-tokenizer's pieces, and gives
those to the byte-pair model of the tokenizers library. Texts in which the string of an added
token occurs are encoded whole by the library, since that string is cut out before
the pre-tokenizer runs; so are all texts if the file has another pre-tokenizer or a
normalizer.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r" (?=\S)")
_LOADED: dict[str, Encoder] = {}
# Fixed values of byte-level pre-tokenizers: their pattern, and the character that stands for each byte
# (itself where it is printable, else the next free one from 256 on).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
SPACE = chr(BYTE_CHARS[0x20])
PLAIN_FIRST = frozenset(range(0x21, 0x7F))  # bytes with which no white space begins


class Pieces:
    """Remembered ids of pieces, in a young and an old generation of at most ``limit`` entries. A full young
    generation becomes the old one, so what is in use all the time stays."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str, make) -> bytes:
        ids = self.young.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is None:
                ids = make(key)
            if len(self.young) >= self.limit:
                self.young, self.old = {}, self.young
            self.young[key] = ids
        return ids


class Segments:
    """Remembered ids of segments, two generations of at most ``limit`` entries each, as arrays: some 60 bytes an
    entry. An entry is found by a 64-bit hash (of this process) and must have the same checksum."""

    def __init__(self, limit: int, dtype: np.dtype):
        self.limit, self.dtype = limit, dtype
        self.young = self.old = self._none()

    def _none(self) -> tuple:
        return pd.Index(np.empty(0, np.int64)), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.dtype)

    @staticmethod
    def _find(generation: tuple, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index, check = generation[:2]
        if not len(index):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = index.get_indexer(h)
        return at, (at >= 0) & (check[at] == c)

    def ids_of(self, segments: list[bytes], make, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, pool) of distinct segments; ``make(segments)`` gives the ids of those not remembered."""
        n = len(segments)
        h, c = np.fromiter(map(hash, segments), np.int64, n), np.fromiter(map(zlib.crc32, segments), np.uint32, n)
        starts, lengths, pools, base = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0
        missing, promoted = np.arange(n), np.empty(0, np.int64)
        for generation in (self.young, self.old):
            at, hit = self._find(generation, h[missing], c[missing])
            some, at = missing[hit], at[hit]
            starts[some], lengths[some] = generation[2][at] + base, generation[3][at]
            pools.append(generation[4])
            base += len(generation[4])
            missing = missing[~hit]
            promoted = some
        made = make([segments[i] for i in missing.tolist()])
        lengths[missing] = np.fromiter(map(len, made), np.int64, len(made)) // self.dtype.itemsize
        starts[missing] = base + np.cumsum(lengths[missing]) - lengths[missing]
        pool = np.concatenate([*pools, np.frombuffer(b"".join(made), self.dtype)])
        small = np.array([len(segments[i]) <= longest for i in missing.tolist()], bool)
        self._keep(np.concatenate([promoted, missing[small]]), h, c, starts, lengths, pool)
        return starts, lengths, pool

    def _keep(self, new: np.ndarray, h: np.ndarray, c: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray) -> None:
        _, first = np.unique(h[new], return_index=True)  # two segments of one hash: only one is remembered
        new = new[first]
        new = new[self.young[0].get_indexer(h[new]) < 0] if len(self.young[0]) else new
        if not len(new):
            return
        index, check, at, size, ids = self.young
        added = spans(starts[new], lengths[new])
        each = lengths[new]
        self.young = (
            pd.Index(np.concatenate([index.to_numpy(), h[new]])), np.concatenate([check, c[new]]), np.concatenate([at, len(ids) + np.cumsum(each) - each]),
            np.concatenate([size, each]), np.concatenate([ids, pool[added]]),
        )
        if len(self.young[0]) > self.limit:
            self.young, self.old = self._none(), self.young


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    upto = np.cumsum(lengths)
    return np.repeat(starts - (upto - lengths), lengths) + np.arange(int(upto[-1]) if len(upto) else 0)


class Encoder:
    def __init__(self, path: str, remembered: int = 400_000, longest: int = 48):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.vocab_size <= 1 << 16 else np.dtype("<u4")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_parts = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
        self.longest = longest
        self.pieces = regex.compile(PIECES)
        self.segments = Segments(remembered, self.dtype)
        self.parts = Pieces(remembered // 32)  # pieces of segments that are more than letters

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            # Of printable ASCII only the space is written by another character.
            chars = piece.replace(" ", SPACE) if piece.isprintable() else piece.translate(BYTE_CHARS)
        else:
            chars = piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return array(self.code, [t.id for t in self.model.tokenize(chars)]).tobytes()

    def _several(self, text: str) -> bytes:
        """The ids of a stretch that begins at a piece's border."""
        return b"".join([self.parts.get(p, self._piece) if len(p) <= self.longest else self._piece(p) for p in self.pieces.findall(text)])

    def _segments(self, segments: list[bytes]) -> list[bytes]:
        """The ids of segments that stand after a space."""
        out = []
        for raw in segments:
            if raw.isalpha():  # ASCII letters alone are one piece
                out.append(array(self.code, [t.id for t in self.model.tokenize(SPACE + raw.decode())]).tobytes())
                continue
            segment = raw.decode()
            out.append(self._piece(" " + segment) if segment.isalpha() else self._several(" " + segment))
        return out

    def encode_column(self, texts: pa.Array, part_bytes: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, offsets) for runs of about ``part_bytes`` of a string column: row first + i has
        ids[offsets[i]:offsets[i + 1]], as the library gives them without special tokens; null has none."""
        texts = texts.cast(pa.large_string())
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            before = int(sizes[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, before + part_bytes, side="right")))
            yield first, *self._part(texts.slice(first, last - first))
            first = last

    def _part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        n = len(texts)
        lists = pc.split_pattern(texts, " ")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
        heads = np.concatenate([[0], ends])[:n].astype(np.int64)  # places of the texts' first segments, which stand after no space
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        where, segments = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_binary()).to_pylist()
        within = np.ones(len(where), bool)
        within[heads] = False

        alone = np.full(n, not self.by_parts)
        for a in self.added:
            alone |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        # A space before white space or the end belongs to no segment: such texts are cut by a pattern.
        loose = np.array([not x or x[0] not in PLAIN_FIRST and x.decode()[0].isspace() for x in segments], bool)
        cut = np.zeros(n, bool)
        cut[np.searchsorted(ends, np.flatnonzero(within & loose[where]), side="right")] = True

        special = alone | cut
        usable = within & ~np.repeat(special, np.diff(np.concatenate([[0], ends])))
        needed = np.zeros(len(segments), bool)
        needed[where[usable]] = True
        at = np.flatnonzero(needed)
        starts, lengths = np.zeros(len(segments), np.int64), np.zeros(len(segments), np.int64)
        starts[at], lengths[at], pool = self.segments.ids_of([segments[i] for i in at.tolist()], self._segments, self.longest)

        # A text's first segment stands after no space. Those of special texts stand for all of their ids, their others for none.
        own, begins = [b""], {}
        where[~usable] = nothing = len(segments)
        first = coded.indices.to_numpy()[heads]
        for i, kind in enumerate(zip(alone.tolist(), cut.tolist(), strict=True)):
            if any(kind):
                text = texts[i].as_py()
                where[heads[i]] = nothing + len(own)
                own.append(self._whole(text) if kind[0] else self._cut_text(text))
                continue
            head = int(first[i])
            if head not in begins:
                begins[head] = nothing + len(own)
                own.append(self._several(segments[head].decode()))
            where[heads[i]] = begins[head]
        more = np.fromiter(map(len, own), np.int64, len(own)) // self.dtype.itemsize
        starts = np.concatenate([starts, len(pool) + np.cumsum(more) - more])
        lengths = np.concatenate([lengths, more])
        pool = np.concatenate([pool, np.frombuffer(b"".join(own), self.dtype)])

        each = lengths[where]
        upto = np.concatenate([[0], np.cumsum(each)])
        return pool[spans(starts[where], each)], upto[np.concatenate([[0], ends])]

    def _cut_text(self, text: str) -> bytes:
        head, *rest = _CUT.split(text)
        return b"".join([self._several(head), *self._segments([x.encode() for x in rest])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the library gives them without special tokens."""
        return [ids[a:b] for _, ids, offsets in self.encode_column(pa.array(texts, pa.string())) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
