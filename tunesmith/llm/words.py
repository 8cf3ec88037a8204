"""Words of whole texts as bytes, for the operators that count or score words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Bytes of a text whose words are listed at a time, so that a very long text needs little memory.
PIECE_BYTES = 1 << 20

WHITE = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
# Maximal runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased:
# every other ASCII byte becomes a space.
_TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each row of a string column."""
    return column.cast(pa.binary()).to_pylist()


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of ``data`` between white space, in lists of about ``size`` bytes; no word is cut."""
    at = 0
    while len(data) - at > size:
        # Cut at the last white space of the piece, or, if it has none, at the next one.
        cut = max(data.rfind(w, at, at + size) for w in WHITE)
        if cut < 0:
            cut = min((i for w in WHITE if (i := data.find(w, at + size)) >= 0), default=len(data))
        yield data[at:cut].split()
        at = cut + 1
    yield data[at:].split()


def terms(data: bytes | None) -> Iterator[list[bytes]]:
    """The lower-cased terms of a text, piece by piece; null has none."""
    return pieces((data or b"").translate(_TERMS))


def words(data: bytes | None) -> Iterator[list[bytes]]:
    r"""The words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, piece by piece; null has none."""
    return pieces((data or b"").lower())
