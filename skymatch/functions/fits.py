"""Images as FITS bytes: headers of 80-character cards and big-endian pixels, both in records of 2,880 bytes."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np

RECORD, CARD = 2880, 80


def card(name: str, value: bool | int | float | str | None) -> bytes:
    """One card; a number that is not finite has no value there."""
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, int):
        text = f"{value:>20}"
    elif isinstance(value, float) and math.isfinite(value):
        text = f"{value!r:>20}".replace("e", "E")
    elif isinstance(value, str):
        text = "'" + value.replace("'", "''").ljust(8) + "'"
    else:
        text = ""
    line = f"{name:<8}= {text}".encode("ascii", "replace")
    if len(line) > CARD:
        raise ValueError(f"the card {name} is too long")
    return line.ljust(CARD)


def _padded(data: bytes, fill: bytes) -> bytes:
    return data + fill * (-len(data) % RECORD)


def unit(pixels: np.ndarray, header: Mapping[str, bool | int | float | str | None], name: str | None = None) -> bytes:
    """Header and pixels (rows from below) of one image: the first of a file, or a named extension."""
    first = [card("SIMPLE", True)] if name is None else [card("XTENSION", "IMAGE")]
    cards = [*first, card("BITPIX", -64), card("NAXIS", 2), card("NAXIS1", int(pixels.shape[1])), card("NAXIS2", int(pixels.shape[0]))]
    cards += [card("EXTEND", True)] if name is None else [card("PCOUNT", 0), card("GCOUNT", 1), card("EXTNAME", name)]
    cards += [card(k, v) for k, v in header.items()]
    return _padded(b"".join(cards) + b"END".ljust(CARD), b" ") + _padded(np.ascontiguousarray(pixels, dtype=">f8").tobytes(), b"\x00")


def image_file(pixels: np.ndarray, header: Mapping[str, bool | int | float | str | None], **extensions: np.ndarray) -> bytes:
    """A whole file: an image and named extensions of pixels alone."""
    return unit(pixels, header) + b"".join(unit(x, {}, name.upper()) for name, x in extensions.items())


def first_pixels(data: bytes) -> np.ndarray:
    """Pixels of the first image of a file that :func:`image_file` made."""
    cards: list[str] = []
    while not cards or not cards[-1].startswith("END "):
        cards.append(data[len(cards) * CARD : (len(cards) + 1) * CARD].decode("ascii"))
    last = len(cards) - 1
    sizes = {line[:8].strip(): int(line[10:]) for line in cards[:last] if line.startswith("NAXIS")}
    begin = -(-(last + 1) * CARD // RECORD) * RECORD
    n = sizes["NAXIS1"] * sizes["NAXIS2"]
    return np.frombuffer(data, dtype=">f8", count=n, offset=begin).reshape(sizes["NAXIS2"], sizes["NAXIS1"])
