"""Text blocks, tokens and row keys that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, functions as F

BLOCK_BYTES = 1 << 20
STRETCH = 1 << 22
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}

# Token bytes: ASCII letters and digits, and every byte of a longer UTF-8 sequence.
TOKEN_BYTES = np.zeros(256, dtype=bool)
TOKEN_BYTES[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = True
TOKEN_BYTES[128:] = True


def row_key(text: str = "text") -> Column:
    """A hash that, beside doc_id, tells rows with the same doc_id apart."""
    return F.xxhash64(F.col(text))


def blocks(texts: list, size: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts in UTF-8, gathered until ``size`` bytes are reached; null counts as empty."""
    first, held, total = 0, [], 0
    for at, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if held and total + len(raw) > size:
            yield first, held
            first, held, total = at, [], 0
        held.append(raw)
        total += len(raw)
    if held:
        yield first, held


def joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, a line end after each, and where each one starts (one entry more)."""
    starts = np.zeros(len(raws) + 1, dtype=np.int64)
    np.cumsum([len(raw) + 1 for raw in raws], out=starts[1:])
    return np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8), starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(inside) + 2, dtype=np.int8)
    padded[1:-1] = inside
    edges = np.flatnonzero(np.diff(padded))
    return edges[0::2], edges[1::2]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=_U64)
            table[0] = 1
            _POWERS[name] = np.cumprod(table, dtype=_U64)
    return _POWERS["up"], _POWERS["down"]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    values = values ^ (values >> _U64(32))
    values = values * _U64(0xD6E8FEB86659FD93)
    return values ^ (values >> _U64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, read off one rolling polynomial over all bytes.

    ``starts`` rise. Long texts are gone through in stretches, so that the
    polynomial's eight bytes per byte of text stay small; only a span longer
    than a stretch makes a longer one.
    """
    out = np.empty(len(starts), dtype=_U64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + STRETCH, "right"))) if len(data) > STRETCH else len(starts)
        last = int(ends[at:to].max())
        piece, up, down = data[first:last], *_powers(last - first + 1)
        rolling = np.zeros(len(piece) + 1, dtype=_U64)
        np.cumsum((piece.astype(_U64) + _U64(1)) * up[: len(piece)], out=rolling[1:])
        out[at:to] = (rolling[ends[at:to] - first] - rolling[starts[at:to] - first]) * down[starts[at:to] - first]
        at = to
    return mixed(out)


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the tokens in (lower-cased) bytes."""
    starts, ends = runs(TOKEN_BYTES[data])
    return starts, ends, span_hashes(data, starts, ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` tokens; none when there are fewer tokens."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U64)
    value = np.zeros(n, dtype=_U64)
    for at in range(k):
        value = value * _U64(_BASE) + hashes[at : at + n]
    return mixed(value)


def small_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
