"""Words and their hashes, for functions that Spark runs on Arrow batches.

A word is a run of bytes other than the blanks 0x20 and 0x09 to 0x0D, which is what ``bytes.split``
gives. Lower-casing touches A-Z only. Whole texts are read; a batch is worked off in pieces so that
memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are tokenised at a time.
PIECE_BYTES = 1 << 21

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def pieces(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Consecutive texts of about PIECE_BYTES together; a longer text comes alone."""
    piece, size = [], 0
    for text in texts:
        length = len(text or b"")
        if piece and size + length > PIECE_BYTES:
            yield piece
            piece, size = [], 0
        piece.append(text)
        size += length
    if piece:
        yield piece


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def tokens(texts: list[bytes | None], lower: bool = True, edge: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): those of text i are hashes[bounds[i]:bounds[i + 1]]. ``edge`` opens and closes every text."""
    words: list[bytes] = []
    bounds = [0]
    for text in texts:
        if edge is not None:
            words.append(edge)
        if text:
            words += (text.lower() if lower else text).split()
        if edge is not None:
            words.append(edge)
        bounds.append(len(words))
    return word_hashes(words), np.array(bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all of them."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def ngrams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of n words inside each text, with their bounds."""
    total = len(hashes) - n + 1
    if n == 1 or total <= 0:
        return (hashes, bounds) if n == 1 else (np.empty(0, np.uint64), np.zeros(len(bounds), np.int64))
    joined = hashes[:total]
    for j in range(1, n):
        joined = mix(joined * _MULTIPLIER + hashes[j : total + j])
    inside = np.ones(total, bool)
    for j in range(1, n):
        last = bounds[1:] - j
        inside[last[(last >= 0) & (last < total)]] = False
    lengths = np.maximum(np.diff(bounds) - n + 1, 0)
    return joined[inside], np.concatenate(([0], np.cumsum(lengths)))


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence that is shorter than a window."""
    joined = hashes[:1] + np.uint64(len(hashes))
    for j in range(len(hashes)):
        joined = mix(joined * _MULTIPLIER + hashes[j])
    return joined
