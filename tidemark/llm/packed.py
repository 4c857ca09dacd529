"""Sorted keys as compressed blobs, and runs of equal keys in sorted batches."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one compressed blob, byte planes apart so that equal bytes meet."""
    import zstandard

    parts = [len(arrays).to_bytes(4, "little")]
    for x in arrays:
        planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
        parts += [x.dtype.str.encode().ljust(4), len(x).to_bytes(8, "little"), planes]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blob: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 4, []
    for _ in range(int.from_bytes(raw[:4], "little")):
        kind, n = np.dtype(raw[at : at + 4].strip().decode()), int.from_bytes(raw[at + 4 : at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def deltas(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=U(0))


def cut_points(keys: np.ndarray, slices: int) -> np.ndarray:
    width = U(64 - (slices.bit_length() - 1))
    starts = np.arange(1, slices, dtype=U) << width
    return np.r_[0, np.searchsorted(keys, starts), len(keys)]


def group_runs(batches, column: int = 0):
    """Rows of each run of equal values in a sorted column, over batch borders: (value, rows)."""
    value, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
            if held and row[column] != value:
                yield value, held
                held = []
            value = row[column]
            held.append(row)
    if held:
        yield value, held
