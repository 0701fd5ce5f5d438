"""Exact integer products with the floating-point matrix product: operands are cut into limbs of few bits.

A product of limbs, summed over all dimensions, stays below 2^53, where float64 holds every whole number; the products of
limbs are put together in 64-bit integers, which wrap around as integers do, so any true result that fits a long is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

MANTISSA_BITS = 53


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or hold a null or non-finite component."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.when(F.forall(vector, finite), F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int | None = None) -> np.ndarray:
    """Rows of a list column as int64, shorter ones filled with zeros to ``dims`` (by default the longest row)."""
    values = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    if not len(values):
        return np.zeros((0, dims or 0), np.int64)
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max()) if dims is None else dims), np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _bits(x: np.ndarray) -> int:
    """Bits of the largest magnitude."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0))).bit_length()


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` as float64 limbs of ``bits`` bits each, lowest first: all but the last from 0 up, the last with the sign."""
    out = []
    while _bits(x) > bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def _check_range(a: np.ndarray, b: np.ndarray) -> None:
    """Raise where a product of rows may pass a long."""
    if _bits(a) + _bits(b) + a.shape[1].bit_length() > 62 and len(a) and len(b):
        about = np.abs(a).astype(np.float64) @ np.abs(b).astype(np.float64).T
        if about.max() >= 2.0**62:
            raise OverflowError("inner products beyond 2^62")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` for int64 matrices of the same width, exact; results beyond 2^62 are an error."""
    _check_range(a, b)
    room = MANTISSA_BITS - max(1, a.shape[1]).bit_length()
    bits_a, bits_b = _bits(a), _bits(b)
    if bits_a + bits_b <= room:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    # The operand with few bits stays whole if that leaves the other one limbs of some size.
    small = min(bits_a, bits_b)
    one, other = (small, room - small) if small <= room // 2 else (room // 2, room // 2)
    cut_a, cut_b = (one, other) if bits_a <= bits_b else (other, one)
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, cut_a)):
        for j, y in enumerate(limbs(b, cut_b)):
            shift = i * cut_a + j * cut_b
            if shift < 64:
                total += (x @ y.T).astype(np.int64) << shift
    return total


def squares(a: np.ndarray) -> np.ndarray:
    """Squared length of every row."""
    if 2 * _bits(a) + a.shape[1].bit_length() > 62 and len(a) and (a.astype(np.float64) ** 2).sum(1).max() >= 2.0**62:
        raise OverflowError("squared lengths beyond 2^62")
    return np.einsum("ij,ij->i", a, a)
