"""Counting quotient filters: compact, lossless counters of whole numbers.

A number of ``bits`` bits is mixed by an invertible permutation, so that the mixed
numbers spread evenly and nothing is lost. A filter keeps mixed numbers in order, each
split into a quotient (its high bits) and the full remainder. The quotients are two bit
vectors, one of those that occur and one of the last slot of each run of equal
quotients; the remainders lie in slots of whole bytes; a counter is a byte, and those
beyond it stand in a list behind. Filters are sorted, so merging them is one merge of
sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<BBQQ")  # bits, bytes of a remainder, entries, large counters
# Odd, so that they have inverses modulo any power of two.
FACTORS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def mix(numbers: np.ndarray, bits: int) -> np.ndarray:
    """A permutation of the numbers below ``2**bits``."""
    half, mask = np.uint64((bits + 1) // 2), _mask(bits)
    for factor in FACTORS:
        numbers = (numbers * np.uint64(factor)) & mask
        numbers = numbers ^ (numbers >> half)  # its own inverse, as the half is not less than half the bits
    return numbers


def unmix(mixed: np.ndarray, bits: int) -> np.ndarray:
    half, mask = np.uint64((bits + 1) // 2), _mask(bits)
    for factor in reversed(FACTORS):
        mixed = mixed ^ (mixed >> half)
        mixed = (mixed * np.uint64(pow(factor, -1, 1 << 64))) & mask
    return mixed


def count(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    mixed = np.sort(mixed)
    first = np.ones(len(mixed), bool)
    first[1:] = mixed[1:] != mixed[:-1]
    at = np.flatnonzero(first)
    return mixed[at], np.diff(np.append(at, len(mixed)))


def pack(mixed: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of distinct numbers below ``2**bits``, in order, with their counts."""
    n = len(mixed)
    wide = -(-max(0, bits - n.bit_length()) // 8)  # bytes of a remainder; about a quotient for each entry
    quotients = mixed >> np.uint64(8 * wide) if 8 * wide < bits else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << max(0, bits - 8 * wide), bool)
    occupied[quotients] = True
    run_ends = np.ones(n, bool)
    run_ends[:-1] = quotients[1:] != quotients[:-1]
    slots = mixed.astype("<u8").view(np.uint8).reshape(n, 8)[:, :wide]
    large = counts >= 255
    return b"".join((HEADER.pack(bits, wide, n, int(large.sum())), np.packbits(occupied).tobytes(),
                     np.packbits(run_ends).tobytes(), np.ascontiguousarray(slots).tobytes(),
                     np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<u8").tobytes()))


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers (uint64) in order, and their counts (int64)."""
    bits, wide, n, n_large = HEADER.unpack_from(blob)
    at = HEADER.size

    def taken(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(blob, np.uint8, size, at - size)

    n_quotients = 1 << max(0, bits - 8 * wide)
    quotients = np.flatnonzero(np.unpackbits(taken(-(-n_quotients // 8)), count=n_quotients)).astype(np.uint64)
    run_ends = np.unpackbits(taken(-(-n // 8)), count=n)
    mixed = np.zeros((n, 8), np.uint8)
    mixed[:, :wide] = taken(n * wide).reshape(n, wide)
    mixed = mixed.reshape(-1).view("<u8")
    if 8 * wide < bits:
        mixed = mixed | (quotients[np.cumsum(run_ends) - run_ends] << np.uint64(8 * wide))
    counts = taken(n).astype(np.int64)
    counts[counts == 255] = taken(8 * n_large).view("<u8")
    return mixed, counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers of all filters in order, their summed counts, and for each entry given its place among them."""
    mixed = np.concatenate([m for m, _ in filters])
    counts = np.concatenate([c for _, c in filters])
    order = np.argsort(mixed, kind="stable")  # merges runs that are sorted already
    ordered = mixed[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(first)
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(first) - 1
    return ordered[at], np.add.reduceat(counts[order], at) if len(at) else counts, places
