"""Static binary-fuse filters over 64-bit keys, in NumPy.

A key has three slots in three neighbouring segments and a fingerprint of eight bits; the
table is filled so that the three slots of every member combine to its fingerprint. About
nine bits a key; a key that is no member passes with chance 1/256, a member always does.
A filter is built once over a fixed set of keys and never changed.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from shelfrank.llm.hashing import mixed

_U = np.uint64
_HEAD = "<QIIQ"
# Construction fails with a small chance for a seed; a set that fails this often holds a defect.
SEEDS = 200


def _shape(keys: int) -> tuple[int, int]:
    """Length of a segment, a power of two, and number of segments a first slot can lie in."""
    if keys < 2:
        return 4, 1
    length = 1 << min(int(math.log(keys) / math.log(3.33) + 2.25), 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(keys))
    return length, max(math.ceil(keys * factor / length) - 2, 1)


def _slots(keys: np.ndarray, seed: int, length: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(three slots of each key, fingerprint of each key)"""
    value = mixed(keys + _U(seed))
    first = ((value >> _U(32)) * _U(length * count)) >> _U(32)
    second = (first + _U(length)) ^ ((value >> _U(18)) & _U(length - 1))
    third = (first + _U(2 * length)) ^ (value & _U(length - 1))
    mark = (value ^ (value >> _U(32))).astype(np.uint8)
    return np.stack([first, second, third]).astype(np.int64), mark


def _peeled(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each holds alone), or nothing if some keys never get one."""
    keys = np.arange(slots.shape[1])
    count = np.zeros(size, dtype=np.int64)
    holder = np.zeros(size, dtype=np.int64)
    for row in slots:
        np.add.at(count, row, 1)
        np.bitwise_xor.at(holder, row, keys)
    rounds, left = [], len(keys)
    single = np.flatnonzero(count == 1)
    while len(single):
        found, at = np.unique(holder[single], return_index=True)
        rounds.append((found, single[at]))
        left -= len(found)
        touched = slots[:, found].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(holder, touched, np.tile(found, 3))
        touched = np.unique(touched)
        single = touched[count[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of 64-bit keys as bytes; repeated keys count once."""
    keys = np.unique(keys.astype(_U, copy=False))
    length, count = _shape(len(keys))
    for attempt in range(SEEDS):
        seed = int(mixed(np.array([attempt + 1], dtype=_U))[0])
        slots, mark = _slots(keys, seed, length, count)
        rounds = _peeled(slots, (count + 2) * length)
        if rounds is not None:
            break
    else:
        raise ValueError("no seed gives every key a slot of its own")
    table = np.zeros((count + 2) * length, dtype=np.uint8)
    # Later rounds first: then the two other slots of a key no longer change.
    for found, own in reversed(rounds):
        table[own] = 0
        one, two, three = (table[row] for row in slots[:, found])
        table[own] = mark[found] ^ one ^ two ^ three
    return struct.pack(_HEAD, seed, length, count, len(keys)) + table.tobytes()


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """For each key whether it may be a member; no member is ever missed."""
    seed, length, count, members = struct.unpack_from(_HEAD, filter_bytes)
    if not members:
        return np.zeros(len(keys), dtype=bool)
    table = np.frombuffer(filter_bytes, dtype=np.uint8, offset=struct.calcsize(_HEAD))
    slots, mark = _slots(keys.astype(_U, copy=False), seed, length, count)
    one, two, three = (table[row] for row in slots)
    return (one ^ two ^ three) == mark
