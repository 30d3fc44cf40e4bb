"""Word splitting and hashing of whole Arrow text columns with numpy.

Helpers for `mapInArrow` functions: texts are worked on as UTF-8 bytes, a few megabytes at a time, so
that memory does not follow the number or the sum of the texts in a batch (one text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xC2B2AE3D27D4EB4F)
_K3 = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D  # odd: one differing word always changes the sum
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


@dataclass(frozen=True)
class Rule:
    """Which bytes belong to words, and to what each byte is mapped first."""

    is_word: np.ndarray
    mapped: np.ndarray | None


def _letters_and_digits() -> Rule:
    mapped = np.arange(256, dtype=np.uint8)
    mapped[ord("A") : ord("Z") + 1] += 32
    inside = np.zeros(256, dtype=bool)
    inside[ord("0") : ord("9") + 1] = True
    inside[ord("a") : ord("z") + 1] = True
    inside[0x80:] = True
    return Rule(inside, mapped)


def _non_space() -> Rule:
    inside = np.ones(256, dtype=bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return Rule(inside, None)


#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z were lower-cased; every byte of a non-ASCII character is inside.
LOWERED = _letters_and_digits()
#: `[^\x20\x09-\x0D]+`, unchanged.
NON_SPACE = _non_space()


@dataclass(frozen=True)
class Words:
    """The words of some texts: byte ranges, and per text the index of its first word (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with some `limit` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    offsets = _offsets(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (one more at the end); null is an empty text."""
    offsets = _offsets(texts)
    buffer = texts.buffers()[2]
    low, high = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(buffer, dtype=np.uint8)[low:high] if buffer is not None else np.zeros(0, np.uint8)
    offsets = offsets - low
    if texts.null_count:  # a null may still hold bytes
        empty = texts.is_null().to_numpy(zero_copy_only=False)
        sizes = np.where(empty, 0, np.diff(offsets))
        keep = np.repeat(~empty, np.diff(offsets))
        raw, offsets = raw[keep], np.concatenate(([0], np.cumsum(sizes)))
    return raw, offsets


def split(texts: pa.Array, rule: Rule) -> Words:
    """Words of each text."""
    raw, offsets = text_bytes(texts)
    data = raw if rule.mapped is None else rule.mapped[raw]
    inside = rule.is_word[data]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = edges[edges > 0] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    values = (values ^ (values >> np.uint64(32))) * _K3
    values = (values ^ (values >> np.uint64(29))) * _K2
    return values ^ (values >> np.uint64(32))


def hashes(words: Words) -> np.ndarray:
    """64-bit hash of each word's bytes, eight bytes at a time."""
    lengths = words.ends - words.starts
    out = lengths.astype(np.uint64) * _K2
    if not len(lengths):
        return out
    padded = np.concatenate((words.data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(words.data) + 1,), strides=(1,))
    rest = np.arange(len(lengths))
    at = 0
    while len(rest):
        left = np.minimum(lengths[rest] - at, 8)
        value = eight[words.starts[rest] + at] & _MASKS[left]
        out[rest] = mixed(out[rest] ^ (value + _K1) * _K2)
        at += 8
        rest = rest[lengths[rest] > at]
    return out


def grams(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` consecutive values from each position; the last `size - 1` positions have none."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, done = np.zeros(len(values), np.uint64), 0
    power, width = values, 1
    while size:  # doubling: a run of 2m values from two runs of m
        if size & 1:
            total = total[: len(total) - width] * _power(width) + power[done : done + len(total) - width] if done else power.copy()
            done += width
        size >>= 1
        if size:
            power = power[: len(power) - width] * _power(width) + power[width:]
            width *= 2
    return mixed(total[:count])


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_BASE, exponent, 1 << 64))


def whole(starts: np.ndarray, words: Words, size: int) -> np.ndarray:
    """Which of the positions have `size` words left in their text."""
    ends = words.first[1:][np.searchsorted(words.first, starts, side="right") - 1]
    return starts + size <= ends


def full_positions(words: Words, size: int) -> np.ndarray:
    """For each word, whether a run of `size` words starts there inside one text."""
    ends = np.repeat(words.first[1:], words.counts)
    return np.arange(len(ends)) + size <= ends


def signed(values: np.ndarray) -> np.ndarray:
    """As Spark's bigint."""
    return values.view(np.int64)


def listed(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists of the given sizes over flat values."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
