"""Periodic runs of words, and texts without the repetitions.

A run is a stretch of consecutive words with smallest period `q` and at least `max(min_length, 2 q)` words that no
neighbouring word extends. Two places of a text are a maximal pair if the words from them on agree as far as
their common prefix goes, and the words before them differ. A maximal pair at a distance of no more than its common
prefix spans a stretch with that distance as a period, which nothing extends: the maximal pairs that satisfy the
length constraints are the runs, without any extension.

The suffixes of a text are sorted by doubling ranks, and the intervals of common prefixes are closed bottom-up.
Each interval merges the occurrence lists of its children, the smaller into the larger, where every occurrence has
the class of the word to its left. Neighbours in the merged list that come from different children and are of
different classes are its maximal pairs. Pairs that are not neighbours need no look: an occurrence between two
that are no further apart than their prefix gives a smaller period. So each interval costs as much as its smaller
children, however often a phrase occurs.

Only texts in which `min_length / 2` words in a row come again go through this; a hash of those words, which can
let more texts through but never hold one back, tells them apart. Words are compared by value.

Defined results: words are `[^\\x20\\x09-\\x0D]+`. A null, empty or blank text has no words, no runs and an empty
collapsed text. Each row is a text of its own, whatever its id; other columns pass through, and the added ones
(`n_words`, `runs`, `collapsed`) replace columns of these names. An empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm import words as W

MIN_LENGTH = 12
ADDED = ["n_words", "runs", "collapsed"]
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
# From so many occurrences on, numpy merges faster than lists.
_MANY = 64


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of a text in the order of the words from there on, and the ranks by the first 1, 2, 4, ... words.

    A rank is the number of smaller suffixes; -1 stands for the end of the text. Each round only sorts places
    that still share their rank.
    """
    size = len(ids)
    order = np.argsort(ids, kind="stable")
    ranked = ids[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    rank = np.empty(size + 1, np.int32)
    rank[order] = np.repeat(begins, np.diff(np.append(begins, size)))
    rank[size] = -1
    levels, width = [rank], 1
    same = np.diff(np.append(begins, size)) > 1
    open_places = order[np.repeat(same, np.diff(np.append(begins, size)))]
    while len(open_places):
        key = rank[open_places].astype(np.int64) * (size + 2) + rank[np.minimum(open_places + width, size)] + 1
        by = np.argsort(key, kind="stable")
        open_places, key = open_places[by], key[by]
        old = rank[open_places]
        at = np.arange(len(by))
        new_group = np.concatenate(([True], old[1:] != old[:-1]))
        new_part = np.concatenate(([True], key[1:] != key[:-1]))
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        part_at = np.maximum.accumulate(np.where(new_part, at, 0))
        rank = rank.copy()
        rank[open_places] = old + (part_at - group_at)
        levels.append(rank)
        width *= 2
        alone = new_part & np.append(new_part[1:], True)
        open_places = open_places[~alone]
    order = np.empty(size, np.int64)
    order[rank[:size]] = np.arange(size)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix has in common with the one before it in the order; 0 for the first."""
    size = len(order)
    left, right = order[:-1].copy(), order[1:].copy()
    total = np.zeros(size, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        equal = (rank[left] == rank[right]).astype(np.int64) << level
        total[1:] += equal
        left += equal
        right += equal
    return total


def _neighbours(children: list[list[int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """The merged occurrences of an interval, and those next to each other that come from different children."""
    children.sort(key=len)
    large, small = children[-1], children[:-1]
    count = sum(map(len, small))
    if count == 1:  # a place more
        place = small[0][0]
        at = bisect_left(large, place)
        pairs = []
        if at:
            pairs.append((large[at - 1], place))
        if at < len(large):
            pairs.append((place, large[at]))
        large.insert(at, place)
        return large, pairs
    owner = {place: n for n, child in enumerate(small) for place in child}
    if 8 * count < len(large):
        for place in owner:
            insort(large, place)
        pairs = set()
        for place in owner:
            at = bisect_left(large, place)
            for one, other in ((at - 1, at), (at, at + 1)):
                if 0 <= one and other < len(large) and owner.get(large[one], -1) != owner.get(large[other], -1):
                    pairs.add((large[one], large[other]))
        return large, list(pairs)
    if count + len(large) < _MANY:
        merged = sorted([*large, *owner])
        return merged, [(x, y) for x, y in zip(merged, merged[1:]) if owner.get(x, -1) != owner.get(y, -1)]
    places = np.concatenate([np.array(child, np.int64) for child in children])
    owners = np.repeat(np.arange(len(children)), [len(child) for child in children])
    by = np.argsort(places, kind="stable")
    places, owners = places[by], owners[by]
    at = np.flatnonzero(owners[1:] != owners[:-1])
    return places.tolist(), list(zip(places[at].tolist(), places[at + 1].tolist()))


def periodic_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs of a text of word numbers as (start, length, period), by start, then period."""
    least = max(1, -(-min_length // 2))
    if len(ids) < 2:
        return []
    order, levels = suffixes(ids)
    shared = common_prefixes(order, levels)
    deep = shared >= least
    kept = deep | np.append(deep[1:], False)
    left = np.concatenate(([-1], ids)).tolist()  # class of a place: the word before it
    found: list[tuple[int, int, int]] = []

    def closed(prefix: int, children: list[list[int]]) -> list[int]:
        merged, pairs = _neighbours(children)
        for x, y in pairs:
            period = y - x
            if period <= prefix and period + prefix >= min_length and left[x] != left[y]:
                found.append((x, period + prefix, period))
        return merged

    stack: list[tuple[int, list[list[int]]]] = []
    node: list[int] = []
    for place, prefix in zip(order[kept].tolist(), np.where(deep, shared, 0)[kept].tolist()):
        while stack and stack[-1][0] > prefix:
            depth, children = stack.pop()
            children.append(node)
            node = closed(depth, children)
        if prefix:
            if stack and stack[-1][0] == prefix:
                stack[-1][1].append(node)
            else:
                stack.append((prefix, [node]))
        node = [place]
    while stack:
        depth, children = stack.pop()
        children.append(node)
        node = closed(depth, children)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeating(part: pa.RecordBatch, least: int) -> np.ndarray:
    """Which texts may hold `least` words in a row twice."""
    words = W.split(part.column("_text"), W.NON_SPACE)
    texts = words.text_of()
    whole = W.full_positions(words, least)
    grams = np.zeros(len(whole), np.uint64)
    found = W.grams(W.hashes(words), least)
    grams[: len(found)] = found
    grams, texts = grams[whole], texts[whole].astype(np.uint64)
    keys = W.mixed(grams + texts * np.uint64(0x9E3779B97F4A7C15))
    by = np.argsort(keys)
    again = np.flatnonzero(keys[by][1:] == keys[by][:-1])
    out = np.zeros(part.num_rows, bool)
    out[texts[by[again]].astype(np.int64)] = True
    return out


def _numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of what follows the first period of a run."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return b" ".join([word for word, drop in zip(words, dropped.tolist()) if not drop])


def _found(batches: Iterator[pa.RecordBatch], names: list[str], min_length: int) -> Iterator[pa.RecordBatch]:
    least = max(1, -(-min_length // 2))
    for batch in batches:
        for part in W.chunks(batch, "_text"):
            repeating = _repeating(part, least).tolist()
            counts, listed, texts = [], [], []
            for text, may_run in zip(part.column("_text").cast(pa.binary()).to_pylist(), repeating):
                words = (text or b"").split()  # at ASCII white space, as bytes
                runs = periodic_runs(_numbered(words), min_length) if may_run else []
                counts.append(len(words))
                listed.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(_collapsed(words, runs) if runs else b" ".join(words))
            added = [pa.array(counts, pa.int64()), pa.array(listed, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.record_batch([*[part.column(n) for n in names], *added], names=[*names, *ADDED])


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """`docs` with `n_words`, all `runs` (`start`, `length`, `period`, in words) and the `collapsed` text in place
    of the text column."""
    if min_length < 1:
        raise ValueError("a run has one word at least")
    names = [c for c in docs.columns if c not in (text, *ADDED)]
    kinds = "".join(f"`{n}` {docs.schema[n].dataType.simpleString()}, " for n in names)
    return docs.select(*names, F.col(text).alias("_text")).mapInArrow(
        partial(_found, names=names, min_length=min_length),
        kinds + "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )
