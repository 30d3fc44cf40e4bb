"""Removal of passages that repeat anywhere in the corpus, with fixed-block anchors.

Each document is cut into non-overlapping blocks of `(window + 1) // 2` words, counted from its start. Any
window of `window` words holds a whole block of its own document, so where a window repeats, the block of
either copy meets a rolling window of the other. All blocks are indexed, every rolling window of block size
probes the index, and a hit is extended: the windows that hold it are compared with all other such windows of
the corpus by a hash of their words. Windows that occur twice are repeats, and runs of them are the maximal
repeated passages.

The index is a bit table of fixed size (`index_bits`, 32 MB by default, read by every task): a superset test
that spares most windows the shuffle. When the corpus outgrows it, more windows are compared and the result
stays the same. Blocks found once are told from repeated ones by a second table, as a block always meets itself.

Defined results: every row is a document, also where ids are null or rows repeat (their passages then repeat).
A null text has no words. Texts shorter than the window lose nothing. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm import bits
from tillwright.llm import words as W
from tillwright.session import written

WINDOW, INDEX_BITS = 35, 28


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.chunks(batch, "text"):
            words = W.split(part.column("text"), W.NON_SPACE)
            at = np.arange(len(words.starts))
            anchored = (at - words.first[words.text_of()]) % size == 0
            starts = at[anchored & W.full_positions(words, size)]
            if len(starts):
                block = W.grams(W.hashes(words), size)[starts]
                yield pa.record_batch([pa.array(W.signed(block))], names=["block"])


def _candidates(
    batches: Iterator[pa.RecordBatch], once: Broadcast, twice: Broadcast, window: int, size: int
) -> Iterator[pa.RecordBatch]:
    """Per document: id, words, hash of all words, windows with a hit, and the text if there are any."""
    for batch in batches:
        for part in W.chunks(batch, "text"):
            texts = part.column("text")
            words = W.split(texts, W.NON_SPACE)
            values = W.hashes(words)
            starts = np.zeros(0, np.int64)
            if len(values) >= window:
                probes = W.grams(values, size)
                anchored = (np.arange(len(probes)) - words.first[words.text_of()[: len(probes)]]) % size == 0
                hit = bits.inside(once.value, probes)
                hit[anchored] = bits.inside(twice.value, probes[anchored])
                upto = np.concatenate(([0], np.cumsum(hit)))
                span = window - size + 1  # probes inside a window
                inside = upto[span:] - upto[:-span] > 0
                starts = np.flatnonzero(inside & W.full_positions(words, window)[: len(inside)])
            wins = W.grams(values, window)[starts] if len(starts) else np.zeros(0, np.uint64)
            owner = np.searchsorted(words.first, starts, side="right") - 1
            counts = np.bincount(owner, minlength=part.num_rows)
            digests = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in texts.to_pylist()]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(digests),
                    W.listed(counts, (starts - words.first[owner]).astype(np.int32), pa.int32()),
                    W.listed(counts, W.signed(wins), pa.int64()),
                    pa.array([t if n else None for t, n in zip(texts.to_pylist(), counts)], type=pa.string()),
                ],
                names=["doc_id", "n_words", "sha256", "start", "win", "text"],
            )


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by hash, those whose neighbour is equal (`row`, `start`). The first and the last window of
    a partition may have their like in the next one: they come out with `win`, and without `row` if known to repeat."""
    carried = None  # last window so far and whether the one before it is equal
    first = True
    names = ["row", "start", "win"]

    def made(rows, starts, wins) -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(wins, pa.int64())], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows, starts, wins = (batch.column(n).to_numpy() for n in names)
        like_before = np.zeros(len(wins) + 1, bool)
        if carried is not None:
            rows, starts, wins = (np.concatenate(([a], b)) for a, b in zip(carried[0], (rows, starts, wins)))
            like_before[0] = carried[1]
        like_before = like_before[: len(wins)]
        equal = wins[1:] == wins[:-1]
        like_before[1:] = equal
        repeat = like_before[:-1] | equal
        if first and len(repeat):
            first = False
            yield made([None if repeat[0] else rows[0]], [None if repeat[0] else starts[0]], [wins[0]])
        kept = np.flatnonzero(repeat)
        yield made(rows[kept], starts[kept], pa.nulls(len(kept), pa.int64()))
        carried = (rows[-1], starts[-1], wins[-1]), like_before[-1]
    if carried is not None:
        (row, start, win), repeat = carried
        yield made([None if repeat else row], [None if repeat else start], [win])
        if repeat:
            yield made([row], [start], [None])


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Per document what is left without the words of the repeated windows that start at `starts`."""
    for batch in batches:
        rows, removed, kept = batch.column("row"), [], []
        for text, starts in zip(batch.column("text"), batch.column("starts")):
            words = np.array(text.as_py().encode().split(), dtype=object)
            change = np.zeros(len(words) + 1, np.int64)
            begins = starts.values.to_numpy()
            np.add.at(change, begins, 1)
            np.add.at(change, begins + window, -1)
            covered = np.cumsum(change[:-1]) > 0
            removed.append(int(covered.sum()))
            kept.append(b" ".join(words[~covered]).decode())
        yield pa.record_batch([rows, pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["row", "n_removed", "kept"])


def repeated_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    index_bits: int = INDEX_BITS,
) -> DataFrame:
    """Per row of `docs`: `doc_id`, `n_words`, `n_removed` (words of repeated windows), `kept` (the other words
    joined by one space where any were removed, else null) and `kept_sha256` (of the words that are left)."""
    spark = docs.sparkSession
    size = (window + 1) // 2
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = written(
        named.select("text").mapInArrow(partial(_blocks, size=size), "block bigint")
        .groupBy("block").agg(F.count("*").alias("n")),
        "blocks",
    )
    once = spark.sparkContext.broadcast(bits.table(blocks, "block", index_bits))
    twice = spark.sparkContext.broadcast(bits.table(blocks.where("n > 1"), "block", index_bits))
    id_type = docs.schema[doc_id].dataType.simpleString()
    scanned = named.mapInArrow(
        partial(_candidates, once=once, twice=twice, window=window, size=size),
        f"doc_id {id_type}, n_words bigint, sha256 string, start array<int>, win array<bigint>, text string",
    )
    # The row number is fixed by writing it: a retried task can't change what was committed.
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "passages")
    candidates = scanned.where("text IS NOT NULL").select("row", F.inline(F.arrays_zip("start", "win")))
    # One shuffle compares all windows: sorted by hash, equal ones are neighbours, however many there are.
    ordered = candidates.repartitionByRange("win", "row", "start").sortWithinPartitions("win", "row", "start")
    repeats = written(ordered.mapInArrow(_repeats, "row bigint, start int, win bigint"), "repeated-windows")
    edges = repeats.where("win IS NOT NULL")  # two per partition
    alike = written(edges.groupBy("win").count().where("count > 1").select("win"), "edges")
    starts = repeats.where("win IS NULL").unionByName(edges.where("row IS NOT NULL").join(alike, "win").select("row", "start", "win"))
    starts = starts.groupBy("row").agg(F.collect_list("start").alias("starts"))
    cleaned = (
        scanned.where("text IS NOT NULL").select("row", "text").join(starts, "row")
        .mapInArrow(partial(_kept, window=window), "row bigint, n_removed bigint, kept string")
    )
    return scanned.select("row", "doc_id", "n_words", "sha256").join(cleaned, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        "kept",
        F.coalesce(F.sha2("kept", 256), "sha256").alias("kept_sha256"),
    )
