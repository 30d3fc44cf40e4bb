"""Benchmark decontamination by winnowing.

Every window of `window` consecutive words has one fingerprint: the smallest hash (the last of equal ones)
among the `k`-grams inside it. Equal windows have equal fingerprints, so a shared span of `window` words or
more is always found. Test fingerprints are joined to the fingerprints of the documents, and each hit is
extended to its windows, which must agree in all their words (64-bit hash of the word sequence).

Before the join, documents drop fingerprints that no test item can have, by a bit table of fixed size
(`filter_bits`); it is a superset test that only saves shuffling. Nothing else is broadcast.

Defined results: each row of documents is a document, also where ids are null or repeat. Null texts have no
words. A test item of fewer words than the window, but not none, is one window of its own. Equal items all count,
under their own ids; items with a null id count as the text "null". Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm import bits
from tillwright.llm import words as W
from tillwright.session import written

WINDOW, K, FILTER_BITS = 10, 5, 25


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out = values[: len(values) - width + 1].copy()
    for shift in range(1, width):
        np.minimum(out, values[shift : shift + len(out)], out=out)
    return out


def _fingerprints(values: np.ndarray, window: int, k: int) -> np.ndarray:
    """Fingerprint of the window of words that starts at each position."""
    if len(values) < window:
        return np.zeros(0, np.uint64)
    return _sliding_minimum(W.grams(values, k), window - k + 1)


def _windows_of(words: W.Words, values: np.ndarray, size: int, k: int):
    """Starts, fingerprints and sequence hashes of all windows of `size` words within one text."""
    prints = _fingerprints(values, size, min(k, size))
    starts = np.flatnonzero(W.full_positions(words, size)[: len(prints)])
    return starts, prints[starts], W.grams(values, size)[starts] if len(starts) else np.zeros(0, np.uint64)


ITEM_TYPE = "item string, size int, print bigint, win bigint"


def _item_windows(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.chunks(batch, "text"):
            words = W.split(part.column("text"), W.LOWERED)
            values, counts = W.hashes(words), words.counts
            items = part.column("item")
            for size in np.unique(np.minimum(counts, window)):
                if size:
                    starts, prints, wins = _windows_of(words, values, int(size), k)
                    owner = words.text_of()[starts]
                    mine = np.minimum(counts[owner], window) == size
                    yield pa.record_batch(
                        [
                            items.take(pa.array(owner[mine])),
                            pa.array(np.full(mine.sum(), size, np.int32)),
                            pa.array(W.signed(prints[mine])),
                            pa.array(W.signed(wins[mine])),
                        ],
                        names=["item", "size", "print", "win"],
                    )


def benchmark_windows(items: DataFrame, item_id: str, text: str, window: int, k: int) -> DataFrame:
    """Each different window of the test items with its size, fingerprint, and the ids (as text) that have it."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    each = named.mapInArrow(partial(_item_windows, window=window, k=k), ITEM_TYPE)
    return each.groupBy("size", "print", "win").agg(F.collect_set("item").alias("items"))


def _document_windows(
    batches: Iterator[pa.RecordBatch], table: Broadcast, sizes: list[int], k: int
) -> Iterator[pa.RecordBatch]:
    """Per document its number of words and the windows whose fingerprint may be a test item's."""
    for batch in batches:
        for part in W.chunks(batch, "text"):
            words = W.split(part.column("text"), W.LOWERED)
            values = W.hashes(words)
            found = []
            for size in sizes:
                starts, prints, wins = _windows_of(words, values, size, k)
                kept = bits.inside(table.value, prints)
                found.append((starts[kept], np.full(kept.sum(), size, np.int32), prints[kept], wins[kept]))
            starts, widths, prints, wins = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.uint64)] * 4
            owner = np.searchsorted(words.first, starts, side="right") - 1
            order = np.argsort(owner, kind="stable")
            counts = np.bincount(owner, minlength=part.num_rows)
            place = (starts - words.first[owner])[order]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    W.listed(counts, place.astype(np.int32), pa.int32()),
                    W.listed(counts, widths[order].astype(np.int32), pa.int32()),
                    W.listed(counts, W.signed(prints[order]), pa.int64()),
                    W.listed(counts, W.signed(wins[order]), pa.int64()),
                ],
                names=["doc_id", "n_words", "start", "size", "print", "win"],
            )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    k: int = K,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row of `docs`: `doc_id`, `n_words`, `n_hit` (words inside any occurrence of a test window), `items`
    (sorted ids of the test items with such a window)."""
    spark = docs.sparkSession
    index = written(benchmark_windows(items, item_id, item_text, window, k), "benchmark-windows")
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())  # at most `window`
    table = spark.sparkContext.broadcast(bits.table(index, "print", filter_bits))
    id_type = docs.schema[doc_id].dataType.simpleString()
    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        partial(_document_windows, table=table, sizes=sizes, k=k),
        f"doc_id {id_type}, n_words bigint, start array<int>, size array<int>, print array<bigint>, win array<bigint>",
    )
    # The row number is fixed by writing it: a retried task can't change what was committed.
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "document-windows")
    candidates = scanned.where(F.size("start") > 0).select(
        "row", F.inline(F.arrays_zip("start", "size", "print", "win"))
    )
    hits = written(candidates.join(index, ["size", "print", "win"]).select("row", "start", "size", "items"), "window-hits")
    reach = F.max(F.col("start") + F.col("size")).over(
        Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = (
        hits.select("row", "start", (F.col("start") + F.col("size")).alias("end"), "size")
        .withColumn("before", F.coalesce(reach, F.lit(0)))
        .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before")))
        .groupBy("row")
        .agg(F.sum("new").alias("n_hit"))
    )
    named = hits.select("row", "items").distinct().select("row", F.explode("items").alias("item"))
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(spans, "row", "left")
        .join(named, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
