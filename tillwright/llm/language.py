"""Language identification by Bayesian fusion of text, declared language and address evidence.

For each language, the log-likelihood of a text comes from a table over hashed byte trigrams (letters lower-cased,
other ASCII bytes as spaces), trained on a bounded sample of labelled documents. To it are added the log-likelihood
of the declared language, from how often each is declared for texts of each language, and the log-prior of the
host, smoothed towards its address suffix and that towards the whole corpus. Both are counted by grouped
aggregation over all rows. One more class, "und", stands for text in none of the languages: all trigrams are
equally likely in it.

A row is rejected (`keep` false) where its text has no letters at all, where "und" is most probable, or where the
most probable language stays below `min_confidence`.

Defined results: null and empty texts have no trigrams: the priors decide and the row is rejected. A null declared
language says nothing. Rows without a host share the host "". Equal rows get equal results; every row is returned.
Ties go to the language that is first in the alphabet. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import words as W
from tillwright.session import written

BUCKET_BITS = 16
SAMPLE_PER_LANGUAGE = 2_000
UNIT = 1024  # log-likelihoods are summed as whole 1/1024, so that no sum depends on its order
UNKNOWN = "und"


def _byte_map() -> np.ndarray:
    mapped = np.arange(256, dtype=np.uint8)
    mapped[:0x80] = 0x20
    lower = np.arange(ord("a"), ord("z") + 1, dtype=np.uint8)
    mapped[lower] = lower
    mapped[lower - 32] = lower
    return mapped


_MAP = _byte_map()


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram with a letter, and per text the index of its first one (one more at the end)."""
    raw, offsets = W.text_bytes(texts)
    data = _MAP[raw].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    joined = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    inside = joined != 0x202020
    for edge in offsets[1:-1]:  # trigrams that reach over the end of a text
        inside[max(edge - 2, 0) : edge] = False
    at = np.flatnonzero(inside)
    buckets = (joined[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    return buckets.astype(np.int64), np.searchsorted(at, offsets)


@dataclass(frozen=True)
class Model:
    """Languages in order, and per language the log-likelihood of each bucket in units of 1 / 1024."""

    languages: list[str]
    table: np.ndarray


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
    for batch in batches:
        for part in W.chunks(batch, "text"):
            buckets, first = trigrams(part.column("text"))
            which = np.repeat([languages.index(x) for x in part.column("language").to_pylist()], np.diff(first))
            np.add.at(counts, (which, buckets), 1)
    language, bucket = np.nonzero(counts)
    yield pa.record_batch(
        [pa.array(language.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[language, bucket])],
        names=["language", "bucket", "n"],
    )


def train(
    labelled: DataFrame, language: str = "lang", text: str = "text", sample_per_language: int = SAMPLE_PER_LANGUAGE
) -> Model:
    """Trigram model of the languages in the `language` column. Of each, some `sample_per_language` rows are
    used, chosen by a hash of the text; the driver gets at most 65,536 counts per language."""
    named = labelled.select(F.col(language).alias("language"), F.col(text).alias("text")).where(
        (F.length("language") > 0) & (F.length("text") > 0)
    )
    sizes = {r["language"]: r["count"] for r in named.groupBy("language").count().collect()}
    languages = sorted(sizes)
    chance = F.lit(0.0)
    for name, size in sizes.items():
        chance = F.when(F.col("language") == name, F.lit(sample_per_language / size)).otherwise(chance)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(5), "text"), 11) / F.lit(float(1 << 53))
    counted = (
        named.where(drawn < chance)
        .mapInArrow(partial(_count, languages=languages), "language int, bucket int, n bigint")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[counted["language"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    smoothed = counts + 0.01
    logs = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)) if languages else counts
    return Model(languages, np.rint(logs * UNIT).astype(np.int64))


def _score(batches: Iterator[pa.RecordBatch], table: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.chunks(batch, "text"):
            buckets, first = trigrams(part.column("text"))
            sums = []
            for row in table.value:
                upto = np.concatenate(([0], np.cumsum(row[buckets])))
                sums.append(upto[first[1:]] - upto[first[:-1]])
            scores = np.stack(sums, axis=1) if sums else np.zeros((part.num_rows, 0), np.int64)
            yield pa.record_batch(
                [
                    *[part.column(c) for c in ("id", "declared", "host", "suffix")],
                    pa.array(np.diff(first).astype(np.int64)),
                    W.listed(np.full(part.num_rows, scores.shape[1]), scores.reshape(-1), pa.int64()),
                ],
                names=["id", "declared", "host", "suffix", "n_grams", "scores"],
            )


def _tally(which: str, languages: list[str]) -> Column:
    """Rows of each language, by its number."""
    return F.array(*[F.sum(F.when(F.col(which) == i, 1).otherwise(0)) for i in range(len(languages))])


def _smoothed(own: str, parent: str, strength: float) -> Column:
    """Shares of the counts in `own` with `strength` rows of the parent's shares added."""
    total = F.aggregate(own, F.lit(0).cast("long"), lambda a, n: a + n)
    return F.zip_with(own, parent, lambda n, p: (n + strength * p) / (total + strength))


def identify(
    rows: DataFrame,
    model: Model,
    row_id: str,
    text: str,
    declared: str | None = None,
    host: str | None = None,
    suffix: str | None = None,
    strength: float = 20.0,
    text_weight: float = 0.25,
    unknown_prior: float = 0.001,
    min_confidence: float = 0.5,
) -> DataFrame:
    """Per row: `id`, `language`, `confidence` (its posterior probability, to six places), `n_grams` and `keep`."""
    spark, languages = rows.sparkSession, model.languages
    column = lambda name, other: F.coalesce(F.col(name).cast("string"), F.lit(other)) if name else F.lit(other)
    id_type = rows.schema[row_id].dataType.simpleString()
    scanned = rows.select(
        F.col(row_id).alias("id"),
        F.col(text).alias("text"),
        F.lower(column(declared, "")).alias("declared"),
        F.lower(column(host, "")).alias("host"),
        F.lower(column(suffix, "")).alias("suffix"),
    ).mapInArrow(
        partial(_score, table=spark.sparkContext.broadcast(model.table)),
        f"id {id_type}, declared string, host string, suffix string, n_grams bigint, scores array<bigint>",
    )
    # The language a text alone would have; texts without letters have none.
    vote = F.when(F.col("n_grams") > 0, F.array_position("scores", F.array_max("scores")) - 1)
    scanned = written(scanned.withColumn("vote", vote.cast("int")), "language-scores")
    if not languages:  # nothing to choose from
        return scanned.select(
            "id", F.lit(UNKNOWN).alias("language"), F.lit(1.0).alias("confidence"), "n_grams", F.lit(False).alias("keep")
        )
    hosts = written(scanned.groupBy("suffix", "host").agg(_tally("vote", languages).alias("own")), "hosts")
    even = F.array(*[F.lit(1.0 / len(languages))] * len(languages))
    sums = [F.sum(F.col("own")[i]).alias(f"n{i}") for i in range(len(languages))]
    packed = F.array(*[F.coalesce(f"n{i}", F.lit(0)) for i in range(len(languages))])
    corpus = hosts.agg(F.count("*").alias("hosts"), *sums).select(packed.alias("all"))
    corpus = corpus.select(_smoothed("all", even, float(len(languages))).alias("all"))
    suffixes = hosts.groupBy("suffix").agg(*sums).select("suffix", packed.alias("wide"))
    suffixes = suffixes.withColumn("all", corpus.scalar()).withColumn("wide", _smoothed("wide", "all", strength))
    priors = hosts.join(suffixes.select("suffix", "wide"), "suffix").withColumn("prior", _smoothed("own", "wide", strength))
    priors = written(priors.select("suffix", "host", "prior"), "host-priors")
    # How often a language is declared for texts of a language: at most a few declared values matter, so the
    # table is keyed by those that are languages of the model; others say nothing.
    said = F.when(F.col("declared").isin(languages), F.col("declared"))
    tally = {
        (r["said"], r["vote"]): r["n"]
        for r in scanned.where("vote IS NOT NULL").groupBy(said.alias("said"), "vote").agg(F.count("*").alias("n")).collect()
    }
    declares = {}
    for name in languages:
        declares[name] = []
        for i in range(len(languages)):
            heard = sum(tally.get((other, i), 0) for other in languages)
            declares[name].append(math.log((tally.get((name, i), 0) + 0.5) / (heard + 0.5 * len(languages))))
    evidence = F.array(*[F.lit(0.0)] * len(languages))
    for name, logs in declares.items():
        evidence = F.when(F.col("declared") == name, F.array(*[F.lit(x) for x in logs])).otherwise(evidence)
    uniform = -BUCKET_BITS * math.log(2) * text_weight
    heard = F.transform("scores", lambda s: s * F.lit(text_weight / UNIT))
    total = F.zip_with(F.zip_with(heard, evidence, lambda a, b: a + b), "prior", lambda a, p: a + F.log(p))
    none = F.col("n_grams") * F.lit(uniform) + F.lit(math.log(unknown_prior)) + F.lit(-math.log(len(languages)))
    names = F.array(*[F.lit(x) for x in [*languages, UNKNOWN]])
    best = F.array_max("all")
    scored = scanned.join(priors, ["suffix", "host"]).withColumn("all", F.concat(total, F.array(none)))
    weight = F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    return scored.select(
        "id",
        F.element_at(names, F.array_position("all", best).cast("int")).alias("language"),
        F.round(1 / weight, 6).alias("confidence"),
        "n_grams",
    ).withColumn(
        "keep", (F.col("n_grams") > 0) & (F.col("language") != UNKNOWN) & (F.col("confidence") >= min_confidence)
    )


def page_evidence(pages: DataFrame, row_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """What a web page offers to `identify`: id, text without markup, declared markup language, host and suffix."""
    plain = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(F.col(html), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    host = F.regexp_extract(F.col(url), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.select(
        F.col(row_id).alias("id"),
        plain.alias("text"),
        declared.alias("declared"),
        host.alias("host"),
        F.element_at(F.split(host, r"\."), -1).alias("suffix"),
    )
