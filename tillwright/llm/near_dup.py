"""Near-duplicate detection with Order MinHash.

Shingles of `SHINGLE` words are labelled with their occurrence number in the document. For each of `SKETCHES`
random orders, the `PICKS` smallest labelled shingles are taken and kept in text order; documents agree in a
sketch with a probability that falls with their edit distance. Documents that agree in any sketch meet in a
bucket. Candidates are verified by aligning their labelled shingles: the longest run of common ones that keeps
the order in both texts, within a band around the diagonal, over all shingles of either text. This is never
above the Jaccard similarity of the shingles and equals it where the order agrees. Pairs of `threshold` or
more are linked; classes are the connected components of the links.

Documents with the same words form one class beforehand and enter with one representative. A bucket is not
paired out. Its members are first compared with its most central one, the document whose buckets are the
fullest: of a text and its edited copies, that is the text. After that, only members of different components are
compared: all of them in buckets of at most `PAIRED` members; in larger ones, at first a member outside the central
one's component with all others. What then still lies in different components of a larger bucket is paired by an
exact prefix filter: with shingles in one common order, the rarest first, two texts at the threshold share a
shingle among the first `size - overlap + 1` of each. So every pair that shares a bucket is compared, lies in one
component already, or is known to be below the threshold; a link is missed only where two documents share no
bucket and no chain of links joins them. Before a pair leaves the join that finds it, the sizes and the parity bits
of both texts, which bound the shingles outside their overlap from below, must allow the threshold: of texts from
one template that are no near-duplicates, next to none is compared. Prefixes are some fifth of the shingles of the documents left; all other
steps handle at most `SKETCHES` rows per document.

Defined results: every row is a document, also where ids are null or rows repeat. Words are as in
decontamination (letters and digits, A-Z lower-cased). Texts without words, null and empty ones too, form one
class. A text of fewer words than a shingle has one shingle, all of it. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import bits
from tillwright.llm import words as W
from tillwright.llm.components import components, packed
from tillwright.session import written

SHINGLE, SKETCHES, PICKS, THRESHOLD, PAIRED = 5, 24, 3, 0.8, 8
# Words of 64 bits that say for each of their bits whether the text has an odd number of shingles there.
PARITY = 8
# Size of the bit table (4 MB) that keeps texts which share no bucket out of a shuffle.
FILTER_BITS = 25
# Texts in which common shingles are counted, and how many of those are kept. Only the number of pairs depends on it.
SAMPLE, COMMON = 20_000, 1 << 20

_ORDERS = (W.mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))[:, None]


def labelled(values: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of one text, each with its occurrence number; all different."""
    if not len(values):
        return values
    shingles = W.grams(values, min(SHINGLE, len(values)))
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if new.all():
        return shingles
    at = np.arange(len(ranked))
    number = np.empty(len(ranked), np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return W.mixed(shingles + number * np.uint64(0x5851F42D4C957F2D))


def _smallest(shingles: np.ndarray, orders: np.ndarray, picks: int) -> np.ndarray:
    """Places of the smallest shingles of each order, in text order."""
    ranks = (shingles * orders) >> np.uint64(1)
    ranks ^= ranks >> np.uint64(31)
    ranks *= np.uint64(0xC2B2AE3D27D4EB4F)
    return np.sort(np.argpartition(ranks, picks - 1, axis=1)[:, :picks], axis=1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One hash per random order, of its smallest labelled shingles in text order."""
    count = len(shingles)
    if not count:
        return np.zeros(SKETCHES, np.uint64)
    picks = min(PICKS, count)
    if count > picks:
        step = max(1, (1 << 20) // count)  # orders at a time, so that a long text needs little memory
        places = np.concatenate([_smallest(shingles, _ORDERS[at : at + step], picks) for at in range(0, SKETCHES, step)])
    else:
        places = np.broadcast_to(np.arange(count), (SKETCHES, count))
    total = np.arange(SKETCHES, dtype=np.uint64)
    for pick in range(picks):
        total = W.mixed(total * np.uint64(0x5851F42D4C957F2D) + shingles[places[:, pick]])
    return total


def parity(shingles: np.ndarray) -> np.ndarray:
    """Per bit, whether an odd number of shingles falls on it. Where two texts differ in a bit, at least one shingle
    belongs to one of them only."""
    odd = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: id, two hashes of its words in order, shingle count, sketches, parity bits, and 32 bits of each
    word's hash."""
    for batch in batches:
        for part in W.chunks(batch, "text"):
            words = W.split(part.column("text"), W.LOWERED)
            values = W.hashes(words)
            keys, sketches, odd, packed, sizes = [], [], [], [], []
            for begin, end in zip(words.first[:-1], words.first[1:]):
                short = (values[begin:end] >> np.uint64(32)).astype(np.uint32)
                own = short.astype(np.uint64) + np.uint64(1)
                whole = values[begin:end]
                keys.append([W.grams(x, len(x))[0] if len(x) else np.uint64(0) for x in (whole, W.mixed(whole + np.uint64(1)))])
                shingles = labelled(W.mixed(own))
                sketches.append(sketch(shingles))
                odd.append(parity(shingles))
                sizes.append(len(shingles))
                packed.append(short.tobytes())
            keys = np.array(keys, dtype=np.uint64).reshape(-1, 2)
            yield pa.record_batch(
                [
                    part.column("id"),
                    pa.array(W.signed(np.ascontiguousarray(keys[:, 0]))),
                    pa.array(W.signed(np.ascontiguousarray(keys[:, 1]))),
                    pa.array(np.array(sizes, np.int32)),
                    W.listed(np.full(len(sizes), SKETCHES), W.signed(np.concatenate(sketches)), pa.int64()),
                    W.listed(np.full(len(sizes), PARITY), np.concatenate(odd), pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["id", "key1", "key2", "size", "sketches", "parity", "words"],
            )


def _longest_rising(places: np.ndarray) -> int:
    """Length of the longest strictly rising run of picks."""
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []
    for place in places.tolist():
        at = bisect_left(ends, place)
        ends[at : at + 1] = [place]
    return len(ends)


def similarity(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Shared labelled shingles in the same order over all shingles; 0 where it can't reach the threshold.

    At `threshold`, aligned shingles are off the diagonal by less than the shingles that are not shared: the band.
    """
    total = len(left) + len(right)
    _, at_left, at_right = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    if len(at_left) < threshold * (total - len(at_left)):
        return 0.0
    band = total - 2 * int(np.ceil(threshold * total / (1 + threshold) - 1e-9))
    near = np.abs(at_left - at_right) <= band
    order = np.argsort(at_left[near])
    shared = _longest_rising(at_right[near][order])
    return shared / (total - shared)


def _unpacked(packed: bytes) -> np.ndarray:
    """Labelled shingles of a text from its packed words."""
    return labelled(W.mixed(np.frombuffer(packed, np.uint32).astype(np.uint64) + np.uint64(1)))


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, seen, known = [], None, None
        for left, right in zip(batch.column("words_v").to_pylist(), batch.column("words_u").to_pylist()):
            if left != seen:
                seen, known = left, _unpacked(left)
            found.append(similarity(known, _unpacked(right), threshold) >= threshold)
        yield pa.record_batch([batch.column("u"), batch.column("v"), pa.array(found, pa.bool_())], names=["u", "v", "linked"])


def _compare(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs `u > v` with `linked`."""
    # `v` is shared by many pairs; its words come second, when pairs are already spread by `u`.
    with_u = pairs.join(texts.select(F.col("row").alias("u"), F.col("words").alias("words_u")), "u")
    with_both = with_u.join(texts.select(F.col("row").alias("v"), F.col("words").alias("words_v")), "v")
    return with_both.select("u", "v", "words_u", "words_v").mapInArrow(
        partial(_verified, threshold=threshold), "u bigint, v bigint, linked boolean"
    )


def _may_link(one: str, other: str, threshold: float, joint: str = ".") -> Column:
    """Sizes that allow the threshold, as the smaller set can at most be inside the larger, and no more differing
    parity bits than shingles outside the overlap. Pairs that can't pass so never leave the join that finds them."""
    size, more = F.col(f"{one}size"), F.col(f"{other}{joint}size")
    own, others = F.col(f"{one}parity"), F.col(f"{other}{joint}parity")
    differing = reduce(Column.__add__, [F.bit_count(own[n].bitwiseXOR(others[n])) for n in range(PARITY)])
    outside = (size + more) * ((1 - threshold) / (1 + threshold)) + 1e-9
    return (F.least(size, more) >= threshold * F.greatest(size, more)) & (differing <= outside)


def _pairs(rows: DataFrame, one: str, other: str) -> DataFrame:
    """Different pairs as `u > v`."""
    return rows.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v")).distinct()


def _sharing(texts: DataFrame) -> DataFrame:
    """Documents that share a bucket with others: `row`, `size`, `parity`, their `buckets` (hash, and number of the sketch it
    stands for), and `score`, the number of members of all of them."""
    each = texts.select("row", F.posexplode("sketches").alias("at", "sketch"))
    each = each.select(F.xxhash64("at", "sketch").alias("bucket"), "at", "row")
    shared = written(each.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    own = each.join(shared, "bucket").groupBy("row")
    own = own.agg(F.collect_list(F.struct("bucket", "at")).alias("buckets"), F.sum("members").alias("score"))
    return written(texts.select("row", "size", "parity").join(written(own, "own-buckets"), "row"), "sharing")


def _central_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Each member with the most central one of its bucket."""
    centres = members.groupBy("bucket").agg(F.max(F.struct("score", "row", "size", "parity")).alias("centre"))
    joined = members.join(packed(centres, "centres"), "bucket").withColumn("other", F.col("centre.row"))
    return _pairs(joined.where("row != other").where(_may_link("", "centre", threshold)), "row", "other")


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that reach over several components, with the component (`top`), the number of
    members, and the component of the most central one (`main`)."""
    tops = links.select(F.col("u").alias("row"), F.col("v").alias("top"))
    labelled = members.join(tops, "row", "left").withColumn("top", F.coalesce("top", "row"))
    stats = labelled.groupBy("bucket").agg(
        F.count("*").alias("members"),
        F.min("top").alias("low"),
        F.max("top").alias("high"),
        F.max(F.struct("score", "row", "top")).alias("best"),
    )
    stats = stats.where("low != high").select("bucket", "members", F.col("best.top").alias("main"))
    return packed(labelled.join(packed(stats, "mixed-buckets"), "bucket"), "mixed")


def _cross_pairs(small: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components inside small buckets."""
    left = small.select("bucket", "row", "size", "parity", "top")
    right = left.withColumnsRenamed({"row": "other", "size": "other_size", "parity": "other_parity", "top": "other_top"})
    joined = left.join(right, "bucket").where("row > other AND top != other_top")
    return _pairs(joined.where(_may_link("", "other", threshold, "_")), "row", "other")


def _outside_pairs(large: DataFrame, threshold: float) -> DataFrame:
    """The most central member outside the main component with all members of other components than its own."""
    outside = large.where("top != main").groupBy("bucket").agg(F.max(F.struct("score", "row", "size", "parity", "top")).alias("centre"))
    joined = large.join(packed(outside, "outside-centres"), "bucket").withColumn("other", F.col("centre.row"))
    return _pairs(joined.where("top != centre.top").where(_may_link("", "centre", threshold)), "row", "other")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed_words in batch.column("words").to_pylist():
            yield pa.record_batch([pa.array(W.signed(_unpacked(packed_words)))], names=["shingle"])


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found in several texts of a bounded sample, sorted, and in how many."""
    part = min(1.0, SAMPLE / max(1, texts.count()))
    drawn = texts.where(F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 20)) < int(part * (1 << 20))).select("words")
    counts = drawn.mapInArrow(_shingled, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    found = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    shingles = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found.column("n").to_numpy()[order]


def prefix_sizes(size: int, threshold: float) -> tuple[int, int]:
    """How many of the first shingles of a text hold one that is shared with any text of no less shingles at the
    threshold, and with any text of no more."""
    least_shared = [int(np.ceil(part * size - 1e-9)) for part in (2 * threshold / (1 + threshold), threshold)]
    return size - least_shared[0] + 1, size - least_shared[1] + 1


def _prefixes(batches: Iterator[pa.RecordBatch], common: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    """The first shingles of each text, the rarest first, with their `place` and whether they are `first` enough to
    meet a larger text."""
    known, counts = common.value
    for batch in batches:
        for at, packed_words in enumerate(batch.column("words").to_pylist()):
            shingles = _unpacked(packed_words)
            number = np.zeros(len(shingles), np.int64)
            if len(known):
                found = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                number = np.where(known[found] == shingles, counts[found], 0)
            few, more = prefix_sizes(len(shingles), threshold)
            places = np.arange(more)
            columns = [pa.array(W.signed(shingles[np.lexsort((shingles, number))[:more]]))]
            own = [pa.repeat(batch.column(name)[at], more) for name in ("row", "size", "score", "top", "parity")]
            yield pa.record_batch(
                [*columns, *own, pa.array(places.astype(np.int32)), pa.array(places < few)],
                names=["shingle", "row", "size", "score", "top", "parity", "place", "first"],
            )


def _prefix_pairs(large: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that can reach the threshold, among all members of large buckets."""
    left = written(large.select("row", "size", "score", "top", "parity").distinct(), "left-over")
    with_words = written(texts.select("row", "words").join(left, "row"), "left-texts")
    common = texts.sparkSession.sparkContext.broadcast(_common(with_words))
    found = with_words.mapInArrow(
        partial(_prefixes, common=common, threshold=threshold),
        "shingle bigint, row bigint, size int, score bigint, top bigint, parity array<bigint>, place int, first boolean",
    )
    found = written(found, "prefixes")
    stats = found.groupBy("shingle").agg(
        F.min("top").alias("low"), F.max("top").alias("high"), F.max("first").alias("any"), F.max(F.struct("score", "top")).alias("best")
    )
    stats = stats.where("low != high AND any").select("shingle", F.col("best.top").alias("main"))
    found = packed(found.drop("score").join(packed(stats, "mixed-prefixes"), "shingle"), "mixed-prefix-members")
    larger = found.drop("first").withColumnsRenamed(
        {"row": "other", "size": "other_size", "parity": "other_parity", "top": "other_top", "place": "other_place", "main": "other_main"}
    )
    outside = found.where("first AND top != main").join(larger, "shingle")
    inside = found.where("first AND top = main").join(larger.where("other_top != other_main"), "shingle")
    joined = outside.unionByName(inside).where("top != other_top AND (size < other_size OR size = other_size AND row < other)")
    # No more can be shared than what follows the first shared shingle.
    reach = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    needed = (F.col("size") + F.col("other_size")) * (threshold / (1 + threshold)) - 1e-9
    return _pairs(joined.where(reach >= needed).where(_may_link("", "other", threshold, "_")), "row", "other")


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs that pass the comparison."""
    return packed(_compare(pairs, texts, threshold).where("linked").select("u", "v"), "links")


def _likely(batches: Iterator[pa.RecordBatch], filled: Broadcast) -> Iterator[pa.RecordBatch]:
    """Rows that may be in the bit table, before they are shuffled."""
    for batch in batches:
        yield batch.filter(pa.array(bits.inside(filled.value, batch.column("hash").to_numpy().view(np.uint64))))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row of `docs`: `id`, `row` (number of the row) and `class_row` (smallest row of its class)."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    scanned = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(
        _sketched,
        f"id {id_type}, key1 bigint, key2 bigint, size int, sketches array<bigint>, parity array<bigint>, words binary",
    )
    # The row number is fixed by writing it: a retried task can't change what was committed.
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "sketches")
    wordings = written(scanned.groupBy("key1", "key2").agg(F.min("row").alias("first")), "wordings")
    firsts = wordings.select(F.col("first").alias("row"))
    texts = written(scanned.where("size > 0").select("row", "size", "sketches", "parity").join(firsts, "row"), "wordings-sketches")
    sharing = _sharing(texts)  # most documents share no bucket
    rows = scanned.select("row", F.xxhash64("row").alias("hash"), "sketches", "words")
    filled = docs.sparkSession.sparkContext.broadcast(bits.table(sharing.select(F.xxhash64("row").alias("hash")), "hash", filter_bits))
    likely = rows.mapInArrow(partial(_likely, filled=filled), rows.schema)
    texts = written(likely.join(sharing.select("row"), "row").drop("hash"), "shared-texts")
    members = sharing.select("row", "size", "score", "parity", F.inline("buckets"))
    links = components(_linked(_central_pairs(members, threshold), texts, threshold))
    mixed = _mixed(members, links)
    large = mixed.where(F.col("members") > PAIRED)
    pairs = _cross_pairs(mixed.where(F.col("members") <= PAIRED), threshold).unionByName(_outside_pairs(large, threshold))
    links = components(links.unionByName(_linked(pairs.distinct(), texts, threshold)))
    large = _mixed(large.select("bucket", "row", "size", "score", "parity"), links)
    if not large.isEmpty():
        links = components(links.unionByName(_linked(_prefix_pairs(large, texts, threshold), texts, threshold)))
    tops = wordings.join(links.select(F.col("u").alias("first"), F.col("v").alias("top")), "first", "left")
    tops = written(tops.select("key1", "key2", F.coalesce("top", "first").alias("class_row")), "classes")
    return scanned.select("id", "row", "key1", "key2").join(tops, ["key1", "key2"]).select("id", "row", "class_row")


def one_per_class(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one row of each class, all columns unchanged."""
    keys = [f"_near_dup_key{salt}" for salt in range(2)]
    keyed = docs.select(*[F.xxhash64(F.lit(salt), F.struct("*")).alias(key) for salt, key in enumerate(keys)], "*")
    packed = keyed.select(F.struct(*keys).alias("key"), F.col(text).alias("text"))
    classes = near_duplicates(packed, "key", "text", threshold)
    kept = written(classes.where("row = class_row").select("id.*"), "kept-rows")
    # Rows that are equal in all columns share a key; one of them stays.
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)
