"""Line deduplication over a whole corpus, in DataFrame operations only.

Lines are reduced to 128-bit hashes, range-partitioned by hash and document and sorted by hash, document and
position. A line that a third of all documents share so lies in many partitions, each of which folds it to one
row (count and first occurrence) before the small rest is shuffled. What comes back per document is a
run-length-coded bitmap of the lines it keeps; no line's text is ever shuffled.

Defined results: rows that agree in id and text are one document, which counts once; every row is returned. The
id may be null. A null text is one empty line, whose empty key is shorter than any `min_chars`, so it is kept.
The first occurrence of a line is the one with the smallest document key, then position. Columns other than id
and text pass through `dedup_lines` untouched, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\f\r"
_DOC = ["_k1", "_k2"]
_LINE = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    """What two lines must share to be the same: white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Own names for what is read, the other columns packed, and 128 bits that stand for id and text."""
    rest = [F.col(c) for c in docs.columns if c != text]
    named = docs.select(F.struct(*rest).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    parts = ["_id", "_text"]
    return named.select(
        "*",
        *[
            F.xxhash64(F.lit(salt), *[F.col(p).isNull() for p in parts], *parts).alias(name)
            for salt, name in enumerate(_DOC)
        ],
    )


def sorted_lines(keyed: DataFrame, min_chars: int) -> DataFrame:
    """One row per line key and document with the key's hash and positions in the document; range-partitioned
    and sorted by hash and document. Spark needs no second shuffle for the grouping."""
    return (
        keyed.select(*_DOC, F.posexplode(_lines(F.col("_text"))).alias("_pos", "_line"))
        .withColumn("_line", line_key(F.col("_line")))
        .where(F.char_length("_line") >= min_chars)
        .select(*[F.xxhash64(F.lit(salt), "_line").alias(name) for salt, name in enumerate(_LINE)], *_DOC, "_pos")
        .repartitionByRange(*_LINE, *_DOC)
        .groupBy(*_LINE, *_DOC)
        .agg(F.array_sort(F.collect_set("_pos")).alias("_positions"))
        .sortWithinPartitions(*_LINE, *_DOC)
    )


def _dropped(keyed: DataFrame, min_docs: int, min_chars: int, keep: str) -> DataFrame:
    """Per document key, the positions it loses."""
    lines = written(sorted_lines(keyed, max(min_chars, 1)), "lines")
    first = F.struct(*_DOC, F.get("_positions", F.lit(0)).alias("_pos"))
    folded = lines.groupBy(*_LINE).agg(F.count("*").alias("_docs"), F.min(first).alias("_first"))
    frequent = written(folded.where(F.col("_docs") >= min_docs), "frequent-lines")
    hits = lines.join(frequent, _LINE)
    if keep == "first":
        is_first = F.struct(*_DOC) == F.struct(*[F.col(f"_first.{k}").alias(k) for k in _DOC])
        hits = hits.withColumn(
            "_positions", F.when(is_first, F.slice("_positions", 2, F.size("_positions"))).otherwise(F.col("_positions"))
        )
    return hits.groupBy(*_DOC).agg(F.array_sort(F.flatten(F.collect_list("_positions"))).alias("_dropped"))


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep: str = "none",
) -> DataFrame:
    """Per row: `_row` (all columns but the text), `_id`, `_text`, `_keep` (the bitmap of kept lines as runs of
    start, from 0, and length), `_n_lines` and `_n_dropped`.

    Keys found in at least `min_docs` documents lose all their lines (`keep="none"`), or all but the first
    occurrence in the corpus (`keep="first"`).
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be none or first, not {keep}")
    keyed = _keyed(docs, doc_id, text)
    n_lines = F.size(_lines(F.col("_text")))
    edges = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("_dropped", lambda p: p + 1)).alias("start"),
        F.concat("_dropped", F.array(n_lines)).alias("stop"),
    )
    runs = F.transform(edges, lambda r: F.struct(r["start"].alias("start"), (r["stop"] - r["start"]).alias("length")))
    return (
        keyed.join(_dropped(keyed, min_docs, min_chars, keep), _DOC, "left")
        .withColumn("_dropped", F.coalesce("_dropped", F.array().cast("array<int>")))
        .select(
            "_row",
            "_id",
            "_text",
            F.filter(runs, lambda r: r["length"] > 0).alias("_keep"),
            n_lines.cast("long").alias("_n_lines"),
            F.size("_dropped").cast("long").alias("_n_dropped"),
        )
    )


def kept_text() -> Column:
    """The kept lines of a row of `keep_bitmaps`, joined by line feeds."""
    # The lines enter the lambda as its variable; named inside, they would be split anew for every run.
    kept = F.transform(
        F.array(_lines(F.col("_text"))),
        lambda lines: F.flatten(F.transform("_keep", lambda r: F.slice(lines, r["start"] + 1, r["length"]))),
    )[0]
    return F.when(F.col("_n_dropped") == 0, F.coalesce("_text", F.lit(""))).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """`docs` with the dropped lines taken out of `text`; all rows and columns stay, a null text stays null."""
    new = F.when(F.col("_text").isNotNull(), kept_text())
    return keep_bitmaps(docs, doc_id, text, **rule).select(
        *[new.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns]
    )
