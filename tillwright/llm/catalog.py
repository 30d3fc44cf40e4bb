"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    chunked_bpe,
    decontaminate,
    html_text,
    language,
    line_dedup,
    merkle,
    mixing,
    near_dup,
    neighbours,
    pii,
    runs,
    substrings,
    tokens,
)
from tillwright.llm.shipping import ship
from tillwright.session import tune, written

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return run(tune(ship(spark)), folder)

    _REGISTERED[run.__name__] = tuned
    return run


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def statements() -> dict[str, str]:
    return dict(ORACLES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in the order of the mixture; a source weighs the square root of its size."""
    rows = _table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(rows, "source", order=["doc_id"])


@_query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.keep_bitmaps(_table(spark, folder, "documents"), min_docs=10, min_chars=1)
    return kept.select(
        F.col("_id").alias("doc_id"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(line_dedup.kept_text(), 256).alias("kept_sha256"),
    )


@_query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all documents, and after two edits of each: a note put in at some place of the first half, and
    some characters of the second half taken out. The places follow from the document's id."""
    state = tokens.count_tokens(_table(spark, folder, "documents").select("doc_id", "text"))
    size = F.coalesce(F.char_length("_text"), F.lit(0))
    half = F.floor(size / 2).cast("int")
    place = F.pmod(F.xxhash64("doc_id"), half + 1).cast("int")
    begin = half + F.pmod(F.xxhash64("doc_id", F.lit(1)), size - half + 1).cast("int")
    edit = lambda start, end, new: F.struct(
        start.alias("start"), end.alias("end"), F.lit(new).alias("replacement")
    )
    edits = F.array(edit(place, place, " [note]"), edit(begin, F.least(begin + 40, size), ""))
    return tokens.apply_edits(state.withColumn("_edits", edits)).select(
        "doc_id",
        F.col("_n_before").alias("n_tokens"),
        F.col("_n_tokens").alias("n_tokens_edited"),
        F.col("_n_reencoded").alias("n_chars_reencoded"),
    )


@_query
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_text.extract(_table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@_query
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its class: the smallest id in it, and its number of documents."""
    found = near_dup.near_duplicates(_table(spark, folder, "documents"))
    sizes = written(
        found.groupBy("class_row").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")), "classes"
    )
    return found.join(sizes, "class_row").select(F.col("id").alias("doc_id"), "class_id", "class_size")


@_query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@_query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), window=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_words(_table(spark, folder, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@_query
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


@_query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Documents: the declared language is `lang`, the host is `source`."""
    docs = _table(spark, folder, "documents")
    found = language.identify(docs, language.train(docs), "doc_id", "text", declared="lang", host="source")
    return found.withColumnsRenamed({"id": "doc_id", "language": "lang"})


@_query
def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages: markup language, host and address suffix, with the text model of the documents."""
    pages = language.page_evidence(_table(spark, folder, "pages"))
    model = language.train(_table(spark, folder, "documents"))
    found = language.identify(pages, model, "id", "text", "declared", "host", "suffix")
    return found.withColumnsRenamed({"id": "page_id", "language": "lang"})


@_query
def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, and the texts they decode to."""
    encoded = chunked_bpe.encode(_table(spark, folder, "documents").select("doc_id", "text"))
    return chunked_bpe.decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves and proofs of all documents. Of every third one, a text with A-Z lower-cased is presented."""
    docs = _table(spark, folder, "documents")
    altered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    presented = {"text": F.translate("text", line_dedup.UPPER, line_dedup.LOWER)}
    found = merkle.manifest(docs, presented=presented, altered=altered)
    found = found.withColumn("folded_root", merkle.folded(F.col("presented"), F.col("proof")))
    digest = lambda name: F.lower(F.hex(name)).alias(name)
    return found.select(
        F.col("id").alias("doc_id"),
        digest("leaf"),
        digest("subroot"),
        digest("root"),
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified"),
    )


@_query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents. In every tenth one, the words from some place on repeat with some period; both follow
    from the document's id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = _table(spark, folder, "documents").select("doc_id", "text", (h % 10 == 0).alias("_chosen"), F.expr("crc32(string(doc_id)) div 10").alias("_g"))
    docs = docs.withColumn("_words", F.when(F.col("_chosen"), words))  # null: left as it is
    docs = docs.withColumn("_n", F.size("_words")).withColumn("_at", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    docs = docs.withColumn("_period", F.expr("cast(1 + (_n - _at) div (3 + _g % 8) as int)"))
    unit = F.slice("_words", F.col("_at") + 1, F.col("_period"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.expr("cast((_n - _at) div _period + 1 as int)"))), F.lit(1), F.col("_n") - F.col("_at"))
    repeated = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_at")), tail), " ")
    docs = docs.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))
    found = runs.find_runs(docs)
    ranked = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("best", F.array_max(ranked))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES: dict[str, str] = {}

ORACLES["op2_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE frequent.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON keyed.key = frequent.key
GROUP BY doc_id
"""

ORACLES["op7_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_at AS (
  SELECT item_id, words, least(10, len(words)) AS size,
         unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS pos
  FROM iw WHERE len(words) > 0),
item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win FROM item_at),
sizes AS (SELECT DISTINCT size FROM item_window),
doc_at AS (
  SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS pos
  FROM dw, sizes WHERE len(words) >= size),
hit AS (
  SELECT doc_id, pos, d.size, item_id
  FROM (SELECT doc_id, pos, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win FROM doc_at) d
  JOIN item_window i ON d.size = i.size AND d.win = i.win),
word AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(pos, pos + size - 1)) AS w FROM hit) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN word ON dw.doc_id = word.doc_id LEFT JOIN item ON dw.doc_id = item.doc_id
"""

ORACLES["op8_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, pos, md5(array_to_string(list_slice(words, pos, pos + 34), ' ')) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS pos FROM d WHERE len(words) >= 35)),
repeated AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
start AS (SELECT doc_id, pos FROM win JOIN repeated ON win.win = repeated.win),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
reach AS (
  SELECT word.doc_id, word, word.pos,
         max(start.pos) OVER (PARTITION BY word.doc_id ORDER BY word.pos) AS last
  FROM word LEFT JOIN start ON word.doc_id = start.doc_id AND word.pos = start.pos),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE last > pos - 35) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE last IS NULL OR last <= pos - 35) AS kept
  FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

# CRC-32 of the decimal id, bit by bit; a leaf's proof is the other members of the run on each level.
ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([CAST(0 AS BIGINT) FOR x IN range(8)], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, byte)),
    CAST(4294967295 AS BIGINT))) % 3 = 0 AS altered
  FROM documents),
coded AS (
  SELECT doc_id, lang, altered, text,
    concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM d),
leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN altered THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS given
  FROM coded),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM leaf),
low AS (
  SELECT tree, 0 AS level, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM low WHERE n > 1 GROUP BY tree, level + 1, place // 8, (n + 7) // 8),
subroot AS (SELECT tree, digest FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM high WHERE n > 1 GROUP BY level + 1, place // 8, (n + 7) // 8),
run AS (
  SELECT 0 AS part, tree, level, place // 8 AS run, list(digest ORDER BY place) AS members FROM low WHERE n > 1 GROUP BY tree, level, place // 8
  UNION ALL
  SELECT 1, 0, level, place // 8, list(digest ORDER BY place) FROM high WHERE n > 1 GROUP BY level, place // 8),
way AS (
  SELECT p.doc_id, p.leaf, p.given, p.tree, r.part, r.level, members,
    ((CASE WHEN r.part = 0 THEN p.place ELSE p.tree END) >> (3 * r.level)) % 8 AS nth
  FROM placed p JOIN run r ON (r.part = 0 AND r.tree = p.tree AND p.place >> (3 * r.level + 3) = r.run)
    OR (r.part = 1 AND p.tree >> (3 * r.level + 3) = r.run)),
step AS (
  SELECT doc_id, leaf, part, level, array_to_string(list_slice(members, 1, nth), '') AS before, array_to_string(list_slice(members, nth + 2, 8), '') AS after FROM way),
proof AS (
  SELECT doc_id, leaf, string_agg(before || after, '' ORDER BY part, level) AS siblings,
    list({'before': before, 'after': after} ORDER BY part, level) AS steps FROM step GROUP BY doc_id, leaf),
folded AS (
  SELECT p.doc_id, p.leaf, s.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root, coalesce(siblings, '') AS siblings,
    list_reduce(coalesce(steps, []), lambda h, step: sha256(step.before || h || step.after), coalesce(given, p.leaf)) AS folded_root
  FROM placed p JOIN subroot s ON s.tree = p.tree LEFT JOIN proof ON proof.doc_id = p.doc_id AND proof.leaf = p.leaf)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
