"""Small tables for the operators' tests."""

import random
import re
from pathlib import Path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Rows as (doc_id, text) or (doc_id, text, lang, source), with the columns of `documents`."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "s0")[:4] if len(row) < 4 else row
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))


def prose(seed, count, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def edited(text, seed, changes):
    rng, parts = random.Random(seed), text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"new{rng.randrange(10**6)}"
    return " ".join(parts)


def sample_table(spark, name):
    return spark.read.parquet(str(Path(SF) / f"{name}.parquet"))
