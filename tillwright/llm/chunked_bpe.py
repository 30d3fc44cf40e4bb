"""BPE encoding that encodes what documents share once, and decoding.

Texts are cut where a rolling hash of the bytes before a place ends in zeros, so the same passage is cut alike in
every document that holds it. Chunks that occur more than once are encoded once for the whole corpus; what stands
between them is encoded where it is read. Then the pieces of a document are put together. A cut may split a word,
so each join is repaired: from the last place before it to the first one after it where the tokenizer must cut
whatever stands around, the text is encoded anew. Such a place is a space after a visible ASCII character: no
pre-token of the pattern and no special token reaches over it. Both sides' tokens agree with the whole text's up
to there; a piece without such a place is taken into the repair as a whole, which goes on to the next one. So the
tokens are exactly those of the whole text, and each byte is encoded twice at most.

A bit table of the hashes that were counted twice (at most 32 MB, by their number) tells likely shared chunks apart
before anything is shuffled. A chunk it lets through by chance is joined like a shared one. Beyond some 10^8 shared
chunks most chunks take that way: more is shuffled and the result stays the same. Texts of shared chunks are sent
once per task, other text not at all. A chunk that a third of all documents share is one row on its own side of
the join, and slim rows on the other, which adaptive execution splits.

The vocabulary file is a byte-level BPE in the format of the tokenizers library; it lies on every node, or where
`path` says. Merges follow the order of the vocabulary's numbers. Texts that hold a special token's string are
encoded by the tokenizers library itself, which gives them the special number.

Defined results: a null or empty text has no tokens, which decode to the empty text. Rows are not told apart by id:
each row is a document. Null ids decode to the empty text, unknown numbers are an error, bytes that are no UTF-8
become U+FFFD. Other columns pass through, and `ids` (`decoded`) replaces a column of this name. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm import bits
from tillwright.llm import words as W
from tillwright.llm.tokens import PATTERN
from tillwright.session import written

VOCABULARY = "byte_bpe_50k.json"
# A chunk has 2^CHUNK_BITS bytes on average; the hash looks at WINDOW bytes.
CHUNK_BITS, WINDOW = 9, 16
# Bits of the table of shared chunks: 16 a chunk, within these bounds.
TABLE_BITS = (16, 28)

_SCRAMBLED = (W.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_STEP = 0x2C1B3C6D  # odd


def installed(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Encoder and decoder of one file; loaded once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        pre = given["pre_tokenizer"]
        if given["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or given["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without prefix space and normalizer is needed")
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): n for token, n in given["model"]["vocab"].items()}
        self.special = [t["content"] for t in given["added_tokens"]]
        if any(" " in content for content in self.special):
            raise ValueError("special tokens must not hold spaces")
        self._fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        size = 1 + max([*ranks.values(), *(t["id"] for t in given["added_tokens"])])
        self.bytes_of = [b""] * size
        for token, n in ranks.items():
            self.bytes_of[n] = token
        for token in given["added_tokens"]:
            self.bytes_of[token["id"]] = token["content"].encode()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.spaced = np.array([t[:1] == b" " for t in self.bytes_of])
        self.solid = np.array([b"!" <= t[-1:] <= b"~" for t in self.bytes_of])

    def encode(self, text: bytes) -> np.ndarray:
        given = text.decode("utf-8")
        if any(content in given for content in self.special):
            return np.array(self._whole.encode(given, add_special_tokens=False).ids, self.kind)
        return np.array(self._fast.encode_ordinary(given), self.kind)

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes_of[n] for n in ids.tolist()])

    def cuts(self, ids: np.ndarray) -> np.ndarray:
        """Tokens, but for the first, that begin where any text around them is cut."""
        return np.flatnonzero(self.spaced[ids[1:]] & self.solid[ids[:-1]]) + 1


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(installed(path))


def joined(pieces: list[np.ndarray], known: Vocabulary) -> np.ndarray:
    """Tokens of the whole text from the tokens of its pieces."""
    out: list[np.ndarray] = []
    waiting: list[np.ndarray] = []  # tokens since the last certain cut
    for piece in pieces:
        if not len(piece):
            continue
        cuts = known.cuts(piece)
        at_join = bool(waiting) and bool(known.spaced[piece[0]] and known.solid[waiting[-1][-1]])
        first = 0 if at_join else int(cuts[0]) if len(cuts) else -1
        if waiting and first >= 0:
            if at_join and len(waiting) == 1:
                out += waiting  # nothing was joined to it
            else:
                out.append(known.encode(b"".join([*map(known.text, waiting), known.text(piece[:first])])))
            waiting, piece = [], piece[first:]
            cuts = cuts[cuts > first] - first
        if waiting:
            waiting.append(piece)
            continue
        last = int(cuts[-1]) if len(cuts) else 0
        out.append(piece[:last])
        waiting = [piece[last:]]
    if len(waiting) > 1:
        out.append(known.encode(b"".join(map(known.text, waiting))))
    else:
        out += waiting
    return np.concatenate(out) if out else np.zeros(0, known.kind)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the `WINDOW` bytes before each place from `WINDOW` on."""
    value, width = _SCRAMBLED[data], 1
    while width < WINDOW:
        value = value[: len(value) - width] * np.uint32(pow(_STEP, width, 1 << 32)) + value[width:]
        width *= 2
    return (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)


def chunked(part: pa.RecordBatch, chunk_bits: int) -> Iterator[list[bytes]]:
    """The chunks of each text: bytes of whole characters, which make up the text."""
    raw, offsets = W.text_bytes(part.column("_text"))
    cuts = np.zeros(0, np.int64)
    if len(raw) > WINDOW:
        cuts = np.flatnonzero(_rolling(raw)[:-1] >> np.uint32(32 - chunk_bits) == 0) + WINDOW
        own = np.searchsorted(offsets, cuts, side="right") - 1  # the text of each cut
        cuts = cuts[(cuts - offsets[own] >= WINDOW) & (raw[cuts] & 0xC0 != 0x80)]
    data, first = raw.tobytes(), np.searchsorted(cuts, offsets)
    for begin, end, low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first[:-1].tolist(), first[1:].tolist()):
        edges = [begin, *cuts[low:high].tolist(), end]
        yield [data[a:b] for a, b in zip(edges, edges[1:]) if a < b]


def _key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _hashes(batches: Iterator[pa.RecordBatch], chunk_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.chunks(batch, "_text"):
            keys = b"".join([_key(chunk) for chunks in chunked(part, chunk_bits) for chunk in chunks])
            yield pa.record_batch([pa.array(np.frombuffer(keys, np.int64)[::2].copy(), pa.int64())], names=["hash"])


def _segments(chunks: list[bytes], likely: list[bool]) -> list[tuple[bool, bytes]]:
    """Pieces of a text: single likely shared chunks, and what stands between them."""
    pieces: list[tuple[bool, bytes]] = []
    own: list[bytes] = []
    for chunk, share in zip(chunks, likely):
        if share:
            if own:
                pieces.append((False, b"".join(own)))
                own = []
            pieces.append((True, chunk))
        else:
            own.append(chunk)
    return [*pieces, (False, b"".join(own))] if own else pieces


def _segmented(part: pa.RecordBatch, shared: np.ndarray, chunk_bits: int) -> Iterator[tuple[bytes, list[tuple[bool, bytes]]]]:
    """Key and pieces of each text."""
    texts = list(chunked(part, chunk_bits))
    keys = b"".join([_key(chunk) for chunks in texts for chunk in chunks])
    likely = bits.inside(shared, np.frombuffer(keys, np.int64)[::2].copy().view(np.uint64)).tolist()
    at = 0
    for chunks in texts:
        yield _key(b"".join(chunks)), _segments(chunks, likely[at : at + len(chunks)])
        at += len(chunks)


def _numbers(keys: list[bytes]) -> list[pa.Array]:
    """128-bit keys as two columns of bigint."""
    halves = np.frombuffer(b"".join(keys), np.int64)
    return [pa.array(halves[0::2].copy(), pa.int64()), pa.array(halves[1::2].copy(), pa.int64())]


def _references(batches: Iterator[pa.RecordBatch], shared: Broadcast, chunk_bits: int) -> Iterator[pa.RecordBatch]:
    """Likely shared chunks of each different text, with their bytes where the task meets them first."""
    seen: set[bytes] = set()
    for batch in batches:
        for part in W.chunks(batch, "_text"):
            docs, places, keys, texts = [], [], [], []
            for doc, pieces in _segmented(part, shared.value, chunk_bits):
                if doc in seen:
                    continue
                seen.add(doc)
                for at, (share, chunk) in enumerate(pieces):
                    if share:
                        key = _key(chunk)
                        docs.append(doc)
                        places.append(at)
                        keys.append(key)
                        texts.append(None if b"c" + key in seen else chunk)
                        seen.add(b"c" + key)
            columns = [*_numbers(docs), pa.array(places, pa.int32()), *_numbers(keys), pa.array(texts, pa.binary())]
            yield pa.record_batch(columns, names=["doc1", "doc2", "at", "key1", "key2", "text"])


def _own(batches: Iterator[pa.RecordBatch], names: list[str], shared: Broadcast, chunk_bits: int, path: str) -> Iterator[pa.RecordBatch]:
    """Per document the key of its text, the tokens of the pieces that are not shared, packed, and their numbers
    (-1 for a shared piece)."""
    known, pack = vocabulary(path), zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for part in W.chunks(batch, "_text"):
            docs, sizes, blobs = [], [], []
            for doc, pieces in _segmented(part, shared.value, chunk_bits):
                tokens = [None if share else known.encode(text) for share, text in pieces]
                docs.append(doc)
                sizes.append([-1 if ids is None else len(ids) for ids in tokens])
                blobs.append(pack(b"".join([ids.tobytes() for ids in tokens if ids is not None])))
            added = [*_numbers(docs), pa.array(sizes, pa.list_(pa.int32())), pa.array(blobs, pa.binary())]
            yield pa.record_batch([*[part.column(n) for n in names], *added], names=[*names, "_doc1", "_doc2", "_sizes", "_own"])


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = vocabulary(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            ids = [known.encode(text).tobytes() for text in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("key1"), part.column("key2"), pa.array(ids, pa.binary())], names=["key1", "key2", "ids"])


def _assembled(batches: Iterator[pa.RecordBatch], names: list[str], path: str) -> Iterator[pa.RecordBatch]:
    known, unpack = vocabulary(path), zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            for sizes, own, found in zip(*[part.column(n).to_pylist() for n in ("_sizes", "_own", "_found")]):
                shared = {one["at"]: np.frombuffer(one["ids"], known.kind) for one in found or []}
                tokens, begin, pieces = np.frombuffer(unpack(own), known.kind), 0, []
                for place, size in enumerate(sizes):
                    if size < 0:
                        pieces.append(shared[place])
                    else:
                        pieces.append(tokens[begin : begin + size])
                        begin += size
                rows.append(joined(pieces, known))
            ids = W.listed(np.array([len(ids) for ids in rows], np.int64), np.concatenate(rows).astype(np.int32), pa.int32())
            yield pa.record_batch([*[part.column(n) for n in names], ids], names=[*names, "ids"])


def _shared(texts: DataFrame, chunk_bits: int) -> np.ndarray:
    """Bit table of the chunks that occur more than once."""
    hashes = texts.select("_text").mapInArrow(partial(_hashes, chunk_bits=chunk_bits), "hash bigint")
    again = written(hashes.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared-chunks")
    wanted = (16 * max(1, again.count())).bit_length()
    return bits.table(again, "hash", min(max(wanted, TABLE_BITS[0]), TABLE_BITS[1]))


def encode(docs: DataFrame, text: str = "text", path: str = VOCABULARY, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """`docs` with `ids` (array of int), the tokens of the whole text, in place of the text column."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in (text, "ids")]
    own = {n: f"_c{i}" for i, n in enumerate(names)}
    texts = docs.select(*[F.col(n).alias(c) for n, c in own.items()], F.col(text).alias("_text"))
    kinds = "".join(f"{c} {docs.schema[n].dataType.simpleString()}, " for n, c in own.items())
    shared = spark.sparkContext.broadcast(_shared(texts, chunk_bits))
    references = written(
        texts.select("_text").mapInArrow(
            partial(_references, shared=shared, chunk_bits=chunk_bits),
            "doc1 bigint, doc2 bigint, at int, key1 bigint, key2 bigint, text binary",
        ),
        "references",
    )
    chunks = references.where("text IS NOT NULL").groupBy("key1", "key2").agg(F.first("text").alias("text"))
    chunks = written(chunks.mapInArrow(partial(_encoded, path=path), "key1 bigint, key2 bigint, ids binary"), "chunks")
    # Texts that agree share their references, however many tasks met them.
    found = references.drop("text").distinct().join(chunks, ["key1", "key2"])
    found = found.groupBy(F.col("doc1").alias("_doc1"), F.col("doc2").alias("_doc2")).agg(
        F.collect_list(F.struct("at", "ids")).alias("_found")
    )
    out = texts.mapInArrow(
        partial(_own, names=list(own.values()), shared=shared, chunk_bits=chunk_bits, path=path),
        kinds + "_doc1 bigint, _doc2 bigint, _sizes array<int>, _own binary",
    )
    out = out.join(found, ["_doc1", "_doc2"], "left").select(*own.values(), "_sizes", "_own", "_found").mapInArrow(
        partial(_assembled, names=list(own.values()), path=path), kinds + "ids array<int>"
    )
    return out.withColumnsRenamed({c: n for n, c in own.items()})


def _decoded(batches: Iterator[pa.RecordBatch], names: list[str], path: str) -> Iterator[pa.RecordBatch]:
    known = vocabulary(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = []
            for ids in part.column("_ids"):
                numbers = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, np.int32)
                if len(numbers) and not 0 <= numbers.min() <= numbers.max() < len(known.bytes_of):
                    raise ValueError("a number is not in the vocabulary")
                texts.append(known.text(numbers).decode("utf-8", "replace"))
            yield pa.record_batch([*[part.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, "decoded"])


def decode(encoded: DataFrame, ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """`encoded` with `decoded`, the text of the tokens; special tokens stay in it."""
    names = [c for c in encoded.columns if c != "decoded"]
    own = {n: f"_c{i}" for i, n in enumerate(names)}
    given = encoded.select(*[F.col(n).alias(c) for n, c in own.items()], F.col(ids).alias("_ids"))
    kinds = "".join(f"{c} {encoded.schema[n].dataType.simpleString()}, " for n, c in own.items())
    out = given.mapInArrow(partial(_decoded, names=list(own.values()), path=path), kinds + "decoded string")
    return out.withColumnsRenamed({c: n for n, c in own.items()})
