"""Token counts that follow edits.

A text is cut into leaves of some `LEAF_CHARS` characters. Leaves only begin at a space after a character that is
not white space: there every pre-token of the tokenizer's pattern ends, whatever stands on either side, so that the
leaves' token counts add up to the text's. The counts are the leaves of a segment tree, kept as one array per
document. An edit re-encodes only the leaves it touches, together with the character before and after it, and
updates the sums on their paths; when it leaves more leaves than before, the tree is put together anew from
the known counts, without encoding other leaves.

Defined results: a null text counts as empty, and edits of it apply to the empty text. Edits of a document are
half-open ranges of code points of the text before any of them, applied together; they must not overlap or lie
outside the text (an error); several insertions at one place keep the order of their replacements' place in the
array. Null and empty arrays of edits change nothing. A text without such spaces is one leaf. Rows are not told
apart by id: each row is a document, and columns pass through.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 512
_CUT = re.compile(r"(?<=\S) ")


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    """Loaded once per worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def leaves(text: str) -> list[int]:
    """Lengths of the leaves of a text; none for the empty text."""
    out, begin = [], 0
    while begin < len(text):
        cut = _CUT.search(text, begin + LEAF_CHARS)
        end = cut.start() if cut else len(text)
        out.append(end - begin)
        begin = end
    return out


def tree(counts: list[int]) -> list[int]:
    """Segment tree over the counts: node 1 is the sum, node i has the children 2i and 2i + 1, leaves come last."""
    width = 1
    while width < len(counts):
        width *= 2
    nodes = [0] * width + list(counts) + [0] * (width - len(counts))
    for node in range(width - 1, 0, -1):
        nodes[node] = nodes[2 * node] + nodes[2 * node + 1]
    return nodes


class Counted:
    """A text with its leaves and their tree."""

    def __init__(self, text: str, sizes: list[int], nodes: list[int]):
        self.text, self.sizes, self.nodes, self.reencoded = text, sizes, nodes, 0

    def _set(self, leaf: int, count: int) -> None:
        node = len(self.nodes) // 2 + leaf
        change = count - self.nodes[node]
        while change and node:
            self.nodes[node] += change
            node //= 2

    def apply(self, edits: list[tuple[int, int, str]], encode) -> None:
        """Edits as (start, end, replacement), in the order of their start."""
        starts = np.concatenate(([0], np.cumsum(self.sizes))).astype(int).tolist()
        size, pieces, regions, done = len(self.text), [], [], 0
        for start, end, new in edits:
            if not done <= start <= end <= size:
                raise ValueError(f"edit {start}..{end} overlaps another or lies outside the text")
            done = end
            # Leaves with the edited characters and one more on each side.
            first = max(0, int(np.searchsorted(starts, max(start - 1, 0), side="right")) - 1)
            last = min(len(self.sizes), int(np.searchsorted(starts, min(end + 1, size), side="left")))
            if regions and (first < regions[-1][1] or first == regions[-1][0]):
                regions[-1][1] = max(last, regions[-1][1])
                regions[-1][2].append((start, end, new))
            else:
                regions.append([first, max(last, first), [(start, end, new)]])
        sizes, counts, at, same = [], [], 0, True
        known = self.nodes[len(self.nodes) // 2 :]
        for first, last, own in regions:
            sizes += self.sizes[at:first]
            counts += known[at:first]
            pieces.append(self.text[starts[at] : starts[first]])
            text, place = "", starts[first]
            for start, end, new in own:
                text += self.text[place:start] + new
                place = end
            text += self.text[place : starts[last]]
            cut = leaves(text)
            same &= len(cut) == last - first
            begin = 0
            for n, length in enumerate(cut):
                count = encode(text[begin : begin + length])
                begin += length
                if same:
                    self._set(first + n, count)
                counts.append(count)
            sizes += cut
            pieces.append(text)
            self.reencoded += len(text)
            at = last
        sizes += self.sizes[at:]
        counts += known[at : len(self.sizes)]
        pieces.append(self.text[starts[at] :])
        self.text, self.sizes = "".join(pieces), sizes
        if not same:
            self.nodes = tree(counts)


def _count(batches: Iterator[pa.RecordBatch], path: str, names: list[str], edited: bool, keep_text: bool):
    encoding = _encoding(path)
    encode = lambda text: len(encoding.encode_ordinary(text))
    for batch in batches:
        for row in range(0, batch.num_rows, 256):
            part = batch.slice(row, 256)
            made = {"text": [], "leaf_chars": [], "tree": [], "n_tokens": [], "n_before": [], "n_reencoded": []}
            rows = part.select([c for c in ("_text", "_leaf_chars", "_tree", "_edits") if c in part.schema.names]).to_pylist()
            for r in rows:
                text = r["_text"] or ""
                if edited:
                    state = Counted(text, r["_leaf_chars"], r["_tree"])
                    made["n_before"].append(state.nodes[1])
                    edits = sorted(r["_edits"] or [], key=lambda e: (e["start"], e["end"]))
                    if edits:
                        state.apply([(e["start"], e["end"], e["replacement"] or "") for e in edits], encode)
                else:
                    sizes, counts, begin = leaves(text), [], 0
                    for length in sizes:
                        counts.append(encode(text[begin : begin + length]))
                        begin += length
                    state = Counted(text, sizes, tree(counts))
                made["text"].append(state.text)
                made["leaf_chars"].append(state.sizes)
                made["tree"].append(state.nodes)
                made["n_tokens"].append(state.nodes[1])
                made["n_reencoded"].append(state.reencoded)
            columns = {n: part.column(n) for n in names}
            if keep_text:
                columns["_text"] = pa.array(made["text"], pa.string())
            columns["_leaf_chars"] = pa.array(made["leaf_chars"], pa.list_(pa.int32()))
            columns["_tree"] = pa.array(made["tree"], pa.list_(pa.int64()))
            columns["_n_tokens"] = pa.array(made["n_tokens"], pa.int64())
            if edited:
                columns["_n_before"] = pa.array(made["n_before"], pa.int64())
                columns["_n_reencoded"] = pa.array(made["n_reencoded"], pa.int64())
            yield pa.record_batch(list(columns.values()), names=list(columns))


_STATE = "_text string, _leaf_chars array<int>, _tree array<bigint>, _n_tokens bigint"


def count_tokens(docs: DataFrame, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """`docs` as a state table: the text column renamed to `_text`, with `_leaf_chars`, `_tree` and `_n_tokens`."""
    names = [c for c in docs.columns if c != text]
    kinds = "".join(f"`{n}` {docs.schema[n].dataType.simpleString()}, " for n in names)
    return docs.select(*names, F.col(text).alias("_text")).mapInArrow(
        partial(_count, path=path, names=names, edited=False, keep_text=True), kinds + _STATE
    )


def with_edits(state: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """`state` with the column `_edits` from a table of single edits (`key`, `start`, `end`, `replacement`)."""
    packed = edits.select(F.col(key).alias("_key"), F.struct("start", "end", "replacement").alias("_edit"))
    packed = packed.groupBy("_key").agg(F.sort_array(F.collect_list("_edit")).alias("_edits"))
    return state.join(packed, state[key] == F.col("_key"), "left").drop("_key")


def apply_edits(state: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """The state table after the edits in `_edits` (array of `start`, `end`, `replacement`), with `_n_before` (tokens
    before) and `_n_reencoded` (characters encoded again) instead of `_edits`."""
    own = {"_text", "_leaf_chars", "_tree", "_n_tokens", "_edits", "_n_before", "_n_reencoded"}
    names = [c for c in state.columns if c not in own]
    kinds = "".join(f"`{n}` {state.schema[n].dataType.simpleString()}, " for n in names)
    return state.select(*names, "_text", "_leaf_chars", "_tree", "_edits").mapInArrow(
        partial(_count, path=path, names=names, edited=True, keep_text=True),
        kinds + _STATE + ", _n_before bigint, _n_reencoded bigint",
    )
