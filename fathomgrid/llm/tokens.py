"""Encoding of whole texts with a public byte-level BPE vocabulary by tree reduction.

A text is halved until the parts are short, the parts are encoded, and
neighbours are joined up the tree. Encoding splits a text into pieces from left
to right and a piece depends on no more than `LOOK` characters after its end.
So of two neighbours only the pieces around the seam can change: a window over
the seam is encoded anew and grows to the right until its pieces meet a piece
start of the right part again; from there on both agree.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage

#: Folder of the vocabulary files.
TOKENIZERS = "/opt/tokenizers"

# The split pattern that belongs to the public vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters after the end of a piece that its match may have looked at: the longest alternative is three long and starts with a piece of one.
LOOK = 3

#: Texts are halved until the parts have no more characters than this.
LEAF = 1024
#: Pieces remembered with their ids, and the longest one that is.
REMEMBERED, LONGEST = 1 << 17, 48

#: A run of pieces: offset of each piece, its ids, and the length of the text.
Part = tuple[list[int], list[list[int]], int]


def _leaf(text: str, encode: Callable[[str], list[int]], split: regex.Pattern) -> Part:
    """A text cut into pieces, which cover it without gaps, and encoded piece by piece."""
    pieces = split.findall(text)
    starts = list(accumulate(map(len, pieces), initial=0))
    return starts[:-1], [encode(p) for p in pieces], len(text)


def join(left: Part, right: Part, text: str, at: int, encode: Callable[[str], list[int]], split: regex.Pattern) -> Part:
    """The part of two neighbours; `text` is the whole text and `at` the offset where `left` begins."""
    ls, li, ln = left
    rs, ri, rn = right
    if not ln or not rn:
        return right if not ln else left
    keep = len(ls) - 1
    while keep > 0 and ls[keep] + LOOK > ln:
        keep -= 1
    begin = ls[keep]
    grow = 64
    while True:
        end = min(rn, grow)
        window = text[at + begin : at + ln + end]
        starts, ids, size = _leaf(window, encode, split)
        meet = None
        for k, s in enumerate(starts):
            there = s + begin - ln
            if there < 0:
                continue
            if s + LOOK > size and end < rn:
                break
            i = bisect_left(rs, there)
            if i < len(rs) and rs[i] == there:
                meet = k, i
                break
        if meet is not None or end == rn:
            break
        grow *= 2
    k, i = meet if meet is not None else (len(starts), len(rs))
    merged = ls[:keep] + [s + begin for s in starts[:k]] + [s + ln for s in rs[i:]]
    return merged, li[:keep] + ids[:k] + ri[i:], ln + rn


def tree(text: str, encode: Callable[[str], list[int]], split: regex.Pattern, leaf: int = LEAF) -> list[int]:
    """Ids of a text by halving it and joining the halves."""

    def part(a: int, b: int) -> Part:
        if b - a <= leaf:
            return _leaf(text[a:b], encode, split)
        middle = (a + b) // 2
        return join(part(a, middle), part(middle, b), text, a, encode, split)

    return list(chain.from_iterable(part(0, len(text))[1]))


class Encoder:
    """Encodes texts with the ranks of a vocabulary file."""

    def __init__(self, ranks: bytes, leaf: int = LEAF):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.core = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})
        self.split, self.leaf = regex.compile(SPLIT), leaf
        self.known: dict[str, list[int]] = {}

    def piece(self, text: str) -> list[int]:
        """Ids of one piece; pieces of usual length are remembered."""
        found = self.known.get(text)
        if found is None:
            found = self.core.encode_ordinary(text)
            if len(text) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[text] = found
        return found

    def ids(self, text: str | None) -> list[int]:
        """Ids without special tokens; null and empty texts have none."""
        if not text:
            return []
        return tree(text, self.piece, self.split, self.leaf)

    def text(self, ids: list[int]) -> str:
        return self.core.decode(ids)


def vocabulary(folder: str, name: str = "byte_bpe_50k") -> bytes:
    """Bytes of a rank file, under 1 MB; they travel to the executors with the query."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return f.read()


def encode(documents: DataFrame, tokenizers: str = TOKENIZERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id and ids of every document, one row per row of the input.

    Null and empty texts give an empty list, blank ones the ids of their white
    space. Strings of special tokens in a text are ordinary text. Repeated rows
    stay repeated, extra columns are ignored, an empty table gives none.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(vocabulary(tokenizers))
    schema = f"{doc_id} long, ids array<int>"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value)
        for b in it:
            lists = [encoder.ids(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lists, pa.list_(pa.int32()))], names=[doc_id, "ids"])

    return storage.spread(documents.select(F.col(doc_id).cast("long").alias(doc_id), text)).mapInArrow(batches, schema)
