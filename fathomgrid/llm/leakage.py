"""Evaluation passages in a corpus: rare n-gram seeds join documents to items, Smith-Waterman alignment decides.

Texts are compared as words in a form without case, markup, spacing and
character variants; items in scripts without spaces by character, Latin letters
among them too. A passage of at least 12 words with at most one in ten edited
holds a run of at least 6 unedited ones: with e edits in a span of L the L - e
clean words fall into e + 1 runs. For 24 characters it is 7. So of each run of
6 words the rarest 4-gram, of each run of 7 characters the rarest 5-gram, as
counted in the documents, is a set of seeds that misses nothing.

The corpus is read once. A bit filter over all n-grams of the items lets few of
a document's n-grams through; what surrounds them is stored, the n-grams are
counted, and the join by the rare ones gives the pairs to align. A passage of
48 characters or 24 words falls into two halves of which one is a passage, so
stretches of that length on both sides of a seed are enough.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid import storage

#: Least length of a passage in words, in characters of scripts without spaces, and unedited words per edited one.
WORDS, CHARACTERS, TENTH = 12, 24, 10
#: Units of a seed and of the clean run that every passage holds, by kind: words (0) and characters (1).
SEED, RUN = (4, 5), (6, 7)
#: n-grams of the item that a shortest passage keeps at least: of L - n + 1 each edit takes n.
SHARED = (5, 10)
#: Words on both sides of a seed in which a shortest passage lies, edits included.
REACH = (26, 53)
#: Words of a piece of a long item or of a document's stretch, and in which pieces of an item overlap.
PIECE, OVERLAP = 1024, 64
#: Bits of the filter over the items' n-grams, as a power of two; it travels to every task and has 8 MB whatever the items.
FILTER = 26

_INLINE = re.compile(r"</?(?:a|abbr|b|big|code|em|font|i|ins|del|kbd|mark|s|small|span|strong|sub|sup|tt|u)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[/!?]?[a-zA-Z][^<>]*>|<!--(?:(?!<!--).)*?-->", re.S)
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐\u00ad][^\S\n]*+\n\s*+(?:[>|]++\s*+)?(?=[^\W\d_])")
_MARKS = re.compile("[*_`~\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\u180e\ufe00-\ufe0f]")
_LINK = re.compile(r"\[([^\[\]]+)\]\([^()\s]*\)")
_WORD = re.compile(r"[\u0e00-\u0e7f\u3040-ヿ㐀-鿿豈-\ufaff]|[^\W_\u0e00-\u0e7f\u3040-ヿ㐀-鿿豈-\ufaff]+")
_DENSE = re.compile(r"[\u0e00-\u0e7f\u3040-ヿ㐀-鿿豈-\ufaff]")
_COMBINING = re.compile(r"[\u0300-\u036f\u0483-҉\u064b-\u0652\u1ab0-\u1aff\u20d0-\u20ff\ufe20-\ufe2f]")


def words(text: str | None) -> list[str]:
    """Words of a text in comparable form; characters of scripts without spaces singly."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "\n" in text:
        text = _BROKEN.sub("", text)
    text = _MARKS.sub("", text)
    if not text.isascii():
        text = _COMBINING.sub("", unicodedata.normalize("NFKD", text))
        text = unicodedata.normalize("NFC", text)
        text = _MARKS.sub("", text)
        if any(c.isdecimal() and c > "9" for c in text):
            text = "".join(str(unicodedata.decimal(c)) if c > "9" and c.isdecimal() else c for c in text)
    return _WORD.findall(text.casefold())


def is_dense(tokens: list[str]) -> bool:
    """Whether at least half of the words are characters of scripts without spaces."""
    return bool(tokens) and 2 * sum(bool(_DENSE.match(t)) for t in tokens) >= len(tokens)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def grams(codes: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of unit codes."""
    n = SEED[kind]
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(codes) - n + 1, kind + 1, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
    return _mix(h)


class Coder:
    """Codes of words, remembered; a bounded number of them."""

    def __init__(self, most: int = 1 << 20):
        self.known: dict[str, int] = {}
        self.most = most

    def words(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for t in tokens:
            if t not in known:
                known[t] = xxhash.xxh3_64_intdigest(t)
        return np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))

    @staticmethod
    def characters(tokens: list[str]) -> np.ndarray:
        return np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def alignments(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Local alignments of two sequences of numbers, best first, that share no cell.

    Scores +2 for equal words and -1 for a replaced, dropped or added one, so
    that a path goes on over an edit to a single equal word behind it.
    Yields the score and the cells (i, j) of the path, -1 for a gap. Rows are
    computed at once: the best score that arrives by dropping words along a row
    is a running maximum. The shorter sequence makes the rows.
    """
    if len(a) > len(b):
        for score, path in alignments(b, a):
            yield score, [(x, y) for y, x in path]
        return
    n, m = len(a), len(b)
    same = np.where(a[:, None] == b[None, :], 2, -1).astype(np.int32)
    used = np.zeros((n, m), bool)
    across = np.arange(m + 1, dtype=np.int32)
    full = np.zeros(m + 1, np.int32)
    masked = False
    while True:
        h = np.zeros((n + 1, m + 1), np.int32)
        for i in range(n):
            row = np.maximum(h[i, :-1] + same[i], h[i, 1:] - 1)
            if masked:
                row[used[i]] = 0
            np.add(row, across[1:], out=full[1:])
            np.maximum(np.maximum.accumulate(full) - across, 0, out=h[i + 1])
            if masked:
                h[i + 1, 1:][used[i]] = 0
        masked = True
        best = int(h.max())
        if best <= 0:
            return
        i, j = np.unravel_index(int(h.argmax()), h.shape)
        path = []
        while i > 0 and j > 0 and h[i, j] > 0:
            if h[i, j] == h[i - 1, j - 1] + same[i - 1, j - 1]:
                path.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif h[i, j] == h[i - 1, j] - 1:
                path.append((i - 1, -1))
                i -= 1
            else:
                path.append((-1, j - 1))
                j -= 1
        path.reverse()
        for x, y in path:
            if x >= 0 and y >= 0:
                used[x, y] = True
        yield best, path


def _qualifies(a: np.ndarray, b: np.ndarray, weights: list[int], least: int, floor: int) -> bool:
    """Whether words b (of a document) hold a passage of the item's words a.

    A passage has weight `least`, where an edited word weighs one, and at most
    one edit for ten words of the item. No passage scores below `floor`.
    """
    for score, path in alignments(a, b):
        if score < floor:
            return False
        cost = [0 if x >= 0 and y >= 0 and a[x] == b[y] else 1 for x, y in path]
        span = [0 if x < 0 else 1 if c else weights[x] for (x, _), c in zip(path, cost)]
        count = [1 if x >= 0 else 0 for x, _ in path]
        for s in range(len(path)):
            if cost[s]:
                continue
            edits = length = tokens = 0
            for e in range(s, len(path)):
                edits += cost[e]
                length += span[e]
                tokens += count[e]
                if length >= least and edits * TENTH <= tokens:
                    return True
    return False


def _numbers(own: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two sequences as numbers, equal where the units are; units of `other` alone are -1 and those at its ends are cut off."""
    codes = {t: n for n, t in enumerate(dict.fromkeys(own))}
    b = np.array([codes.get(t, -1) for t in other], np.int32)
    near = np.flatnonzero(b >= 0)
    return np.array([codes[t] for t in own], np.int32), b[near[0] : near[-1] + 1] if len(near) else b[:0]


def holds(item: list[str], stretch: list[str], kind: int, shared: np.ndarray) -> bool:
    """Whether a stretch of a document's words holds a passage of an item's words.

    By words; items in scripts without spaces (kind 1) by characters, or, with
    an edit, by words that have 24 characters. shared: sorted places of the
    item's n-grams that the stretch has too; passages lie around them.
    """
    if len(shared) < SHARED[kind]:
        return False
    a, b = max(0, int(shared[0]) - REACH[kind]), int(shared[-1]) + SEED[kind] + REACH[kind]
    if not kind:
        item = item[a:b]
        return _qualifies(*_numbers(item, stretch), [1] * len(item), WORDS, 2 * (WORDS - 1) - 1)
    letters = list("".join(item))[a:b]
    if _qualifies(*_numbers(letters, list("".join(stretch))), [1] * len(letters), CHARACTERS, 2 * (CHARACTERS - 2) - 2):
        return True
    return _qualifies(*_numbers(item, stretch), [len(t) for t in item], CHARACTERS, 2 * (TENTH - 1) - 1)


_ITEMS = "item long, piece int, kind int, words string, hashes array<long>"
_HITS = "row long, part int, doc_id long, kind int, words string, hashes array<long>"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _prepared(items: DataFrame) -> DataFrame:
    """Items as rows item, kind, words and the hashes of their n-grams in order; those shorter than a passage are left out.

    Long items come in pieces that overlap by more than a shortest passage.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for b in it:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = words(text)
                kind = int(is_dense(tokens))
                if (sum(map(len, tokens)) if kind else len(tokens)) < (CHARACTERS if kind else WORDS):
                    continue
                for s in range(0, max(1, len(tokens) - OVERLAP), PIECE - OVERLAP):
                    part = tokens[s : s + PIECE]
                    rows.append((i, s, kind, " ".join(part), grams(coder.characters(part) if kind else coder.words(part), kind).view(np.int64)))
            yield _batch(rows, _ITEMS)

    return items.mapInArrow(batches, _ITEMS)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter for hashes."""
    return h >> np.uint64(64 - FILTER), (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FILTER)


def _filter(prepared: DataFrame) -> np.ndarray:
    """Bit filter over all n-grams of the items: of a fixed size, its words combined where the items are."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            h = b.column(0).values.to_numpy(zero_copy_only=False)[b.column(0).offsets[0].as_py() : b.column(0).offsets[-1].as_py()] if len(b) else np.zeros(0, np.int64)
            bit = np.unique(np.concatenate(_places(h.view(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    found = prepared.select("hashes").mapInArrow(batches, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _stretches(at: np.ndarray, reach: int, n: int) -> Iterator[tuple[int, int, int, int]]:
    """Words around sorted places, close ones together: first and last place (by index), start and end."""
    first = 0
    for k in range(1, len(at) + 1):
        if k == len(at) or at[k] - at[k - 1] > 2 * reach or at[k] - at[first] > PIECE:
            yield first, k, max(0, int(at[first]) - reach), min(n, int(at[k - 1]) + reach + RUN[1])
            first = k


def _hits(documents: DataFrame, bits: np.ndarray) -> DataFrame:
    """Stretches of the documents (row, doc_id, text) around n-grams that the filter lets through."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, coder, one = shared.value, Coder(), np.uint64(1)

        def known(h: np.ndarray) -> np.ndarray:
            p, q = _places(h)
            at = np.flatnonzero((table[p >> np.uint64(6)] >> (p & np.uint64(63))) & one)
            q = q[at]
            return at[((table[q >> np.uint64(6)] >> (q & np.uint64(63))) & one).astype(bool)]

        for b in it:
            rows: list[tuple] = []
            for row, doc, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                tokens = words(text)
                for kind in (0, 1):
                    h = grams(coder.characters(tokens) if kind else coder.words(tokens), kind)
                    at = known(h)
                    if not len(at):
                        continue
                    h = h[at].view(np.int64)
                    if kind:
                        at = np.searchsorted(np.cumsum([len(t) for t in tokens]), at, side="right")
                    rows += [(row, 2 * k + kind, doc, kind, " ".join(tokens[s:e]), np.unique(h[f:t])) for k, (f, t, s, e) in enumerate(_stretches(at, REACH[kind], len(tokens)))]
            yield _batch(rows, _HITS)

    return documents.select("row", "doc_id", "text").mapInArrow(batches, _HITS)


def rare_seeds(prepared: DataFrame, counts: DataFrame) -> DataFrame:
    """Seeds of the items: of each clean run that a passage must hold, the n-gram in the fewest stretches.

    Ties go to the smaller hash. A run with an n-gram that occurs nowhere is in
    no document and gives no seed. Columns: item, piece, hash.
    """
    places = prepared.select("item", "piece", F.posexplode("hashes").alias("pos", "hash"))
    counted = places.join(counts, "hash", "left").withColumn("g", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash"))
    run = Window.partitionBy("item", "piece").orderBy("pos").rowsBetween(0, RUN[0] - SEED[0])
    rarest = counted.select("item", "piece", F.min("g").over(run).alias("g"), F.count(F.lit(1)).over(run).alias("size"))
    return rarest.where((F.col("size") > RUN[0] - SEED[0]) & (F.col("g.n") > 0)).select("item", "piece", F.col("g.hash").alias("hash")).distinct()


def _aligned(pairs: DataFrame) -> DataFrame:
    """Of pairs of a stretch and an item's piece those where the stretch holds a passage."""
    schema = "row long, doc_id long, item long"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = []
            for r, d, k, stretch, own, i, item, hashes in zip(*(b.column(n).to_pylist() for n in range(4)), b.column(4), b.column(5).to_pylist(), b.column(6).to_pylist(), b.column(7)):
                shared = np.flatnonzero(np.isin(hashes.values.to_numpy(), own.values.to_numpy()))
                if holds(item.split(" "), stretch.split(" "), k, shared):
                    found.append((r, d, i))
            yield _batch(found, schema)

    return storage.scatter(pairs.select("row", "doc_id", "kind", "stretch", "own", "item", "words", "hashes")).mapInArrow(batches, schema)


def leaks(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Pairs (item_id, doc_id) where the document holds a passage of the item.

    Null and empty texts hold nothing; repeated documents give a row each,
    repeated items once; items shorter than a passage can't leak. Extra columns
    are ignored, empty tables give none. Texts of any length are read whole.
    """
    own = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    named, _ = storage.materialise(own.groupBy("text").agg(F.collect_set("item_id").alias("ids")).withColumn("item", F.monotonically_increasing_id()), "items")
    prepared, _ = storage.materialise(_prepared(named.select("item", "text")), "item-grams")
    texts = storage.spread(documents.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    hits, _ = storage.materialise(_hits(texts.withColumn("row", F.monotonically_increasing_id()), _filter(prepared)), "hits")
    found = hits.select("row", "part", F.explode("hashes").alias("hash"))
    seeds = rare_seeds(prepared, found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")))
    candidates = found.join(seeds, "hash").select("row", "part", "item", "piece").distinct()
    stretches = hits.select("row", "part", "doc_id", F.col("words").alias("stretch"), F.col("hashes").alias("own"))
    leaked = _aligned(candidates.join(stretches, ["row", "part"]).join(prepared, ["item", "piece"])).distinct().join(named.select("item", "ids"), "item")
    return leaked.select(F.explode("ids").alias("item_id"), "doc_id")
