"""Benchmark decontamination by SimHash over item-sized windows.

Every text is read whole, as words in lower case without ASCII punctuation. Windows as long as a benchmark item
that hold at least one of the benchmark's 5-word shingles get a 64-bit SimHash of their shingles (a window
without any can't be similar). Fingerprints are cut into one block more than the search radius, so two
within the radius agree in a block: a table of the items by block finds all of them. Each candidate is then
verified by the exact weighted similarity of its shingles, the weight being how often a shingle stands:
sum of the lesser weights over sum of the greater ones.

At the threshold of 0.8 two windows of equal size differ in about 10 of 64 bits; a radius of 20 is more
than three standard deviations beyond, and exact copies differ in none.

A window at a text's edge may be cut by it, as long as what is left can reach the threshold. A text shorter
than an item is one window. Its shingles are looked up in those of the items, and items that it shares
enough with are verified at any distance.

The benchmark is sent to the executors in blocks of bounded size, and each block is held against all texts
in one pass without a shuffle. The driver holds one block at a time.

Defined results: an item of fewer than 5 words is one shingle; items or texts without words match nothing;
null ids are kept; equal items all match; for each document and item the best window, then the first, is
reported; repeated rows give repeated results.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 20
#: Characters of benchmark text that are sent to the executors at a time.
BLOCK_CHARS = 16_000_000
_BITS = 64
_BLANKS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 20


class Match(NamedTuple):
    item: int
    start: int
    similarity: float
    distance: int
    words: int


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").lower().encode().translate(_BLANKS).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of k words; fewer words are one run."""
    k = min(k, len(words))
    if not k:
        return words
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ words[i : i + len(out)]) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


def _planes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    bits = np.unpackbits((hashes * _FACTOR).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


def _totals(hashes: np.ndarray) -> np.ndarray:
    """Sums of the planes up to each place."""
    return np.concatenate([np.zeros((1, _BITS), np.int32), np.cumsum(_planes(hashes), axis=0, dtype=np.int32)])


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each run of `size` shingles."""
    total = _totals(hashes)
    return _packed(total[size:] - total[:-size])


def similarity(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


class Items:
    """A block of the benchmark: shingles to find windows by, fingerprints by block, shingle weights."""

    def __init__(self, texts: list[str | None], threshold: float = THRESHOLD, radius: int = RADIUS):
        self.threshold, self.radius = threshold, radius
        words = [word_hashes(t) for t in texts]
        self.sizes = [len(w) for w in words]
        grams = [shingles(w) for w in words]
        self.weights = [Counter(g.tolist()) for g in grams]
        self.prints = [int(fingerprints(g, len(g))[0]) if len(g) else 0 for g in grams]
        cuts = np.linspace(0, _BITS, radius + 2).astype(int)
        self.blocks = [(int(a), (1 << int(b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.table: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        self.known: dict[int, np.ndarray] = {}
        self.slots: dict[int, np.ndarray] = {}
        owners: dict[int, set[int]] = defaultdict(set)
        by_length: dict[int, list[np.ndarray]] = defaultdict(list)
        for i, n in enumerate(self.sizes):
            if not n:
                continue
            by_length[min(n, SHINGLE)].append(grams[i])
            for g in grams[i].tolist():
                owners[g].add(n)
            for k, (shift, mask) in enumerate(self.blocks):
                self.table[n, k, self.prints[i] >> shift & mask].append(i)
        self.sizes_of = dict(owners)
        self.longest = max(self.sizes, default=0)
        # Each item's different shingles in order, to hold short texts against.
        distinct = [np.unique(g) for g in grams]
        flat = np.concatenate([np.empty(0, np.uint64), *distinct])
        order = np.argsort(flat, kind="stable")
        self.postings = flat[order]
        self.posting_items = np.repeat(np.arange(len(grams)), [len(g) for g in distinct])[order]
        self.n_grams = np.array([len(g) for g in grams], np.int64)
        self.n_words = np.array(self.sizes, np.int64)
        for k, parts in by_length.items():
            self.known[k] = np.unique(np.concatenate(parts))
            self.slots[k] = np.zeros(_SLOTS, bool)
            self.slots[k][self.known[k] & np.uint64(_SLOTS - 1)] = True

    def _hits(self, grams: np.ndarray, k: int) -> np.ndarray:
        # A table of low bits passes over nearly all shingles before the exact look-up.
        maybe = np.flatnonzero(self.slots[k][grams & np.uint64(_SLOTS - 1)])
        own = self.known[k]
        at = np.minimum(np.searchsorted(own, grams[maybe]), len(own) - 1)
        return maybe[own[at] == grams[maybe]]

    def matches(self, text: str | None) -> list[Match]:
        words, best = word_hashes(text), {}
        for k in self.known:
            if len(words) < k:
                continue
            grams = shingles(words, k)
            hits = self._hits(grams, k)
            places: dict[int, list[int]] = defaultdict(list)
            for p in hits.tolist():
                for n in self.sizes_of[int(grams[p])]:
                    if min(n, SHINGLE) == k:
                        places[n].append(p)
            for n, at in places.items():
                if n <= len(words):
                    self._around(grams, n, n - k + 1, at, best)
            if k == SHINGLE and len(words) < self.longest and len(hits):
                self._whole(grams, grams[hits], len(words), best)
        return [best[i] for i in sorted(best)]

    def _whole(self, grams: np.ndarray, hits: np.ndarray, n: int, best: dict[int, Match]) -> None:
        """A text of n words and `grams` against all longer items, by its shingles that items have."""
        values, weights = np.unique(hits, return_counts=True)
        lo, hi = np.searchsorted(self.postings, values), np.searchsorted(self.postings, values, "right")
        counts = hi - lo
        at = np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        items, which = np.unique(self.posting_items[at], return_inverse=True)
        # At least what is common; a shingle may stand in the item less often than here.
        common = np.bincount(which, np.repeat(weights, counts), len(items))
        enough = common * (1 + self.threshold) >= self.threshold * (len(grams) + self.n_grams[items]) - 1e-9
        own = Counter(grams.tolist())
        for item in items[enough & (self.n_words[items] > n)].tolist():
            score = similarity(own, self.weights[item])
            if score >= self.threshold:
                distance = (int(fingerprints(grams, len(grams))[0]) ^ self.prints[item]).bit_count()
                best[item] = Match(item, 0, score, distance, n)

    def _around(self, grams: np.ndarray, n: int, size: int, at: list[int], best: dict[int, Match]) -> None:
        """Windows of `size` shingles, an item's, that hold a shingle at one of the places; the text's ends may cut some off."""
        cut = size - int(np.ceil(self.threshold * size - 1e-9))
        last, lo = len(grams) - size + cut, None
        for p, q in zip(at, [*at[1:], None], strict=True):
            lo = max(-cut, p - size + 1) if lo is None else lo
            # Overlapping neighbourhoods are one.
            if q is not None and q - size + 1 <= p + 1:
                continue
            hi = min(p, last)
            if hi >= lo:
                self._search(grams, n, size, lo, hi, best)
            lo = None

    def _search(self, grams: np.ndarray, n: int, size: int, lo: int, hi: int, best: dict[int, Match]) -> None:
        base = max(lo, 0)
        total = _totals(grams[base : hi + size])
        begin, end = np.arange(lo, hi + 1), np.arange(lo, hi + 1) + size
        begin, end = np.maximum(begin, 0), np.minimum(end, len(grams))
        prints = _packed(total[end - base] - total[begin - base])
        pairs = set()
        for k, (shift, mask) in enumerate(self.blocks):
            values = (prints >> np.uint64(shift)) & np.uint64(mask)
            for v in np.unique(values).tolist():
                for item in self.table.get((n, k, v), ()):
                    pairs.update((item, w) for w in np.flatnonzero(values == v).tolist())
        for item, w in sorted(pairs):
            distance = (int(prints[w]) ^ self.prints[item]).bit_count()
            if distance > self.radius:
                continue
            known = best.get(item)
            if known and known.similarity == 1.0:
                continue
            first, past = int(begin[w]), int(end[w])
            score = similarity(Counter(grams[first:past].tolist()), self.weights[item])
            if score >= self.threshold and (known is None or score > known.similarity):
                best[item] = Match(item, first, score, distance, n - size + past - first)


def _n_blocks(benchmark: DataFrame) -> int:
    chars = benchmark.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    return max(1, -(-chars // BLOCK_CHARS))


def _block(benchmark: DataFrame, part: int, parts: int) -> tuple[list, list]:
    """ids and texts of a part of the benchmark, of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
    return [r[0] for r in rows], [r[1] for r in rows]


def find(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity (6 digits), distance: each item that a document holds."""

    def scan(ids: list, texts: list) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(texts, threshold, radius)
            for batch in batches:
                found = [
                    (doc_id, ids[m.item], m.start, m.words, round(m.similarity, 6), m.distance)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for m in items.matches(text)
                ]
                columns = list(zip(*found, strict=True)) or [[]] * 6
                kinds = ("int64", "int64", "int64", "int64", "float64", "int32")
                names = ("doc_id", "item_id", "start_word", "n_words", "similarity", "distance")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        schema = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"
        return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, schema)

    parts = _n_blocks(benchmark)
    if parts == 1:
        return scan(*_block(benchmark, 0, 1))
    for part in range(parts):
        found = scan(*_block(benchmark, part, parts))
        found.write.mode("append").option("compression", "zstd").parquet(scratch.path("found"))
    return docs.sparkSession.read.schema(found.schema).parquet(scratch.path("found"))


def clean(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of docs, with all columns, whose text holds no benchmark item."""
    parts = _n_blocks(benchmark)
    for part in range(parts):
        if part:
            docs = scratch.table(f"after{part}", docs)
            scratch.drop(f"after{part - 1}")
        docs = docs.mapInArrow(_without(_block(benchmark, part, parts)[1], docs.columns.index("text"), threshold, radius), docs.schema)
    return docs


def _without(texts: list, column: int, threshold: float, radius: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts, threshold, radius)
        for batch in batches:
            yield batch.filter(pa.array([not items.matches(t) for t in batch.column(column).to_pylist()], "bool"))

    return rows
