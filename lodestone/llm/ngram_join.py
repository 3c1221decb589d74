"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are different sets of word n-grams (texts with equal sets are one row from
the start), columns are n-grams as 63-bit hashes, blocks are the partitions that columns are dealt to. A
link needs an overlap of at least `need(a, b)` n-grams, so it shows within the first few columns of each
row in any fixed order of columns; only this part of the matrix is dealt out. The order puts the most
frequent n-grams last, so a passage that many texts share gives no products. The product then goes

1. against one row of each column, its pivot: many rows of a group of near copies link to its pivots;
2. in rounds, against a row of each column by chance, where that is of another component: each row tries the
   one that its parities put nearest, so a group whose rows link only with some of the others falls together
   in a few rounds. They end when a round connects few rows;
3. between all rows of a column that these links don't connect yet, a column's rows outside its main
   component against all. At each common column a pair is discarded if that column and what both rows have
   beyond it can't reach need(a, b): of a link, the first common column stays. Each row of a column carries
   the row's LATELY columns before it; a pair that has one of them in common met there already and isn't
   made again, so near copies, which share nearly all columns, meet about once.

A row also carries the parity of its n-grams in each of BITS groups that their hashes fall into. Each n-gram
that only one of two rows has changes one parity, so the parities that differ are no more than the n-grams
not shared, and a pair with more of them than its bound allows is discarded before it is counted. Pairs that
are left are held against each other by a sketch of the same kind, with two bits or more for each n-gram.

What is left is counted exactly on the whole sets. Rows that are connected already need no product to find
components. The number of each document's links needs them: all pairs of rows of a component are counted
exactly on the whole sets, block by block of the component, in as many tasks as there are pairs of blocks. A task
returns a sum for each row, so no pair becomes a row of a table.

Frequent n-grams are counted over all rows; the list of them is of bounded size and only decides the
order, never the result.

Defined results: texts without a word have no n-grams and link with nothing; fewer words than n are one
n-gram; a null doc_id comes after all others and its component is null if it has no other id; rows with
equal doc_id are judged each by its text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORDS = 4
#: A link: 100 * overlap >= PERCENT * union.
PERCENT = 85
#: At most so many n-grams are put last as frequent; more rows raise the count that makes one frequent.
FREQUENT, LEAST_FREQUENT = 1 << 17, 48
#: Ids up to this number are sent to all executors, more are joined by a shuffle.
BROADCAST_IDS = 500_000
SALTS = 16
#: Rounds against rows by chance, at most, and the links that a round must find for another: a share of the rows, but so many at least.
ROUNDS, LEAST_SHARE, LEAST_FOUND = 8, 1 / 1024, 64
#: Columns of a row before the present one that tell whether a pair met earlier.
LATELY = 4
#: Groups of n-grams with a parity, 64 to a column. They tell rows of up to a few thousand n-grams apart.
BITS = 512
#: Bits of a sketch for each n-gram, at least.
SKETCH_BITS = 2
#: A component is cut into blocks of so many rows, so many blocks at most, but never more than MOST_ROWS and about BLOCK_GRAMS n-grams a block.
BLOCK_ROWS, BLOCKS, MOST_ROWS, BLOCK_GRAMS = 128, 24, 4096, 1 << 21
#: Common n-grams of pairs that a task counts at a time.
PRODUCTS = 1 << 21
PARITIES = tuple(f"w{i}" for i in range(BITS // 64))
_NO_ID = (1 << 63) - 1
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h


def ngrams(text: str | None, n: int = WORDS) -> np.ndarray:
    """The set of a text's word n-grams as sorted non-negative 63-bit hashes; ASCII case is dropped."""
    # bytes.split and bytes.lower know ASCII white space and letters only.
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    count = max(1, len(words) - n + 1)
    out = np.full(count, len(words) if len(words) < n else 0, np.uint64)
    for k in range(min(n, len(words))):
        out = (out * _MULTIPLIER) + _mixed(h[k : k + count])
    return np.unique((_mixed(out) >> np.uint64(1)).astype(np.int64))


def signature(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that tell different sets apart."""
    v = xxhash.xxh3_128_intdigest(grams.tobytes())
    return (v >> 64) - (1 << 63), (v & ((1 << 64) - 1)) - (1 << 63)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Of each group of n-grams, whether the set has an odd number of them, 64 bits a number; more groups for larger sets."""
    bits = BITS
    while bits < SKETCH_BITS * len(grams):
        bits *= 2
    return np.packbits(np.bincount(grams & (bits - 1), minlength=bits).astype(np.uint8) & 1).view(np.int64)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch as one of `size` numbers, the size being a part of its own by a power of two."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size))


def parities(grams: np.ndarray) -> np.ndarray:
    """The sketch of BITS groups."""
    return folded(sketch(grams), len(PARITIES))


def reach(n: np.ndarray | int, percent: int = PERCENT):
    """How many columns of a row of n must be seen to find every link to a row at most as large."""
    return n - (percent * n + 99) // 100 + 1


def need(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Common n-grams that a link takes."""
    return F.ceil((a + b) * percent / (100 + percent))


def gram_sets(docs: DataFrame, n: int = WORDS, whole: bool = False, percent: int = PERCENT) -> DataFrame:
    """id, n, s1, s2, the parities, the sketch and the set's first columns in hash order, or all."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, s1, s2, parts, bits, odd = batch.column(0), [], [], [], [], [], np.empty((batch.num_rows, len(PARITIES)), np.int64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                grams = ngrams(text, n)
                a, b = signature(grams)
                own = sketch(grams)
                bits.append(own.tobytes())
                odd[i] = folded(own, len(PARITIES))
                sizes.append(len(grams))
                s1.append(a)
                s2.append(b)
                # A fifth more than are needed if none turns out frequent.
                parts.append(grams if whole else grams[: -(-reach(len(grams), percent) * 6 // 5)] if len(grams) else grams)
            offsets = np.zeros(len(parts) + 1, np.int32)
            np.cumsum([len(p) for p in parts], out=offsets[1:])
            flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            numbers = [pa.array(c, "int64") for c in (sizes, s1, s2, *(np.ascontiguousarray(w) for w in odd.T))]
            yield pa.RecordBatch.from_arrays([ids, *numbers, pa.array(bits, "binary"), lists], ["id", "n", "s1", "s2", *PARITIES, "sketch", "grams"])

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id")
    return docs.select(ids, F.col("text").cast("string")).mapInArrow(rows, f"id long, n long, s1 long, s2 long, {', '.join(f'{w} long' for w in PARITIES)}, sketch binary, grams array<long>")


def _few(rows: DataFrame) -> DataFrame:
    """rows, to be sent to all executors if there are few of them."""
    return F.broadcast(rows) if rows.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else rows


def whole_sets(docs: DataFrame, classes: DataFrame, n: int, scratch: Scratch, name: str) -> DataFrame:
    """node, grams: the whole set of each of the classes, from the text of one document that has it."""
    wanted = scratch.table(name, classes.select("node", "n", "s1", "s2", F.col("rep").alias("id")))
    ids = _few(wanted.select(F.col("id").alias("_id")).distinct())
    own = F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID))
    sets = gram_sets(docs.join(ids, own == F.col("_id"), "left_semi"), n, whole=True)
    # Documents may share an id: the signature says which is meant, and one of those that are equal will do.
    return sets.select("id", "n", "s1", "s2", "grams").join(_few(wanted), ["id", "n", "s1", "s2"]).select("node", "n", "grams").dropDuplicates(["node"])


def _postings(rows: DataFrame, frequent: np.ndarray, percent: int, whole: bool) -> DataFrame:
    """key, node, n, pos of each row's first columns in the order: frequent n-grams last, then by hash.

    A key is the n-gram's hash, raised above all others if it is frequent, so keys sort in that order.
    With `whole` sets all is there; else rows with too few columns give node alone, key null.
    """
    known = rows.sparkSession.sparkContext.broadcast(frequent)
    lift = np.int64(-(1 << 63))

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = known.value
        for batch in batches:
            node, n = (batch.column(i).to_numpy() for i in (0, 1))
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(node)), ends)
            if len(top):
                at = np.minimum(np.searchsorted(top, flat), len(top) - 1)
                often = top[at] == flat
            else:
                often = np.zeros(len(flat), bool)
            # Hashes are non-negative: the others move below zero, in the same order.
            keys = np.where(often, flat, flat + lift)
            order = np.lexsort((keys, owner))
            keys, often = keys[order], often[order]
            begin = np.cumsum(ends) - ends
            pos = np.arange(len(flat)) - begin[owner]
            want = reach(n, percent)
            rare = np.bincount(owner, ~often, len(node)).astype(np.int64)
            enough = (n > 0) if whole else (rare >= want) | (ends == n)
            enough &= n > 0
            keep = (pos < want[owner]) & enough[owner]
            who = owner[keep]
            columns = [keys[keep], node[who], n[who], pos[keep]]
            short = np.flatnonzero(~enough & (n > 0))
            nulls = pa.nulls(len(short), "int64")
            arrays = [pa.concat_arrays([pa.array(c, "int64"), nulls]) for c in columns]
            arrays[1] = pa.array(np.concatenate([node[who], node[short]]), "int64")
            yield pa.RecordBatch.from_arrays(arrays, ["key", "node", "n", "pos"])

    return rows.select("node", "n", "grams").mapInArrow(out, "key long, node long, n long, pos long")


def _sizes_fit(percent: int) -> Column:
    """Of columns n_a <= n_b: sizes that can link."""
    return F.col("n_a") * 100 >= F.col("n_b") * percent


def _differ(x: str, y: str) -> Column:
    """Places in which the parities of two rows differ."""
    return sum((F.bit_count(F.col(f"{w}_{x}").bitwiseXOR(F.col(f"{w}_{y}"))) for w in PARITIES), F.lit(0))


def _parities_fit(x: str, y: str, percent: int) -> Column:
    """Rows whose parities differ in no more places than the n-grams that a link may leave unshared."""
    n_x, n_y = F.col(f"n_{x}"), F.col(f"n_{y}")
    return _differ(x, y) <= n_x + n_y - 2 * need(n_x, n_y, percent)


def _can_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that their parities don't rule out, and `differ` of each."""
    side = lambda s: classes.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", *PARITIES)))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(_parities_fit("a", "b", percent)).select(*pairs.columns, _differ("a", "b").alias("differ"))


def _both_ways(pairs: DataFrame, *carried: str) -> DataFrame:
    """(x, y) pairs as a, b with n_a <= n_b."""
    swap = (F.col("n_x") > F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("x") > F.col("y")))
    names = [("a", "b", "x", "y"), *((f"{c}_a", f"{c}_b", f"{c}_x", f"{c}_y") for c in ("n", *carried))]
    out = []
    for a, b, x, y in names:
        out += [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(a), F.when(swap, F.col(x)).otherwise(F.col(y)).alias(b)]
    return pairs.select(*out)


def _named(df: DataFrame, side: str) -> DataFrame:
    return df.select("key", F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in ("key", "node", "pos")))


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that their sketches don't rule out."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"k_{s}"))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, k_a, k_b = batch.columns
            both = n_a.to_numpy() + n_b.to_numpy()
            most, keep = both - 2 * -(-both * percent // (100 + percent)), []
            for i, (x, y) in enumerate(zip(k_a, k_b, strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                size = min(len(x), len(y))
                keep.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= most[i])
            kept = pa.array(keep, "bool")
            yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], ["a", "b"])

    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "k_a", "k_b")
    return met.mapInArrow(hold, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, name: str, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, counted on whole sets."""
    likely = scratch.table(f"{name}-likely", _likely(pairs, classes, percent))
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = whole_sets(docs, classes.join(nodes, "node", "left_semi"), n, scratch, f"{name}-wanted")
    side = lambda s: sets.select(F.col("node").alias(s), F.col("grams").alias(f"g_{s}"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ga, gb = batch.columns
            keep = []
            va, vb = ga.flatten().to_numpy(), gb.flatten().to_numpy()
            oa, ob = ga.offsets.to_numpy() - ga.offsets[0].as_py(), gb.offsets.to_numpy() - gb.offsets[0].as_py()
            for i in range(len(a)):
                x, y = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep, "bool")), b.filter(pa.array(keep, "bool"))], ["a", "b"])

    whole = likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "g_a", "g_b")
    links = scratch.table(name, whole.mapInArrow(count, "a long, b long"))
    scratch.drop(f"{name}-likely", f"{name}-wanted")
    return links


def _spread() -> tuple[Column, Column]:
    """A row's salt and all salts of a column: only the frequent columns, keys from 0 on, are spread; the others have few rows each."""
    often, none = F.col("key") >= 0, F.lit(0)
    return F.when(often, F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(0), F.explode(F.when(often, F.sequence(none, F.lit(SALTS - 1))).otherwise(F.array(none)))


def _tried(shared: DataFrame, roots: DataFrame, classes: DataFrame, turn: int, percent: int) -> DataFrame:
    """a, b: each row with the nearest, by parities, of those of other components that its columns offer it, one a column."""
    salt, every_salt = _spread()
    placed = shared.select("key", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    chance = F.struct(F.xxhash64("node", "key", F.lit(turn)), "node", "n", "root")
    offers = placed.groupBy("key").agg(F.min(chance).alias("p"), (F.min("root") < F.max("root")).alias("open")).filter("open").select("key", "p.node", "p.n", "p.root")
    left, right = _named(placed.withColumn("salt", salt), "x"), _named(offers.withColumn("salt", every_salt), "y").withColumnRenamed("salt_y", "salt_x")
    pairs = _both_ways(left.join(right, ["key", "salt_x"]).filter("root_x <> root_y")).filter(_sizes_fit(percent)).select("a", "b").distinct()
    pairs = _can_link(pairs, classes, percent)
    ends = pairs.select(F.col("a").alias("x"), "differ", "a", "b").union(pairs.select("b", "differ", "a", "b"))
    return ends.groupBy("x").agg(F.min(F.struct("differ", F.xxhash64("a", "b"), "a", "b")).alias("m")).select("m.a", "m.b").distinct()


def _met(outside: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """a, b: rows outside a column's main component with rows of other ones there, where bounds allow a link; about once a pair."""
    # Two rows outside the main component meet once.
    left, right = _named(outside, "x"), _named(met, "y").withColumnRenamed("salt_y", "salt_x")
    products = left.join(right, ["key", "salt_x"]).filter("root_x <> root_y and (root_y = main_x or x < y)")
    possible = F.least("rest_x", "rest_y") + 1 >= need(F.col("n_x"), F.col("n_y"), percent)
    # Rows of different components meet at their first common column, whichever components these are.
    anew = ~F.arrays_overlap("lately_x", "lately_y")
    return _both_ways(products.filter(possible & _parities_fit("x", "y", percent) & anew)).filter(_sizes_fit(percent)).select("a", "b")


def _lately() -> Column:
    """The LATELY columns of a row before the present one."""
    before = Window.partitionBy("node").orderBy("key")
    return F.array_compact(F.array(*(F.lag("key", i).over(before) for i in range(1, LATELY + 1))))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, root: the least node that edges (a, b) connect it to; nodes without an edge are left out.

    Each round takes the least root among the neighbours and then the root's own root, until none changes.
    """
    both = scratch.table(f"{name}-edges", edges.union(edges.select("b", "a")).toDF("node", "other").distinct())
    roots = scratch.table(f"{name}-0", both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")))
    turn = 0
    while True:
        turn += 1
        seen = roots.select(F.col("node").alias("other"), F.col("root").alias("near"))
        least = both.join(seen, "other").groupBy("node").agg(F.min("near").alias("near"))
        nearer = roots.join(least, "node").select("node", "root", F.least("root", "near").alias("near"))
        above = roots.select(F.col("node").alias("near"), F.col("root").alias("top"))
        moved = nearer.join(above, "near", "left").select("node", F.least("near", F.coalesce("top", "near")).alias("root"), (F.coalesce("top", "near") != F.col("root")).alias("changed"))
        now = scratch.table(f"{name}-{turn}", moved)
        scratch.drop(f"{name}-{turn - 1}")
        roots = now.select("node", "root")
        if now.filter("changed").isEmpty():
            scratch.drop(f"{name}-edges")
            return roots


def _common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Common n-grams of each row of a with each of b, as matrices of a few rows of a, and the first of these; a block is its rows' ends and n-grams."""
    (ends_a, flat_a), (ends_b, flat_b) = a, b
    order = np.argsort(flat_b, kind="stable")
    grams, begin, often = np.unique(flat_b[order], return_index=True, return_counts=True)
    rows_b = np.searchsorted(ends_b, order, side="right")
    at = np.minimum(np.searchsorted(grams, flat_a), len(grams) - 1)
    hits = np.flatnonzero(grams[at] == flat_a)
    at, rows_a = at[hits], np.searchsorted(ends_a, hits, side="right")
    many = often[at]
    made = np.concatenate([[0], np.cumsum(np.bincount(rows_a, many, len(ends_a)).astype(np.int64))])
    first = 0
    while first < len(ends_a):
        last = max(first + 1, int(np.searchsorted(made, made[first] + PRODUCTS, side="right")) - 1)
        x, y = np.searchsorted(rows_a, (first, last))
        n = many[x:y]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cells = np.repeat((rows_a[x:y] - first) * len(ends_b), n) + rows_b[np.repeat(begin[at[x:y]], n) + within]
        yield first, np.bincount(cells, minlength=(last - first) * len(ends_b)).reshape(-1, len(ends_b))
        first = last


def _linked(own: pa.Table, other: pa.Table | None, percent: int) -> Iterator[pa.RecordBatch]:
    """node, links: how many documents of the other block, or of its own where that is none, each row of a block links with."""

    def parts(rows: pa.Table) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
        grams = rows["grams"].combine_chunks()
        ends = np.cumsum(np.diff(grams.offsets.to_numpy()))
        return (ends, grams.flatten().to_numpy()), np.diff(ends, prepend=0), rows["copies"].to_numpy()

    a, n_a, copies_a = parts(own)
    b, n_b, copies_b = parts(other) if other else (a, n_a, copies_a)
    of_own, of_other = np.zeros(len(n_a), np.int64), np.zeros(len(n_b), np.int64)
    for first, common in _common(a, b):
        here = slice(first, first + len(common))
        link = 100 * common >= percent * (n_a[here, None] + n_b - common)
        if other is None:
            link[np.arange(len(common)), np.arange(first, first + len(common))] = False
        of_own[here] = link @ copies_b
        of_other += copies_a[here] @ link
    for rows, links in ((own, of_own), (other, of_other)) if other else ((own, of_own),):
        yield pa.RecordBatch.from_arrays([rows["node"].combine_chunks(), pa.array(links)], ["node", "links"])


def linked_documents(named: DataFrame, docs: DataFrame, scratch: Scratch, n: int, percent: int) -> DataFrame:
    """node, n_links: with how many other documents the documents of each row link, exactly; named holds each row's root and copies."""
    size = named.groupBy("root").agg(F.count("*").alias("members"), F.sum("copies").alias("total"), F.sum("n").alias("grams"))
    enough = F.ceil(F.col("members") / F.greatest(F.lit(BLOCK_ROWS), F.least(F.lit(MOST_ROWS), F.ceil(F.col("members") / BLOCKS))))
    size = size.withColumn("blocks", F.greatest(enough, F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")).drop("grams")
    sized = scratch.table("sized", named.join(size, "root").select("node", "n", "s1", "s2", "rep", "root", "copies", "members", "total", "blocks"))
    # Two rows of a component link; of more, each two may or may not.
    wanted = sized.filter("members > 2")
    sets = whole_sets(docs, wanted, n, scratch, "counted")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = scratch.table("members", wanted.select("node", "root", "copies", "blocks", block.alias("block")).join(sets.select("node", "grams"), "node"))
    # A block meets each block of its component, itself included; a pair of blocks is known by the first and the second.
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("root", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), (F.col("block") > F.col("other")).alias("second"), "node", "copies", "grams")
    key = ["root", "p", "q"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        known = None

        def counted() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            second = rows["second"]
            if known[1] == known[2]:
                yield from _linked(rows, None, percent)
            elif 0 < (k := second.to_numpy().sum()) < len(rows):
                yield from _linked(rows.slice(0, len(rows) - k), rows.slice(len(rows) - k), percent)

        for batch in batches:
            ids = [batch.column(i).to_numpy() for i in range(3)]
            cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in ids], axis=0)) + 1
            for x, y in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if x == y:
                    continue
                now = tuple(int(c[x]) for c in ids)
                if held and now != known:
                    yield from counted()
                    held = []
                known = now
                held.append(batch.slice(x, y - x))
        if held:
            yield from counted()

    # By range: pairs of blocks are alike in size, so tasks are.
    sums = met.repartitionByRange(parts, *key).sortWithinPartitions(*key, "second").mapInArrow(count, "node long, links long")
    sums = sums.groupBy("node").agg(F.sum("links").alias("links"))
    others = F.when(F.col("members") <= 2, F.col("total") - 1).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    return scratch.table("links-of", sized.join(sums, "node", "left").select("node", others.alias("n_links")))


def join(docs: DataFrame, scratch: Scratch, n: int = WORDS, percent: int = PERCENT, count_links: bool = True) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, and n_links.

    The last is the number of other documents that the document links with, copies included. Those who need
    components alone can do without it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    found = scratch.table("sets", gram_sets(docs, n, percent=percent))
    # Equal sets are one row: a group of copies is one value for each task after pre-aggregation.
    grouped = found.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in (*PARITIES, "sketch", "grams")))
    rows = scratch.table("classes", grouped.withColumn("node", F.monotonically_increasing_id()))
    documents = scratch.table("documents", found.drop("grams", "sketch", *PARITIES))
    scratch.drop("sets")
    counted = rows.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("c"))
    total = rows.agg(F.sum(F.size("grams"))).first()[0] or 0
    # At most total / bound n-grams stand more than bound times.
    bound = max(LEAST_FREQUENT, total // FREQUENT)
    frequent = np.array(sorted(r["g"] for r in counted.filter(F.col("c") > bound).select("g").toLocalIterator()), np.int64)
    first = scratch.table("postings", _postings(rows, frequent, percent, whole=False))
    # Rows made mostly of frequent n-grams need more of their columns than were kept: their whole sets.
    short = first.filter("key is null").select("node")
    wholes = whole_sets(docs, rows.join(short, "node", "left_semi"), n, scratch, "short")
    postings = first.filter("key is not null").unionByName(_postings(wholes, frequent, percent, whole=True))
    # A column with one row gives no product. Frequent columns have more for certain and are not gathered.
    near = Window.partitionBy("key").orderBy("node")
    many = F.lag("node").over(near).isNotNull() | F.lead("node").over(near).isNotNull()
    rare = postings.filter("key < 0").withColumn("many", many).filter("many").drop("many")
    shared = scratch.table("shared", rare.unionByName(postings.filter("key >= 0")))
    scratch.drop("postings", "short")
    classes = scratch.table("rows", rows.drop("grams"))
    scratch.drop("classes")

    salt, every_salt = _spread()
    # The pivot is the row that has the column earliest: one with few n-grams of its own.
    pivot = shared.groupBy("key").agg(F.min(F.struct("pos", "n", "node")).alias("p"))
    pivot = scratch.table("pivots", pivot.select("key", "p.node", "p.n"))
    stars = _named(shared.withColumn("salt", salt), "x").join(_named(pivot.withColumn("salt", every_salt), "y"), (F.col("salt_x") == F.col("salt_y")) & (shared["key"] == pivot["key"]))
    stars = _both_ways(stars.filter("x <> y")).filter(_sizes_fit(percent)).groupBy("a", "b").agg(F.count("*").alias("c"))
    stars = scratch.table("possible", _can_link(stars, classes, percent).drop("differ"))
    ends = stars.select(F.col("a").alias("x"), F.col("b").alias("other"), "a", "b", "c").union(stars.select("b", "a", "a", "b", "c"))
    # Each row takes the pivot it shares most with, and the least one, on which the rows of a group agree.
    best = ends.groupBy("x").agg(F.max(F.struct("c", "a", "b")).alias("m"), F.min(F.struct("other", "a", "b")).alias("l"))
    best = best.select("m.a", "m.b").union(best.select("l.a", "l.b")).distinct()
    links = _verified(scratch.table("stars", best), classes, docs, scratch, "links", n, percent)
    scratch.drop("possible", "stars")
    roots = components(links, scratch, "first")
    least, rounds = max(LEAST_FOUND, int(LEAST_SHARE * classes.count())), []
    for turn in range(ROUNDS):
        tried = scratch.table(f"tried-{turn}", _tried(shared, roots, classes, turn, percent))
        more = _verified(tried, classes, docs, scratch, f"links-{turn}", n, percent)
        scratch.drop(f"tried-{turn}")
        links, rounds = links.unionByName(more), [*rounds, f"links-{turn}"]
        roots = components(links, scratch, f"after-{turn}")
        if more.count() < least:
            break

    # rest: the columns that a row has beyond this one.
    placed = shared.select("key", "node", "n", (F.col("n") - F.col("pos") - 1).alias("rest"), _lately().alias("lately")).join(roots, "node", "left")
    placed = scratch.table("placed", placed.withColumn("root", F.coalesce("root", "node")))
    main = pivot.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("main"), every_salt.alias("salt"))
    outside = placed.withColumn("salt", salt).join(main, ["key", "salt"]).filter("root <> main").drop("salt")
    odd = classes.select("node", *PARITIES)
    outside = scratch.table("outside", outside.join(odd, "node"))
    scratch.drop("shared", "pivots")
    # Columns that are all of one component have nothing left to find.
    open_columns = outside.select("key").distinct().select("key", every_salt.alias("salt"))
    met = placed.withColumn("salt", salt).join(open_columns, ["key", "salt"], "left_semi").join(odd, "node")
    products = _met(outside.withColumn("salt", every_salt), met, percent)
    close = scratch.table("close", products.distinct())
    scratch.drop("placed", "outside")
    links = links.unionByName(_verified(close, classes, docs, scratch, "more-links", n, percent))
    roots = components(links, scratch, "last")

    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = named.join(least, "root")
    if count_links:
        of_class = of_class.join(linked_documents(named, docs, scratch, n, percent), "node")
    number = ["n_links"] if count_links else []
    of_class = scratch.table("components", of_class.select("n", "s1", "s2", "component", *number))
    scratch.drop("rows", "close", "links", "more-links", "sized", "counted", "members", "links-of", *rounds)
    # Copies are spread by a salt, as their class is one row.
    spread = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    of_class = of_class.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = documents.withColumn("salt", spread).join(of_class, ["n", "s1", "s2", "salt"], "left")
    known = lambda c: F.when(c != _NO_ID, c)
    return out.select(
        known(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), known(F.coalesce("component", "id")).alias("component_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in number),
    )
