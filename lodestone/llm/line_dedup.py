"""Line dedup: a suffix array over line ids by prefix doubling; later copies of repeated runs go.

The sequence of a document is its lines with a word, as ids; no run crosses documents. Doubling gives each
suffix the class of its first 1, 2, 4, ... lines, kept only while the class has two suffixes: two suffixes
are neighbours to a depth of 2^k lines just if their classes at k agree. Going down the levels again, each
class is split by the class of what follows its common prefix, which builds the longest-common-prefix
intervals from the longest on: an interval is a set of suffixes with exactly those lines in common. In
each, all suffixes but the first in document order mark a repeated run of the interval's length, and the
first goes on to stand for them in the wider interval. A marked run with enough words is deleted.

So line p of a document goes just if some run of lines that holds it, with MIN_WORDS words or more, also
begins at an earlier place: in a document with a smaller id, or before in the same one.

A line id is 128 bits of hashes, and so is a class. Every step is a projection, a pre-aggregated group or
an equi-join; a class that a third of all lines belong to is counted before the shuffle and joined back
in salted parts. Each level is a table in the shared folder, which the next starts from.

Defined results: a null text stays null and has no lines; lines without a word are never ids and stay, but
a document that loses all its words becomes empty; rows equal in doc_id and text are one document and
fare alike; a null doc_id comes before all others, equal doc_ids are ordered by a hash of their texts;
input columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, has_word, words

MIN_WORDS = 5
SALTS = 16
_DOC = ("d", "th")
_AT = ("d", "th", "p")


def _pair(*columns: Column) -> tuple[Column, Column]:
    """Two hashes that don't depend on each other."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)


def _key(docs: DataFrame) -> DataFrame:
    """docs with d, th: what names a document, without nulls."""
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "th": F.xxhash64("text")})


def line_ids(docs: DataFrame) -> DataFrame:
    """d, th, p (place among lines with a word), line (place among all), c1, c2 (id), before, after (words up to the line and past it)."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    worded = F.filter(lines, lambda s: has_word(s["x"]))
    # Equal documents become one where they are read, before any moves; this is the only shuffle, for the sums too.
    single = _key(docs).groupBy(*_DOC).agg(F.first("text").alias("text"))
    rows = single.select(*_DOC, F.posexplode(worded).alias("p", "s"))
    c1, c2 = _pair(F.col("s.x"))
    rows = rows.select(*_AT, F.col("s.line").alias("line"), c1.alias("c1"), c2.alias("c2"), F.size(words(F.col("s.x"))).alias("n"))
    after = F.sum("n").over(Window.partitionBy(*_DOC).orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("after", after).withColumn("before", F.col("after") - F.col("n")).drop("n")


def _grouped(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows whose key two or more rows have, with `first`, the least place of these."""
    counted = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.min(F.struct(*_AT)).alias("first")).filter("copies > 1")
    salted = counted.drop("copies").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*_AT), F.lit(SALTS)).cast("int")).join(salted, [*key, "salt"]).drop("salt")


def suffix_classes(lines: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """For each k, the suffixes (d, th, p) whose first 2^k lines another suffix begins with too, and their class c1, c2."""
    repeated = _grouped(lines, ["c1", "c2"])
    levels = [scratch.table("level0", repeated.select(*_AT, "c1", "c2"))]
    while True:
        k = len(levels)
        half = 1 << (k - 1)
        ahead = Window.partitionBy(*_DOC).orderBy("p").rangeBetween(half, half)
        both = levels[-1].withColumns({"e1": F.first("c1").over(ahead), "e2": F.first("c2").over(ahead)}).filter("e1 is not null")
        c1, c2 = _pair(*(F.col(c) for c in ("c1", "c2", "e1", "e2")))
        doubled = both.select(*_AT, c1.alias("c1"), c2.alias("c2"))
        level = scratch.table(f"level{k}", _grouped(doubled, ["c1", "c2"]).select(*_AT, "c1", "c2"))
        if level.isEmpty():
            return levels
        levels.append(level)


def repeated_runs(levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """d, th, p, m: m lines from p on also stand at an earlier place, and no longer run from p does."""
    marks, state, gone = [], None, None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k]
        # Suffixes in no interval yet: all that a longer run has not taken in.
        fresh = own if gone is None else own.join(gone, list(_AT), "left_anti")
        fresh = fresh.select(*_AT, F.lit(0).alias("m"), F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"), F.col("c1").alias("e1"), F.col("c2").alias("e2"))
        if state is None:
            rows = fresh
        else:
            follow = own.select("d", "th", F.col("p").alias("q"), F.col("c1").alias("e1"), F.col("c2").alias("e2"))
            rows = state.withColumn("q", F.col("p") + F.col("m")).join(follow, ["d", "th", "q"], "left").drop("q").unionByName(fresh)
        key = ["g1", "g2", "e1", "e2"]
        rows = rows if k == len(levels) - 1 else scratch.table(f"rows{k}", rows)
        split = scratch.table(f"split{k}", _grouped(rows.filter("e1 is not null"), key))
        later = F.struct(*_AT) != F.col("first")
        m = (F.col("m") + (1 << k)).alias("m")
        marks.append(split.filter(later).select(*_AT, m))
        if k == 0:
            break
        g1, g2 = _pair(*(F.col(c) for c in key), F.lit(k))
        inner = split.select(*_AT, m, g1.alias("g1"), g2.alias("g2"))
        # What stays in an interval: suffixes that nothing matched, and the first of each that split off.
        taken = split.filter(later).select(*_AT, "m", "g1", "g2")
        outer = rows.filter("m > 0").select(*_AT, "m", "g1", "g2").join(taken, [*_AT, "m", "g1", "g2"], "left_anti")
        state = scratch.table(f"state{k}", inner.unionByName(outer))
        freed = split.filter(later & (F.col("m") == 0)).select(*_AT)
        gone = scratch.table(f"gone{k}", freed if gone is None else gone.unionByName(freed))
        for old in (f"rows{k + 1}", f"state{k + 1}", f"gone{k + 1}"):
            scratch.drop(old)
    out = marks[0]
    for more in marks[1:]:
        out = out.unionByName(more)
    return out.groupBy(*_AT).agg(F.max("m").alias("m"))


def deleted_lines(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """d, th, gone: the places, among all lines of the document, of those to delete."""
    lines = line_ids(docs.select("doc_id", "text"))
    lines = scratch.table("lines", lines)
    levels = suffix_classes(lines, scratch)
    runs = repeated_runs(levels, scratch)
    # Every line of a repeated run is itself repeated, so the other lines need not be looked at.
    own = lines.join(levels[0].select(*_AT), list(_AT), "left_semi").select(*_AT, "line", "before", "after")
    ends = own.select("d", "th", (F.col("p") + 1).alias("end"), F.col("after").alias("up_to"))
    begun = own.join(runs, list(_AT), "left").withColumn("end", F.col("p") + F.col("m"))
    sized = begun.join(ends, ["d", "th", "end"], "left")
    reach = F.when(F.col("up_to") - F.col("before") >= min_words, F.col("end"))
    covered = F.max(reach).over(Window.partitionBy(*_DOC).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)) > F.col("p")
    gone = sized.withColumn("covered", covered).filter("covered").groupBy(*_DOC).agg(F.collect_list("line").alias("gone"))
    out = scratch.table("deleted", gone)
    steps = [f"{name}{k}" for k in range(len(levels) + 1) for name in ("level", "rows", "split", "state", "gone")]
    scratch.drop("lines", *steps)
    return out


def dedup(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the lines deleted from `text`, and n_lines (with a word), n_deleted."""
    gone = deleted_lines(docs, scratch, min_words)
    plain = docs.drop("d", "th", "gone", "n_lines", "n_deleted")
    out = _key(plain).join(gone, list(_DOC), "left").drop(*_DOC).withColumn("_parts", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("gone"))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col("_parts"), i)), "\n")
    out = out.withColumn("_rest", F.when(F.col("gone").isNotNull(), rest))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.filter("_parts", has_word)))
    return out.withColumns(
        {
            "n_lines": n_lines.cast("long"),
            "n_deleted": F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long"),
            "text": F.when(F.col("gone").isNull(), F.col("text")).when(has_word(F.col("_rest")), F.col("_rest")).otherwise(F.lit("")),
        }
    ).drop("gone", "_parts", "_rest")
