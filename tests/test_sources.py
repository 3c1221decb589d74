"""Sources and readers of files against plain versions: archives, flat OpenDocument and other XML, keyset scans."""

import os
import random
import signal
import sqlite3
import subprocess
import sys
import textwrap
import time
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from lodestone.functions import extract
from lodestone.sources import archives, keyset

OFFICE = "urn:oasis:names:tc:opendocument:xmlns:office:1.0"


def test_members_are_read_once_whatever_the_parts(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    for a in range(5):
        with zipfile.ZipFile(tmp_path / f"a{a}.zip", "w") as z:
            z.mkdir("folder")
            for m in range(rng.randrange(0, 40)):
                want[f"a{a}.zip", f"folder/{m}.txt"] = data = rng.randbytes(rng.randrange(0, 3000))
                z.writestr(f"folder/{m}.txt", data)
    for size in (100, 5_000, 1 << 30):
        rows = archives.members(spark, str(tmp_path), partition_bytes=size)
        got = [((os.path.basename(r["archive"]), r["member"]), bytes(r["content"])) for r in rows.collect()]
        assert len(got) == len(want) and dict(got) == want
    assert archives.members(spark, str(tmp_path), "*/1?.txt").count() == sum("/1" in m and len(m) == 13 for _, m in want)


def test_parts_cover_every_byte_once():
    files = [("a", 0), ("b", 10), ("c", 95), ("d", 400), ("e", 3)]
    parts = archives.planned(files, 100)
    for path, _ in files:
        spans = sorted(s for p in parts for s in p.spans if s[0] == path)
        assert spans[0][1] == 0 and spans[-1][2] == 1 << 62
        assert all(a[2] == b[1] for a, b in zip(spans, spans[1:], strict=False))
    assert len(parts) == 7 and archives.planned([], 100) == []


def test_broken_archives_and_members_are_rows(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("one.txt", b"first member" * 10)
        z.writestr("two.txt", b"x" * 500)
        z.writestr("three.txt", b"kept")
    data = bytearray((tmp_path / "good.zip").read_bytes())
    data[data.index(b"first") + 2] ^= 255
    (tmp_path / "good.zip").write_bytes(data)
    (tmp_path / "none.zip").write_bytes(b"PK no archive at all")
    (tmp_path / "empty.zip").write_bytes(b"")
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "x.zip").write_bytes(b"not looked at")
    got = {(os.path.basename(r["archive"]), r["member"]): (r["content"], r["error"]) for r in archives.members(spark, str(tmp_path), member_bytes=400, partition_bytes=50).collect()}
    assert len(got) == 5 and bytes(got["good.zip", "three.txt"][0]) == b"kept"
    assert got["good.zip", "one.txt"][0] is None and "damaged" in got["good.zip", "one.txt"][1]
    assert got["good.zip", "two.txt"] == (None, "more than 400 bytes")
    assert all(got[n, None][1].startswith("no archive") for n in ("none.zip", "empty.zip"))


def test_written_archives_read_back(spark, tmp_path):
    rows = [(f"m{i}", bytes([i % 256]) * i) for i in range(50)] + [(None, b"no name"), ("m1", b"again"), ("none", None)]
    df = spark.createDataFrame(rows, "member string, content binary").repartition(3)
    place = str(tmp_path / "out")
    archives.write(df, place)
    want = sorted((m or "", bytes(c or b"")) for m, c in rows)
    assert sorted((r["member"], bytes(r["content"])) for r in archives.members(spark, place).collect()) == want
    archives.write(df.limit(1), place)
    assert archives.members(spark, place).count() == len(want) + 1
    archives.write(df.filter("member = 'm7'"), place, "overwrite")
    assert [r["member"] for r in archives.members(spark, place).collect()] == ["m7"]
    assert [n for n in os.listdir(place) if n.startswith("_")] == []
    archives.write(df.filter("false"), str(tmp_path / "none"))
    assert archives.members(spark, str(tmp_path / "none")).collect() == []


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    df = spark.range(100, numPartitions=4).select(F.col("id").cast("string").alias("member"), F.when(F.col("id") == 99, F.raise_error("stop")).otherwise("x").alias("content"))
    with pytest.raises(Exception, match="stop"):
        archives.write(df, str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_text_of_an_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("b.xml", "<a>first\n <b>second</b></a>")
        z.writestr("c.png", "left out")
        z.writestr("a.txt", b"th\xffird  ")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("c.png", "left out")
    (tmp_path / "c.zip").write_bytes(b"broken")
    got = {os.path.basename(r["archive"]): r["text"] for r in archives.texts(archives.members(spark, str(tmp_path))).collect()}
    assert got == {"a.zip": "first second third", "b.zip": None, "c.zip": None}


def plain_lines(root):
    """What each wanted element of the body says before its first child, over the whole tree."""
    children = list(root)
    bodies = [c for c in children if c.tag == f"{{{OFFICE}}}body"] or [c for c in children if c.tag.split("}")[-1] == "body"]
    if not bodies:
        return None, "no body"
    lines = [e.text.strip() for e in bodies[0].iter() if e.tag.split("}")[-1] in ("p", "span", "h", "list-item") and (e.text or "").strip()]
    return ("\n".join(lines)[:8000], None) if lines else (None, "no text")


def random_tree(rng, depth=0):
    tags = ["p", "t:p", "t:span", "t:h", "list-item", "o:body", "body", "div"]
    e = tags[rng.randrange(len(tags))] if depth else "o:document"
    names = f' xmlns:o="{OFFICE}" xmlns:t="urn:t"' if not depth else rng.choice(["", ' k="1"', ' t:k="2"'])
    inner = "".join(rng.choice(["", " said &amp; done ", "\n", "ü<!-- not this -->x"]) + random_tree(rng, depth + 1) for _ in range(rng.randrange(0, 4) if depth < 5 else 0))
    return f"<{e}{names}>{rng.choice(['', 'line ', ' '])}{inner}{rng.choice(['', 'tail'])}</{e}>"


def paths_of(node, above=""):
    here = f"{above}/{node.tag}"
    return {here, *(f"{here}/@{a}" for a in node.attrib)}.union(*(paths_of(c, here) for c in node))


def test_open_document_and_xml_are_as_by_a_tree(spark):
    rng = random.Random(4)
    files = [random_tree(rng) for _ in range(300)]
    others = [f.replace("o:document", "other") for f in files[:100]]
    df = spark.createDataFrame([(i, f.encode()) for i, f in enumerate(files + others)], "i int, content binary")
    got = df.select("i", extract.open_document_text(F.col("content")).alias("o"), extract.xml_text(F.col("content")).alias("x")).orderBy("i").collect()
    found = set()
    for r, f in zip(got, files + others, strict=True):
        root = ElementTree.fromstring(f)
        want = plain_lines(root)
        found.add((want[0] is None, want[1]))
        assert tuple(r["o"]) == want
        assert tuple(r["x"]) == (want if f in files else (" ".join(sorted(paths_of(root))), None))
    assert len(found) == 3


def test_extraction_takes_the_kind_first(spark):
    rows = [
        ("a.TXT", b"  text \xff here ", None), ("b.csv", b"x, ,y\r\n\r\n z ", None), ("c.xml", b"<a><b k='1'/></a>", None), ("d.dat", b"<a>", "xml"),
        ("e.txt", b"<a/>", "xml"), ("f.xyz", b"?", "other"), ("g", None, None), (None, b"", None), ("h.txt", None, None), ("i.txt", b"", None),
    ]
    df = spark.createDataFrame([(*r, "old", "old") for r in rows], "path string, content binary, kind string, text string, more string")
    got = {r["path"]: (r["text"], r["error"]) for r in extract.extracted(df, kind=F.col("kind")).collect()}
    assert got == {
        "a.TXT": ("text � here", None), "b.csv": ("x | y\nz", None), "c.xml": ("/a /a/b /a/b/@k", None), "d.dat": ("<a>", None), "e.txt": ("/a", None),
        "f.xyz": (None, "Unknown format: .xyz"), "g": (None, "Unknown format: "), None: (None, "Unknown format: "), "h.txt": (None, "no content"), "i.txt": ("", None),
    }
    out = extract.extracted(df, kind=F.col("kind"), by_kind={"other": extract.plain_text}, by_extension={})
    assert {r["path"]: r["text"] for r in out.filter("text is not null").collect()} == {"f.xyz": "?"}
    assert extract.extracted(df.filter("false")).collect() == [] and set(out.columns) == set(df.columns) | {"error"}


def filled(place, rows):
    with sqlite3.connect(place) as db:
        db.execute("CREATE TABLE IF NOT EXISTS docs (id INTEGER, type TEXT, text TEXT)")
        db.executemany("INSERT INTO docs VALUES (?, ?, ?)", rows)
    db.close()


def test_keyset_scan_is_the_table(spark, tmp_path):
    place = str(tmp_path / "t.db")
    rng = random.Random(2)
    rows = [(rng.randrange(-50, 10_000), rng.choice("ab"), None if i % 9 == 0 else f"t{i}") for i in range(3000)] + [(None, "a", "no key")]
    filled(place, rows)
    options = {"database": place, "table": "docs", "key": "id", "pageRows": 17, "ranges": 5}
    order = lambda found: sorted(tuple(r) for r in found)
    plain = [(i, t, x or "") for i, t, x in rows if i is not None]
    got = keyset.batch(spark, "id long, type string, text string", **options).fillna("")
    assert got.rdd.getNumPartitions() == 5 and order(got.collect()) == sorted(plain)
    some = keyset.batch(spark, "text string, id long", where="type IN ('a')", **options).fillna("")
    assert order(some.collect()) == sorted((x, i) for i, t, x in plain if t == "a")
    filled(place, [(20_000, "a", "x")] * 18)
    with pytest.raises(Exception, match="more than 17 rows"):
        keyset.batch(spark, "id long", **options).collect()
    with pytest.raises(Exception, match="not a name"):
        keyset.batch(spark, "id long", **{**options, "table": "docs; DROP"}).collect()


def test_keyset_stream_goes_on_after_it_was_killed(spark, tmp_path):
    """A process that streams the table is killed amid its work; the next one, and a later batch, leave every row once."""
    place, out, state = str(tmp_path / "t.db"), str(tmp_path / "out"), str(tmp_path / "state")
    filled(place, [(i, "a", f"t{i}") for i in range(500)])
    run = textwrap.dedent(f"""
        from pyspark.sql import SparkSession
        from lodestone.sources import keyset
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        rows = keyset.stream(spark, "id long, text string", database={place!r}, table="docs", key="id", pageRows=50, ranges=3)
        rows.writeStream.format("parquet").option("checkpointLocation", {state!r}).trigger(processingTime="200 milliseconds").start({out!r}).awaitTermination()
    """)
    work = subprocess.Popen([sys.executable, "-c", run], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        until = time.time() + 90
        while not os.path.isdir(f"{state}/commits") and time.time() < until:
            time.sleep(0.1)
        filled(place, [(i, "a", f"t{i}") for i in range(500, 900)])
    finally:
        os.killpg(work.pid, signal.SIGKILL)
        work.wait()
    filled(place, [(i, "a", f"t{i}") for i in range(900, 1000)])
    options = {"database": place, "table": "docs", "key": "id", "pageRows": 50, "ranges": 3}
    for _ in range(2):
        rows = keyset.stream(spark, "id long, text string", **options)
        rows.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
        assert got == sorted(tuple(r) for r in keyset.batch(spark, "id long, text string", **options).collect()) and len(got) == 1000


def test_a_written_archive_has_a_bounded_number_of_members(spark, tmp_path):
    assert archives.ARCHIVE_MEMBERS == 1 << 14
    rows = spark.range(0, (1 << 14) + 10, 1, 1).selectExpr("CAST(id AS STRING) AS member", "CAST(id AS STRING) AS content")
    archives.write(rows, f"file://{tmp_path}/out")
    read = archives.members(spark, f"file://{tmp_path}/out")
    assert sorted(r["count"] for r in read.groupBy("archive").count().collect()) == [10, 1 << 14]
    assert read.selectExpr("CAST(content AS STRING) = member AS same").filter("same").count() == (1 << 14) + 10
