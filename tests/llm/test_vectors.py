"""Clustering, whitening and vector packing against brute force, on given and on awkward tables."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from lodestone.llm import dual_tree, queries, tokens, vector_packing, whitening
from lodestone.llm.common import Scratch, tokenizer_path

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
NAN, INF = float("nan"), float("inf")


def lloyd(rows, k, rounds):
    """(cluster, distance) of each of rows (id, x), and the centroids, by all pairs of Python integers."""
    first = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(x) for _, x in first]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    assign = lambda: [min((far(x, c), i) for i, c in enumerate(centroids)) for _, x in rows]
    for _ in range(rounds):
        to = assign()
        for i in range(len(centroids)):
            own = [x for (_, x), (_, j) in zip(rows, to, strict=True) if i == j]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return [(i, d) for d, i in assign()], centroids


@pytest.mark.parametrize("dim, spread, tree_rows", [(2, 40, 64), (6, 5, 200), (3, 1, 50), (2, 1 << 26, 64)])
def test_clustering_is_all_pairs(spark, monkeypatch, dim, spread, tree_rows):
    rng = random.Random(dim * spread)
    monkeypatch.setattr(dual_tree, "TREE_ROWS", tree_rows)
    rows = [(i, [rng.randrange(-spread, spread + 1) for _ in range(dim)]) for i in range(300)]
    # Many copies of one vector, repeated rows and null ids.
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + rows[:5] + [(None, rows[7][1]), (None, rows[8][1])]
    want, centroids = lloyd(rows, 9, 3)
    frame = spark.createDataFrame(rows, "id long, x array<long>").repartition(3)
    got = dual_tree.cluster(frame, Scratch(spark, "t"), dim, 9, 3).collect()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda k: sum(d for i, d in want if i == k)
    fits = lambda x: x if x < 1 << 63 else None
    show = lambda r: tuple("" if v is None else str(v) for v in r)
    expect = [(r[0], k, d, fits(of(k)), fits(sum(d for _, d in want)), digest[k]) for r, (k, d) in zip(rows, want, strict=True)]
    assert sorted(map(show, got)) == sorted(map(show, expect))


def test_a_cover_tree_covers_separates_and_prunes():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, (900, 3)) + rng.integers(0, 6, (900, 1)) * 3000
    order, tree = dual_tree.build(x)
    assert sorted(order) == list(range(900)) and (tree.vectors == x[order]).all()
    far = lambda a, b: float(np.sqrt(((a - b) ** 2).sum()))
    for n in tree.nodes:
        pivot = tree.vectors[n["pivot"]]
        assert max(far(v, pivot) for v in tree.vectors[n["first"] : n["end"]]) == pytest.approx(n["radius"])
        children = tree.nodes[n["child"] : n["last_child"]]
        pivots = [tree.vectors[c["pivot"]] for c in children]
        if pivots:
            assert (pivots[0] == pivot).all()
        assert all(far(a, b) > n["radius"] / 2 for i, a in enumerate(pivots) for b in pivots[:i])
    centroids = x[::100].tolist()
    to, compared = dual_tree.walk(tree, *reversed(dual_tree._centroid_tree(centroids)))
    d = ((tree.vectors[:, None] - np.array(centroids)) ** 2).sum(-1)
    assert (to == d.argmin(1)).all() and compared < 0.3 * d.size


def awkward_vectors(rng, dim=64, n=120):
    good = [(i, [rng.gauss(0, 0.1) for _ in range(dim)]) for i in range(n)]
    bad = [(900, None), (901, []), (902, [0.1] * (dim - 1)), (903, [0.1] * (dim - 1) + [None]), (904, [NAN] + [0.0] * (dim - 1)), (905, [0.0] * (dim - 1) + [-INF])]
    return good + bad + good[:3] + [(None, [rng.gauss(0, 0.1) for _ in range(dim)])], len(bad)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("vectors"))
    rows, _ = awkward_vectors(random.Random(2))
    rows = [(i, v, "x", 3) for i, v in rows]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string, n int").write.parquet(f"{out}/embeddings.parquet")
    return out


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    path = f"{folder}/embeddings.parquet"
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    found = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in found.description]
    show = lambda r: tuple(str(v) for v in r)
    got = queries.queries()[name](spark, folder).collect()
    assert got and sorted(show(r[n] for n in names) for r in got) == sorted(map(show, found.fetchall()))


def test_clustering_of_awkward_vectors_is_its_sql(spark, folder):
    same_as_sql(spark, folder, "op11_centroid_clustering")


@tables
def test_clustering_is_its_sql(spark):
    same_as_sql(spark, FOLDER, "op11_centroid_clustering")


def whitened_by_numpy(rows):
    """n, deviation by row and the projections' squares, for whole-number vectors."""
    x = np.array(rows, object)
    n, s = len(x), x.sum(0)
    dev = ((n * x - s) ** 2).sum(1).tolist()
    d = (n * x - s).astype(float) / n
    values, vectors = np.linalg.eigh(d.T @ d / n)
    return n, dev, values[::-1], vectors[:, ::-1], d


def check_whitening(got, ids, x):
    n, dev, values, vectors, d = whitened_by_numpy(x)
    use = min(8, len(values))
    assert len(got) == n * use
    by_id = {}
    for r in got:
        assert r["n"] == n and r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-6) and r["identity_error"] <= 1e-4
        by_id.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    want = d @ vectors[:, :use] / np.sqrt(values[:use])
    for k in range(use):
        column = [by_id[ids[i], dev[i]][k + 1][0] for i in range(n)]
        sign = np.sign(np.dot(column, want[:, k]))
        assert np.allclose(column, sign * want[:, k], atol=1e-7)


def test_whitening_of_awkward_vectors(spark, folder):
    got = queries.queries()["op12_whitening"](spark, folder).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    check_whitening(got, [i for i, _ in kept], [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept])


@tables
def test_whitening_of_given_vectors(spark):
    got = queries.queries()["op12_whitening"](spark, FOLDER).collect()
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check_whitening(got, [r["vec_id"] for r in rows], [[int(np.floor(1024 * float(c))) + 100_000 for c in r["embedding"]] for r in rows])


def test_whitening_keeps_small_eigenvalues_and_marks_absent_ones(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-(10**8), 10**8), rng.randrange(-(10**4), 10**4), 5]) for i in range(400)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>"), Scratch(spark, "t")).collect()
    assert {r["component"] for r in got if r["whitened"] is None} == {3}
    second = [r["whitened"] for r in got if r["component"] == 2]
    assert np.var(second) == pytest.approx(1, abs=1e-7) and all(r["identity_error"] < 1e-4 for r in got)
    n, s = len(rows), [sum(x[j] for _, x in rows) for j in range(3)]
    exact = {i: sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True)) for i, x in rows}
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None) for r in got)


def test_whitening_of_one_vector_and_of_none(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [4, 5])], "vec_id long, x array<long>"), Scratch(spark, "t")).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    none = spark.createDataFrame([], "vec_id long, x array<long>")
    assert whitening.whiten(none, Scratch(spark, "t")).collect() == []
    assert dual_tree.cluster(none.withColumnRenamed("vec_id", "id"), Scratch(spark, "t"), 64, 16, 3).collect() == []


def test_jacobi_keeps_the_relative_accuracy_of_small_eigenvalues():
    rng = np.random.default_rng(6)
    scale = 10.0 ** -np.arange(0, 24, 4)
    core = np.eye(6) + 0.1 * rng.normal(size=(6, 6))
    core = core @ core.T
    values, vectors = whitening.jacobi(scale[:, None] * core * scale)
    exact = [[Fraction(scale[i]) * Fraction(core[i, j]) * Fraction(scale[j]) for j in range(6)] for i in range(6)]
    det = Fraction(1)
    for p in range(6):
        det *= exact[p][p]
        for r in range(p + 1, 6):
            f = exact[r][p] / exact[p][p]
            exact[r] = [a - f * b for a, b in zip(exact[r], exact[p], strict=True)]
    assert np.prod(values) == pytest.approx(float(det), rel=1e-10) and (values > 0).all()
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-14)


def check_packed(rows, whole, limits):
    """Every id in one piece, no gap in a sequence, the limits kept, and nothing padded."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"], r["loss_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["loss_tokens"]))
    wanted = {}
    for doc_id, silent, ids in whole:
        wanted.setdefault((doc_id, len(ids) // 4), []).append((silent, ids))
    assert pieces.keys() == wanted.keys()
    for key, copies in wanted.items():
        silent, ids = copies[0]
        starts = sorted(pieces[key])
        assert sum(p[1] for p in starts) == sum(len(c) // 4 for _, c in copies)
        for start, length, crc, loss in starts:
            assert length > 0 and crc == zlib.crc32(ids[4 * start : 4 * (start + length)]) and loss == length - max(0, min(silent, start + length) - start)
        if len(copies) == 1:
            assert [p[0] for p in starts] == [sum(p[1] for p in starts[:i]) for i in range(len(starts))]
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(p[1] for p in parts[:i]) for i in range(len(parts))]
        n = sum(p[1] for p in parts)
        assert n <= limits.tokens and len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
        assert n == limits.tokens or n & (n - 1) == 0
    return len(sequences)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(vector_packing.TOKENIZER))
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


END = np.array([1], "<u4").tobytes()


def test_packing_of_awkward_documents(spark, library):
    rng = random.Random(5)
    texts = [None, "", " \n ", "<|endoftext|> x", "é ß", "क़. ড়,", *("w" * rng.randrange(40) + " " + "lorem ipsum " * rng.randrange(0, 400) for _ in range(90)), "long " * 9000]
    rows = [(i, t, "x", 4) for i, t in enumerate(texts)]
    rows += [(None, "null id", "y", 4), rows[8], rows[8]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, start int").repartition(5)
    whole = [(r[0], 0, library(r[1]) + END) for r in rows]
    got = vector_packing.pack(docs, Scratch(spark, "t"))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
    n = check_packed(got.collect(), whole, vector_packing.Limits())
    assert n <= sum(len(w[2]) for w in whole) // 4 / 2048 + 1 + 11
    # A window of a few examples, many tasks, and limits that all bind.
    limits = vector_packing.Limits(64, 3, 40)
    check_packed(vector_packing.pack(docs, Scratch(spark, "t"), limits, window=7).collect(), whole, limits)
    assert vector_packing.pack(docs.limit(0), Scratch(spark, "t")).collect() == []


@tables
def test_packing_of_instructions_from_conversations(spark, library):
    """The user's turn is the prompt; the answer bears the loss."""
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    answers = turns.filter("role = 'assistant'").selectExpr("conv_id", "turn - 1 as turn", "text")
    asked = turns.filter("role = 'user'").selectExpr("conv_id", "turn", "text as prompt")
    examples = answers.join(asked, ["conv_id", "turn"]).selectExpr("conv_id * 1000 + turn as doc_id", "text", "prompt")
    rows = examples.collect()
    assert rows
    whole = []
    for r in rows:
        before = library(r["prompt"])
        whole.append((r["doc_id"], len(before) // 4, before + library(r["text"]) + END))
    limits = vector_packing.Limits(256, 6, 100)
    got = vector_packing.pack(examples, Scratch(spark, "t"), limits).collect()
    check_packed(got, whole, limits)


@tables
def test_packing_of_given_documents(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    whole = [(r["doc_id"], 0, library(r["text"]) + END) for r in docs]
    got = queries.queries()["op13_vector_packing"](spark, FOLDER).collect()
    check_packed(got, whole, vector_packing.Limits())


@pytest.mark.parametrize("name, encoder", [("byte_bpe_50k.json", tokens.byte_encoder), ("word_bpe_49k.json", tokens.encoder)])
def test_ids_of_letters_beside_punctuation_are_the_librarys(name, encoder):
    """Every sign of the first planes of scripts and some of the rest: before, after and between punctuation and white space."""
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    own, known = encoder(path), Tokenizer.from_file(path)
    signs = [chr(i) for i in [*range(0x3400), *range(0xA000, 0x20000, 37), *range(0xF900, 0xFFFF), *range(0x10A00, 0x11000)] if not 0xD800 <= i < 0xE000]
    for lo in range(0, len(signs), 2000):
        text = " ".join(f"x{c}. {c}.y {c} {c}. .{c} a,{c}{c}!  {c}\n{c}b\n\n{c}" for c in signs[lo : lo + 2000])
        assert own(text) == np.array(known.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
