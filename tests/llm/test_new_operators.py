"""Language identification, spelling variants and vector codes."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import duck_bag, spark_bag
from screenroll.llm import codes, langid, spelling
from screenroll.llm.common import read, remainder, stage

SF = "/root/testdata/sf0.01"


# Languages


def test_languages_of_held_out_rows(spark):
    scored = stage(corpus_pipeline.REGISTRY["op11_language"][0](spark, SF), "test-languages")
    docs = read(spark, SF, "documents")
    assert scored.count() == docs.count()
    assert scored.where(F.col("held_out") != (remainder("doc_id", 3) == 1)).count() == 0
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    held = scored.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").select("lang", "lang_pred").collect()
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_language_edges(spark, documents):
    text = {"a": "alma bela cana dama eba", "o": "olmo bolo cono domo ebo"}
    rows = [(i, text["ao"[i % 2]] + " " * (i % 5)) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "123 -- 456"), (None, text["a"]), (61, ""), (63, text["o"] * 100_000)]
    docs = documents(rows, language="clash", score="clash", at="clash", shard="clash").withColumn(
        "lang", F.when(F.col("doc_id") < 60, F.when(F.col("doc_id") % 2 == 0, "a").otherwise("o")))
    got = {(r.doc_id, r.lang_pred): r.score for r in langid.report(docs).collect()}
    assert all(got[i, "ao"[i % 2]] > 0.5 for i in range(60)) and got[63, "o"] > 0.5 and got[None, "a"] > 0.5
    assert got[60, "und"] == got[61, "und"] == got[62, "und"] == 0
    assert langid.report(docs).count() == len(rows)
    unlabelled = langid.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert langid.report(docs.where("false")).count() == 0
    one = langid.report(docs.withColumn("lang", F.lit("x"))).where("doc_id < 60").collect()
    assert {r.lang_pred for r in one} == {"x"}


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_ngrams_do_not_depend_on_the_pieces(monkeypatch, piece):
    text = "Straße, été  ÉTÉ?! 42 naïve—çà 日本語 " * 9
    monkeypatch.setattr(langid, "_PIECE", piece)
    at, counts = langid.ngrams(text)
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = " " + " ".join(words) + " "
    want = Counter(line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1))
    del want[" "]
    assert counts.sum() == sum(want.values()) and len(at) == len(want)
    assert sorted(counts.tolist()) == sorted(want.values())


def test_leader_follows_the_gradient():
    """One row alone: the first step is the closed form of the regularised leader."""
    z, n = np.zeros((4, 2)), np.zeros((4, 2))
    langid.follow(z, n, [(np.array([0, 2]), np.array([0.6, 0.8]))], np.array([1]))
    slope = np.outer([0.6, 0.0, 0.8, 1.0], [0.5, -0.5])
    assert np.allclose(z, slope) and np.allclose(n, slope**2)
    w = langid.leader(z, n)
    assert (w[1] == 0).all() and (np.sign(w[[0, 2, 3]]) == -np.sign(slope[[0, 2, 3]])).all()
    assert np.allclose(w[0, 1], (0.3 - langid.L1) / ((langid.BETA + 0.3) / langid.ALPHA + langid.L2))
    assert (langid.leader(np.full((3, 1), langid.L1), np.ones((3, 1)))[:2] == 0).all()


# Spelling


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        found = sorted((-m, v) for v, m in counts.items() if v != w and near(v, w))
        form = found[0] if found and -found[0][0] >= 2 * n else None
        out[w] = (form and form[1], n, len(found), form and -form[0])
    rows = []
    for w, (form, n, many, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, many, form_n))
    return sorted(rows)


@pytest.mark.parametrize("limit", [2, 8192])
def test_variants_equal_all_pairs(spark, limit, monkeypatch):
    rng = random.Random(limit)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 9))) for _ in range(500)}
    words |= {"a" * k for k in range(1, 12)} | {"stem" + "".join(rng.choices("abcdefgh", k=4)) for _ in range(300)} | {"z" * 300, "z" * 301}
    counts = {w: rng.choice([1, 2, 3, 7, 20, 90, 400]) for w in words}
    vocabulary = stage(spark.createDataFrame(list(counts.items()), "word string, n long"), "test-vocabulary")
    partitions = spelling.partitions
    monkeypatch.setattr(spelling, "partitions", lambda v, _: partitions(v, limit))
    monkeypatch.setattr(spelling, "ROWS", 200 if limit == 2 else spelling.ROWS)
    got = sorted((tuple(r) for r in spelling.variants(vocabulary).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()))
    assert got == brute_variants(counts)


def test_partitions_are_small_or_have_one_place_left(spark):
    words = sorted({"prefix" + a + b + c for a in "abcdef" for b in "abcdef" for c in "abcdef"})
    vocabulary = stage(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), "test-vocabulary")
    sizes = spelling.partitions(vocabulary, 20).groupBy("m", "lo", "hi", "head", "tail").count().collect()
    assert max(r["count"] for r in sizes if r.hi - r.lo > 1) <= 20 and max(r["count"] for r in sizes) <= 36


def test_words_lose_letters_by_checksum(documents):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["Gamma", "delta", "épsilon", "ÉPSILON", "zêta-eta", "x1theta"]) for _ in range(30))) for i in range(60)]
    rows += [(None, "gamma Gamma"), (3, None), (4, ""), (5, "delta"), (5, "delta")]
    want = Counter()
    for i, t in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in t).split(" "):
            if run:
                h = crc32(f"{i}:{run}".encode())
                if i is not None and h % 7 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                want[run] += 1
    docs = documents(rows, word="clash", n="clash")
    got = {r.word: r.n for r in spelling.word_counts(docs, drop_one_in=7, min_length=1, min_count=1).collect()}
    assert got == {w: n for w, n in want.items() if w}
    assert spelling.report(documents([])).count() == 0 and spelling.report(documents([(1, None)])).count() == 0


# Vector codes


def test_codes_equal_duckdb_on_edges(spark):
    import duckdb

    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (700, 8)).astype(np.float32).tolist()
    vectors[300:340] = [vectors[5]] * 40  # copies
    ids, labels = list(range(700)), [None if i % 5 == 0 else i % 3 for i in range(700)]
    ids[10] = 9
    vectors[20], vectors[21], vectors[22], vectors[23] = None, [None] * 8, [float("nan")] * 8, [float("inf")] * 8
    table = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())),
                      "label": pa.array(labels, pa.int32()), "code": ["clash"] * 700, "pivots": ["clash"] * 700, "error": ["x"] * 700})
    con = duckdb.connect()
    con.register("embeddings", table)
    assert spark_bag(codes.report(spark.createDataFrame(table))) == duck_bag(con, codes.codes_sql())
    few = table.slice(0, 30)
    con.register("embeddings", few)
    assert spark_bag(codes.report(spark.createDataFrame(few))) == duck_bag(con, codes.codes_sql())
    assert codes.report(spark.createDataFrame(table).where("false")).count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 6, 0), (2, [1.0] * 8, 0)], "vec_id long, embedding array<double>, label int")
    assert codes.report(odd).count() == 0


def test_codes_of_extreme_components_are_exact(spark):
    rng = random.Random(6)
    size = lambda: rng.choice([1.0, 1e6, 1e12, 3e38])
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * size())) for _ in range(8)], 0) for i in range(300)]
    got = {r.vec_id: r for r in codes.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    whole = [[int(v * 1024 // 1) for v in r[1]] for r in rows]
    books = [[w[2 * p:2 * p + 2] for w in whole[:256]] for p in range(4)]

    def assign(w, p):
        return min((sum((a - b) ** 2 for a, b in zip(w[2 * p:2 * p + 2], e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            mine = {}
            for w in whole:
                mine.setdefault(assign(w, p)[1], []).append(w[2 * p:2 * p + 2])
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k], strict=True)] if k in mine else e for k, e in enumerate(books[p])]
    for i, w in enumerate(whole):
        best = [assign(w, p) for p in range(4)]
        assert got[i].code == "".join(f"{k:02x}" for _, k in best)
        error = sum(d for d, _ in best)
        assert got[i].error == (error if error < 1 << 63 else None)


def test_pruning_computes_few_distances(monkeypatch):
    rng = np.random.default_rng(7)
    centres = rng.integers(-4000, 4000, (256, 16))
    x = centres[rng.integers(0, 256, 3000)] + rng.integers(-40, 40, (3000, 16))
    books = codes.Codebooks(centres[None], codes._far_apart(centres, codes.PIVOTS)[None])
    known = books.pivot_distances(x)
    computed, exact = [], codes._squares
    monkeypatch.setattr(codes, "_squares", lambda a, b: computed.append(np.broadcast(a, b).size // 16) or exact(a, b))
    code, error = books.assign(x, known)
    assert sum(computed) < 0.2 * 3000 * 256
    whole = ((x[:, None] - centres) ** 2).sum(axis=2)
    assert (code[:, 0] == whole.argmin(axis=1)).all() and (error[:, 0] == whole.min(axis=1)).all()


def test_decoded_vectors_are_the_entries(spark):
    rows = read(spark, SF, "embeddings")
    books = codes.first_codebooks(rows)
    coded = codes.encode(codes.with_pivots(rows, books), books)
    got = codes.decode(coded, books).where("vec_id < 20").collect()
    vectors = {r.vec_id: np.floor(np.array(r.embedding) * 1024) / 1024 for r in rows.where("vec_id < 20").collect()}
    assert all(np.allclose(r.embedding, vectors[r.vec_id]) and r.error == 0 for r in got)
