"""Joins, searches, repeated runs and archives against brute force on small tables."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa

from screenroll.llm import jaccard, substrings, topk, warc
from screenroll.llm.components import components
from screenroll.llm.common import new_path


def near_copies(seed=1):
    """Texts with copies, near copies in chains, short and empty ones, repeated rows and NULLs."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    rows, i = [], 0
    for _ in range(6):
        base = [word() for _ in range(rng.randint(30, 160))]
        chain = list(base)
        for _ in range(25):
            copy = list(chain if rng.random() < 0.3 else base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            chain = copy
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i + k, t) for k, t in enumerate([None, "", "One two", "one TWO", "one", " \n", "x y z", "X  y\tz", "the the the the"])]
    rng.shuffle(rows)
    return rows + [rows[0], (None, rows[1][1]), (None, None)]


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = [bytes(x).lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def test_components_equal_brute_force(documents):
    for seed in (1, 2):
        rows = near_copies(seed)
        got = jaccard.join_components(documents(rows, set="clash", n="clash"))
        assert sorted(map(tuple, got.collect()), key=repr) == brute_components(rows)
    assert jaccard.join_components(documents([])).count() == 0


def test_bitmaps_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (rng.integers(0, 1 << 62, rng.integers(1, 2500), dtype=np.uint64) for _ in "ab")
        a, b = np.unique(np.append(a, b[:400])), np.unique(b)
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        while len(x) != len(y):
            x, y = sorted((x, y), key=len)
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
        assert np.unpackbits((x ^ y).view(np.uint8)).sum() <= len(np.setxor1d(a, b))


def test_large_near_copies_of_different_map_widths_are_linked(documents):
    """Sizes around the step from one width to the next, where maps are folded."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(560)]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate((500, 510, 520, 530, 560))] + [(9, " ".join(reversed(words)))]
    got = jaccard.join_components(documents(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_components(rows)


def test_one_document_of_each_group_stays(documents):
    rows = near_copies(3)
    kept = jaccard.keep_one(documents(rows))
    ids = {d for d, _, c in brute_components(rows) if d is not None and d == c}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == ids and "text" in kept.columns


def test_links_from_differences_to_a_hub(spark):
    """Members of one hub in several blocks: links as by their sets."""
    rng, hub = random.Random(6), list(range(60))
    rows, sets = [], {}
    for i in range(1500):
        gone = rng.sample(hub, rng.randint(0, 5))
        more = [1000 + rng.randrange(8) for _ in range(rng.randint(0, 2))]
        s = (set(hub) - set(gone)) | set(more)
        sets[b"%05d" % i] = frozenset(s)
        rows.append((b"%05d" % i, b"h", 60, len(s), sorted(gone), sorted(set(more)), b"%05d" % i))
    members = spark.createDataFrame(rows, "set binary, hub binary, size int, n int, missing array<int>, extra array<long>, root binary")
    got = jaccard.member_links(members).collect()
    pairs = {(bytes(r.a), bytes(r.b)) for r in got}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    assert all(linked(a, b) for a, b in pairs)
    names = sorted(sets)
    assert {(a, b) for i, a in enumerate(names[:300]) for b in names[i + 1:] if linked(a, b)} == {p for p in pairs if p[0] in names[:300]}


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def brute_repeats(rows, window):
    low, words = {}, [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i:i + window])
                low[key] = min(d, low.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and low[tuple(w[i:i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def test_repeats_equal_brute_force(documents):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 2)
    run = lambda n: [word() for _ in range(n)]
    shared = [run(80), run(55), run(200), ["same"] * 130]
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(
        run(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 20):] + run(rng.randint(0, 40)))) for i in range(40)]
    rows += [(50, rows[0][1]), (51, rows[0][1]), (52, None), (53, ""), (None, rows[0][1]), (51, rows[0][1]), (54, "été " * 120)]
    rng.shuffle(rows)
    got = substrings.remove_repeats(documents(rows, kept="clash", start="clash"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, 50)
    assert substrings.report(documents([])).count() == 0


def vectors(spark, rows):
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                      "score": pa.array(["clash"] * len(rows))})
    return spark.createDataFrame(table)


def test_search_equals_brute_force(spark, documents):
    rng = random.Random(9)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, 0.05))) for c in rng.choice(centres)]) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(700)]
    valid = list(rows) + [(5000, [0.5] * 4), (5001, [])]
    bad = [(100, None), (6000, [None] * 8), (6001, [float("nan")] * 8), (6002, [float("inf")] * 8), (None, [0.1] * 8)]
    got = sorted(tuple(r) for r in topk.report(vectors(spark, valid + bad)).collect())
    whole = [(i, np.pad(np.floor(256 * np.array(v, float)), (0, 8 - len(v))).astype(int)) for i, v in valid]
    ids, matrix = np.array([i for i, _ in whole]), np.array([v for _, v in whole])
    want = []
    for q, v in whole:
        if q % 50 == 0:
            ranked = sorted(((-int(s), int(i)) for s, i in zip(matrix @ v, ids, strict=True) if i != q))[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    assert got == sorted(want)
    assert topk.report(vectors(spark, [])).count() == 0
    assert topk.report(vectors(spark, [(0, [1.0]), (1, [0.5])])).collect() == [(0, 1, 1, 256 * 128)]


def brute_search(rows, k=5):
    """Every row is a candidate; equal ids are ranked together; scores beyond a long are the end of its range."""
    whole = [(i, [int(c) * 256 if abs(c) >= 2 ** 53 else math.floor(c * 256) for c in v]) for i, v in rows]
    found = {}
    for q, a in whole:
        if q % 50 == 0:
            found.setdefault(q, []).extend(
                (-min(max(sum(x * y for x, y in zip(a, b)), -2 ** 63), 2 ** 63 - 1), i) for i, b in whole if i != q)  # noqa: B905
    return sorted((q, r, i, -s) for q, all_of in found.items() for r, (s, i) in enumerate(sorted(all_of)[:k], 1))


def test_search_of_repeated_rows_and_wide_vectors(spark):
    rng = random.Random(19)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(400)]
    rows += [rows[0], rows[50], rows[50], *[rows[7]] * 6]
    wide = [(1000, [3e5, -1.0, 0.25, 0.0]), (1001, [-3e5, 2.0, 1.0, 1.0]), (1050, [1e16, 1.0, 1.0, 1.0]),
            (1051, [1e300, 1.0]), (1052, [-1e300, 0.0, 1e300, 2.0]), (1053, [0.5, 2.0 ** 30, 0.5, -0.1]), (1100, [1.7e308] * 4)]

    def found(given):
        table = pa.table({"vec_id": pa.array([r[0] for r in given], pa.int64()),
                          "embedding": pa.array([r[1] for r in given], pa.list_(pa.float64()))})
        return sorted(tuple(r) for r in topk.report(spark.createDataFrame(table).repartition(3)).collect())

    assert found(rows) == brute_search(rows)
    assert found(rows + wide) == brute_search(rows + wide)
    assert found(wide) == brute_search(wide)


def test_search_stops_at_the_bounds(spark, monkeypatch):
    """Of clustered vectors, blocks of far clusters are not read."""
    rng = random.Random(20)
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    centres = [[8.0 if d == c else 0.0 for d in range(8)] for c in range(8)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 8]]) for i in range(4000)]
    table = topk.stage(topk.integer_vectors(vectors(spark, rows), "vec_id", "embedding"), "topk-test")
    pivots = topk.choose_pivots(table)
    blocks = topk.build_index(table, pivots)
    queries = table.where("id % 50 = 0")
    packed = topk.stage(topk._blocks(topk._keyed(queries, pivots, False), 8, False), "topk-test")
    pairs = topk.stage(topk.block_pairs(packed, blocks, pivots), "topk-test")
    start = pairs.where(f"turn <= {topk.FIRST}").selectExpr(
        "queries", "block", "cast(null as array<struct<query_row:int,floor:long>>) floors")
    first = topk.stage(topk._search(start, packed, blocks, pivots, 5), "topk-test")
    rest = topk.still_open(pairs, first, 5)
    assert rest.count() < pairs.count() / 3
    assert sorted(map(tuple, topk.search(queries, pivots, blocks, 5).collect())) == brute_search(
        [(i, [float(np.float32(c)) for c in v]) for i, v in rows])


def test_archives_round_trip(spark, documents, monkeypatch):
    rng = random.Random(10)
    bodies = [None, "", "<p>é</p>", "x" * 300000, "WARC/1.1\r\n\r\n", *(rng.choice(["a", "b", "c"]) * rng.randint(1, 3) for _ in range(60))]
    rows = [(i, f"http://h/{i}" if i % 7 else None, b) for i, b in enumerate(bodies)] + [(None, "u\r\nX: y", "a"), (3, "again", "x" * 300000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("page_id", "page_id")
    root = new_path(spark, "warc-test")
    index = warc.write_archives(pages.repartition(3), root)
    assert {(r.page_id, r.url) for r in index.collect()} == {(i, u) for i, u, _ in rows}
    got = warc.read_records(index, root).collect()
    largest = {}
    for i, _, b in rows:
        if i is not None:
            largest[b or ""] = max(i, largest.get(b or "", -1))
    assert len(got) == len(rows)
    for r in got:
        bodies_of = {(b or "") for i, _, b in rows if i == r.page_id}
        body = r.html if r.html is not None else next(b for b in bodies_of if largest[b] == r.refers_to)
        assert body in bodies_of and r.payload_bytes == len(body.encode())
        assert (r.refers_to is None) == (r.page_id is None or largest[body] == r.page_id)
        assert r.record_type == ("response" if r.refers_to is None else "revisit")
    one = warc.read_records(index.where("page_id = 2"), root).collect()
    assert [(r.html, hashlib.sha1(r.html.encode()).hexdigest()[:0]) for r in one] == [("<p>é</p>", "")]
    assert warc.report(pages.where("false")).count() == 0
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    several = warc.read_records(index, root)
    assert several.rdd.getNumPartitions() > 2
    assert sorted(map(str, several.collect())) == sorted(map(str, got))
