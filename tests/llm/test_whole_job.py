"""Operators find all that they are for: leaks, near copies and notices that narrower rules miss."""

import random
import re

import corpus_pipeline
from screenroll.llm import decontaminate, jaccard, licenses


def brute_leaks(rows, items):
    """Pairs with three words in a row in common whose best alignment reaches the threshold."""
    grams = lambda w: {tuple(w[i:i + 3].tolist()) for i in range(len(w) - 2)}
    texts = [(d, decontaminate.words_of((t or "").encode())) for d, t in rows]
    found = []
    for i, t in items:
        item = decontaminate.words_of(t.encode())
        found += [(d, i, score) for d, w in texts if len(w) and grams(item) & grams(w)
                  and (score := decontaminate.align(item, w)[0] / 2 / len(item)) >= decontaminate.THRESHOLD]
    return sorted(found)


def test_edited_copies_are_leaks_however_many(documents, spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    common = [word() for _ in range(3)]
    noise = lambda n: [w for _ in range(n // 4) for w in [*common, word()]]
    items, rows = [], []
    for i, copies in enumerate((3, 50, 1000, 20)):
        item = [*common, *(word() for _ in range(37))]
        edited = list(item)
        for k in (6, 15, 24, 33):
            edited[k] = word()
        items.append((i, " ".join(item)))
        rows += [(len(rows) + k, " ".join(noise(40) + edited + noise(40))) for k in range(copies)]
    # One exact copy of the last item, one with words put in, and long texts of a frequent seed.
    rows.append((len(rows), items[3][1]))
    rows.append((len(rows), " ".join(w for k, v in enumerate(items[3][1].split()) for w in ([v] if k % 4 else [word(), word(), v]))))
    rows += [(len(rows) + k, " ".join(noise(800))) for k in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.score) for r in decontaminate.find_leaks(documents(rows), bench).collect())
    assert got == brute_leaks(rows, items) and len(got) == 3 + 50 + 1000 + 20 + 2


def brute_firsts(rows, n, link, of):
    """Smallest ids of the groups of texts linked by their n-word shingles."""
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or {tuple(w)})
    label = {d: d for d, _ in rows}
    for a, (x, _) in enumerate(rows):
        for b, (y, _) in enumerate(rows[:a]):
            if of * len(sets[a] & sets[b]) >= link * len(sets[a] | sets[b]):
                low, high = sorted((label[x], label[y]))
                label = {d: low if r == high else r for d, r in label.items()}
    return {d for d, r in label.items() if d == r}


def test_the_near_copy_stage_takes_five_words_and_four_fifths(documents, spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = []
    for size, most in ((50, 2), (200, 6), (500, 14), (3, 1), (8, 1)):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for changes in (0, *(rng.randint(0, most) for _ in range(9))):
                copy = list(base)
                for k in rng.sample(range(size), changes):
                    copy[k] = word()
                rows.append((len(rows), " ".join(copy)))
    # One word in 50, 4 in 200 and 10 in 500: at least 0.8 by five words, below 0.9 by three.
    pairs = []
    for size, changes in ((50, 1), (200, 4), (500, 10)):
        base = [word() for _ in range(size)]
        copy = [word() if k % (size // changes) == size // changes // 2 else w for k, w in enumerate(base)]
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    kept = {r.doc_id for r in corpus_pipeline.keep_first_copies(spark, documents(rows), "").collect()}
    assert kept == brute_firsts(rows, 5, 80, 100)
    assert all(a in kept and b not in kept for a, b in pairs)
    strict = {r.doc_id for r in jaccard.keep_one(documents(rows)).collect()}
    assert strict == brute_firsts(rows, 3, 90, 100) and all(b in strict for _, b in pairs)


def test_notices_in_long_lines_and_over_two_lines(documents):
    rng = random.Random(10)
    noise = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    rows, want = [], {}
    for name, template in licenses.TEMPLATES:
        words = template.split()
        half = len(words) // 2
        for text in (
            " ".join(noise(100) + words + noise(100)),
            " ".join(noise(200) + words), " ".join(words + noise(200)),
            " ".join(noise(30) + words[:half]) + "\n * " + " ".join(words[half:] + noise(30)),
            " ".join(noise(60) + words[:half] + noise(1) + words[half:] + noise(60)),
        ):
            want[len(rows)] = name
            rows.append((len(rows), text))
    for text in (" ".join(noise(200)), "the " * 200 + "license " + "of " * 200, " ".join(noise(90) + ["mit"] + noise(90)), None):
        want[len(rows)] = None
        rows.append((len(rows), text))
    idf = licenses.weights(10_000, {"the": 9_000, "of": 8_000, "is": 7_000, "license": 500, "licensed": 300, "under": 900})
    got = {r.doc_id: r.own_license for r in licenses.own_license(documents(rows), idf).collect()}
    assert got == want
