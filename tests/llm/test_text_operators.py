"""Personal data, encoding, licenses and leaks against plain rules on small texts."""

import hashlib
import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from screenroll.llm import bpe, common, decontaminate, licenses, pii
from screenroll.llm.queries import BPE

LUHN, IBAN = "4111 1111 1111 1111", "GB82WEST12345698765432"
TEXTS = [
    None, "", " ", "mail me: a.b@c.d.e_x@y.zz, and ip 1.2.3.4.5.6.7.8 or 256.1.1.1",
    f"card {LUHN} phone +1 (555) 010-9999 iban {IBAN}", "tel 555-123-4567, no 555-123-4567",
    "a@b.c" * 300, "1.1.1.1 " * 400, "9" * 5000, "+1 ((((((", "é@ñ.fr ü1.2.3.4ü", "ssn 123-45-6789",
    "x" * 20000 + "@", f"{LUHN}" * 3,
]


def base_spans(text):
    found = []
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    tests = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")),
             lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 9 <= len(digits(m)) <= 15]
    for i, test in enumerate(tests):
        for m in re.finditer(pii.KINDS[i].pattern, text or ""):
            if test(m.group()):
                found.append((m.start(), i, f"{pii.KINDS[i].name}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(found))


def test_pii_equals_plain_patterns(documents):
    rng = random.Random(5)
    parts = ["a@b.co", "@", ".", "1.2.3.4", "300.1.2.3", " ", "-", LUHN, "+49 (30) 123-456 78", "é", "7", "x", "\n", "+"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(150)]
    df = documents(list(enumerate(texts)) + [(None, "a@b.cc"), (0, None)], spans="clash", pii="clash")
    got = [(r.doc_id, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in pii.report(df).collect()]
    want = []
    for i, t in [*enumerate(texts), (None, "a@b.cc"), (0, None)]:
        spans = base_spans(t)
        want.append((i, hashlib.sha256(spans.encode()).hexdigest(), len(spans.split(",")) if spans else 0))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_checksums_and_context_add_spans(documents):
    df = documents([(1, TEXTS[4]), (2, TEXTS[5]), (3, TEXTS[11]), (4, "code 123-45-6789")])
    spans = {r.doc_id: r.spans for r in pii.report(df).collect()}
    assert "iban:" in spans[1] and spans[2] == "local_phone:4:16" and spans[3] == "ssn:4:15" and spans[4] == ""


def test_redaction_masks_overlapping_spans_once(documents):
    df = documents([(1, f"to a@b.cc, {LUHN}!"), (2, None), (3, "plain")])
    got = {r.doc_id: r.text for r in pii.redact(pii.find_pii(df)).collect()}
    assert got == {1: "to <EMAIL>, <CARD>!", 2: None, 3: "plain"}
    assert pii.report(documents([])).count() == 0


@pytest.fixture(scope="module")
def reference():
    codec = bpe.Codec(open(BPE["rank_path"], "rb").read(), BPE["pattern"])
    return codec, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_ids_equal_those_of_the_library(documents, reference):
    rng = random.Random(2)
    parts = ["a", "aa", "the", " ", "\n", "é", "ß", "日", "́", "1", "'s", "!", "\x1c", "😀", "<|endoftext|>"]
    texts = [None, "", "a" * 3000, "ab" * 5000, *("".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(200))]
    df = documents(list(enumerate(texts)) + [(0, None)], ids="clash", decoded="clash")
    got = bpe.decode(bpe.encode(df, **BPE), **BPE).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        text = texts[row.doc_id] or ""
        ids = [int.from_bytes(row.ids[i:i + 4], "little") for i in range(0, len(row.ids), 4)]
        assert ids == reference[1].encode_ordinary(text) and bytes(row.decoded) == text.encode()
    assert sorted(map(tuple, bpe.round_trip(df, **BPE).select(*df.columns).collect()), key=str) == sorted(
        map(tuple, bpe.decode(bpe.encode(df, **BPE), **BPE).select(*df.columns).collect()), key=str)
    assert bpe.report(documents([]), **BPE).count() == 0


def test_workers_hold_the_tables_of_one_operator():
    assert common.held("a", lambda: 1) == 1 and common.held("a", lambda: 2) == 1
    batch = pa.RecordBatch.from_pydict({"text": ["x"] * 5})
    assert [b.num_rows for b in common.slices([batch], 3, holds=True)] == [3, 2]
    assert common.held("a", lambda: 3) == 1
    assert len(list(common.slices([batch]))) == 1 and common.held("a", lambda: 4) == 4
    assert common.held("b", lambda: 5) == 5 and common.held("a", lambda: 6) == 6


def test_rank_queue_gives_the_least_rank():
    queue, rng, held = bpe.RankQueue(50257), random.Random(1), {}
    for p in range(3000):
        rank = rng.randrange(50257)
        queue.push(rank, p)
        held.setdefault(rank, []).append(p)
    while held:
        least = queue.first()
        assert least == min(held) and queue.buckets[least] == held.pop(least)
        queue.drop(least)
    assert queue.first() is None


def test_long_texts_are_split_piece_by_piece(reference, monkeypatch):
    codec, encoding = reference
    text = "The quick brown fox's 12 dogs \n\n jumped.  " * 200
    whole = codec.encode([text])
    monkeypatch.setattr(bpe, "LONG_TEXT", 80)
    monkeypatch.setattr(bpe, "HELD_PIECES", 7)
    codec.known.clear()
    assert codec.encode([text]) == whole and len(whole[0]) == 4 * len(encoding.encode_ordinary(text))


def test_licenses_are_found_and_inherited(documents, spark):
    rows = [(1, "words\nReleased under the MIT License."), (2, "plain"), (3, None), (4, "plain"), (5, "plain"),
            (6, "Licensed under the Apache License, Version 2.0.\n" + "word " * 30000), (7, "the work of any person is in this version")]
    paths = {1: "a/LICENSE", 2: "a/b/c.txt", 3: "a/x", 4: "z/y", 5: "a/b/d/e", 6: "a/b/d/COPYING.txt", 7: None}
    df = documents(rows, own_license="clash").join(
        spark.createDataFrame(list(paths.items()), "doc_id long, path string"), "doc_id")
    got = {r.doc_id: (r.own_license, r.license, r.inherited_from) for r in licenses.scan(df).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: (None, "MIT", "a"), 4: (None, None, None),
                   5: (None, "Apache-2.0", "a/b/d"), 6: ("Apache-2.0", "Apache-2.0", None), 7: (None, None, None)}
    assert licenses.scan(df.where("false")).count() == 0


def test_license_score_equals_plain_cosine(documents):
    lines = ["Released under the MIT License.", "released under MIT license terms and more words", "the license of this work work"]
    idf = licenses.weights(10, {"the": 9, "license": 2, "this": 5})
    unknown = max(idf.values())
    got = {r.text: r.own_score for r in licenses.own_license(documents(list(enumerate(lines))), idf).collect()}
    for line in lines:
        terms = licenses._terms(line)
        known = {t: terms.count(t) * idf[t] for t in terms if t in idf}
        norm = (sum(v * v for v in known.values()) + unknown ** 2 * sum(t not in idf for t in terms)) ** 0.5
        best = 0.0
        for _, template in licenses.TEMPLATES:
            own = licenses._terms(template)
            values = {t: own.count(t) * idf[t] for t in own}
            best = max(best, sum(values.get(t, 0) * w for t, w in known.items()) / norm / sum(v * v for v in values.values()) ** 0.5)
        assert got[line] == pytest.approx(best if best >= licenses.THRESHOLD else 0.0)


def smith_waterman(a, b):
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = decontaminate.MATCH if x == y else decontaminate.MISMATCH
            rows[i][j] = max(0, rows[i - 1][j - 1] + step, rows[i - 1][j] + decontaminate.GAP, rows[i][j - 1] + decontaminate.GAP)
            best = max(best, rows[i][j])
    return best


def test_alignment_equals_the_plain_recurrence():
    import numpy as np

    rng = random.Random(3)
    for _ in range(100):
        a = np.array([rng.randrange(6) for _ in range(rng.randint(1, 12))], np.uint64)
        b = np.array([rng.randrange(6) for _ in range(rng.randint(1, 25))], np.uint64)
        assert decontaminate.align(a, b)[0] == smith_waterman(a.tolist(), b.tolist())


def test_leaks_are_found_in_edited_copies(documents, spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    items = {i: [word() for _ in range(40)] for i in range(6)}
    noise = lambda n: [rng.choice(["the", "of", word()]) for _ in range(n)]
    edited = list(items[1])
    for i in range(3, 40, 7):
        edited[i] = word()
    del edited[20]
    rows = [(0, " ".join(noise(300))), (1, " ".join(noise(90) + items[0] + noise(9))), (2, " ".join(noise(9) + edited).upper()),
            (3, ", ".join(items[2])), (4, " ".join(items[3][:9])), (5, None), (6, ""), (1, " ".join(items[0])), (None, " ".join(items[4]))]
    rows += [(100 + i, " ".join(noise(30) + items[5])) for i in range(40)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(7, None), (8, "of the"), (None, "x y z")],
                                  "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id) for r in decontaminate.find_leaks(
        documents(rows, item_id="clash", score="clash"), bench).collect())
    assert got == [(-1, 4), (1, 0), (1, 0), (2, 1), (3, 2), *((100 + i, 5) for i in range(40))]
    kept = {r.doc_id for r in decontaminate.keep_clean(documents(rows), bench).collect()}
    # The row without an id holds an item and goes, as every row is judged by its own text.
    assert kept == {0, 4, 5, 6}
    assert decontaminate.find_leaks(documents([]), bench).count() == 0
    assert decontaminate.find_leaks(documents(rows), bench.where("false")).count() == 0
