"""Spelling variants by finite-state composition.

Near words, which differ by one inserted, deleted or replaced code point, are the pairs that
the machine A . E . A accepts: A is the minimised acyclic acceptor of the vocabulary, E the
transducer that copies letters and makes one edit. Its states are pairs of states of A and the
number of edits made; before the edit both sides have read the same letters.

The machine is divided by initial states. A pair of words has its edit behind their common
prefix; let m be the length of the shorter word. A partition holds the pairs whose common prefix
has at least ``lo`` and less than ``hi`` letters: both words then share their first ``lo`` and
their last ``m - hi`` letters, so the words are partitioned by those, and the part between them
is a small vocabulary with an initial state of its own. A partition with more than PARTITION
words is divided at the middle of its range, again and again if need be, until it is small or has
one edit position left (then it has at most as many words as there are pairs of letters). Each
pair of words meets in exactly one partition; each partition adds up what its words find there.

Many partitions share one acceptor in a task. Words are numbered by the acceptor (an arc knows
how many words sort before those behind it), so accepted pairs are pairs of numbers.

Defined results: NULL texts have no words; rows without an id take part, their words are never
changed; equal rows count each; an empty table has no words; words of any length are handled;
columns other than id and text are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, slices, small_or_plain, stage
from .tokens import mix

MIN_LENGTH, MIN_COUNT = 5, 3
#: Of so many words of documents, one loses a letter (the query's stand-in for misspellings).
DROP_ONE_IN = 97
#: Words beyond which a partition is divided, rows a task works on at a time, words it counts at a time.
PARTITION, ROWS, COUNTED = 8192, 60_000, 300_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Maximal runs of a-z and U+00C0 to U+00FF in lower-cased UTF-8.
_RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_BLOCK = ["m", "lo", "hi", "head", "tail"]


def _without_one(run: bytes, number: int) -> bytes:
    letters = run.decode()
    at = number % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(
    df: DataFrame, key: str = "doc_id", text: str = "text", drop_one_in: int | None = DROP_ONE_IN,
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word`` and its number of occurrences ``n`` over all texts, for words long and frequent enough.

    With ``drop_one_in``, a run whose checksum (with its row's id) is divisible by it loses a letter.
    """

    def run(batches):
        total: dict[bytes, int] = {}

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.binary()).cast(pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for i, t in zip(batch.column(key).to_pylist(), byte_texts(batch.column(text)), strict=True):
                counts = Counter(_RUNS.findall(t.translate(_LOWER)))
                start = crc32(f"{i}:".encode())
                for word, n in counts.items():
                    if drop_one_in and i is not None and not (h := crc32(word, start)) % drop_one_in:
                        word = _without_one(word, h)
                    total[word] = total.get(word, 0) + n
                if len(total) >= COUNTED:
                    yield flush()
                    total.clear()
        yield flush()

    found = df.select(key, text).mapInArrow(run, "word string, n long").where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _placed(df: DataFrame) -> DataFrame:
    """Words with m, lo and hi: the letters that their partition shares, and those between."""
    tail = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    size = F.length("word")
    return df.select(
        "m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("head"),
        F.substring("word", size - tail + 1, tail).alias("tail"),
        F.substring("word", F.col("lo") + 1, size - tail - F.col("lo")).alias("mid"), "n")


def _halves(df: DataFrame, *columns: str) -> DataFrame:
    """Every row twice: with the lower and the upper half of its range of edit positions."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    ranges = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
    return df.select(*columns, "m", F.inline(ranges))


def partitions(vocabulary: DataFrame, limit: int = PARTITION) -> DataFrame:
    """Rows (m, lo, hi, head, tail, mid, n) of the partitions of a stored vocabulary, each word once for each of its partitions."""
    size = F.length("word")
    whole = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where("m > 0").select(
        "word", "n", "m", F.lit(0).alias("lo"), (F.col("m") + 1).alias("hi"))
    rows = _placed(_halves(whole, "word", "n"))
    done = None
    while True:
        large = stage(rows.groupBy(*_BLOCK).count().where((F.col("count") > limit) & (F.col("hi") - F.col("lo") > 1))
                      .drop("count"), "spelling-large")
        n = large.count()
        if not n:
            return rows if done is None else done.unionByName(rows)
        known = small_or_plain(large, n, 200)
        small = rows.join(known, _BLOCK, "left_anti").select(*_BLOCK, "mid", "n")
        done = small if done is None else done.unionByName(small)
        divided = rows.join(known, _BLOCK, "left_semi").withColumn("word", F.concat("head", "mid", "tail"))
        rows = stage(_placed(_halves(divided, "word", "n")), "spelling-divided")


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Acceptor:
    """Minimised acyclic acceptor of sorted word lists, one initial state for each list.

    ``owner`` tells the list (0, 1, ..) of every word; words are sorted within their list. Before
    minimisation states are prefixes (``depth``, ``first`` word, ``state`` after minimisation).
    Arcs are sorted by state and letter; ``skip`` is the number of words passed over by an arc.
    """

    def __init__(self, owner: np.ndarray, letters: np.ndarray, lengths: np.ndarray):
        offsets = np.cumsum(lengths) - lengths
        node, alive, depth = owner.copy(), np.arange(len(owner)), 0
        new = np.diff(owner, prepend=-1) != 0
        count = int(new.sum())
        first, depths, levels, ended = [alive[new]], [np.zeros(count, np.int64)], [], []
        while len(alive):
            stop = lengths[alive] == depth
            ended.append(node[alive[stop]])
            alive = alive[~stop]
            if not len(alive):
                break
            source, letter = node[alive], letters[offsets[alive] + depth]
            new = np.ones(len(alive), bool)
            new[1:] = (source[1:] != source[:-1]) | (letter[1:] != letter[:-1])
            node[alive] = count - 1 + np.cumsum(new)
            levels.append((source[new], letter[new].astype(np.int64), node[alive[new]]))
            first.append(alive[new])
            depth += 1
            depths.append(np.full(int(new.sum()), depth))
            count += int(new.sum())
        self.first, self.depth = np.concatenate(first), np.concatenate(depths)
        final = np.zeros(count, bool)
        final[np.concatenate(ended)] = True
        none = (np.zeros(0, np.int64),) * 3
        source, letter, target = (np.concatenate(c) for c in zip(none, *levels, strict=True))
        degree = np.bincount(source, minlength=count)
        start = np.cumsum(degree) - degree
        self.state, kept = self._classes(count, final, levels, degree, start, letter, target)
        # The arcs of the kept prefixes become those of the states.
        self.final, self.degree = final[kept], degree[kept]
        self.start = np.cumsum(self.degree) - self.degree
        arcs = np.repeat(start[kept], self.degree) + _ranges(self.degree)
        self.letter, self.target = letter[arcs], self.state[target[arcs]]
        self.skip = self.first[target[arcs]] - self.first[source[arcs]]
        self.key = np.repeat(np.arange(len(kept)), self.degree) << 21 | self.letter

    @staticmethod
    def _classes(count, final, levels, degree, start, letter, target):
        """States of equal right languages, found by hash from the ends and then compared arc by arc."""
        value = mix(final.astype(np.uint64) + np.uint64(1))
        for source, sign, end in reversed(levels):
            new = np.flatnonzero(np.diff(source, prepend=-1))
            sums = np.add.reduceat(mix(value[end] * np.uint64(0x9E3779B97F4A7C15) + sign.astype(np.uint64)), new)
            value[source[new]] = mix(value[source[new]] + sums)
        _, kept, state = np.unique(value, return_index=True, return_inverse=True)
        same = (final == final[kept[state]]) & (degree == degree[kept[state]])
        if same.all():
            mine = np.repeat(start, degree) + _ranges(degree)
            other = np.repeat(start[kept[state]], degree) + _ranges(degree)
            if (letter[mine] == letter[other]).all() and (state[target[mine]] == state[target[other]]).all():
                return state, kept
        return np.arange(count), np.arange(count)  # two languages with one hash: leave the states apart

    def both(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Common letters of pairs of states: number of the pair, arc of the left, arc of the right state."""
        of = np.repeat(np.arange(len(left)), self.degree[left])
        arc = np.repeat(self.start[left], self.degree[left]) + _ranges(self.degree[left])
        key = right[of] << 21 | self.letter[arc]
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        hit = self.key[at] == key if len(key) else np.zeros(0, bool)
        return of[hit], arc[hit], at[hit]


class Composition:
    """A . E . A after the edit: pairs of states that can still accept, with their steps."""

    def __init__(self, a: Acceptor, left: np.ndarray, right: np.ndarray):
        n = len(a.final)
        pairs = frontier = np.unique(left * n + right)
        steps = []
        while len(frontier):
            of, x, y = a.both(frontier // n, frontier % n)
            steps.append((frontier[of], a.target[x] * n + a.target[y], a.skip[x], a.skip[y]))
            frontier = np.setdiff1d(steps[-1][1], pairs)
            pairs = np.union1d(pairs, frontier)
        none = (np.zeros(0, np.int64),) * 4
        source, target, x, y = (np.concatenate(c) for c in zip(none, *steps, strict=True))
        source, target = np.searchsorted(pairs, source), np.searchsorted(pairs, target)
        self.accepts = a.final[pairs // n] & a.final[pairs % n]
        live, known = self.accepts.copy(), -1
        while known != (known := int(live.sum())):
            live[source[live[target]]] = True
        use = live[target]
        order = np.argsort(source[use], kind="stable")
        self.target, self.x, self.y = target[use][order], x[use][order], y[use][order]
        self.degree = np.bincount(source[use], minlength=len(pairs))
        self.start = np.cumsum(self.degree) - self.degree
        self.pairs, self.live, self.n = pairs, live, n

    def numbers(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of pairs of states, -1 for those that cannot accept."""
        at = np.searchsorted(self.pairs, left * self.n + right)
        return np.where(self.live[at], at, -1) if len(at) else at

    def words(self, state: np.ndarray, x: np.ndarray, y: np.ndarray):
        """Pairs of word numbers accepted from pairs of states that are reached with numbers x and y."""
        while len(state):
            done = self.accepts[state]
            yield x[done], y[done]
            count = self.degree[state]
            arc = np.repeat(self.start[state], count) + _ranges(count)
            x, y = np.repeat(x, count) + self.x[arc], np.repeat(y, count) + self.y[arc]
            state = self.target[arc]


def near_pairs(owner: np.ndarray, letters: np.ndarray, lengths: np.ndarray, span: np.ndarray):
    """Pairs (x, y) of word numbers of one list that one edit at a position below the list's ``span`` tells apart.

    Each pair comes once; x is the shorter word of an insertion.
    """
    a = Acceptor(owner, letters, lengths)
    prefix = np.flatnonzero(a.depth < span[owner[a.first]])
    used = np.unique(a.state[prefix])
    # Replacement: two arcs of one state. Insertion: an arc on one side only, then not the same letter again.
    arcs = np.repeat(a.start[used], a.degree[used]) + _ranges(a.degree[used])
    at = np.repeat(used, a.degree[used])
    later = a.start[at] + a.degree[at] - arcs - 1
    i = np.repeat(arcs, later)
    j = i + 1 + _ranges(later)
    of, x, y = a.both(at, a.target[arcs])
    other = a.letter[x] != a.letter[arcs[of]]
    of, x, y = of[other], x[other], y[other]
    left = np.concatenate([a.target[i], a.target[x]])
    right = np.concatenate([a.target[j], a.target[y]])
    machine = Composition(a, left, right)
    edits = [
        np.concatenate([np.repeat(at, later), at[of]]), machine.numbers(left, right),
        np.concatenate([a.skip[i], a.skip[x]]), np.concatenate([a.skip[j], a.skip[arcs[of]] + a.skip[y]])]
    live = edits[1] >= 0
    order = np.argsort(edits[0][live], kind="stable")
    source, state, x, y = (c[live][order] for c in edits)
    degree = np.bincount(source, minlength=len(a.final))
    start = np.cumsum(degree) - degree
    count = degree[a.state[prefix]]
    edit = np.repeat(start[a.state[prefix]], count) + _ranges(count)
    base = np.repeat(a.first[prefix], count)
    yield from machine.words(state[edit], base + x[edit], base + y[edit])
    # A letter put in at the very end.
    ends = a.final[at] & a.final[a.target[arcs]]
    degree = np.bincount(at[ends], minlength=len(a.final))
    start = np.cumsum(degree) - degree
    count = degree[a.state[prefix]]
    arc = arcs[ends][np.repeat(start[a.state[prefix]], count) + _ranges(count)]
    base = np.repeat(a.first[prefix], count)
    yield base, base + a.skip[arc]


def _found(rows: pa.Table) -> pa.RecordBatch:
    """What the words of whole partitions find in them: number of near words, and the best."""
    m, lo, hi, n = (rows.column(c).to_numpy() for c in ("m", "lo", "hi", "n"))
    heads, tails, mids = (rows.column(c).to_pylist() for c in ("head", "tail", "mid"))
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    for texts in (heads, tails):
        new[1:] |= np.fromiter((a != b for a, b in zip(texts, texts[1:])), bool, len(m) - 1)
    owner = np.cumsum(new) - 1
    lengths = np.fromiter(map(len, mids), np.int64, len(mids))
    letters = np.frombuffer("".join(mids).encode("utf-32-le"), np.uint32)
    words = [a + b + c for a, b, c in zip(heads, mids, tails, strict=True)]
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = sorted(range(len(words)), key=words.__getitem__)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words), 0, -1)
    # More occurrences are better, then the word that sorts first.
    worth = n * (len(words) + 1) + place
    near, best = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for x, y in near_pairs(owner, letters, lengths, (hi - lo)[new].astype(np.int64)):
        # Two words of m + 1 letters have their pair in another partition.
        mine = size[x] == m[x]
        for a, b in ((x[mine], y[mine]), (y[mine], x[mine])):
            near += np.bincount(a, minlength=len(words))
            np.maximum.at(best, a, worth[b])
    hit = np.flatnonzero(near)
    chosen = np.array(order)[len(words) - best[hit] % (len(words) + 1)]
    return pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in hit], pa.string()), pa.array(near[hit]),
        pa.array([words[i] for i in chosen], pa.string()), pa.array(n[chosen])], ["word", "n_near", "best", "best_n"])


def near_words(vocabulary: DataFrame, limit: int = PARTITION) -> DataFrame:
    """Words that have near words: how many, the most frequent one (ties: first in code-point order) and its count."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last partition of a batch may go on in the next one.
            keys = list(zip(*(batch.column(c).to_pylist() for c in _BLOCK), strict=True))
            cut = keys.index(keys[-1])
            held.append(batch.slice(0, cut) if cut else batch)
            if cut and sum(b.num_rows for b in held) >= ROWS:
                yield _found(pa.Table.from_batches(held).combine_chunks())
                held = []
            if cut:
                held.append(batch.slice(cut))
        if held:
            yield _found(pa.Table.from_batches(held).combine_chunks())

    rows = partitions(vocabulary, limit).repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "mid")
    found = rows.mapInArrow(run, "word string, n_near long, best string, best_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    ).select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def _roots(links: DataFrame) -> DataFrame:
    """``word`` and the last word reached from it by following ``form``; pointers double in each round."""
    roots = stage(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while roots.where("moved").limit(1).count():
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(roots.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return roots.drop("moved")


def variants(vocabulary: DataFrame, times: int = 2) -> DataFrame:
    """Words with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    A word's form is its most frequent near word if that has at least ``times`` (2 or more) its occurrences, so forms
    are ever more frequent and following them ends.
    """
    near = vocabulary.join(near_words(vocabulary), "word", "left")
    formed = F.col("best_n") >= times * F.col("n")
    words = stage(near.select(
        "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best_n")).alias("form_n")), "spelling-words")
    roots = _roots(words.where("form is not null"))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per word of the documents, see ``variants``."""
    return variants(stage(word_counts(documents, key), "spelling-vocabulary"))


def spelling_sql() -> str:
    """DuckDB SQL for ``report`` over ``documents``; checksums byte by byte, near words by patterns with one open place."""
    return f"""
    with recursive bits as (
        select b, 0 as k, b::bigint as c from range(256) t(b)
        union all
        select b, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from bits where k < 8),
    crc as (select list(c order by b) as t from bits where k = 8),
    runs as (
        select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
    counted as (select doc_id, run, count(*) as n from runs group by all),
    coded as (
        select run, n, case when doc_id is not null then encode(doc_id || ':' || run) end as bytes from counted),
    hashed as (
        select run, n, case when bytes is not null then xor(list_reduce(
            list_prepend(4294967295::bigint, list_transform(range(octet_length(bytes)),
              lambda i: ('0x' || substr(hex(bytes), 2 * i + 1, 2))::bigint)),
            lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) end as h
        from coded, crc),
    results as (
        select case when h % {DROP_ONE_IN} = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
          else run end as word, n from hashed),
    words as (
        select word, sum(n)::bigint as n from results where length(word) >= {MIN_LENGTH}
        group by word having sum(n) >= {MIN_COUNT}),
    places as (select word, n, unnest(range(length(word))) as i from words),
    open as (select word, n, left(word, i) || '*' || substr(word, i + 2) as pattern from places),
    shorter as (select distinct word, n, left(word, i) || substr(word, i + 2) as pattern from places),
    pairs as (
        select a.word, a.n, b.word as other, b.n as other_n from open a join open b on a.pattern = b.pattern and a.word <> b.word
        union
        select a.word, a.n, b.word, b.n from shorter a join words b on a.pattern = b.word
        union
        select b.word, b.n, a.word, a.n from shorter a join words b on a.pattern = b.word),
    ranked as (
        select word, n, other, other_n, count(*) over (partition by word) as n_near,
          row_number() over (partition by word order by other_n desc, other) as place from pairs),
    formed as (
        select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 2 * w.n then other end as form,
          case when other_n >= 2 * w.n then other_n end as form_n
        from words w left join (select * from ranked where place = 1) r on r.word = w.word),
    walk as (
        select word, word as root, form as next from formed
        union all
        select walk.word, walk.next, f.form from walk join formed f on f.word = walk.next)
    select f.word, f.form, walk.root, f.n, f.n_near, f.form_n from formed f
    join walk on walk.word = f.word and walk.next is null"""
