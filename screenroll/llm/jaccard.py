"""N-gram Jaccard join with skipping by set relations, and the components of its links.

Sets are the distinct n-word shingles of a text. Equal sets become one class. Classes are joined
over index lists: for each of the first elements of a set (in one global order, rare ones first)
its list holds size and position of the set. Index-level skipping: lists are cut into blocks by
size, and blocks or entries whose sizes or positions rule a link out are skipped. Answer-level
skipping: a list first compares its sets with one hub; sets that are linked to the hub are
answered, the pairs among them need no comparison of their own. Pairs of sets that are similar to
one hub but lie in different components are answered from their small differences to it, without
their texts. Pairs of different components without a common hub are compared one by one, as far as
bitmaps of the sets, which never differ more than the sets, leave a link possible. So a
group of thousands of near copies costs comparisons in proportion to its size, and no link between
different components is lost.

All steps are shuffles of numbers; texts travel only for sets that are compared. The order of
elements comes from a bounded sample; it affects speed alone.

Defined results: NULL and empty texts have the empty set, which is linked with nothing and is its
own component; a text with fewer words than a shingle has its whole sequence as one; rows with
equal texts are linked; a row without an id belongs to a component but never names it (a component
without any id has NULL); repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, slices, small_or_plain, stage
from .components import components
from .tokens import ngram_hashes, word_hashes

N = 3
LINK, OF = 90, 100
SAMPLE, FREQUENT, AT_LEAST = 8000, 200_000, 3
LIST_BLOCK = 4096
#: Sets with at least so many tenths in common count as similar; members of a hub compared at once.
NEAR, MEMBERS = 7, 1024
#: Least width of a bitmap.
BITS = 1024


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least Jaccard similarity ``link / of`` of linked sets."""

    n: int = N
    link: int = LINK
    of: int = OF

    def __post_init__(self):
        # Linked sets must count as similar, or members of one hub would miss links.
        if not NEAR * self.of <= 10 * self.link <= 10 * self.of:
            raise ValueError(f"similarity {self.link}/{self.of} is not between {NEAR}/10 and 1")


RULE = Rule()


def shingle_set(text: bytes, n: int = N) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    if len(words) < n:
        return ngram_hashes(words, len(words), seed=n + 1 + len(words))
    return np.unique(ngram_hashes(words, n))


def bitmap(elements: np.ndarray) -> np.ndarray:
    """A bit map in which every element turns one bit over, as 64-bit numbers.

    Two maps of one width differ in no more bits than the sets differ in elements. Large sets have
    wider maps; the halves of a map, one turned over by the other, are the map of half the width.
    """
    width = max(BITS, 1 << int(2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements >> np.uint64(24) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_length(n: int, link: int = LINK, of: int = OF) -> int:
    """Elements of which linked sets must share one, whatever the order."""
    return n - -(-link * n // of) + 1


def frequent_tokens(df: DataFrame, text: str = "text", rule: Rule = RULE) -> np.ndarray:
    """Hashes of shingles that are frequent in a bounded sample of rows, most frequent last."""
    total = df.count()
    share = min(1.0, SAMPLE / max(total, 1))
    rows = df.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select(text)

    def run(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, rule.n) for t in byte_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["token"])

    found = rows.mapInArrow(run, "token long").groupBy("token").count().where(F.col("count") >= AT_LEAST)
    top = found.orderBy(F.desc("count"), "token").limit(FREQUENT).select("token").collect()
    return np.array([r[0] for r in reversed(top)], np.int64).view(np.uint64)


class Order:
    """The global order: rare elements by hash, then frequent ones by how often they occur."""

    def __init__(self, frequent: np.ndarray):
        by_hash = np.argsort(frequent)
        self.hashes, self.places = frequent[by_hash], by_hash.astype(np.uint64)

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """Sorted order keys of a set."""
        out = elements >> np.uint64(1)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, elements), len(self.hashes) - 1)
            hit = self.hashes[at] == elements
            out[hit] = self.places[at[hit]] | np.uint64(1 << 63)
        out.sort()
        return out


def set_table(df: DataFrame, order: Order, key: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """Per row: id, set size, name of the set (NULL if empty) and its first order keys."""

    def run(batches):
        for batch in slices(batches):
            sizes, names, firsts, maps = [], [], [], []
            for t in byte_texts(batch.column(text)):
                elements = shingle_set(t, rule.n)
                n = len(elements)
                sizes.append(n)
                maps.append(bitmap(elements))
                names.append(xxhash.xxh3_128_digest(elements.tobytes()) if n else None)
                length = prefix_length(n, rule.link, rule.of) if n else 0
                firsts.append(order.keys(elements)[:length].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(maps, pa.list_(pa.int64())), batch.column("text_hash")],
                ["doc_id", "n", "set", "first", "bits", "text_hash"])

    own = df.select(F.col(key).cast("long").alias(key), text, F.xxhash64(text).alias("text_hash"))
    return own.mapInArrow(run, "doc_id long, n long, set binary, first array<long>, bits array<long>, text_hash long")


def _can(n, at, m, to, rule: Rule) -> np.ndarray:
    """Whether sets of sizes n, m that share the elements at these positions can be linked."""
    need = -(-rule.link * (n + m) // (rule.of + rule.link))
    return (np.minimum(n, m) * rule.of >= np.maximum(n, m) * rule.link) & (1 + np.minimum(n - at - 1, m - to - 1) >= need)


def index_lists(rows: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Lists of the elements that several classes share, in blocks of bounded size.

    Entries stand by size. An entry that no other of its block can be linked with by size and
    position is left out, unless a neighbouring block of its list reaches it.
    """
    postings = rows.where(F.col("set").isNotNull()).select(
        F.posexplode("first").alias("at", "token"), F.col("n").cast("int").alias("n"), "set"
    ).select("token", "n", F.col("at").cast("int").alias("at"), "set")

    def packed(held, part, opened):
        n, at = (np.array([h[i] for h in held], np.int64) for i in (1, 2))
        keep = np.ones(len(held), bool)
        if not opened:
            hub = int(np.lexsort((n, at))[0])
            keep = _can(n, at, n[hub], at[hub], rule)
            keep[hub] = keep.sum() > 1
            for i in np.flatnonzero(~keep):
                others = _can(n, at, n[i], at[i], rule)
                others[i] = False
                keep[i] = others.any()
        chosen = np.flatnonzero(keep)
        if len(chosen) < 2 and not opened:
            return
        yield pa.RecordBatch.from_arrays(
            [pa.array([held[0][0]], pa.int64()), pa.array([part], pa.int64()), pa.array([opened]),
             pa.array([n[chosen]], pa.list_(pa.int64())), pa.array([at[chosen]], pa.list_(pa.int64())),
             pa.array([[held[i][3] for i in chosen]], pa.list_(pa.binary()))],
            ["token", "part", "opened", "n", "at", "sets"])

    def run(batches):
        # Lists at the edges of a partition may go on in another one and stay open, like cut ones.
        held, opened, part = [], True, TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("token", "n", "at", "set")), strict=True):
                if held and row == held[-1]:
                    continue
                if held and row[0] != held[0][0]:
                    if opened or len(held) > 1:
                        yield from packed(held, part, opened)
                    held, opened, part = [], False, part + 1
                elif len(held) == LIST_BLOCK:
                    yield from packed(held, part, True)
                    held, opened, part = [], True, part + 1
                held.append(row)
        if held:
            yield from packed(held, part, True)

    order = ["token", "n", "set", "at"]
    return postings.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "token long, part long, opened boolean, n array<long>, at array<long>, sets array<binary>")


_PAIR = "a binary, b binary"


def _pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def hub_pairs(lists: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Each block's hub (the set whose element comes first) with every set that it can be linked with."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, at, sets = np.array(row["n"]), np.array(row["at"]), row["sets"]
                hub = int(np.lexsort((n, at))[0])
                can = _can(n, at, n[hub], at[hub], rule)
                can[hub] = False
                if can.any():
                    yield _pair_batch([(sets[hub], sets[i]) for i in np.flatnonzero(can)])

    return lists.mapInArrow(run, _PAIR).distinct()


def _folded(bits: np.ndarray) -> np.ndarray:
    half = len(bits) // 2
    return bits[:half] ^ bits[half:]


class Maps:
    """Bitmaps of the entries of a list, side by side for each width that two of them can have in common."""

    def __init__(self, bits: list[np.ndarray]):
        self.width = np.array([len(b) for b in bits])
        self.rows, self.maps = {}, {}
        for w in np.unique(self.width).tolist():
            own, wider = np.flatnonzero(self.width == w), np.flatnonzero(self.width == 2 * w)
            self.rows[w] = np.full(len(bits), -1)
            self.rows[w][np.concatenate([own, wider])] = np.arange(len(own) + len(wider))
            self.maps[w] = np.stack([bits[k] for k in own] + [_folded(bits[k]) for k in wider])

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """Least number of elements in which entry ``i`` differs from others; none where widths are too far apart."""
        out = np.zeros(len(others), np.int64)
        common = np.minimum(self.width[others], self.width[i])
        for w in np.unique(common).tolist():
            at, rows = np.flatnonzero(common == w), self.rows[w]
            at = at[(rows[others[at]] >= 0) & (rows[i] >= 0)]
            both = self.maps[w][rows[others[at]]] ^ self.maps[w][rows[i]]
            out[at] = np.bitwise_count(both).sum(axis=1)
        return out


def cross_pairs(lists: DataFrame, roots: DataFrame, classes: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Pairs of a list that can be linked by size, position and bitmaps and are not answered yet.

    Answered are pairs in one component and pairs with one hub (``roots`` has both for the sets
    that have them). Blocks of one list are paired where their sizes reach each other. Bitmaps
    travel only to the blocks that hold sets of several components, or are parts of longer lists.
    """
    # A closed list of two sets has no pair that its hub was not compared with.
    lists = lists.where(F.col("opened") | (F.size("sets") > 2))
    entries = lists.select("token", "part", "opened", F.explode(F.arrays_zip("n", "at", "sets")).alias("e")).select(
        "token", "part", "opened", F.col("e.n").alias("n"), F.col("e.at").alias("at"), F.col("e.sets").alias("set"))
    placed = stage(entries.join(roots, "set", "left").select(
        "token", "part", "opened", "n", "at", "set", F.coalesce("root", "set").alias("root"), "hub"), "jaccard-entries")
    mixed = stage(placed.groupBy("token", "part").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.max("opened").alias("cut")
    ).where("cut or low != high").select("token", "part"), "jaccard-mixed")
    held = placed.join(small_or_plain(mixed, mixed.count(), 48), ["token", "part"], "left_semi")
    known = held.join(classes.select("set", "bits"), "set").select(
        "token", "part", "opened", F.struct("n", "at", "set", "root", "hub", "bits").alias("e"))
    blocks = known.groupBy("token", "part", "opened").agg(
        F.collect_list("e").alias("e"), F.min("e.n").alias("low"), F.max("e.n").alias("high"),
        F.min("e.root").alias("first"), F.max("e.root").alias("last"))
    alone = blocks.where(F.col("first") != F.col("last")).select("token", F.col("e").alias("x"), F.lit(None).cast(
        blocks.schema["e"].dataType).alias("y"))
    cut = blocks.where("opened")
    left = cut.select("token", F.col("part").alias("p"), F.col("e").alias("x"), "high",
                      F.col("low").alias("least"), F.col("first").alias("f"), F.col("last").alias("l"))
    right = cut.select("token", "part", F.col("e").alias("y"), "low",
                       F.col("high").alias("upper"), "first", "last")
    across = left.join(right, "token").where(
        (F.col("p") < F.col("part")) & (F.col("high") * rule.of >= F.col("low") * rule.link)
        & (F.col("upper") * rule.of >= F.col("least") * rule.link)
        & ((F.col("f") != F.col("l")) | (F.col("first") != F.col("last")) | (F.col("f") != F.col("first")))
    ).select("token", "x", "y")

    def arrays(entries):
        return (np.array([e["n"] for e in entries]), np.array([e["at"] for e in entries]),
                [e["set"] for e in entries], np.unique([e["root"] for e in entries], return_inverse=True)[1],
                [e["hub"] or e["set"] for e in entries], Maps([np.array(e["bits"], np.int64) for e in entries]))

    def run(batches):
        for batch in slices(batches, 64):
            for row in batch.to_pylist():
                x = row["x"] if row["y"] is None else row["x"] + row["y"]
                first = len(row["x"])
                n, at, sets, root, hubs, maps = arrays(x)
                hub = np.unique(hubs, return_inverse=True)[1]
                out = []
                for i in range(len(x)):
                    stop = i if row["y"] is None else first
                    if row["y"] is not None and i < first or not stop:
                        continue
                    j = slice(0, stop)
                    can = (root[j] != root[i]) & (hub[j] != hub[i]) & _can(n[j], at[j], n[i], at[i], rule)
                    can = np.flatnonzero(can)
                    most = (n[can] + n[i] - maps.differ(i, can)) / 2
                    can = can[most * rule.of >= (n[can] + n[i] - most) * rule.link]
                    out += [(sets[k], sets[i]) for k in can]
                if out:
                    yield _pair_batch(out)

    return alone.unionByName(across).select("x", "y").mapInArrow(run, _PAIR).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def compare(pairs: DataFrame, texts: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Exact sizes and overlap of pairs of sets, with the differences of similar ones.

    ``missing`` holds the places of the elements of ``a`` that ``b`` lacks, ``extra`` the elements of
    ``b`` that ``a`` lacks. ``texts`` has one text per set.
    """

    def run(batches):
        last, hub = None, None
        for batch in slices(batches):
            a, b = batch.column("a"), batch.column("b")
            overlap, n, m, missing, extra = [], [], [], [], []
            for name, x, y in zip(a.to_pylist(), byte_texts(batch.column("x")), byte_texts(batch.column("y")), strict=True):
                if name != last:
                    last, hub = name, shingle_set(x, rule.n)
                other = shingle_set(y, rule.n)
                common, at, its = np.intersect1d(hub, other, assume_unique=True, return_indices=True)
                overlap.append(len(common))
                n.append(len(hub))
                m.append(len(other))
                near = len(common) * 10 >= NEAR * max(len(hub), len(other))
                missing.append(np.delete(np.arange(len(hub), dtype=np.int32), at) if near else None)
                extra.append(np.delete(other, its).view(np.int64) if near else None)
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(overlap, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                 pa.array(missing, pa.list_(pa.int32())), pa.array(extra, pa.list_(pa.int64()))],
                ["a", "b", "overlap", "n", "m", "missing", "extra"])

    both = pairs.join(texts.select(F.col("set").alias("b"), F.col("text").alias("y")), "b").join(
        texts.select(F.col("set").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(
        run, "a binary, b binary, overlap long, n long, m long, missing array<int>, extra array<long>").withColumn(
        "linked", F.col("overlap") * rule.of >= (F.col("n") + F.col("m") - F.col("overlap")) * rule.link)


def hub_members(compared: DataFrame) -> DataFrame:
    """Every set that is similar to a hub, with one hub: of several the one with most such sets."""
    near = compared.where(F.col("missing").isNotNull())
    popular = near.groupBy("a").agg(F.count("*").alias("members"))
    own = near.groupBy("a").agg(F.first("n").alias("size")).select(
        "a", F.col("a").alias("set"), "size", F.col("size").alias("n"),
        F.array().cast("array<int>").alias("missing"), F.array().cast("array<long>").alias("extra"))
    every = near.select("a", F.col("b").alias("set"), F.col("n").alias("size"), F.col("m").alias("n"), "missing", "extra")
    ranked = every.unionByName(own).join(popular, "a").groupBy("set").agg(
        F.max_by(F.struct("a", "size", "n", "missing", "extra"), F.struct("members", "a")).alias("h"))
    return ranked.select("set", F.col("h.a").alias("hub"), "h.size", "h.n", "h.missing", "h.extra")


def member_links(members: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Links between members of one hub that lie in different components, one per pair of components.

    The overlap of two members follows from their differences to the hub:
    |x & y| = |h| - |missing of x or y| + |extra of x and y|, for blocks of members by matrix products.
    Hubs with many members are dealt out in pairs of blocks.
    """
    mixed = members.groupBy("hub").agg(
        F.count("*").alias("count"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    blocks = F.ceil(F.col("count") / MEMBERS).cast("int")
    block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    dealt = members.join(mixed.select("hub", blocks.alias("blocks")), "hub").withColumn("own", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def linked(rows):
        n = np.array([r["n"] for r in rows])
        lacking = np.zeros((len(rows), rows[0]["size"]), np.float32)
        for line, r in zip(lacking, rows, strict=True):
            line[r["missing"]] = 1
        extra = np.concatenate([np.array(r["extra"], np.int64) for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(r["extra"]) for r in rows])
        values, slot, times = np.unique(extra, return_inverse=True, return_counts=True)
        shared = times[slot] > 1
        names, slot = np.unique(slot[shared], return_inverse=True)
        having = np.zeros((len(rows), len(names)), np.float32)
        having[owner[shared], slot] = 1
        lacks = lacking.sum(1)
        either = lacks[:, None] + lacks - lacking @ lacking.T
        overlap = np.rint(rows[0]["size"] - either + having @ having.T).astype(np.int64)
        root = np.unique([r["root"] for r in rows], return_inverse=True)[1]
        hit = (overlap * rule.of >= (n[:, None] + n - overlap) * rule.link) & (root[:, None] < root)
        x, y = np.nonzero(hit)
        first = np.unique(root[x] * (root.max() + 1) + root[y], return_index=True)[1]
        return [(rows[a]["set"], rows[b]["set"]) for a, b in zip(x[first], y[first], strict=True)]

    def run(batches):
        held: list[dict] = []
        for batch in slices(batches):
            for row in batch.to_pylist():
                if held and any(row[c] != held[0][c] for c in ("hub", "i", "j")):
                    if links := linked(held):
                        yield _pair_batch(links)
                    held = []
                held.append(row)
        if held and (links := linked(held)):
            yield _pair_batch(links)

    unit = ["hub", "i", "j"]
    return dealt.select(*unit, "set", "root", "size", "n", "missing", "extra").repartition(
        *unit).sortWithinPartitions(*unit).mapInArrow(run, _PAIR)


def plausible(pairs: DataFrame, classes: DataFrame, near: bool, rule: Rule = RULE) -> DataFrame:
    """The pairs that may be linked (or, with ``near``, similar) by the difference of their bitmaps."""
    side = lambda c: classes.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    width = F.least(F.size("bits_a"), F.size("bits_b"))

    def folded(bits: str):
        halves = F.zip_with(F.slice(bits, F.lit(1), width), F.slice(bits, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) == width, F.col(bits)).otherwise(halves)

    differ = F.aggregate(
        F.zip_with(folded("bits_a"), folded("bits_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda n, x: n + x)
    # Widths further apart than a fold are of sets that are not similar.
    both = both.where(F.greatest(F.size("bits_a"), F.size("bits_b")) <= 2 * width)
    total = F.col("n_a") + F.col("n_b")
    most = (total - differ) / 2
    if near:
        can = most * 10 >= F.greatest("n_a", "n_b") * NEAR
    else:
        can = most * rule.of >= (total - most) * rule.link
    return stage(both.where(can).select("a", "b"), "jaccard-plausible")


def _texts_of(df: DataFrame, classes: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """One text for every set in ``pairs``."""
    sets = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    wanted = stage(sets.join(classes, "set").select("set", "doc_id", "text_hash"), "jaccard-wanted")
    own = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))
    near = small_or_plain(wanted, wanted.count(), 80)
    same = own["doc_id"].eqNullSafe(near["doc_id"]) & (own["text_hash"] == near["text_hash"])
    # Repeated rows of the chosen document give its text once.
    return stage(own.join(near, same).select(near["set"], own["text"]).dropDuplicates(["set"]), "jaccard-texts")


def _compared(df: DataFrame, classes: DataFrame, pairs: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    return stage(compare(pairs, _texts_of(df, classes, pairs, key, text), rule), "jaccard-compared")


def join_components(df: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """Per row: doc_id, n_shingles (set size), component_id (smallest id reachable by links)."""
    rows = stage(set_table(df, Order(frequent_tokens(df, text, rule)), key, text, rule), "jaccard-sets")
    classes = stage(
        rows.where(F.col("set").isNotNull()).groupBy("set")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("c"), F.first("n").alias("n"),
             F.first("bits").alias("bits"))
        .select("set", "c.doc_id", "c.text_hash", "n", "bits"), "jaccard-classes")
    lists = stage(index_lists(rows, rule), "jaccard-index")
    pairs = stage(hub_pairs(lists, rule), "jaccard-pairs")
    first = _compared(df, classes, plausible(pairs, classes, True, rule), key, text, rule)
    linked = first.where("linked").select("a", "b")
    members = stage(hub_members(first), "jaccard-members")
    roots = components(linked).withColumnRenamed("node", "set")
    members = stage(members.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "jaccard-members")
    derived = member_links(members, rule)
    known = members.select("set", "root", "hub").unionByName(
        roots.join(members, "set", "left_anti").withColumn("hub", F.lit(None).cast("binary")))
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stage(cross_pairs(lists, known, classes, rule).join(done, ["a", "b"], "left_anti"), "jaccard-pairs")
    crossed = _compared(df, classes, plausible(rest, classes, False, rule), key, text, rule)
    more = crossed.where("linked").select("a", "b").unionByName(derived)
    whole = components(linked.unionByName(more)).withColumnRenamed("node", "set").join(classes.select("set", "doc_id"), "set")
    named = whole.groupBy("root").agg(F.min("doc_id").alias("component"))
    of_set = whole.select("set", "root").join(named, "root").select("set", "component")
    of_class = classes.join(of_set, "set", "left").select("set", F.coalesce("component", "doc_id").alias("component"))
    return rows.select("doc_id", "n", "set").join(of_class, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """The rows of ``df`` whose document is the first of its component, or has no id."""
    found = join_components(df, key, text, rule)
    gone = stage(found.where("doc_id != component_id").select("doc_id").distinct(), "jaccard-gone")
    return df.join(small_or_plain(gone, gone.count(), 16).withColumnRenamed("doc_id", "_gone"),
                   F.col(key).cast("long") == F.col("_gone"), "left_anti")


def jaccard_sql() -> str:
    """The same rows as a DuckDB statement, by brute force over shared shingles."""
    return f"""
      with recursive w as (
        select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
      s as (select rid, doc_id, case when len(w) = 0 then [] when len(w) < {N} then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        end as s from w),
      u as (select rid, len(s) as n, unnest(s) as g from s),
      l as (select a.rid as a, b.rid as b from u a join u b on a.g = b.g and a.rid <> b.rid
        and least(a.n, b.n) * {OF} >= greatest(a.n, b.n) * {LINK}
        group by a.rid, b.rid, a.n, b.n having count(*) * {OF} >= (a.n + b.n - count(*)) * {LINK}),
      r(a, b) as (select rid, rid from s union select r.a, l.b from r join l on r.b = l.a)
      select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(t.doc_id) as component_id
      from s join r on s.rid = r.a join s t on t.rid = r.b group by s.rid, s.doc_id, s.s"""
