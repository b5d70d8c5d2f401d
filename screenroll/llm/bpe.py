"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A piece of text is a linked list of byte runs. Every pair of neighbours whose bytes together
are a token goes to the bucket of that token's rank; a bitmap of three levels marks the buckets
that are filled. The next merge is found by find-first-set on each level, a bucket gives its
leftmost position, and entries whose pair has changed meanwhile are skipped. The cost of a merge
does not depend on the length of the piece, so pieces of megabytes are no special case.

Each match of the split pattern is encoded separately, without special tokens. Encoding is a
narrow pass over the rows: nothing is shuffled. The ranks (a fixed-size file, read once on the
driver) travel with the function.

Defined results: a NULL text counts as empty and gives no ids; equal rows give equal ids; an
empty table gives an empty result; other columns pass through, except columns named like the
result, which are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import islice
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, slices

#: Pieces whose ids a worker remembers; a speed-up only, every other piece is merged anew.
REMEMBERED = 450_000
#: Pieces merged together, and characters beyond which a text is split piece by piece.
HELD_PIECES = 200_000
#: Bytes of new pieces, beside the last one, that share one queue at a time.
MERGED_BYTES = 1 << 18
LONG_TEXT = 1_000_000
#: Links of a slot between pieces and of a run that was taken over.
CLOSED, GONE = 1 << 60, -1


def _plain_split(pattern: str) -> re.Pattern | None:
    """The same pattern for the faster built-in engine, valid for texts within the basic plane.

    Its character classes become the ranges that the other engine finds; None if there are others.
    """
    plane = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    ranges = {}
    for name in (r"\p{L}", r"\p{N}", r"\s", r"\S"):
        runs = regex.findall(f"{name}+", plane)
        # The gap of the surrogates is no part of any text.
        ranges[name] = "".join(rf"\u{ord(r[0]):04x}-\u{ord(r[-1]):04x}" for r in runs)
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((n for n in ranges if pattern.startswith(n, at)), None)
        if name:
            out.append(ranges[name] if inside else f"[{ranges[name]}]")
            at += len(name)
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return re.compile("".join(out))


class RankQueue:
    """Positions by rank; ``first`` gives the smallest rank that has any."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, *positions: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.extend(positions)
            return
        self.buckets[rank] = [*positions]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def first(self) -> int | None:
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        return b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1

    def drop(self, rank: int) -> None:
        """Forget the bucket of a rank."""
        del self.buckets[rank]
        b, a = rank >> 6, rank >> 12
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)


def _ranks(rank_file: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in rank_file.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Decoder:
    """The bytes of all tokens of a rank file in one table; all that a worker needs to decode."""

    def __init__(self, rank_file: bytes, pattern: str):
        tokens = {rank: token for token, rank in _ranks(rank_file).items()}
        self.size = max(tokens) + 1
        width = np.zeros(self.size, np.int64)
        width[list(tokens)] = [len(t) for t in tokens.values()]
        self.width, self.place = width, np.cumsum(width) - width
        self.bytes = np.frombuffer(b"".join(tokens.get(r, b"") for r in range(self.size)), np.uint8)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of all tokens, gathered from one table."""
        ids, parts = np.frombuffer(packed, "<u4"), []
        for start in range(0, len(ids), LONG_TEXT // 4):
            own = ids[start:start + LONG_TEXT // 4].astype(np.int64)
            width = self.width[own]
            ends = np.cumsum(width)
            parts.append(self.bytes[np.repeat(self.place[own] - ends + width, width) + np.arange(ends[-1])].tobytes())
        return b"".join(parts)


class Codec(Decoder):
    """Encoder and decoder for the ranks of a rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__(rank_file, pattern)
        self.ranks = _ranks(rank_file)
        self.longest = max(map(len, self.ranks))
        self.widths = self.width.tolist()
        self.packed = {token: pack("<I", rank) for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks.get(bytes([b]), 0) for b in range(256)])
        self.byte_pairs = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
        self.split, self.plain_split = regex.compile(pattern), _plain_split(pattern)
        self.queue = RankQueue(self.size)  # empty again after every piece
        self.known: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece; one queue serves all of them, a closed slot stands after each."""
        data = b"\0".join(pieces) + b"\0"
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        closed = np.cumsum(lengths + 1) - 1
        starts = closed - lengths
        slots = np.frombuffer(data, np.uint8)
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        after[closed], before[starts] = CLOSED, -1
        token = self.single[slots]
        token[closed] = GONE
        after, before, token = after.tolist(), before.tolist(), token.tolist()
        queue, buckets, push = self.queue, self.queue.buckets, self.queue.push
        ranks, longest, widths = self.ranks.get, self.longest, self.widths
        self._push_byte_pairs(slots, closed)
        while (rank := queue.first()) is not None:
            bucket, width, lower = buckets[rank], widths[rank], False
            bucket.sort(reverse=True)
            while bucket and not lower:
                p = bucket.pop()
                q = after[p]
                # Stale: the run at p was taken over, or its pair is another one by now.
                if q < 0 or q == CLOSED or after[q] - p != width:
                    continue
                end = after[p] = after[q]
                before[end] = p
                token[p] = rank
                after[q] = token[q] = GONE
                far, left = after[end], before[p]
                if far - p <= longest:
                    found = ranks(data[p:far])
                    if found is not None:
                        lower = found < rank
                        if found in buckets:
                            buckets[found].append(p)
                        else:
                            push(found, p)
                if left >= 0 and end - left <= longest:
                    found = ranks(data[left:end])
                    if found is not None:
                        lower = lower or found < rank
                        if found in buckets:
                            buckets[found].append(left)
                        else:
                            push(found, left)
            if not bucket:
                queue.drop(rank)
        ids = np.array(token)
        alive = ids != GONE
        ends = np.cumsum(alive)
        packed = ids[alive].astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], ends[closed]])).tolist()
        return [packed[i:j] for i, j in zip(cuts, cuts[1:])]

    def _push_byte_pairs(self, data: np.ndarray, closed: np.ndarray) -> None:
        """Fill the queue with all pairs of single bytes that are tokens."""
        rank = self.byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        rank[closed[:-1]] = -1
        rank[closed - 1] = -1
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank[at])) + 1
        for group in np.split(at, cuts):
            if len(group):
                self.queue.push(int(rank[group[0]]), *group.tolist())

    def pieces(self, text: str):
        """Lists of the pieces of a text, in order; one list unless the text is very long."""
        # Two bytes a character in UTF-16 say that none is beyond the basic plane.
        plain = len(text) <= LONG_TEXT and len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        if len(text) <= LONG_TEXT:
            yield (self.plain_split if plain and self.plain_split else self.split).findall(text)
            return
        found = (m.group() for m in self.split.finditer(text))
        while chunk := list(islice(found, LONG_TEXT // 8)):
            yield chunk

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, packed as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, count = [], 0
        for i, text in enumerate(texts):
            for chunk in self.pieces(text):
                held.append((i, chunk))
                count += len(chunk)
                if count >= HELD_PIECES:
                    self._flush(held, out)
                    held, count = [], 0
        self._flush(held, out)
        return [b"".join(parts) for parts in out]

    def _flush(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        known, used = self.known, set()
        for _, chunk in held:
            used.update(chunk)
        fresh = list(used.difference(known))
        if len(known) + len(fresh) > REMEMBERED:
            # Frequent pieces are most likely among the present ones.
            self.known = known = {p: known[p] for p in used if p in known}
        plain = [(p, p.encode()) for p in fresh]
        known.update((p, self.packed[b]) for p, b in plain if b in self.packed)
        plain = [(p, b) for p, b in plain if b not in self.packed]
        start = size = 0
        for i, (_, b) in enumerate(plain):
            size += len(b)
            if size >= MERGED_BYTES or i + 1 == len(plain):
                group = plain[start:i + 1]
                known.update(zip((p for p, _ in group), self.merge([b for _, b in group]), strict=True))
                start, size = i + 1, 0
        for i, chunk in held:
            out[i].append(b"".join(map(known.__getitem__, chunk)))


def codec(rank_file: bytes, pattern: str, kind: type[Decoder] = Codec) -> Decoder:
    """The worker's codec for a rank file, built once per process while no other operator uses it."""
    key = kind, hashlib.sha256(rank_file + pattern.encode()).digest()
    return held(key, lambda: kind(rank_file, pattern))


def _added(df: DataFrame, source: str, names: tuple[str, ...], make) -> DataFrame:
    """``df`` with binary columns made from another column, slice by slice."""
    rest = df.drop(*(n for n in names if n != source))
    schema = rest.withColumns({n: F.lit(b"") for n in names}).schema

    def run(batches):
        for batch in slices(batches, holds=True):
            made = [pa.array(values, pa.binary()) for values in make(batch.column(source))]
            columns = {n: batch.column(n) for n in batch.schema.names} | dict(zip(names, made, strict=True))
            yield pa.RecordBatch.from_arrays([columns[f] for f in schema.names], schema.names)

    return rest.mapInArrow(run, schema)


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the packed ids of its texts."""
    rank_file = Path(rank_path).read_bytes()
    return _added(df, text, (ids,), lambda column: [codec(rank_file, pattern).encode(
        [t or "" for t in column.to_pylist()])])


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its packed ids stand for; NULL ids give no bytes."""
    rank_file = Path(rank_path).read_bytes()
    return _added(df, ids, (decoded,), lambda column: [[
        codec(rank_file, pattern, Decoder).decode(b or b"") for b in column.to_pylist()]])


def round_trip(df: DataFrame, rank_path: str, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``df`` with the packed ids of its texts and the bytes that these decode to, by one worker per task."""
    rank_file = Path(rank_path).read_bytes()

    def make(column):
        own = codec(rank_file, pattern)
        packed = own.encode([t or "" for t in column.to_pylist()])
        return packed, [own.decode(b) for b in packed]

    return _added(df, text, (ids, decoded), make)


def report(df: DataFrame, rank_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: number and digest of the ids, digest of what they decode to."""
    return round_trip(df.select(key, "text"), rank_path, pattern).select(
        key,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
