"""Token sequences of bounded length, packed by exact complements and best fit."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, tidied
from .staging import stage

#: Word encodings that a worker keeps.
KEEP = 150_000
#: A space that the pattern below would not attach to what follows it.
_LOOSE = re.compile(r" (?=\s|\Z)")


class Encoder:
    """A byte-level BPE vocabulary (tokenizers' JSON), applied to each distinct space-led word once.

    The vocabulary's ids are its merge order, so a rank engine gives the library's own ids;
    tests compare the two. A space before a non-space always starts a token, so a text
    falls apart there; texts with other spaces, which are rare, are encoded whole. Texts that
    hold one of the vocabulary's added tokens are left to the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN

        file = json.load(open(path, encoding="utf-8"))
        vocab, added = file["model"]["vocab"], file.get("added_tokens", [])
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        special = {x["id"] for x in added}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in vocab.items() if i not in special}
        self._engine = tiktoken.Encoding("siftworks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._path, self._library = path, None
        self._added = re.compile("|".join(re.escape(x["content"]) for x in added)) if added else None
        self._kept: dict[str, bytes] = {}

    def _whole(self, text: str) -> list[int]:
        """The library's own ids of a text."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        return self._library.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> bytes:
        ids = array("I", self._engine.encode_ordinary(word)).tobytes()
        if len(self._kept) < KEEP:
            self._kept[word] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, as uint32, and each text's number of ids."""
        loose: dict[int, list[int]] = {}
        for i, t in enumerate(texts.to_pylist()):
            if self._added is not None and self._added.search(t):
                loose[i] = self._whole(t)
            elif _LOOSE.search(t):
                loose[i] = self._engine.encode_ordinary(t)
        if loose:
            texts = pc.if_else(pa.array([i in loose for i in range(len(texts))]), "", texts)
        words = pc.split_pattern(texts, " ")
        bounds = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        code[bounds[:-1]] += size  # the first word of a text has no space before it
        used = np.zeros(2 * size, bool)
        used[code] = True
        where = np.flatnonzero(used)
        names, kept = coded.dictionary.to_pylist(), self._kept
        units = [names[k - size] if k >= size else " " + names[k] for k in where.tolist()]
        ids = [kept.get(u) or self._word(u) for u in units]
        lens, flat = np.fromiter((len(b) // 4 for b in ids), np.int32, len(ids)), np.frombuffer(b"".join(ids), np.uint32)
        at = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(lens, out=at[1:])
        place = np.empty(2 * size, np.int32)
        place[where] = np.arange(len(where), dtype=np.int32)
        code = place[code]
        n = lens[code]
        total = np.zeros(len(code) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        out = flat[np.repeat((at[code] - total[:-1]).astype(np.int32), n) + np.arange(total[-1], dtype=np.int32)]
        counts = total[bounds[1:]] - total[bounds[:-1]]
        if loose:
            parts = np.split(out, np.cumsum(counts)[:-1])
            for i, x in loose.items():
                parts[i] = np.array(x, np.uint32)
            out, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return out, counts


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of n ids: one, or full ones after a first that may be shorter."""
    return [n] if n <= capacity else [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Every document's ids, ``end`` after them, as pieces of at most ``capacity`` ids; with_ids adds the ids themselves."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(tokenizer)
        for batch in batches:
            for b in slices(batch):
                flat, counts = tok.encode(pc.fill_null(b.column("text"), ""))
                rows, at = [], 0
                for doc, n in zip(b.column("doc_id").to_pylist(), counts.tolist()):
                    ids = np.append(flat[at : at + n], np.uint32(end)).astype("<u4")
                    at, start = at + n, 0
                    for k, size in enumerate(cuts(n + 1, capacity)):
                        part = ids[start : start + size]
                        rows.append((doc, k, start, size, zlib.crc32(part.tobytes()), *[part.astype(np.int32)] * with_ids))
                        start += size
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(tidied(run), PIECE + ", ids array<int>" * with_ids)


class Complements:
    """Index of sums of one, two and three lengths over the counts of pieces that are left.

    For each sum it holds the largest first member that may still complete it. Counts only
    fall, so a combination that has run out never comes back, and each entry only moves down:
    all lookups together cost at most the number of pairs of lengths. What the sequence being
    filled uses itself (``own``) is looked past without moving an entry.
    """

    def __init__(self, left: np.ndarray) -> None:
        n = len(left)
        self.left = left.tolist()
        self.pair, self.triple = [s - 1 for s in range(n)], [s - 2 for s in range(n)]

    def take(self, parts: tuple[int, ...], times: int) -> None:
        for x in parts:
            self.left[x] -= times

    def _free(self, x: int, own: dict[int, int], n: int = 1) -> bool:
        return self.left[x] - own.get(x, 0) >= n

    def two(self, total: int, own: dict[int, int]) -> tuple[int, int] | None:
        """The pair of this sum with the largest first member."""
        left, a = self.left, self.pair[total]
        while 2 * a >= total and not (left[a] > 0 and left[total - a] > (a + a == total)):
            a -= 1
        self.pair[total] = a
        while 2 * a >= total > a:
            if self._free(a, own, 1 + (a + a == total)) and self._free(total - a, own):
                return a, total - a
            a -= 1
        return None

    def three(self, total: int, own: dict[int, int]) -> tuple[int, int, int] | None:
        """A triple of this sum, first members from the largest down."""
        left, a = self.left, self.triple[total]
        while 3 * a >= total and not (left[a] > 0 and self.two(total - a, {})):
            a -= 1
        self.triple[total] = a
        while 3 * a >= total > a > 0:
            if self._free(a, own) and (rest := self.two(total - a, own | {a: own.get(a, 0) + 1})):
                return a, *rest
            a -= 1
        return None

    def exact(self, gap: int, own: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap exactly."""
        return (gap,) if self._free(gap, own) else self.two(gap, own) or self.three(gap, own)

    def fit(self, gap: int, own: dict[int, int]) -> int:
        """The longest that fits, 0 for none."""
        return next((x for x in range(gap, 0, -1) if self._free(x, own)), 0)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences are filled by each, for counts of pieces by length.

    Longest first. A gap is filled exactly by one length, else a pair, else a triple that is
    still available, looked up by their sums; else by the longest that fits, and the rest of
    the gap again. A pattern is used as often as its lengths last, so the work depends on the
    number of distinct lengths, not of pieces.
    """
    index = Complements(counts.astype(np.int64))
    runs: list[tuple[tuple[int, ...], int]] = []
    for longest in range(capacity, 0, -1):
        while index.left[longest] > 0:
            parts, gap = [longest], capacity - longest
            while gap > 0:
                own = {x: parts.count(x) for x in parts}
                found = index.exact(gap, own) or ((fit,) if (fit := index.fit(gap, own)) else ())
                if not found:
                    break
                parts += found
                gap -= sum(found)
            times = min(index.left[x] // parts.count(x) for x in set(parts))
            index.take(tuple(parts), times)
            runs.append((tuple(parts), times))
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    The counts by length (``capacity`` rows at most) give the plan. Pieces are ranked by
    length over a range partitioning, which splits any length however frequent, and a piece's
    rank tells its sequence and place: the plan is a sorted list of rank intervals. Null texts
    count as empty and give one piece, the end id; repeated rows are packed each; an empty
    table gives an empty result; other columns of ``docs`` are not looked at.
    """
    cut = stage(pieces(docs, tokenizer, capacity, end, with_ids), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        counts[length] = n
    before = np.concatenate([[0], np.cumsum(counts)])
    used, slots, base = np.zeros(capacity + 1, np.int64), [(0, 0, 0)], 0
    for parts, times in plan(counts, capacity):
        at = 0
        for x in parts:
            slots.append((int(before[x] + used[x]), base, at))
            used[x] += times
            at += x
        base += times
    lows, bases, offsets = np.array(sorted(slots[1:] or slots), np.int64).T

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            more = [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(at, at + b.num_rows))]
            yield pa.RecordBatch.from_arrays(b.columns + more, [*b.schema.names, "part", "place"])
            at += b.num_rows

    order = ["length", "doc_id", "piece"]
    fields = PIECE + ", ids array<int>" * with_ids
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = cut.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(tidied(number), fields + ", part int, place long")
    ranked = stage(ranked, "ranked")
    first, total = {}, 0
    for part, rows in sorted(ranked.groupBy("part").count().collect()):
        first[part], total = total, total + rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rank = np.array([first[p] for p in b.column("part").to_pylist()], np.int64) + b.column("place").to_numpy()
                k = np.searchsorted(lows, rank, "right") - 1
                b = b.drop_columns(["part", "place"])
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(bases[k] + rank - lows[k]), pa.array(offsets[k])], [*b.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(tidied(assign), fields + ", sequence_id long, offset long")
