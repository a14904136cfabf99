"""SentencePiece encoding and decoding in batches of words.

A text's words are encoded once each. Words of equal length advance together through one
Viterbi pass: at each end position every start within the longest piece is tried for all words
at once, substring hashes are looked up among the sorted hashes of pieces of that length, and a
vectorised maximum over the candidates' scores stores the back pointer.

For unigram models a candidate's score is the best score before it plus its piece's. For BPE
models, whose segmentation is no maximum of summed scores, it is 0 if piece and predecessor
agree and minus infinity otherwise: two neighbours agree if merging their joint text gives just
these two. A segmentation is the model's own exactly if all its neighbours agree, and each
prefix has one last piece for which they do, so the maximum is unique and exact. Whether two
agree is read from tables of merges, for many pairs at once, by taking both apart along their
border in the reverse order of merging.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, tidied

#: Words that a worker remembers; characters that advance together; from this length on words are filled up to a power of two, so that different lengths do.
KEEP, BATCH, FILLED = 600_000, 1_000_000, 64
SPACE = "▁"
#: Bytes of text that are encoded together.
SLICE = 12_000_000
_LOOSE = re.compile(r"\A | (?= |\Z)")
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: After a word's end; no character.
_FILL = 0x110000
#: Leaves the leading bits of a hash, by which most that are not there are told at once.
_TOP = np.uint64(48)
_ODD, _PAIR_BITS = 0x1E3779B97F4A7C15, (1 << 19) - 1


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    h = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        h[:, j + 1] = h[:, j] * _BASE + codes[:, j] + np.uint64(1)
    return h


class Pieces:
    """The pieces of a model file, and batched encoding and decoding with them."""

    def __init__(self, path: str | None = None, blob: bytes | None = None) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(blob if blob is not None else open(path, "rb").read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models without normalisation of characters and spaces")
        self.unigram = model.trainer_spec.model_type == 1
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.size = len(model.pieces)
        self.ids, self.scores = {}, np.zeros(self.size, np.float32)  # the library adds in this precision
        self.text, self.bytes, self.unknown, self.fallback = [""] * self.size, [b""] * self.size, 0, {}
        for i, p in enumerate(model.pieces):
            self.scores[i] = p.score
            if p.type == 2:
                self.unknown, self.bytes[i] = i, " ⁇ ".encode()
            elif p.type == 6:
                b = int(p.piece[3:5], 16)
                self.fallback[b], self.bytes[i] = i, bytes([b])
            elif p.type in (1, 4):
                self.ids[p.piece], self.text[i], self.bytes[i] = i, p.piece, p.piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids), default=1)
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        usable = self.ids
        if not self.unigram:
            usable = self._merges()
        self.keys, self.of_key, self.codes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((0, 0), np.uint32)]
        for k in range(1, self.longest + 1):
            own = [(p, i) for p, i in usable.items() if len(p) == k]
            codes = np.array([[ord(c) for c in p] for p, _ in own], np.uint32).reshape(len(own), k)
            h = _prefix_hashes(codes.astype(np.uint64))[:, -1]
            order = np.argsort(h)
            self.keys.append(h[order])
            self.of_key.append(np.array([i for _, i in own], np.int64)[order])
            self.codes.append(codes[order])
        self.maybe = [np.bincount((h >> _TOP).astype(np.int64), minlength=1 << 16) > 0 for h in self.keys]
        self._kept: dict[str, bytes] = {}
        lens = np.array(list(map(len, self.bytes)), np.int64)
        self._at, self._len = np.concatenate([[0], np.cumsum(lens)]), lens
        self._flat = np.frombuffer(b"".join(self.bytes), np.uint8)

    def _merges(self) -> dict[str, int]:
        """Fills the tables of merges; returns the pieces that merging can give, as others are never candidates."""
        wide = self.size + _FILL
        order = np.argsort(-self.scores, kind="stable")
        self.rank = np.full(wide, -1, np.int64)  # single characters come before all merges
        self.left, self.right = np.arange(wide), np.arange(wide)
        code = lambda c: self.ids.get(c, self.size + ord(c))
        place = np.empty(self.size, np.int64)
        place[order] = np.arange(self.size)
        usable, pairs, merged = {}, [], []
        for p, i in self.ids.items():
            if len(p) == 1:
                usable[p] = i
                continue
            self.rank[i] = place[i]
            for at in range(1, len(p)):
                a, b = p[:at], p[at:]
                if (a in self.ids or at == 1) and (b in self.ids or at == len(p) - 1):
                    pairs.append((code(a) if at == 1 else self.ids[a]) * wide + (code(b) if at == len(p) - 1 else self.ids[b]))
                    merged.append(place[i])
            parts, last = self.merge(p)
            if len(parts) == 1:
                usable[p] = i
                self.left[i], self.right[i] = (code(x) if len(x) == 1 else self.ids[x] for x in last)
        pairs = np.array(pairs, np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], np.array(merged, np.int64)[order]
        self.maybe_pair = np.bincount(pairs * _ODD >> 44 & _PAIR_BITS, minlength=_PAIR_BITS + 1) > 0
        return usable

    def merge(self, word: str) -> tuple[list[str], tuple[str, str]]:
        """The word's parts after merging the best-scored neighbours, leftmost first, until none is a piece; and the two that were merged last."""
        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []
        last = ("", "")

        def add(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (k := self.ids.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-self.scores[k], i, j, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            add(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            last = (parts[i], parts[j])
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            add(before[i], i)
            add(i, after[i])
        return [p for p in parts if p is not None], last

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, side by side, are what merging makes of their joint text.

        They are unless some merge over the border comes before one that made what lies at it.
        So the later-made of both is taken apart, and what is left at the border is looked up
        as a pair that may merge before it; of equal ranks the one on the left is first.
        """
        wide = self.size + _FILL
        out, at = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), np.iinfo(np.int64).max)
        while len(at):
            keys, bad = a * wide + b, np.zeros(len(at), bool)
            some = np.flatnonzero(self.maybe_pair[keys * _ODD >> 44 & _PAIR_BITS])
            k = np.minimum(np.searchsorted(self.pairs, keys[some]), max(len(self.pairs) - 1, 0))
            bad[some] = (self.pairs[k] == keys[some]) & (self.pair_rank[k] < limit[some]) if len(self.pairs) else False
            out[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            go = ~bad & ((ra >= 0) | (rb >= 0))  # two characters have nothing to be taken apart
            a, b = np.where(first, self.right[a], a)[go], np.where(first, b, self.left[b])[go]
            at, limit = at[go], limit[go]
        return out

    def viterbi(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of n words, given as code points in rows filled up to one length, all words' in a row, and each word's number; unknown characters as size + code point."""
        n, length = codes.shape
        h, unk = _prefix_hashes(codes.astype(np.uint64)), (self.scores.min() if self.size else 0.0) - 10
        best = np.full((n, length + 1), -np.inf, np.float32)
        best[:, 0] = 0
        last, back = np.full((n, length + 1), -1, np.int64), np.zeros((n, length + 1), np.int32)
        for j in range(1, length + 1):
            for k in range(min(j, self.longest), 0, -1):
                keys = self.keys[k]
                on = np.isfinite(best[:, j - k]) & (ends >= j)
                sub = h[:, j] - h[:, j - k] * self.powers[k]
                rows = np.flatnonzero(self.maybe[k][(sub >> _TOP).astype(np.int64)] & on)  # few substrings of a word are pieces
                at = np.minimum(np.searchsorted(keys, sub[rows]), max(len(keys) - 1, 0))
                hit = np.flatnonzero(keys[at] == sub[rows]) if len(keys) else np.zeros(0, np.int64)
                rows, at = rows[hit], at[hit]
                same = (self.codes[k][at] == codes[rows, j - k : j]).all(1)  # equal hashes, equal texts
                rows, t = rows[same], self.of_key[k][at[same]]
                if k == 1:
                    unknown = on.copy()
                    unknown[rows] = False
                    other = np.flatnonzero(unknown)
                    rows, t = np.concatenate([rows, other]), np.concatenate([t, self.size + codes[other, j - 1].astype(np.int64)])
                if not len(rows):
                    continue
                if self.unigram:
                    score = best[rows, j - k] + np.where(t < self.size, self.scores[np.minimum(t, self.size - 1)], np.float32(unk))
                elif j == k:
                    score = np.zeros(len(rows))
                else:
                    score = np.where(self.agree(last[rows, j - k], t), 0.0, -np.inf)
                better = score > best[rows, j]
                rows, t = rows[better], t[better]
                best[rows, j], last[rows, j], back[rows, j] = score[better], t, j - k
        rows, at, steps = np.arange(n), ends.copy(), []
        while len(rows):
            steps.append((rows, last[rows, at]))
            at = back[rows, at]
            rows, at = rows[at > 0], at[at > 0]
        row, found = (np.concatenate([x[k] for x in steps[::-1]]) for k in (0, 1))
        order = np.argsort(row, kind="stable")
        return found[order], np.bincount(row, minlength=n)

    def _finish(self, parts: list[int]) -> list[int]:
        """Unknown characters as bytes, or as one unknown piece for each run of them."""
        out: list[int] = []
        for t in parts:
            if t < self.size:
                out.append(t)
            elif self.fallback:
                out += [self.fallback[b] for b in chr(t - self.size).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown or not self.unigram:
                out.append(self.unknown)
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian uint32."""
        found: list[bytes | None] = [self._kept.get(w) for w in words]
        todo: dict[int, list[int]] = {}
        for i, x in enumerate(found):
            if x is None:
                n = len(words[i])
                todo.setdefault(n if n < FILLED else 1 << (n - 1).bit_length(), []).append(i)
        for length, own in todo.items():
            step = max(1, BATCH // max(length, 1))
            for lo in range(0, len(own), step):
                part = own[lo : lo + step]
                if length:
                    codes = np.frombuffer("".join(words[i].ljust(length, chr(0)) for i in part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length)
                    ends = np.array([len(words[i]) for i in part])
                    codes = np.where(np.arange(length)[None, :] < ends[:, None], codes, np.uint32(_FILL))
                    flat, n = self.viterbi(codes, ends)
                else:
                    flat, n = np.zeros(0, np.int64), np.zeros(len(part), np.int64)
                data, to = flat.astype("<u4").tobytes(), np.cumsum(n)
                for i, a, b in zip(part, (4 * (to - n)).tolist(), (4 * to).tolist()):
                    found[i] = data[a:b]
                strange = np.unique(np.searchsorted(to, np.flatnonzero(flat >= self.size), "right"))  # words with unknown characters
                for k in strange.tolist():
                    found[part[k]] = np.array(self._finish(flat[to[k] - n[k] : to[k]].tolist()), "<u4").tobytes()
                if len(self._kept) < KEEP:
                    self._kept.update((words[i], found[i]) for i in part)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and each text's number of ids."""
        if not self.prefix:
            raise ValueError("only models that put a space before a text")
        plain = texts.to_pylist()
        loose = {i: _UNIT.findall(SPACE + t.replace(" ", SPACE)) for i, t in enumerate(plain) if SPACE in t or _LOOSE.search(t)}
        split = pc.split_pattern(pc.if_else(pa.array([i in loose for i in range(len(plain))], pa.bool_()), "", texts), " ")
        coded = split.flatten().dictionary_encode()
        names = [SPACE + w for w in coded.dictionary.to_pylist()]
        extra = sorted({u for units in loose.values() for u in units})
        place = {u: len(names) + k for k, u in enumerate(extra)}
        ids = self.words(names + extra)
        lens, flat = np.fromiter((len(b) // 4 for b in ids), np.int64, len(ids)), np.frombuffer(b"".join(ids), "<u4")
        at = np.concatenate([[0], np.cumsum(lens)])
        code, bounds = coded.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()
        empty = np.array([not t for t in plain], bool)
        if loose or empty.any():
            rows = [np.array([place[u] for u in loose[i]], np.int64) if i in loose else code[bounds[i] : bounds[i] if empty[i] else bounds[i + 1]] for i in range(len(plain))]
            code, bounds = np.concatenate([*rows, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum(list(map(len, rows)))])
        total = np.concatenate([[0], np.cumsum(lens[code])])
        out = flat[np.repeat(at[code] - total[:-1], lens[code]) + np.arange(total[-1])]
        return out, total[bounds[1:]] - total[bounds[:-1]]

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts, as UTF-8, of ids in a row, ``counts`` ids each."""
        lens = self._len[flat]
        total = np.concatenate([[0], np.cumsum(lens)])
        data = self._flat[np.repeat(self._at[flat] - total[:-1], lens) + np.arange(total[-1])].tobytes()
        ends = total[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b][1:] if self.prefix and data[a : a + 1] == b" " else data[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_decode(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, decoded, round_trip[, ids]) for every row's whole text.

    ids_crc32 is of the ids as little-endian uint32; decoded is the text that the ids stand for;
    round_trip tells whether it is the text itself. Null texts count as empty and have no ids;
    repeated rows and a null doc_id are kept; other columns are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("decoded", pa.string()), ("round_trip", pa.bool_())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pieces(model)
        for batch in batches:
            for b in slices(batch, SLICE):
                texts = pc.fill_null(b.column("text"), "")
                flat, counts = tok.encode(texts)
                back = tok.decode(flat, counts)
                ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
                same = [d == t.encode() for d, t in zip(back, texts.to_pylist())]
                crc = [zlib.crc32(flat[x:y].astype("<u4").tobytes()) for x, y in zip(ends, ends[1:])]
                cols = [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), pa.array([d.decode("utf-8", "replace") for d in back], pa.string()), pa.array(same, pa.bool_())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(tidied(run), "doc_id long, n_ids long, ids_crc32 long, decoded string, round_trip boolean" + ", ids array<int>" * with_ids)
