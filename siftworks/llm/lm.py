"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

A word's hash gives its cell, LEVELS digits of BITS bits. Each digit has a softmax over WIDTH
values: the first digit is the word's class, each further one a class within those before it.
Its logits are a bias, from the training counts of the cells, and the weights of two hashed
features: the word before, and the two before, each together with the digits so far. The first
digit also has the second word before alone (a skip). Words of one cell share its probability by
their smoothed counts in the training texts, so the probabilities of all known words and one
unknown word of each cell add up to one.

Texts are dealt by a hash into shards of about SHARD bytes, and sorted there. Training goes in
ROUNDS: in each, every shard makes gradient steps (AdaGrad) over its own part of the round, from
weights that are the mean of all shards' after the round before. So weights and scores depend on
the rows only, not on how a table is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices, tidied, tidy
from .staging import stage

LEVELS, BITS = 4, 3
WIDTH, CELLS = 1 << BITS, 1 << LEVELS * BITS
#: Features of each digit: 0 the word before, 1 the two before, 2 the second before.
FEATURES = ((0, 1, 2), *((0, 1) for _ in range(LEVELS - 1)))
TABLES = [(level, k) for level in range(LEVELS) for k in FEATURES[level]]
#: Rows of a feature's table are as many as a power of two that grows with the corpus, within these.
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 14
#: Bytes of text for each row, in a shard, and in a part of it that is worked on together.
ROW_BYTES, SHARD, PART = 64, 24_000_000, 4_000_000
#: Averaging rounds, tokens in a gradient step, its rate.
ROUNDS, STEP, RATE = 2, 8192, 0.4
END = xxhash.xxh64_intdigest(b"\n")
_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_ONES = np.ones(WIDTH, np.float32)
_RECORD = np.dtype((np.void, 4 * WIDTH))


@dataclass
class Tokens:
    """Words' hashes, each text's followed by END."""

    hashes: np.ndarray  # of distinct words; END is the last
    code: np.ndarray  # of each token, an index into hashes
    ends: np.ndarray  # the token after each text's last


def tokens(texts: pa.Array) -> Tokens:
    """Lower-cased (A-Z) words between bytes 0x20 and 0x09 to 0x0D; null counts as empty."""
    clean = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(clean)
    flat = split.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # an empty text gives one empty word
    seen = np.concatenate([[0], np.cumsum(full)])
    bounds = seen[split.offsets.to_numpy()]
    coded = (flat if full.all() else flat.filter(pa.array(full))).dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    n = bounds[1:] - bounds[:-1] + 1
    ends = np.cumsum(n)
    code = np.full(int(n.sum()), len(names), np.int32)
    inner = np.ones(len(code), bool)
    inner[ends - 1] = False
    code[inner] = coded.indices.to_numpy()
    return Tokens(np.append(hashes, np.uint64(END)), code, ends)


def cell_of(h: np.ndarray) -> np.ndarray:
    """The cells of words by their hash."""
    return (h >> np.uint64(7)).astype(np.int64) & (CELLS - 1)


def biases(mass: np.ndarray) -> list[np.ndarray]:
    """Log-probabilities of each digit after those before it, from the cells' masses (all positive)."""
    out = []
    for level in range(LEVELS):
        x = mass.reshape(WIDTH ** (level + 1), -1).sum(1).reshape(-1, WIDTH)
        out.append(np.log(x / x.sum(1, keepdims=True)).astype(np.float32))
    return out


def contexts(h: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> list[np.ndarray]:
    """Hashes of the features of tokens lo to hi: the word before, both before, the second before; nothing before a text's first word."""
    x = np.concatenate([np.zeros(max(0, 2 - lo), np.uint64), h[max(0, lo - 2) : hi]])
    one, two, first = x[1:-1].copy(), x[:-2].copy(), starts[lo:hi]
    one[first] = 0
    two[first] = 0
    two[1:][first[:-1]] = 0
    if lo and starts[lo - 1]:
        two[0] = 0
    return [one * _SALT[0] + np.uint64(1), one * _SALT[1] + two * _SALT[2] + np.uint64(1), two * _SALT[3] + np.uint64(1)]


class Model:
    """Tables of weights and, under training, of their summed squared gradients."""

    def __init__(self, rows: int, bias: list[np.ndarray], w: np.ndarray | None = None, squares: np.ndarray | None = None) -> None:
        self.shift, self.bias = np.uint64(64 - (rows.bit_length() - 1)), bias
        self.w = np.zeros((len(TABLES), rows, WIDTH), np.float32) if w is None else w
        self.squares = np.ones((len(TABLES), rows), np.float32) if squares is None else squares

    def steps(self, h: np.ndarray, starts: np.ndarray, use: np.ndarray | None = None) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
        """For each step and digit: where it is (lo, hi), the digit, probabilities, token numbers, true values and the rows of its tables."""
        for lo in range(0, len(h), STEP):
            hi = min(lo + STEP, len(h))
            on = None if use is None else use[lo:hi]
            if on is not None and not on.any():
                continue
            ctx, cell = contexts(h, starts, lo, hi), cell_of(h[lo:hi])
            if on is not None and not on.all():
                ctx, cell = [c[on] for c in ctx], cell[on]
            at, table = np.arange(len(cell)), 0
            for level in range(LEVELS):
                before = cell >> BITS * (LEVELS - level)
                salt = (before + WIDTH**level).astype(np.uint64) * _SALT[2]
                rows = []
                for k in FEATURES[level]:
                    rows.append((table, (((ctx[k] ^ salt) * _SALT[1]) >> self.shift).astype(np.uint16)))
                    table += 1
                p = np.take(self.bias[level], before, axis=0)
                for t, r in rows:
                    p += np.take(self.w[t], r, axis=0)
                np.exp(p, out=p)  # logits stay small: AdaGrad bounds the weights' growth
                p /= (p @ _ONES)[:, None]
                yield lo, hi, level, p, at, (cell >> BITS * (LEVELS - level - 1)) & (WIDTH - 1), rows

    def learn(self, h: np.ndarray, starts: np.ndarray, use: np.ndarray) -> None:
        """Gradient steps over the tokens that ``use`` marks."""
        for _, _, _, g, at, true, rows in self.steps(h, starts, use):
            g[at, true] -= 1
            for t, r in rows:
                self._update(t, r, g)

    def _update(self, t: int, r: np.ndarray, g: np.ndarray) -> None:
        order = np.argsort(r, kind="stable")
        own = r[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        n = np.diff(np.append(first, len(r)))
        total = np.take(g, order[first], axis=0)
        if (many := n > 1).any():  # most rows of a step have one token
            size = n[many]
            total[many] = np.add.reduceat(np.take(g, order[np.repeat(many, n)], axis=0), np.cumsum(size) - size)
        own = own[first]
        squares = np.take(self.squares[t], own) + np.einsum("ij,ij->i", total, total) / 2
        self.squares[t][own] = squares
        total *= (RATE / np.sqrt(squares))[:, None]
        self.w[t].view(_RECORD).ravel()[own] = (np.take(self.w[t], own, axis=0) - total).view(_RECORD).ravel()

    def log_probs(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token's cell."""
        out = np.ones(len(h))
        for lo, hi, _, p, at, true, _ in self.steps(h, starts):
            out[lo:hi] *= p[at, true]
        return np.log10(out)


def _starts(ends: np.ndarray) -> np.ndarray:
    out = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    out[np.concatenate([[0], ends[:-1]])[: len(ends)]] = True
    return out


def held_out(fold: int = 7, at: int = 2) -> Column:
    """Whether crc32 of doc_id as text leaves ``at``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold == at, F.lit(False))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_CODED = "shard long, doc_ids array<long>, held array<boolean>, ends array<binary>, codes array<binary>, hashes binary, n binary"
_CODED_ARROW = pa.schema([("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("ends", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary())), ("hashes", pa.binary()), ("n", pa.binary())])


class _Shard:
    """A shard's texts as codes into its own words, in parts, compressed."""

    def __init__(self) -> None:
        self.hashes, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sorted, self.of_sorted = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.doc_ids: list[int | None] = []
        self.held: list[bool] = []
        self.ends: list[bytes] = []
        self.codes: list[bytes] = []

    def add(self, b: pa.RecordBatch) -> None:
        t = tokens(b.column("text"))
        at = np.searchsorted(self.sorted, t.hashes)
        known = np.zeros(len(t.hashes), bool) if not len(self.sorted) else self.sorted[np.minimum(at, len(self.sorted) - 1)] == t.hashes
        code = np.empty(len(t.hashes), np.int32)
        code[known] = self.of_sorted[at[known]]
        new = t.hashes[~known]
        code[~known] = np.arange(len(self.hashes), len(self.hashes) + len(new))
        self.hashes = np.concatenate([self.hashes, new])
        order = np.argsort(new)
        place = np.searchsorted(self.sorted, new[order])
        self.sorted, self.of_sorted = np.insert(self.sorted, place, new[order]), np.insert(self.of_sorted, place, code[~known][order])
        on = ~b.column("held_out").to_numpy(zero_copy_only=False)
        use = np.repeat(on, np.diff(np.concatenate([[0], t.ends])))
        n = np.zeros(len(self.hashes), np.int64)
        n[: len(self.n)] = self.n
        np.add.at(n, code, np.bincount(t.code[use], minlength=len(t.hashes)))
        self.n = n
        self.doc_ids += b.column("doc_id").to_pylist()
        self.held += (~on).tolist()
        self.ends.append(t.ends.astype(np.int64).tobytes())
        self.codes.append(pa.compress(code[t.code].astype(np.int32).tobytes(), codec="zstd", asbytes=True))

    def row(self, shard: int) -> pa.RecordBatch:
        values = (shard, self.doc_ids, self.held, self.ends, self.codes, self.hashes.tobytes(), self.n.astype(np.int64).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CODED_ARROW)], schema=_CODED_ARROW)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch, sorted by shard, in pieces of one shard."""
    key = batch.column("shard").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    yield from (batch.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:]) if hi > lo)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard of (shard, doc_id, held_out, text), whose rows come together."""
    at, own = None, _Shard()
    for run in (run for b in batches for run in _runs(b)):
        key = run.column("shard")[0].as_py()
        if key != at:
            if at is not None:
                yield own.row(at)
            at, own = key, _Shard()
            tidy()
        for b in slices(run, PART):
            own.add(b)
    if at is not None:
        yield own.row(at)


def _pack(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Counts (shard, i, c) of each shard as few rows of bytes."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        held.clear()
        shard, i, c = (t.column(k).to_numpy() for k in ("shard", "i", "c"))
        order = np.argsort(shard, kind="stable")
        shard, i, c = shard[order], i[order].astype(np.int32), c[order].astype(np.int64)
        first = np.flatnonzero(np.diff(shard, prepend=-1))
        ends = np.append(first[1:], len(shard))
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(shard[first]), cut(i), cut(c)], ["shard", "at", "c"])

    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= most:
            yield out()
    if held:
        yield out()


def _parts(b: dict, i: int, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, slice]]:
    """Of a shard's row: codes, hashes, ends and the texts of each part."""
    at = 0
    for packed, ends in zip(b["codes"][i], b["ends"][i]):
        ends = np.frombuffer(ends, np.int64)
        code = np.frombuffer(pa.decompress(packed, decompressed_size=4 * int(ends[-1]), codec="zstd", asbytes=True), np.int32)
        yield code, hashes[code], ends, slice(at, at + len(ends))
        at += len(ends)


def score(docs: DataFrame, test: Column | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row's whole text.

    Texts that ``test`` marks are kept out of the training. Each text is tokenised once: a
    shard becomes one row of codes into its own words. Every (shard, word) is one row of a
    table partitioned by word, where training counts are summed and given back to the shards,
    so a word's rows are as many as shards that hold it. The driver holds the weights, 9 tables
    of MOST_ROWS rows at most, and the sums by cell. Null texts count as empty and consist of an
    end; repeated rows are counted each; an empty table gives an empty result; other columns
    are not looked at.
    """
    test = held_out() if test is None else test
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), test.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = kept.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards = max(1, -(-size // SHARD))
    rows = 1 << int(np.clip(size // ROW_BYTES, LEAST_ROWS, MOST_ROWS)).bit_length() - 1

    mix = F.xxhash64("doc_id", "text")
    dealt = kept.withColumns({"shard": F.pmod(mix, F.lit(shards)).cast("long"), "_mix": F.xxhash64("text", "doc_id")})
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "_mix", "doc_id").select("shard", "doc_id", "held_out", "text")
    coded = stage(dealt.mapInArrow(tidied(_encode), _CODED), "coded")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, hashes, n in zip(*(c.to_pylist() for c in b.columns)):
                h, n = np.frombuffer(hashes, np.int64), np.frombuffer(n, np.int64)
                for at in range(0, len(h), 100_000):
                    own = slice(at, at + 100_000)
                    k = len(h[own])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard)), pa.array(np.arange(at, at + k, dtype=np.int32)), pa.array(h[own]), pa.array(n[own])], ["shard", "i", "h", "n"])

    by_word = Window.partitionBy("h")
    one = coded.select("shard", "hashes", "n").mapInArrow(tidied(words), "shard long, i int, h long, n long")
    one = one.select("shard", "i", "h", F.sum("n").over(by_word).alias("c"), F.min("shard").over(by_word).alias("least"))
    spot = F.when(F.col("shard") == F.col("least"), F.shiftrightunsigned("h", 7).bitwiseAND(CELLS - 1).cast("int"))
    counts = stage(one.select("shard", "i", "c", spot.alias("cell")), "counts")
    total, kinds = np.zeros(CELLS), np.zeros(CELLS)
    for k, n, v in counts.where("cell is not null and c > 0").groupBy("cell").agg(F.sum("c"), F.count("*")).collect():
        total[k], kinds[k] = n, v
    within, all_tokens = np.log10(total + kinds + 1), int(total.sum())
    below = float(np.log10(total.sum() + kinds.sum() + 1))
    bias = biases(total + 1)
    w, squares = _train(coded, rows, bias)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's counts come first, then its texts."""
        model, n = Model(rows, bias, w, squares), np.zeros(0, np.int64)
        for batch in (run for b in batches for run in _runs(b)):
            counted = batch.filter(pc.is_valid(batch.column("at")))
            for at, c in zip(counted.column("at").to_pylist(), counted.column("c").to_pylist()):
                at = np.frombuffer(at, np.int32)
                if at.max() >= len(n):
                    n = np.concatenate([n, np.zeros(max(int(at.max()) + 1 - len(n), len(n)), np.int64)])
                n[at] = np.frombuffer(c, np.int64)
            texts = batch.filter(pc.is_null(batch.column("at")))
            for k in range(texts.num_rows):
                b = texts.slice(k, 1).to_pydict()
                hashes = np.frombuffer(b["hashes"][0], np.uint64)
                n = n[: len(hashes)]
                up, known = np.log10(n + 1.0), (n > 0).astype(np.int64)
                share = up - within[cell_of(hashes)]
                for code, h, ends, own in _parts(b, 0, hashes):
                    first = np.concatenate([[0], ends[:-1]])
                    sums = lambda x: np.add.reduceat(x, first)
                    size = ends - first
                    cols = [pa.array(b["doc_ids"][0][own], pa.int64()), pa.array(b["held"][0][own], pa.bool_()), pa.array(size), pa.array(sums(known[code])), pa.array(sums(up[code]) - size * below), pa.array(sums(model.log_probs(h, _starts(ends)) + share[code]))]
                    yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in SCORES.split(", ")])
                n = np.zeros(0, np.int64)
                tidy()

    fields = ["doc_ids", "held", "ends", "codes", "hashes"]
    none = [F.lit(None).cast(dict(coded.dtypes)[c]).alias(c) for c in fields]
    packed = counts.select("shard", "i", "c").mapInArrow(tidied(_pack), "shard long, at binary, c binary")
    both = packed.select("shard", "at", "c", *none).union(coded.select("shard", F.lit(None).cast("binary"), F.lit(None).cast("binary"), *fields))
    both = both.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", F.col("at").isNull()).select("shard", "at", "c", *fields)
    scored = both.mapInArrow(tidied(judge), SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(all_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _train(coded: DataFrame, rows: int, bias: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and mean squares after all rounds: each row's weights are the shards' mean, weighted by their gradients' squares."""
    w, squares = np.zeros((len(TABLES), rows, WIDTH), np.float32), np.ones((len(TABLES), rows), np.float32)
    for turn in range(ROUNDS):
        start_w, start_squares = w, squares

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    b = batch.slice(k, 1).to_pydict()
                    model, hashes = Model(rows, bias, start_w.copy(), start_squares.copy()), np.frombuffer(b["hashes"][0], np.uint64)
                    held = np.array(b["held"][0], bool)
                    for part, (_, h, ends, own) in enumerate(_parts(b, 0, hashes)):
                        if part % ROUNDS == turn:
                            use = np.repeat(~held[own], np.diff(np.concatenate([[0], ends])))
                            model.learn(h, _starts(ends), use)
                    gain = (model.squares - start_squares).ravel()
                    at = np.flatnonzero(gain > 0)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(model.w.reshape(-1, WIDTH)[at].ravel()), WIDTH).cast(pa.list_(pa.float32()))
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(gain[at]), lists], ["key", "s", "w"])

        found = coded.select("shard", "held", "ends", "codes", "hashes").mapInArrow(tidied(learn), "key long, s float, w array<float>")
        means = [(F.sum(F.col("s").cast("double") * F.get("w", i)) / F.sum(F.col("s").cast("double"))).cast("float").alias(f"w{i}") for i in range(WIDTH)]
        got = found.groupBy("key").agg(*means, F.avg(F.col("s").cast("double")).cast("float").alias("s")).toArrow()
        w, squares = w.copy(), squares.copy()
        if got.num_rows:
            at = got.column("key").to_numpy()
            w.reshape(-1, WIDTH)[at] = np.stack([got.column(f"w{i}").to_numpy() for i in range(WIDTH)], 1)
            squares.ravel()[at] += got.column("s").to_numpy()
    return w, squares
