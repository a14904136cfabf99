"""Repeated passages by prefix-partitioned suffix trees over words.

A window is WINDOW consecutive words. Of the GRAM-word prefixes that start in it, the one with
the smallest hash (the leftmost of equals) is its anchor, so equal windows have equal anchors at
the same distance from their start. Where a few words repeat at once, as in a pair said hundreds of
times, nearly each repetition is an anchor of the same windows; such anchors of a document, at most
WINDOW words apart, are one occurrence from the first to the last of them, and so are the words that
its windows cover. Suffixes that start at anchors are partitioned by that prefix:

* prefixes that occur in one document only are dropped after a grouped count of hashes;
* prefixes with up to GROUP occurrences go, many at a time, into memory-sized sorted suffix
  groups. The sorted order with its common-prefix lengths is the suffix tree: a node of depth d
  is a run whose common prefixes are at least d long. One tree reads the words to the right of
  the anchor, one the words to the left; a window at distance o is repeated where occurrences
  share a left node of depth o and a right node of depth WINDOW - o;
* more frequent prefixes are lengthened by HALF words, to the right for windows with as many words
  there and to the left for the others, and go into such groups; those that are still more
  frequent are lengthened to the whole window, whose tree would be a single deep node: a grouped
  minimum finds its smallest document, however many documents share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import by_rows, tidied
from .joins import hub_join
from .staging import stage

WINDOW, GRAM = 50, 10
SPAN = WINDOW - GRAM
HALF = SPAN // 2
#: Occurrences of a prefix that one tree takes, and rows that are sorted together.
GROUP, SORTED = 20_000, 20_000
#: Bytes of a word's hash that the trees compare: all.
WIDE = 8

_rng = np.random.Generator(np.random.PCG64(7))
_ODD = _rng.integers(0, 1 << 63, (3, WINDOW), np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h


def split(text: str | None) -> list[bytes]:
    """Words as UTF-8: runs of other bytes than space and 0x09 to 0x0D."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grams(w: np.ndarray, size: int, row: int) -> np.ndarray:
    """A hash of the ``size`` words from each position."""
    n = len(w) - size + 1
    h = w[:n] * _ODD[row, 0]
    for j in range(1, size):
        h += w[j : n + j] * _ODD[row, j]
    return _mix(h)


def _anchors(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The GRAM-word hashes, and for each window the position of its anchor."""
    h = _grams(w, GRAM, 0)
    at = np.lib.stride_tricks.sliding_window_view(h, SPAN + 1).argmin(1)
    return h, at + np.arange(len(at))


def _occurrences(w: np.ndarray) -> tuple[np.ndarray, ...]:
    """The GRAM-word hashes; for each run of anchors of the same windows the first's and the last's position, and the first's first and last window."""
    h, at = _anchors(w)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    pos = at[first]
    upto, alone = pos.copy(), np.ones(len(pos), bool)
    _, which, often = np.unique(h[pos], return_inverse=True, return_counts=True)
    heads: dict[bytes, int] = {}
    for k in np.flatnonzero(often[which] > 1).tolist():
        p, i, j = int(pos[k]), int(first[k]), int(last[k])
        own = xxhash.xxh3_128_digest(b"%d:%d:" % (p - i, j - i) + w[i : j + WINDOW].tobytes())
        head = heads.get(own)
        if head is not None and p - upto[head] <= WINDOW:
            upto[head], alone[k] = p, False
        else:
            heads[own] = k
    return h, pos[alone], upto[alone], first[alone], last[alone]


_SEEN = "doc_id long, rid long, n_words long, key_a long, key_b long, anchors array<long>, times array<int>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's number of words, a hash of its words, its anchors' distinct hashes and how often each occurs."""
    for b in by_rows(batches):
        n, keys, anchors, times = [], [], [], []
        for t in b.column(2).to_pylist():
            words = split(t)
            n.append(len(words))
            keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
            if len(words) >= WINDOW:
                h, pos, *_ = _occurrences(_hashes(words))
                own, often = np.unique(h[pos], return_counts=True)
            else:
                own = often = np.zeros(0, np.uint64)
            anchors.append(own.view(np.int64))
            times.append(often.astype(np.int32))
        k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        ends = pa.array(np.cumsum([0, *map(len, anchors)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*x, np.zeros(0, t)]))) for x, t in ((anchors, np.int64), (times, np.int32))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), *lists], [x.split()[0] for x in _SEEN.split(", ")])


_FOUND = "whole boolean, key_a long, key_b long, doc_id long, rid long, pos int, upto int, lo int, hi int, left binary, right binary"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the trees: an anchor's position, that of the last of its run, its windows' distances and the words around it; of frequent prefixes (``whole``) under longer ones."""
    names = [x.split()[0] for x in _FOUND.split(", ")]
    types = [pa.bool_(), *[pa.int64()] * 4, *[pa.int32()] * 4, pa.binary(), pa.binary()]
    for b in by_rows(batches):
        rows: list[tuple] = []
        for doc, rid, text, few, many in zip(*(c.to_pylist() for c in b.columns)):
            w = _hashes(split(text))
            h, pos, upto, first, last = _occurrences(w)
            hs = h[pos].view(np.int64)
            cold = np.isin(hs, np.array(few or [], np.int64))
            flat = w.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :WIDE]
            back = flat[::-1]
            n = len(w)
            for k in np.flatnonzero(cold).tolist():
                p, i, j = int(pos[k]), int(first[k]), int(last[k])
                rows.append((False, int(hs[k]), 0, doc, rid, p, int(upto[k]), p - j, p - i, back[n - p : n - i].tobytes(), flat[p + GRAM : j + WINDOW].tobytes()))
            hot = np.isin(hs, np.array(many or [], np.int64)) & ~cold
            for k in np.flatnonzero(hot).tolist():  # longer prefixes: to the right for windows that have HALF words there, to the left for the others
                p, i, j = int(pos[k]), int(first[k]), int(last[k])
                lo, hi = p - j, p - i
                left, right = back[n - p : n - i].tobytes(), flat[p + GRAM : j + WINDOW].tobytes()
                for side, low, high, words in ((b"r", lo, min(hi, HALF), right), (b"l", max(lo, HALF + 1), hi, left)):
                    if low <= high:
                        longer = xxhash.xxh3_64_intdigest(side + h[p].tobytes() + words[: HALF * WIDE])
                        rows.append((True, longer - (longer >> 63 << 64), 0, doc, rid, p, int(upto[k]), low, high, left, right))
            if len(rows) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of SPAN words, what a row lacks at its end as zeros."""
    wide = np.zeros((len(col), SPAN * WIDE), np.uint8)
    off = col.offsets.to_numpy() if hasattr(col, "offsets") else np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if off[-1] else np.zeros(0, np.uint8)
    lens = np.diff(off)
    row = np.repeat(np.arange(len(col)), lens)
    wide[row, np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)] = data[off[0] : off[-1]]
    return wide


def _tree(prefix: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in sorted order, and the common-prefix length, in words, of each with the one before; -1 where another prefix begins."""
    whole = np.concatenate([prefix.astype(">i8").view(np.uint8).reshape(-1, 8), words], axis=1)
    order = np.argsort(np.ascontiguousarray(whole).view(np.dtype((np.void, whole.shape[1]))).ravel(), kind="stable")
    s = words[order]
    same = (s[1:] == s[:-1]).reshape(len(s) - 1, SPAN, WIDE).all(2)
    common = np.where(same.all(1), SPAN, same.argmin(1))
    p = prefix[order]
    return order, np.concatenate([[-1], np.where(p[1:] == p[:-1], common, -1)])


def repeated_windows(prefix: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each anchor occurrence and each distance 0..SPAN, whether that window starts in a smaller document too."""
    n = len(prefix)
    out = np.zeros((n, SPAN + 1), bool)
    by_right, common_right = _tree(prefix, right)
    by_left, common_left = _tree(prefix, left)
    r, l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(SPAN + 1):
        own = np.flatnonzero((lo <= o) & (o <= hi))
        if len(own) > 1:
            r[by_right] = np.cumsum(common_right < SPAN - o)
            l[by_left] = np.cumsum(common_left < o)
            node = r[own] * (n + 1) + l[own]
            order = np.lexsort((doc[own], node))
            node = node[order]
            start = np.flatnonzero(np.diff(node, prepend=-1))
            least = np.repeat(doc[own][order][start], np.diff(np.append(start, len(node))))
            out[own[order], o] = least < doc[own][order]
    return out


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffix groups of about SORTED rows, cut between prefixes -> (doc_id, rid, start, end) of covered words."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        c = {k: t.column(k).combine_chunks() if isinstance(t.column(k), pa.ChunkedArray) else t.column(k) for k in t.column_names}
        num = {k: c[k].to_numpy() for k in ("key_a", "doc_id", "rid", "pos", "upto", "lo", "hi")}
        rep = repeated_windows(num["key_a"], num["doc_id"], num["lo"], num["hi"], _matrix(c["left"]), _matrix(c["right"]))
        edge = np.diff(np.pad(rep.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, near = np.nonzero(edge == 1)
        far = np.nonzero(edge == -1)[1] - 1
        p, q = num["pos"][row].astype(np.int64), num["upto"][row].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(num["doc_id"][row]), pa.array(num["rid"][row]), pa.array(p - far), pa.array(q - near + WINDOW)], ["doc_id", "rid", "start", "end"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) >= SORTED:
            t = pa.Table.from_batches(held)
            key = t.column("key_a").to_numpy()
            cut = int(np.searchsorted(key, key[-1], "left"))
            if cut:
                yield solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def _deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window around an anchor, with what it covers in the anchor's run, under a hash of all its words."""
    names = ["key_a", "key_b", "doc_id", "rid", "start", "end"]
    for b in batches:
        rows: list[tuple] = []
        for key, doc, rid, p, q, lo, hi, left, right in zip(*(c.to_pylist() for c in b.columns)):
            for o in range(lo, hi + 1):
                own = xxhash.xxh3_128_digest(b"%d:%d:" % (key, o) + left[: o * WIDE] + right[: (SPAN - o) * WIDE])
                rows.append((int.from_bytes(own[:8], "little", signed=True), int.from_bytes(own[8:], "little", signed=True), doc, rid, p - o, q - o + WINDOW))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)], names)


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, start, end): runs of words, by position, that are covered by windows which also start in a smaller document.

    rid is xxhash64 of the text and tells rows of one doc_id apart. Documents of the same
    words are first reduced to the smallest doc_id; of the others all words count as covered
    if they have a window at all.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("rid"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    seen = stage(kept.select("doc_id", "rid", "text").mapInArrow(tidied(_scan), _SEEN).where(f"n_words >= {WINDOW}"), "seen")
    least = seen.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    n_seen, n_anchors = seen.agg(F.count("*"), F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()
    marked = hub_join(seen.select("doc_id", "rid", "key_a", "key_b", "n_words"), least, ["key_a", "key_b"], "n", n_seen).where(copy)
    copies = stage(marked.select("doc_id", "rid", "n_words").distinct(), "copies")
    firsts = seen.join(copies, ["doc_id", "rid"], "left_anti").select("doc_id", "rid", F.explode(F.arrays_zip("anchors", "times")).alias("a"))
    firsts = firsts.select("doc_id", "rid", F.col("a.anchors").alias("h"), F.col("a.times").alias("times"))
    again = firsts.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.sum("times").alias("n"), F.count("*").alias("rows")).where("x < y")
    hits = hub_join(firsts, again.select("h", (F.col("n") <= GROUP).alias("few"), "rows"), ["h"], "rows", n_anchors).groupBy("doc_id", "rid").agg(F.collect_set(F.when(F.col("few"), F.col("h"))).alias("few"), F.collect_set(F.when(~F.col("few"), F.col("h"))).alias("many"))
    found = kept.join(hits, ["doc_id", "rid"]).select("doc_id", "rid", "text", "few", "many").mapInArrow(tidied(_gather), _FOUND)
    found = stage(found, "suffixes")
    cols = ["key_a", "doc_id", "rid", "pos", "upto", "lo", "hi", "left", "right"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = stage(found.where("whole").groupBy("key_a").count().where(F.col("count") > GROUP).select("key_a"), "large")
    some = found.join(F.broadcast(large), "key_a", "left_anti").select(*cols)
    in_trees = some.repartition(n, "key_a").sortWithinPartitions("key_a").mapInArrow(tidied(_trees), "doc_id long, rid long, start long, end long")
    deep = found.where("whole").join(F.broadcast(large), "key_a").select(*cols).mapInArrow(tidied(_deepen), "key_a long, key_b long, doc_id long, rid long, start long, end long")
    deep = stage(deep, "windows")
    smallest = deep.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n")).where("x < y").select("key_a", "key_b", "x", "n")
    in_nodes = hub_join(deep, smallest, ["key_a", "key_b"], "n", deep.count()).where("doc_id > x").select("doc_id", "rid", "start", "end")
    return in_trees.union(in_nodes).union(copies.select("doc_id", "rid", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))


def _cut(words: list[bytes], runs: list[dict] | None) -> tuple[int, bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs or []:
        gone[r["start"]] += 1
        gone[r["end"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return int(len(words) - keep.sum()), b" ".join([words[i] for i in np.flatnonzero(keep)])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, n_removed and kept_text: the words that no repeated window covers, joined by one space.

    Null texts have no words; a null doc_id is never smaller nor larger than another, so its
    text stays and hides no other; repeated rows are treated alike; columns of ``docs`` pass
    through, but those named n_words, n_removed and kept_text are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    runs = spans(docs).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "end")).alias("_runs"))
    runs = stage(runs, "runs").withColumnsRenamed({"doc_id": "_doc", "rid": "_rid"})
    joined = docs.withColumn("_hash", F.xxhash64("text")).join(runs, (F.col("doc_id").cast("long") == F.col("_doc")) & (F.col("_hash") == F.col("_rid")), "left").drop("_doc", "_rid", "_hash")
    names = joined.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            texts, found = b.column(names.index("text")).to_pylist(), b.column(names.index("_runs")).to_pylist()
            out = []
            for t, r in zip(texts, found):
                words = split(t)
                out.append((len(words), *(_cut(words, r) if r else (0, b" ".join(words)))))
            cols = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary()).cast(pa.string())]
            keep = [i for i, k in enumerate(names) if k != "_runs"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + cols, [*(names[i] for i in keep), "n_words", "n_removed", "kept_text"])

    more = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    schema = T.StructType([*docs.schema.fields, *more])
    return joined.mapInArrow(tidied(run), schema)
