"""Near-duplicate documents: SimHash with covering locality-sensitive hashing, and exact Jaccard groups."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import by_rows, tidied
from .graph import components
from .joins import hub_join
from .staging import drop_staged, stage

#: Shingles hashed at a time; bounds the memory of one very long document.
CHUNK = 1 << 15
#: Texts in which common shingles are counted, and how many of these are kept: both bounded at any input size.
SAMPLE, COMMON = 50_000, 200_000
#: Rounds in which codes are compared with one code of each bucket, before all are.
TURNS = 1
#: Bits of a set that bound how far two sets differ, and the most cells in which wanted documents are marked.
BITS, CELLS = 1024, 1 << 26


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : min(at + CHUNK, n) + shingle - 1]
        whole = zip(*(part[k:] for k in range(shingle))) if len(words) >= shingle else [words]
        h = np.fromiter((digest(b" ".join(s), 42) for s in whole), np.uint64)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed long. Null and wordless texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            fp = pa.array([_signed(fingerprint(t, shingle)) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), "doc_id long, fp long")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Masks such that two codes differing in at most ``radius`` bits agree under one of them.

    Bit i carries a non-zero vector m(i) of radius+1 bits; for each non-zero v, mask v keeps
    the bits with an odd number of common ones in m(i) and v. The differing bits' vectors
    cannot span the space, so some v is orthogonal to all of them and its mask drops them.
    Where there are more vectors than bits, the bits take vectors spread over all of them.
    """
    size = (1 << (radius + 1)) - 1
    m = [1 + (i if size <= bits else 5 * i) % size for i in range(bits)]
    return [sum((m[i] & v).bit_count() % 2 << i for i in range(bits)) for v in range(1, size + 1)]


def _ball(code: Column, bits: list[int]) -> Column:
    return F.array(code, *(code.bitwiseXOR(F.lit(_signed(1 << i))) for i in bits))


def links(codes: DataFrame, radius: int = 2, hot: int = 64) -> DataFrame:
    """Links (a, b) that connect all codes within ``radius`` bits of each other (radius 1 or 2).

    ``codes``: (fp, rep) with distinct fp. Codes that share a masked value meet in a bucket.
    Buckets of up to ``hot`` codes compare their codes; in larger ones each code is sent to the
    codes one bit away from it, where exactly those within two bits of each other meet in
    groups of at most 65, so a bucket of any size costs its size times its free bits and no
    link is lost. The result holds a spanning set of links, not all pairs.
    """
    if radius not in (1, 2):
        raise ValueError("radius is 1 or 2")
    masks = covering_masks(radius)
    table = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks))))
    keyed = codes.select("fp", "rep", table.alias("k")).select("k.t", "k.key", "fp", "rep")
    code = F.struct("fp", "rep")
    buckets = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min(code).alias("x"), F.max(code).alias("y")).where("n > 1")
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= radius
    buckets = stage(buckets, "buckets")
    two = buckets.where("n = 2").where(near("x.fp", "y.fp")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    members = keyed.join(buckets.where("n > 2").select("t", "key", "n"), ["t", "key"])
    few = members.where(F.col("n") <= hot)
    other = few.select("t", "key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    some = few.join(other, ["t", "key"]).where(F.col("fp") < F.col("fp2")).where(near("fp", "fp2")).select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    crowd = members.where(F.col("n") > hot)
    free = [[i for i in range(64) if not m >> i & 1] for m in masks]
    middle = F.array().cast("array<bigint>")
    for t, bits in enumerate(free):
        middle = F.when(F.col("t") == t, _ball(F.col("fp"), bits)).otherwise(middle)
    balls = crowd.select("t", "key", "fp", "rep", F.explode(middle).alias("z"))
    if radius == 2:
        met = balls.groupBy("t", "key", "z").agg(F.collect_set("rep").alias("reps")).where("size(reps) > 1")
        many = met.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a <> b")
    else:
        ends = crowd.select("t", "key", F.col("fp").alias("z"), F.col("rep").alias("rep2"))
        many = balls.where("fp <> z").join(ends, ["t", "key", "z"]).select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    return two.union(some).union(many)


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, hot: int = 64) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id that can be reached over links between fingerprints
    at ``radius`` or fewer differing bits. Equal fingerprints are first reduced to one code,
    so a group of copies costs one code however large it is. Null texts count as empty;
    empty texts share fingerprint zero; repeated rows give repeated result rows; a null
    doc_id gets its fingerprint's component; an empty table gives an empty result.
    """
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    codes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("rep is not null"), "codes")
    found = components(links(codes.drop("n"), radius, hot))
    of_code = codes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", "n", F.coalesce("component", "rep").alias("component_id"))
    return hub_join(fps, of_code, ["fp"], "n", fps.count(), "left").select("doc_id", "fp", "component_id")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles of lower-cased words; of all its words, if fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    n = max(1, len(words) - shingle + 1)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle])) for i in range(n)), np.uint64, n)).view(np.int64)


def _common(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of ``SAMPLE`` distinct texts hold, sorted, and how many of these hold each.

    They only decide in which order shingles are looked at, so sample and cut cost time, not links.
    """
    step = max(1, -(-docs.count() // SAMPLE))
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select(F.lit(0).alias("id"), "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            w, n = np.unique(np.concatenate([np.zeros(0, np.int64), *(shingle_set(t, shingle) for t in b.column(1).to_pylist())]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(n.astype(np.int64))], ["w", "n"])

    counted = some.mapInArrow(tidied(count), "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).where("n > 3")
    got = counted.orderBy(F.desc("n"), "w").limit(COMMON).toArrow()
    w, n = got.column("w").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(w)
    return w[order], n[order]


def _bits(s: np.ndarray) -> np.ndarray:
    """BITS bits of a set as longs: how many of its hashes fall on each, odd or even.

    A hash that only one of two sets holds turns one bit, so their bits differ in no more places than the sets in hashes.
    """
    odd = np.bincount(s & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _near_in_squares(similarity: float, nearest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs (a, b) that can be alike by sizes, places and bits, of rows sorted by (w, lo, hi), within these.

    A square's codes are compared here and pairs are not written out before; where lo < hi only those of different sides.
    ``nearest``: for each part in a square only its pair with the fewest differing bits for its sizes.
    """
    least, gap = similarity / (1 + similarity), (1 - similarity) / (1 + similarity)

    def compare(t: pa.Table) -> pa.RecordBatch:
        w, lo, hi, side, id_, n, i, part = (t.column(c).to_numpy() for c in ("w", "lo", "hi", "side", "id", "n", "i", "part"))
        bits = t.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)  # of signed numbers, numpy counts the bits of the absolute value
        square = np.cumsum(np.r_[0, (w[1:] != w[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        found, far, at, d = [np.zeros((2, 0), np.int64)], [np.zeros(0)], np.arange(len(w)), 0
        while len(at):
            d += 1
            at = at[at + d < len(w)]
            at = at[square[at + d] == square[at]]
            y = at + d
            both, rest = n[at] + n[y], np.minimum(n[at] - i[at], n[y] - i[y])
            ok = (part[at] != part[y]) & ((side[at] != side[y]) | (lo[at] == hi[at])) & (rest + 1e-9 >= both * least)
            ok &= np.minimum(n[at], n[y]) + 1e-9 >= np.maximum(n[at], n[y]) * similarity
            x, y, both = at[ok], y[ok], both[ok]
            turned = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
            ok = turned <= both * gap + 1e-6
            found.append(np.stack([x[ok], y[ok]]))
            far.append(turned[ok] / both[ok])
        (x, y), far = np.concatenate(found, axis=1), np.concatenate(far)
        if nearest:
            ends, pair = np.r_[x, y], np.tile(np.arange(len(x)), 2)
            order = np.lexsort((np.tile(far, 2), part[ends], square[ends]))
            ends = ends[order]
            first = np.r_[True, (part[ends[1:]] != part[ends[:-1]]) | (square[ends[1:]] != square[ends[:-1]])][: len(ends)]
            chosen = np.unique(pair[order][first])
            x, y = x[chosen], y[chosen]
        got = np.unique(np.stack([np.minimum(id_[x], id_[y]), np.maximum(id_[x], id_[y])], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last square may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(c).to_numpy() for c in ("w", "lo", "hi")]
            starts = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
            at = int(starts[-1]) + 1 if len(starts) else 0
            if not at and held and any(h.column(c)[-1] != b.column(c)[0] for h in held[-1:] for c in ("w", "lo", "hi")):
                yield compare(pa.Table.from_batches(held))
                held = []
            if at:
                yield compare(pa.Table.from_batches([*held, b.slice(0, at)]))
                held = []
            held.append(b.slice(at))
        if held:
            yield compare(pa.Table.from_batches(held))

    return run


def _cells(ids: DataFrame) -> tuple[Column, np.ndarray]:
    """A doc_id's cell, and which cells have one of ``ids`` (doc_id): of 16 cells an id, at most CELLS (8 MB)."""
    n = min(CELLS, 1 << max(10, (16 * ids.count()).bit_length()))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(n))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {n}L) % 64 as int))")
    got = ids.groupBy(F.expr(f"cast(pmod(xxhash64(doc_id), {n}L) div 64 as long)").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(n // 64, np.int64)
    words[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return cell, words


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, block: int = 4096) -> DataFrame:
    """(doc_id, component_id): groups of documents whose shingle sets have a Jaccard index of at least ``similarity``.

    Exact but for 64-bit shingle hashes: component_id is the smallest doc_id that can be
    reached over such pairs. Documents of the same shingle set are one code.

    The first candidates come from SimHash, as in ``simhash_groups``: codes of equal fingerprints,
    and the links that covering masks find within 2 bits. An index of 0.8 is some 10 bits, so
    they are not all. For the rest each set is
    ordered, rare shingles first; two sets that are alike share one of the first
    n - ceil(similarity * n) + 1, and the first one they share leaves enough behind it in
    both. So codes meet at these shingles. In TURNS turns each code is compared with one code
    of each of its buckets, which brings groups of near copies together at about their own
    size; then all members of a bucket that are not yet connected are compared, in squares of
    ``block`` by ``block`` codes: once for the nearest pair of each part that is connected so far,
    once for all pairs that are left. Only links that the exact Jaccard index confirms count, and no
    code leaves before all its candidates are compared or connected with it.

    Null and wordless texts are copies of each other. Rows without a doc_id have a null component_id.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common, times = _common(kept, shingle)

    def key(s: np.ndarray) -> bytes:
        return xxhash.xxh3_128_digest(s.tobytes())

    def rare(s: np.ndarray) -> np.ndarray:
        """The shingles of a set at which similar sets meet, rare ones first."""
        if len(common):
            at = np.minimum(np.searchsorted(common, s), len(common) - 1)
            s = s[np.argsort(np.where(common[at] == s, times[at], 0), kind="stable")]
        return s[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            texts = b.column(1).to_pylist()
            got = [shingle_set(t, shingle) for t in texts]
            k = np.frombuffer(b"".join(map(key, got)), np.int64).reshape(-1, 2)
            n, p = pa.array([len(s) for s in got], pa.int64()), pa.array([rare(s) for s in got], pa.list_(pa.int64()))
            fp, bits = pa.array([_signed(fingerprint(t)) for t in texts], pa.int64()), pa.array([_bits(s) for s in got], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), n, fp, bits, p], ["doc_id", "id", "more", "n", "fp", "bits", "p"])

    seen = stage(kept.mapInArrow(tidied(scan), "doc_id long, id long, more long, n long, fp long, bits array<long>, p array<long>"), "shingles")
    own = seen.where("doc_id is not null")
    codes = stage(own.groupBy("id", "more").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("bits").alias("bits")), "codes")
    n_seen, n_codes, n_places = seen.count(), codes.count(), seen.agg(F.sum(F.size("p"))).first()[0] or 0

    def sets(cells: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in by_rows(batches):
                cell = b.column(2).to_numpy()
                b = b.filter(pa.array(cells[cell >> 6] >> (cell & 63) & 1 == 1))
                got = [shingle_set(t, shingle) for t in b.column(1).to_pylist()]
                k = np.frombuffer(b"".join(map(key, got)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(k[:, 0].copy()), pa.array(got, pa.list_(pa.int64()))], ["doc_id", "id", "s"])

        return run

    def confirmed(found: DataFrame) -> DataFrame:
        """The pairs (a, b) of ``found`` that are alike: first by sizes and bits, then by their whole sets."""
        pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        side = lambda k: codes.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
        turned = sum((F.bit_count(F.col("bitsa")[i].bitwiseXOR(F.col("bitsb")[i])) for i in range(BITS // 64)), F.lit(0))
        able = (turned <= (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-6) & (F.least("na", "nb") + 1e-9 >= F.greatest("na", "nb") * similarity)
        pairs = stage(pairs.join(side("a"), "a").join(side("b"), "b").where(able).select("a", "b"), "pairs")
        ids = stage(codes.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id").select(F.col("rep").alias("doc_id")).distinct(), "ids")
        cell, cells = _cells(ids)
        of = kept.where("doc_id is not null").select("doc_id", "text", cell.alias("cell")).mapInArrow(tidied(sets(cells)), "doc_id long, id long, s array<long>")
        of = stage(of.join(ids, "doc_id").select("id", "s").dropDuplicates(["id"]), "sets")
        both = pairs.join(of.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(of.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        shared = both.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("both"))
        alike = stage(shared.where(F.col("both") >= (F.col("n") - F.col("both")) * F.lit(similarity)).select("a", "b"), "alike")
        drop_staged(pairs, ids, of)
        return alike

    of_fp = codes.groupBy("fp").agg(F.min("id").alias("b"), F.count("*").alias("c"))
    same = hub_join(codes.select("fp", F.col("id").alias("a")), of_fp, ["fp"], "c", n_codes).select("a", "b")
    alike = confirmed(same.union(links(of_fp.select("fp", F.col("b").alias("rep")))))
    groups = components(alike)

    places = own.groupBy("id").agg(F.first("n").alias("n"), F.first("p").alias("p")).select("id", "n", F.posexplode("p").alias("i", "w"))
    buckets = places.groupBy("w").agg(F.count("*").alias("c")).where("c > 1")
    members = stage(hub_join(places, buckets, ["w"], "c", n_places), "members")
    n_members, of_doc = members.count(), stage(seen.select("doc_id", "id", "more"), "codes_of")
    drop_staged(seen)
    size = F.least("n", "y.n") + 1e-9 >= F.greatest("n", "y.n") * similarity
    for turn in range(TURNS + 2):
        now = members.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
        one = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n", "part")).alias("y")
        open_ = now.groupBy("w").agg(one, F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("c")).where("p <> q").select("w", "y", "c")
        now = hub_join(now, open_.withColumn("rows", F.col("c")), ["w"], "rows", n_members)
        if turn < TURNS:
            found = now.where(size).where("part <> y.part").select(F.col("id").alias("a"), F.col("y.id").alias("b"))
        else:
            last = F.ceil(F.col("c") / block).cast("int") - 1
            now = now.drop("y").join(codes.select("id", "bits"), "id").withColumn("last", last).withColumn("side", F.pmod(F.xxhash64("id", F.lit("block")), F.col("last") + 1).cast("int"))
            now = now.withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")})
            now = now.select("w", "lo", "hi", "side", "id", "n", "i", "part", "bits").repartition("w", "lo", "hi").sortWithinPartitions("w", "lo", "hi")
            found = now.mapInArrow(tidied(_near_in_squares(similarity, turn == TURNS)), "a long, b long")
        alike = alike.union(confirmed(found))
        groups = components(alike)
    drop_staged(members)
    of_code = stage(codes.join(groups.withColumnRenamed("node", "id"), "id", "left").select("id", "more", "rep", "rows", F.coalesce("component", "id").alias("part")), "parts")
    least = of_code.groupBy("part").agg(F.min("rep").alias("component_id"))
    of_code = of_code.join(least, "part").select("id", "more", "rows", "component_id")
    return hub_join(of_doc, of_code, ["id", "more"], "rows", n_seen, "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
