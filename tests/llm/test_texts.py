"""Text operators against brute force on small tables."""

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from siftworks.llm import lm, packing, pieces, pii, quality, simhash, substring
from siftworks.llm.staging import shared_dir


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def groups(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("hot", [64, 2])
def test_simhash_groups(odd, docs, hot):
    for df in (odd, docs.limit(60)):
        d = texts(df)
        fp = {i: plain_fingerprint(t) for i, t in d.items()}
        want = groups(d, [(a, b) for a in d for b in d if a < b and (fp[a] ^ fp[b]).bit_count() <= 2])
        rows = simhash.simhash_groups(df, hot=hot).collect()
        assert len(rows) == df.count()
        assert all(r.fp & (1 << 64) - 1 == fp[r.doc_id] and r.component_id == want[r.doc_id] for r in rows)


def test_every_close_pair_collides(spark):
    rnd = np.random.default_rng(0)
    for radius in (1, 2, 6):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(300):
            bits = rnd.choice(64, radius, replace=False)
            assert any(not any(m >> int(b) & 1 for b in bits) for m in masks)
    codes = [int(x) for x in {*(int(v) for v in rnd.integers(0, 1 << 20, 40)), *(sum(1 << int(b) for b in rnd.choice(12, 3)) for _ in range(120))}]
    df = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "fp long, rep long")
    for radius in (1, 2):
        want = groups(range(len(codes)), [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= radius])
        for hot in (2, 64):
            got = groups(range(len(codes)), [(r.a, r.b) for r in simhash.links(df, radius, hot).collect()])
            assert got == want


def test_similar_groups(docs):
    d = texts(docs)
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in d.items()}
    alike = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    want = groups(d, [(a, b) for a in d for b in d if a < b and alike(sets[a], sets[b])])
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert all(want[i] == want[got[i]] for i in d)  # nothing is joined that is not alike
    missed = sum(got[i] != want[i] for i in d)
    assert missed <= 0.02 * len(d)


def plain_mask(text, spans):
    out, at, name, end = [], 0, None, 0
    for x in sorted((x.start, x.end, x.kind) for x in spans):
        if name is not None and x[0] < end:
            end = max(end, x[1])
            continue
        if name is not None:
            out.append(f"<{name}>")
            at = end
        out.append(text[at : x[0]])
        name, end = x[2], x[1]
    return text if name is None else "".join(out) + f"<{name}>" + text[end:]


def test_mask(spark, odd, nothing):
    rnd = random.Random(8)
    parts = ["a@b.com", "+1 555 123 4567", "(555) 123-4567", "10.0.0.1", "4111 1111 1111 1111", "call", "é😀", "x" * 700, "\n", "GB82 WEST 1234 5698 7654 32"]
    rows = [(i, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 900 if i < 3 else 30))), "en", "s", 0, 1.0, 2, "k") for i in range(40)]
    for df in (spark.createDataFrame(rows, odd.schema), odd, nothing):
        found = pii.find_spans(df)
        want = Counter((r.doc_id, plain_mask(r.text, r.spans) if r.text is not None else None) for r in found.collect())
        assert Counter((r.doc_id, r.text) for r in pii.mask_text(found).collect()) == want


def alike_groups(d):
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in d.items()}
    return groups(d, [(a, b) for a in d for b in d if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])


def test_similar_groups_beside_decoys(spark, odd, nothing):
    """Reordered texts have the words of a near copy, but not its shingles; they must not hide it, in crowded buckets either."""
    rnd = random.Random(5)
    d = {}
    for k in range(8):
        words = [f"k{k}w{j}" for j in range(200)]
        for i in range(3):
            d[100 * k + i] = " ".join(rnd.sample(words, len(words)))
        for i in range(3, 7):
            d[100 * k + i] = " ".join(words[:190] + [f"k{k}x{i}{j}" for j in range(4)])
    parts = [" ".join(f"p{k}w{j}" for j in range(40)) for k in range(9)]
    for i in range(60):
        d[1000 + i] = " ".join(rnd.sample(parts, rnd.randint(3, 5)))
    for df in (spark.createDataFrame(list(d.items()), "doc_id long, text string"), odd, nothing):
        own = texts(df)
        want = alike_groups(own)
        for block in (256, 3):
            rows = simhash.similar_groups(df, block=block).collect()
            assert len(rows) == df.count() and all(r.component_id == want[r.doc_id] for r in rows)


def test_near_copies_at_the_edge_are_all_found(spark):
    """Pairs that are alike but not identical, just above an index of 0.8, whatever their words."""
    rnd, d = random.Random(6), {}
    for k in range(150):
        words = [f"k{k}w{j}" for j in range(rnd.randint(60, 120))]
        n = next(n for n in range(len(words)) if len(words) - 4 < 0.8 * (len(words) - 4 + n + 1))
        d[2 * k], d[2 * k + 1] = " ".join(words), " ".join(words + [f"k{k}x{j}" for j in range(n)])
    want = alike_groups(d)
    assert all(want[2 * k + 1] == 2 * k for k in range(150))
    df = spark.createDataFrame(list(d.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()} == want


def test_many_texts_that_are_nearly_alike_make_few_pairs(spark, monkeypatch):
    """Variants of one text, most of them below an index of 0.8 to each other, are compared but not written out as pairs."""
    rnd, made = random.Random(9), []
    words = [f"w{j}" for j in range(200)]
    d = {i: " ".join(f"v{j}x{rnd.randint(0, 2)}" if j % 10 == 5 else w for j, w in enumerate(words)) for i in range(240)}
    for i in range(240, 260):
        d[i] = d[i - 240] + " z"

    def counted(df, name, stage=simhash.stage):
        out = stage(df, name)
        made.extend([out.count()] if name == "pairs" else [])
        return out

    monkeypatch.setattr(simhash, "stage", counted)
    df = spark.createDataFrame(list(d.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()} == alike_groups(d)
    assert max(made) <= 2 * len(d)


def test_squares_in_batches_of_any_size():
    """Squares that go on over several batches, end with one or fill one give the pairs of plain comparison."""
    rnd, rows = random.Random(10), []
    sets = [np.unique(np.array([rnd.randint(-(2**63), 2**63 - 1) for _ in range(60)])) for _ in range(12)]
    sets += [np.unique(np.r_[s[2:], rnd.randint(-(2**63), 2**63 - 1)]) for s in sets]
    for w in range(9):
        for k in rnd.sample(range(24), rnd.randint(2, 24)):
            rows.append((w, 0, w % 2, rnd.randint(0, w % 2), k, len(sets[k]), rnd.randint(0, 3), k % 5 if w == 8 else k, simhash._bits(sets[k]).tolist()))
    names = ["w", "lo", "hi", "side", "id", "n", "i", "part", "bits"]
    want = {(min(x[4], y[4]), max(x[4], y[4])) for x in rows for y in rows if x[:3] == y[:3] and x[7] != y[7] and (x[1] == x[2] or x[3] != y[3]) and abs(x[4] - y[4]) == 12}
    for size in (1, 7, 24, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64()) if n == "bits" else pa.int64()) for n, c in zip(names, zip(*rows[i : i + size]))], names) for i in range(0, len(rows), size)]
        got = {(a, b) for out in simhash._near_in_squares(0.8, False)(iter(batches)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
        one = {(a, b) for out in simhash._near_in_squares(0.8, True)(iter(batches)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
        assert got == want and want and one <= want and {i for p in one for i in p} == {i for p in want for i in p}


def test_intermediate_tables_go(spark, odd):
    """The search leaves only what its result reads."""
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = simhash.similar_groups(odd)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert out.count() == odd.count() and not left & {"shingles", "members", "pairs", "ids", "sets"}


def test_marked_cells_hold_all_ids(spark):
    ids = [-5, 0, 3, 2**62, *range(1000, 9000, 3)]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    cell, cells = simhash._cells(df)
    marked = lambda f: [cells[c >> 6] >> (c & 63) & 1 for (c,) in f.select(cell).collect()]
    assert all(marked(df)) and sum(marked(spark.range(10_000, 20_000).toDF("doc_id"))) < 2000
    assert not simhash._cells(df.limit(0))[1].any()


def test_masks_use_all_dimensions():
    masks = simhash.covering_masks(6)
    assert len(set(masks)) == 127 and min(m.bit_count() for m in masks) > 16


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(digits)) for x in [int(c) * (1 + i % 2)]) % 10 == 0


def plain_spans(text):
    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


ODD_PII = ["1.2.3.4.5.6.7.8 x", "a@b@c.d a.b@c.d.e_f@g.h", "é😀 +1 (234) 567-8901 and 4111 1111 1111 1111", "300.1.1.1 0001.2.3.004", "a@b.c@d.e @ x@y", "12345678901234567890123", "4111-1111-1111-1111-", "+1 23 45 67 89 +12 345 678 901", "", None, "x" * 50_000 + "@y.zz", " ".join(f"u{i}@h{i}.com" for i in range(700)), "+" * 50 + "1 " * 300]


def test_personal_data(spark, odd, docs):
    df = spark.createDataFrame(list(enumerate(ODD_PII)), "doc_id long, text string")
    for own in (df, odd.drop("fp"), docs):
        for r in pii.find_spans(own).select("text", "spans").collect():
            assert [(x.kind, x.start, x.end) for x in r.spans if x.kind in PATTERNS] == plain_spans(r.text)
            assert all(r.text[x.start : x.end] == x.value for x in r.spans)


def test_checked_and_contextual_data(spark):
    rows = ["DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "call 555-123-4567", "of 555-123-4567", "ssn 123-45-6789", "id 123-45-6789", None]
    found = pii.find_spans(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert [[x.kind for x in r.spans] for r in found.orderBy("doc_id").collect()] == [["iban"], [], ["tel"], [], ["ssn"], [], []]
    masked = pii.mask_text(pii.find_spans(spark.createDataFrame([(0, "é a@b.co, 1.2.3.4 a"), (1, None)], "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [r.text for r in masked] == ["é <email>, <ip> a", None]


def test_quality(spark, sf, docs, odd, nothing):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    feats = quality.features(docs)
    model = quality.fit(feats.where(~quality.held_out()), labels)
    got = {r.doc_id: r.score for r in quality.score(feats, model).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    x = np.array([quality.statistics(t) for t in texts(docs).values()])
    assert np.allclose([got[i] for i in texts(docs)], model.scores(x))
    held = [i for i in marks if zlib.crc32(str(i).encode()) % 5 == 0 and i in got]
    assert np.mean([(got[i] >= 0.3) == marks[i] for i in held]) >= 0.85
    through = quality.with_score(odd, model)
    assert through.columns == [*odd.drop("score").columns, "score"] and all(0 <= r.score <= 1 for r in through.collect())
    assert quality.score(quality.features(nothing), model).count() == 0
    none = quality.fit(quality.features(odd), labels.limit(0))
    assert none.factors is None and set(none.scores(x[:3])) == {0.5}


def test_quality_fit_equals_plain_formulas(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    feats = quality.features(docs).where(~quality.held_out())
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(marks[r.doc_id], r.x) for r in feats.collect() if r.doc_id in marks]
    y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    covs = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * covs[k] for k in (0, 1))
    gap = np.log((y == 1).sum() + 1) - np.log((y == 0).sum() + 1)
    for k, sign in ((0, -1), (1, 1)):
        own = 0.8 * (0.7 * covs[k] + 0.3 * pooled) + 0.2 * np.diag(np.maximum(np.diag(pooled), 1e-6))
        z = x - x[y == k].mean(0)
        gap = gap + sign * (-0.5 * (z @ np.linalg.inv(own) * z).sum(1) - 0.5 * np.linalg.slogdet(own)[1])
    model = quality.fit(feats, labels)
    assert np.allclose(model.log_odds(x), gap, rtol=1e-6, atol=1e-6)
    p, t = model.scores(x), np.round(np.clip(gap, -50, 50), 1)
    slope = [((1 / (1 + np.exp(-(model.scale * t + model.shift))) - y) * v).sum() + r for v, r in ((t, model.scale - 1), (1, 0.01 * model.shift))]
    assert np.abs(slope).max() < 1e-3 or (model.scale, model.shift) == (1.0, 0.0)  # calibrated where the penalised likelihood is flat
    assert p[y == 1].mean() > p[y == 0].mean()


def test_slices_by_bytes():
    import pyarrow as pa

    from siftworks.llm.batches import by_rows

    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["x" * 10, None, "x" * 25, "", "x" * 9, "x"])], ["i", "t"])
    assert [s.num_rows for s in by_rows(iter([b]), 4, 20)] == [2, 1, 3] and [s.num_rows for s in by_rows(iter([b]), 4, 1000)] == [4, 2]


def test_quality_density_is_gaussian():
    rnd = np.random.default_rng(0)
    a = rnd.normal(size=(2, 3, 3))
    cov = [m @ m.T + np.eye(3) for m in a]
    lower = [np.linalg.cholesky(c) for c in cov]
    model = quality.Model((-1.0, -0.5), np.zeros((2, 3)), np.stack([np.linalg.inv(c) for c in lower]), np.array([np.log(np.diag(c)).sum() for c in lower]))
    x = rnd.normal(size=(5, 3))
    log = [-0.5 * np.einsum("ni,ij,nj->n", x, np.linalg.inv(c), x) - 0.5 * np.linalg.slogdet(c)[1] for c in cov]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-(log[1] - log[0] + 0.5))))


def lm_words(t):
    return (t or "").encode().lower().split() + [b"\n"]


def lm_in_training(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


def test_lm(docs, odd, nothing):
    for df in (docs, odd):  # with repeated rows
        d = [(r.doc_id, lm_words(r.text)) for r in df.select("doc_id", "text").collect()]
        c = Counter(w for i, x in d if lm_in_training(i) for w in x)
        n = sum(c.values())
        want = Counter((i, len(x), sum(c[w] > 0 for w in x), n, not lm_in_training(i), round(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in x), 6)) for i, x in d)
        rows = lm.score(df).collect()
        assert all(r.score < 0 for r in rows)
        assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.held_out, round(r.base_score, 6)) for r in rows) == want
    assert lm.score(nothing).count() == 0


def plain_lm(rows, size):
    """The model of one shard in plain loops; rows: (doc_id, words) in the order of training."""
    salt, top = [int(x) for x in lm._SALT], (1 << 64) - 1
    c = Counter(w for i, x in rows if lm_in_training(i) for w in x)
    code = {w: xxhash.xxh64_intdigest(w) for _, x in rows for w in x}
    digits = lambda w: [(code[w] >> 7 + lm.BITS * (lm.LEVELS - 1 - k)) % lm.WIDTH for k in range(lm.LEVELS)]
    cell = lambda w: tuple(digits(w))
    total, kinds = Counter(), Counter()
    for w, n in c.items():
        total[cell(w)] += n
        kinds[cell(w)] += 1
    mass = Counter()
    for x in itertools.product(range(lm.WIDTH), repeat=lm.LEVELS):
        for k in range(lm.LEVELS + 1):
            mass[x[:k]] += total[x] + 1
    weights, squares = {}, {}

    def row(table, context, before):
        x = 0
        for v in before:
            x = x * lm.WIDTH + v
        key = (context ^ (x + lm.WIDTH ** len(before)) * salt[2] & top) * salt[1] & top
        return table, key >> 64 - size.bit_length() + 1

    def places(x, k):
        one = code[x[k - 1]] if k else 0
        two = code[x[k - 2]] if k > 1 else 0
        ctx = [one * salt[0] + 1 & top, one * salt[1] + two * salt[2] + 1 & top, two * salt[3] + 1 & top]
        d = digits(x[k])
        for level in range(lm.LEVELS):
            own = [row(t, ctx[f], d[:level]) for t, (at, f) in enumerate(lm.TABLES) if at == level]
            logits = [math.log(mass[tuple(d[:level]) + (v,)] / mass[tuple(d[:level])]) + sum(weights[r][v] if r in weights else 0 for r in own) for v in range(lm.WIDTH)]
            whole = sum(map(math.exp, logits))
            yield d[level], [math.exp(v) / whole for v in logits], own

    flat = [(i, x, k) for i, x in rows for k in range(len(x))]
    for lo in range(0, len(flat), lm.STEP):
        for level in range(lm.LEVELS):
            sums = {}
            for i, x, k in flat[lo : lo + lm.STEP]:
                if lm_in_training(i):
                    true, p, own = list(places(x, k))[level]
                    for r in own:
                        g = sums.setdefault(r, [0.0] * lm.WIDTH)
                        for v in range(lm.WIDTH):
                            g[v] += p[v] - (v == true)
            for r, g in sums.items():
                squares[r] = squares.get(r, 1.0) + sum(v * v for v in g) / 2
                own = weights.setdefault(r, [0.0] * lm.WIDTH)
                weights[r] = [w - lm.RATE * v / math.sqrt(squares[r]) for w, v in zip(own, g)]
    share = lambda w: (c[w] + 1) / (total[cell(w)] + kinds[cell(w)] + 1)
    return [(i, sum(sum(math.log10(p[true]) for true, p, _ in places(x, k)) + math.log10(share(x[k])) for k in range(len(x)))) for i, x in rows]


def test_lm_scores_equal_a_plain_model(docs):
    few = docs.where("doc_id < 40 and length(text) < 2000")
    order = few.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("m")).orderBy("m", "doc_id").collect()
    want = plain_lm([(r.doc_id, lm_words(r.text)) for r in order], lm.LEAST_ROWS)
    got = {r.doc_id: r.score for r in lm.score(few).collect()}
    assert len(got) == len(want) > 15
    for i, s in want:
        assert math.isclose(got[i], s, rel_tol=1e-4)


@pytest.mark.parametrize("shard", [64_000_000, 100_000])
def test_lm_does_not_depend_on_partitions(docs, shard, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", shard)
    want = sorted((r.doc_id, r.score) for r in lm.score(docs).collect())
    for n in (1, 4, 16):
        got = sorted((r.doc_id, r.score) for r in lm.score(docs.repartition(n)).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert all(math.isclose(g[1], w[1], rel_tol=1e-6) for g, w in zip(got, want))


def test_lm_is_normalised():
    import pyarrow as pa

    t = lm.tokens(pa.array(["a b c", None, " "]))
    assert t.ends.tolist() == [4, 5, 6] and len(t.hashes) == 4
    model = lm.Model(lm.LEAST_ROWS, lm.biases(np.arange(lm.CELLS) + 1.0))
    model.learn(t.hashes[t.code], lm._starts(t.ends), np.ones(6, bool))
    for before in (0, 12345 << 7):  # all words that can follow one, and start a text
        h = np.array([x for cell in range(lm.CELLS) for x in (before, cell << 7)], np.uint64)
        p = 10 ** model.log_probs(h, np.arange(len(h)) % 2 == 0)
        assert math.isclose(p[1::2].sum(), 1, rel_tol=1e-4)


def test_lm_is_better_than_base_on_texts_it_has_not_seen(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    for held, least in ((True, 0.1), (False, 0.3)):
        own = [r for r in rows if r.held_out == held]
        assert sum(r.score - r.base_score for r in own) > least * sum(r.n_tokens for r in own)


def plain_repeats(d):
    first = {}
    for i, t in sorted(d.items()):
        w = (t or "").encode().split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    out = {}
    for i, t in d.items():
        w = (t or "").encode().split()
        gone = [0] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [1] * 50
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats(odd, docs, nothing, group, monkeypatch):
    monkeypatch.setattr(substring, "GROUP", group)
    for df in (odd, docs):
        want = plain_repeats(texts(df))
        rows = substring.remove_repeats(df).collect()
        assert len(rows) == df.count() and any(r.n_removed for r in rows)
        assert all((r.n_words, r.n_removed, r.kept_text) == want[r.doc_id] for r in rows)
    assert substring.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("group", [20_000, 2])
def test_words_that_repeat_at_once_take_no_row_for_each_time(spark, group, monkeypatch):
    """Rows for the trees do not grow with how often documents say a few words in succession, and what is covered stays exact."""
    made = []

    def staged(df, name, stage=substring.stage):
        out = stage(df, name)
        made.extend([out.count()] if name == "suffixes" else [])
        return out

    monkeypatch.setattr(substring, "GROUP", group)
    monkeypatch.setattr(substring, "stage", staged)
    for times in (1, 3):
        rnd, d = random.Random(5), {}
        for size in (1, 2, 7, 45):
            said = [rnd.choice("ab") + f"{size}" for _ in range(size)]
            for _ in range(6):
                own = [f"w{len(d)}x{j}" for j in range(120)]
                d[len(d)] = " ".join([*own[:60], *said * (400 // size) * times, *own[60:]])
        want = plain_repeats(d)
        df = spark.createDataFrame(list(d.items()), "doc_id long, text string")
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(df).collect()} == want
    assert made[0] == made[1] < 24 * 100


def unigram_model(rnd, fallback):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, fallback
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", True, False

    def add(piece, score, kind):
        p = m.pieces.add()
        p.piece, p.score, p.type = piece, score, kind

    for p, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        add(p, 0, kind)
    for b in range(256 * fallback):
        add(f"<0x{b:02X}>", 0, 6)
    for p in sorted({"▁", *"abcdet"} | {("▁" if rnd.random() < 0.3 else "") + "".join(rnd.choice("abcdet") for _ in range(rnd.randint(1, 5))) for _ in range(300)}):
        add(p, -rnd.randrange(1, 1 << 20) / (1 << 10), 1)
    return m.SerializeToString()


@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_pieces(fallback):
    import random

    import pyarrow as pa
    import sentencepiece

    rnd = random.Random(2)
    blob = unigram_model(rnd, fallback)
    theirs, ours = sentencepiece.SentencePieceProcessor(model_proto=blob), pieces.Pieces(blob=blob)
    lines = ["".join(rnd.choice("abcdet  xyé") for _ in range(rnd.randint(0, 40))) for _ in range(150)] + ["abc" * 100]
    flat, counts = ours.encode(pa.array(lines))
    parts = np.split(flat, np.cumsum(counts)[:-1])
    best = lambda ids: sum(theirs.get_score(int(i)) for i in ids)
    for line, got in zip(lines, parts):
        want = theirs.encode(line)
        assert got.tolist() == want or math.isclose(best(got), best(want), rel_tol=1e-6)


def test_bpe_pieces(spark, docs, odd):
    import public_tokenizers
    import pyarrow as pa
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    theirs = sentencepiece.SentencePieceProcessor(model_file=path)
    extra = ["Hello world", " a", "a  b", "a\nb", "\n", "é😀", "a ", "     x", "<s> x <unk>", "a\x00b", "\t\t", "ﬁ Å", "▁x ▁ y", "x" * 500]
    flat, counts = pieces.pieces(path).encode(pa.array(extra))
    for line, got, back in zip(extra, np.split(flat, np.cumsum(counts)[:-1]), pieces.pieces(path).decode(flat, counts)):
        assert got.tolist() == theirs.encode(line) and back.decode("utf-8", "replace") == theirs.decode(got.tolist())
    assert pieces.encode_decode(odd.limit(0), path).count() == 0
    for df in (odd, docs):
        d = texts(df)
        for r in pieces.encode_decode(df, path, with_ids=True).collect():
            assert r.ids == theirs.encode(d[r.doc_id] or "") and r.round_trip and r.decoded == (d[r.doc_id] or "") and r.n_ids == len(r.ids)


def test_agreement_of_pieces_is_what_merging_gives():
    import public_tokenizers

    tok = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = np.random.default_rng(3)
    ids = np.array([i for k in range(1, tok.longest + 1) for i in tok.of_key[k].tolist()])
    short = np.array([i for k in range(1, 4) for i in tok.of_key[k].tolist()])
    cut = [(p[:k], p[k:]) for p in list(tok.ids)[300:9000] if len(p) > 2 for k in (1, len(p) // 2)]
    usable = set(ids.tolist())
    cut = np.array([(tok.ids[x], tok.ids[y]) for x, y in cut if {tok.ids.get(x), tok.ids.get(y)} <= usable])
    a = np.concatenate([rnd.choice(ids, 3000), rnd.choice(short, 6000), [tok.size + 233], cut[:, 0]])
    b = np.concatenate([rnd.choice(ids, 3000), rnd.choice(short, 6000), [short[0]], cut[:, 1]])
    name = lambda i: tok.text[i] if i < tok.size else chr(i - tok.size)
    want = [tok.merge(name(x) + name(y))[0] == [name(x), name(y)] for x, y in zip(a.tolist(), b.tolist())]
    assert tok.agree(a, b).tolist() == want and 0.1 < np.mean(want) < 0.95


def test_packing(odd, docs, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    special = odd.select("doc_id", "text").limit(0).unionByName(odd.sparkSession.createDataFrame([(1, "<|endoftext|> hi"), (2, "a<|endoftext|><|endoftext|>b  c"), (3, "a " * 5000)], "doc_id long, text string"))
    for df in (odd, docs, special):  # with repeated rows
        ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts(df).items()}
        copies = Counter(r.doc_id for r in df.select("doc_id").collect())
        rows = packing.pack(df, path).collect()
        placed, covered = defaultdict(list), Counter()
        for r in rows:
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert len(part) == r.length <= 2048 and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            placed[r.sequence_id].append((r.offset, r.length))
            covered[r.doc_id] += r.length
        assert covered == {i: len(x) * copies[i] for i, x in ids.items()}
        for own in placed.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(placed) <= 1.02 * sum(covered.values()) / 2048 + 2
    assert packing.pack(nothing, path).count() == 0


def test_words_the_tokenizer_cuts_oddly(spark):
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    odd = ["", " ", "  ", " a", "a  b", "a \n b\n\n c", "x  y  z", "<|endoftext|> hi", "é😀 don't I'll  ", "\t\ta b", "a　 b  c", " \x1c a \x85b", "nl\nword  \n", "a\u00a0 b \u2003c"]
    flat, counts = packing.encoder(path).encode(pa.array(odd))
    for t, got in zip(odd, np.split(flat, np.cumsum(counts)[:-1])):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids


def test_exact_complements_are_found_whenever_they_exist():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        cap = int(rnd.integers(3, 25))
        left = np.zeros(cap + 1, np.int64)
        left[1:] = rnd.integers(0, 3, cap) * (rnd.random(cap) < 0.5)
        index = packing.Complements(left)
        for _ in range(12):
            gap = int(rnd.integers(1, cap + 1))
            own = {x: 1 for x in rnd.integers(1, cap + 1, 2).tolist() if index.left[x] > 0}
            have = [x for x in range(1, cap + 1) for _ in range(max(0, index.left[x] - own.get(x, 0)))]
            some = any(sum(c) == gap for k in (1, 2, 3) for c in itertools.combinations(have, k))
            found = index.exact(gap, own)
            assert bool(found) == some
            if found:
                assert sum(found) == gap and all(found.count(x) <= index.left[x] - own.get(x, 0) for x in found)
                index.take(found, 1)


def test_plan_uses_every_piece_once():
    rnd = np.random.default_rng(1)
    for _ in range(20):
        cap = int(rnd.integers(1, 60))
        counts = np.zeros(cap + 1, np.int64)
        counts[1:] = rnd.integers(0, 50, cap) * (rnd.random(cap) < 0.5)
        used = np.zeros_like(counts)
        for parts, times in packing.plan(counts, cap):
            assert sum(parts) <= cap and times > 0
            for p in parts:
                used[p] += times
        assert (used == counts).all()
    assert packing.plan(np.array([0, 0, 0, 5, 0, 5, 0, 5, 0]), 8) != []
    assert packing.cuts(2048, 2048) == [2048] and packing.cuts(5000, 2048) == [904, 2048, 2048] and packing.cuts(4096, 2048) == [2048, 2048]


