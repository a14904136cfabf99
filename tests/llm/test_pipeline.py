"""The pipeline's stages against brute force, each on its own input."""

import random

import numpy as np
import public_tokenizers
import xxhash
from test_texts import alike_groups, groups, plain_fingerprint, plain_repeats, plain_spans, texts
from tokenizers import Tokenizer

import corpus_pipeline
from siftworks.llm import quality, simhash
from siftworks.llm.staging import stage


def test_stages(spark, sf):
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        seen.append(docs)
        docs = stage(step(spark, docs, sf), f"test-{name}")
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    start, good, distinct, cut, masked = (texts(d) for d in seen)
    model = quality.fit(quality.features(seen[0].where(~quality.held_out())), spark.read.parquet(f"{sf}/labels.parquet"))
    score = model.scores(np.array([quality.statistics(t) for t in start.values()]))
    assert set(good) == {i for i, s in zip(start, score) if s >= 0.3}
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in good.items()}
    want = groups(good, [(a, b) for a in good for b in good if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    assert {i for i in good if want[i] == i} <= set(distinct) and len(distinct) <= len(set(want.values())) + 2
    for i, (n, gone, kept) in plain_repeats(distinct).items():
        assert (i in cut) == (gone < n or n == 0) and (i not in cut or cut[i] == (kept if gone else distinct[i]))
    assert not any(plain_spans(t) for t in masked.values() if "<" not in t)
    assert {r.doc_id for r in docs.collect()} == set(masked)


def test_stages_take_odd_and_empty_tables(spark, odd, nothing, sf):
    """Nulls, empty and long texts, repeated rows, extra columns with clashing names: each stage's result is defined."""
    null_id = spark.createDataFrame([(None, "a b c d e f", "en", "s", 0, 1.0, 2, "k")] * 2, odd.schema)
    own = [(r.doc_id, r.text) for r in odd.collect()]
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, nothing, sf).count() == 0
        rows = step(spark, odd.union(null_id), sf).collect()
        if name != "packing":
            assert list(rows[0].asDict()) == list(corpus_pipeline.COLUMNS)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) or name in ("quality", "near_duplicates") for r in rows)
            got = [(r.doc_id, r.text) for r in rows if r.doc_id is not None]
        if name == "quality":
            assert set(got) <= set(own)
        elif name == "near_duplicates":
            assert sum(r.doc_id is None for r in rows) == 2  # they have no smaller copy
            sets = {i: frozenset(simhash.shingle_set(t, 5).tolist()) for i, t in own}
            kept = {i for i, _ in got}
            assert all(i in kept or any(sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets if j < i) for i in sets)
            assert len([i for i in kept if not sets[i]]) == 1
        elif name == "substring":
            want = plain_repeats(dict(own))
            assert {i for i, _ in got} == {i for i, (n, gone, _) in want.items() if gone < n or n == 0}
        elif name == "pii":
            assert sorted(map(str, {i for i, _ in got})) == sorted(map(str, {i for i, _ in own}))
        else:
            assert {r.doc_id for r in rows} == {i for i, _ in own} | {None}


def test_near_copies_are_found_by_fingerprints_first(spark, monkeypatch):
    """The stage searches the SimHash of every text, and the first links it confirms join all alike texts within 2 bits."""
    rnd, codes, alike = random.Random(12), [], []
    d = {}
    for k in range(25):
        words = [f"k{k}w{j}" for j in range(400)]
        for i in range(4):
            d[4 * k + i] = " ".join([*words[: rnd.randint(385, 400)], f"x{k}y{i}"])
    fp = {i: plain_fingerprint(t) for i, t in d.items()}

    def links(df, *more, search=simhash.links):
        codes.extend(r.fp & (1 << 64) - 1 for r in df.collect())
        return search(df, *more)

    def staged(df, name, stage=simhash.stage):
        out = stage(df, name)
        alike.extend([out.collect()] if name == "alike" else [])
        return out

    monkeypatch.setattr(simhash, "links", links)
    monkeypatch.setattr(simhash, "stage", staged)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in d.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
    assert sorted(codes) == sorted(set(fp.values()))
    key = {i: np.frombuffer(xxhash.xxh3_128_digest(simhash.shingle_set(t, 5).tobytes()), np.int64)[0] for i, t in d.items()}
    first, near = groups(key.values(), [(r.a, r.b) for r in alike[0]]), [(a, b) for a in d for b in d if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    assert near and all(first[key[a]] == first[key[b]] for a, b in near)
    assert kept == set(alike_groups(d).values())


def test_sequences_can_be_built_from_the_result(spark, odd, sf):
    """The last stage's rows alone give each document's ids, and sequences without gaps or overlaps."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd.dropDuplicates(["doc_id"])
    own, ids, sequences = texts(docs), {}, {}
    for r in sorted(corpus_pipeline.pack_sequences(spark, docs, sf).collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == r.length
        ids.setdefault(r.doc_id, []).extend(r.ids)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    assert ids == {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in own.items()}
    for parts in sequences.values():
        at = 0
        for offset, part in sorted(parts, key=lambda x: x[0]):
            assert offset == at
            at += len(part)
        assert at <= 2048


def test_run_registers(spark, sf):
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in e.queries()
