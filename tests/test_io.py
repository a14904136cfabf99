import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftworks.functions import models, prompts
from siftworks.operators import dedup, index, limits
from siftworks.sources import download, files, pages, sinks
from siftworks.streaming import ingest


def test_index_is_permissive(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"sha1":"a","path":"p","timestamp":1.5}\n\nbroken\n{"sha1":5,"path":"q"}\n[1]\n')
    rows = files.index(spark, str(tmp_path / "i.jsonl")).orderBy("line_no").collect()
    assert [(r.sha1, r.path, r.timestamp) for r in rows] == [("a", "p", 1.5), (None, "q", None)]


def test_manifests(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"id":"x","image":"a.jpg","n":1}\n{"path":"b.jpg"}\n')
    rows = files.manifest(spark, str(tmp_path / "m.jsonl")).collect()
    assert [r.image_path for r in rows] == ["a.jpg", "b.jpg"] and rows[0].id == "x" and rows[1].id.startswith("row-")
    (tmp_path / "a.json").write_text('[{"identifier":"x","image_path":"a"},3]')
    assert [(r.id, r.image_path) for r in files.manifest(spark, str(tmp_path / "a.json")).collect()] == [("x", "a")]
    (tmp_path / "o.json").write_text('{"k1":"p1","k2":{"path":"p2"},"k3":{"id":"own","path":"p3"}}')
    assert sorted((r.id, r.image_path) for r in files.manifest(spark, str(tmp_path / "o.json")).collect()) == [("k1", "p1"), ("k2", "p2"), ("own", "p3")]
    for name, content in (("bad.jsonl", "{"), ("none.jsonl", '{"id":1}'), ("root.json", "3")):
        (tmp_path / name).write_text(content)
        with pytest.raises(Exception):
            files.manifest(spark, str(tmp_path / name)).collect()


def test_images_sidecars_and_contents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("a.JPG", "b.png", "c.txt"):
        (tmp_path / "d" / name).write_bytes(name[0].encode())
    (tmp_path / "d/a.json").write_text('{"sha1":"s","width":3}')
    (tmp_path / "d/b.json").write_text("broken")
    found = files.images(spark, str(tmp_path))
    joined = files.with_sidecar(found, files.sidecars(spark, str(tmp_path))).orderBy("path").collect()
    assert [r.path[-5:] for r in joined] == ["a.JPG", "b.png"] and joined[0].meta.width == 3 and (joined[1].meta is None or joined[1].meta.sha1 is None)
    assert files.images(spark, str(tmp_path), name_glob="*.txt", with_content=False).count() == 1
    sinks.contents(found, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_query_list(spark):
    lines = spark.createDataFrame([("a",), ("#x",), (" ",), (" b ",)], "value string")
    got = [r.query for r in files.queries(spark, ["q", "q"], lines, True).orderBy("ordinal").collect()]
    assert got[:4] == ["q", "q", "a", "b"] and got[4:] == list(files.BUILT_IN_QUERIES)


def test_pages_source(spark):
    entry = lambda n: {"objURL": f"http://h/{n}"}
    fetch = pages.captured({"q": [[entry(0), entry(1), {}], [entry(2)], []], "r": []})
    got = pages.read(spark, fetch, ["q", "r"], "captured_test", limit=2)
    assert [r.url for r in pages.keyword_urls(got).orderBy("page", "position").collect()] == ["http://h/0", "http://h/1"]
    assert pages.keyword_urls(pages.read(spark, fetch, ["q", "r"], "captured_all")).count() == 3
    similar = spark.createDataFrame([("q", 0, 0, json.dumps({"thumbUrl": "http://t"})), ("q", 0, 1, json.dumps({"isVideo": True, "thumbUrl": "http://v"})), ("q", 0, 2, json.dumps({"objURL": "ftp://x", "thumbURL": "http://y"}))], pages.SCHEMA)
    assert [r.url for r in pages.similar_urls(similar).collect()] == ["http://t"]
    alone = spark.createDataFrame([("q", 0, 0, json.dumps({"objURL": "http://o", "middleURL": "http://m"})), ("q", 0, 1, json.dumps({"middleURL": "http://m"}))], pages.SCHEMA)
    assert [r.url for r in pages.similar_urls(alone).collect()] == ["http://m"]  # an entry without an image URL of its own goes


def test_similar_pages():
    context = {"ajax_params": {"a": "b c", "page_size": "99", "next": "1"}}
    assert pages.similar_request(context, 2, "http://x") == "http://x?a=b%20c&page_size=60&next=4&page=3"
    assert pages.similar_request({"ajax_params": {"pagesize": "x"}}, 0, "u") == "u?pagesize=x&page=1&page_size=30" and pages.similar_request({}, 0, "u") is None
    assert pages.fallback_request({"image": "i", "token": "t", "sign": None}, 1, "u") == "u?entrance=GENERAL&tpl_from=pc&sign=&carousel=5038&token=t&queryImageUrl=i&pn=30&rn=60"
    assert pages.fallback_request({"image": "i"}, 1, "u") is None
    page = '<img data-imgurl="http://b?x=1&amp;y" SRC="https://a"><img data-src="https://a" src="/c">'
    assert pages.fallback_entries(page) == [{"middleURL": "http://b?x=1&y"}, {"middleURL": "https://a"}]
    fetch = pages.similar_fetch({"s": context, "t": {"image": "i", "token": "t"}}, lambda u: {"data": {"list": [u]}}, lambda u: page, "http://x", "u")
    assert fetch("s", 60, 30)["data"][0].endswith("page=3") and len(fetch("t", 0, 30)["data"]) == 2 and fetch("z", 0, 30) == {}


def test_downloads(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, None), (4, "late"), (5, "odd")], "id int, url string")

    def get(u, calls={}):  # noqa: B006
        calls[u] = calls.get(u, 0) + 1
        if u == "bad" or (u == "late" and calls[u] < 2):
            raise ValueError(u)
        return {"content": u.encode(), "status": 200, "final_url": u}

    def codec(c):
        if c == b"odd":
            raise TypeError("codec")
        return c, ".jpg", 3, 4, "JPEG"

    rows = {r.id: r for r in download.download(df.coalesce(1), get, normalise=codec, wait=lambda s: None).collect()}
    assert [rows[k].error for k in (1, 2, 3, 4, 5)] == [None, "ValueError('bad')", "no URL", None, "TypeError('codec')"]
    assert (rows[4].content, rows[4].width, rows[4].ending, rows[4].status) == (b"late", 3, ".jpg", 200) and rows[5].content is None


def test_prompt_versions(spark, tmp_path):
    for k in (1, 2, 10):
        (tmp_path / f"judge_v{k}.txt").write_text(f"p{k}")
    (tmp_path / "notes.txt").write_text("x")
    known = prompts.versions(spark, str(tmp_path))
    assert known.count() == 3 and prompts.prompt(known, "judge") == "p10" and prompts.prompt(known, "judge", 2) == "p2"
    with pytest.raises(KeyError):
        prompts.prompt(known, "judge", 3)


def test_attempts_and_backoff():
    calls, waits = [], []

    def fail():
        calls.append(1)
        raise ValueError

    assert pages.attempts(fail, 3, waits.append) == {} and len(calls) == 3 and len(waits) == 2
    assert pages.backoff(50, rand=lambda a, b: 0) == 10 and pages.backoff(0, rand=lambda a, b: -1) == 0.1


def test_index_sinks(spark, tmp_path):
    path = str(tmp_path / "idx")
    entries = spark.createDataFrame([("b", 1), ("a", 2)], "path string, n int")
    sinks.append_index(entries, path)
    sinks.append_index(entries, path)
    assert spark.read.json(path).count() == 4
    sinks.rewrite_index(entries, path, dry_run=True)
    assert spark.read.json(path).count() == 4
    sinks.rewrite_index(spark.read.json(path).distinct(), path)
    assert [r.path for r in spark.read.json(path).collect()] == ["a", "b"]
    (tmp_path / "idx").rename(tmp_path / "idx.old")  # a crash between the two moves
    assert sinks.rewrite_index(entries.union(entries), path).count() == 4 and not (tmp_path / "idx.old").exists()
    (tmp_path / "idx").rename(tmp_path / "idx.old")
    assert sinks.restore_index(spark, path) and not sinks.restore_index(spark, path) and spark.read.json(path).count() == 4
    failed = spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "y")], "id string, error string")
    assert json.loads(sinks.error_document(failed).first().json) == {"count": 2, "errors": {"a": "w", "b": "y"}}
    assert not sinks.errors(entries.limit(0), str(tmp_path / "e")) and sinks.errors(entries, str(tmp_path / "e"))
    assert sinks.errors_path("a/b.jsonl") == "a/b.errors.json"
    sinks.routed(entries, F.col("n") == 1, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.is_dir()) == ["route=keep", "route=reject"]
    assert sinks.run_folder("r", "s", "t", frozenset({"r/s/t", "r/s/t-01"})) == "r/s/t-02"


def test_index_laws(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "path string, sha1 string")
    new = spark.createDataFrame([("b", "3"), ("c", None), ("d", "4")], "path string, sha1 string")
    s = index.summary(index.changes(old, new)).first()
    assert (s.added, s.removed, s.updated, s.same) == (1, 1, 1, 1)
    assert index.mode("_filtered_index.jsonl") == "filtered" and index.mode("x", {"target": "t"}) == "filtered" and index.mode("x") == "global"
    assert index.mode("/data/filtered/_global_index.jsonl", ["target"]) == "global" and index.mode("/filtered/x.jsonl") == "global" and index.mode("x", ["path", "target"]) == "filtered"
    there = {"r/_global_index.jsonl"}.__contains__
    assert index.find_index("r/", there) == "r/_global_index.jsonl" and index.find_index("a/Filtered", there) == "a/Filtered/_filtered_index.jsonl" and index.find_index("a", there, "b") == "b"


def test_dedup_is_idempotent_and_bands_find_all(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 61) for i in range(200)], "id long, code long")
    once = dedup.first_by_key(df, F.col("code"), ["id"]).select("id", "code")
    assert sorted(once.collect()) == sorted(dedup.first_by_key(once, F.col("code"), ["id"]).select("id", "code").collect())
    codes = [(i, (i * 7919) % 61) for i in range(80)]
    got = {(r.a, r.b) for r in dedup.banded_pairs(df.where("id < 80"), 2).collect()}
    first = {x: min(a for a, y in codes if y == x) for _, x in codes}
    want = {(min(a, b), max(a, b)) for x, a in first.items() for y, b in first.items() if x < y and (x ^ y).bit_count() <= 2}
    assert got == want
    crowded = [(r.a, r.b) for r in dedup.banded_pairs(df.where("id < 80"), 2, block=4).collect()]
    assert len(crowded) == len(want) and set(crowded) == want
    assert {(r.id, r.representative) for r in dedup.representatives(df.where("id < 80")).collect()} == {(a, first[x]) for a, x in codes}


def test_limits(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "i int")
    assert limits.limit_kept(df, ["i"], 0).count() == 10 and limits.limit_candidates(df, ["i"], 0).count() == 0
    own, seen = limits.counted(df, big=F.col("i") > 6)
    own.collect()
    assert seen.get == {"rows": 10, "big": 3}
    with pytest.raises(ValueError):
        limits.limit_candidates(df, ["i"], -1)
    assert [(r.i, r.ordinal) for r in limits.ordinal(df, ["i"]).orderBy("i").collect()] == [(i, i) for i in range(10)]


@pytest.mark.parametrize("partitions", [4, 200])
def test_ordinals_of_wide_tables(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        wide = spark.range(120_000).select(F.xxhash64("id").alias("k"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(8)).alias("pad"), F.array(F.lit("a"), F.col("id").cast("string")).alias("parts"))
        out = limits.ordinal(wide, ["k"])
        assert out.agg(F.count("*"), F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal")).first()[:] == (120_000, 120_000, 0, 119_999)
        assert out.where("ordinal % 1000 = 0").orderBy("ordinal").select("k").collect() == [r for i, r in enumerate(wide.orderBy("k").select("k").collect()) if i % 1000 == 0]
        named = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 > 0, F.concat(F.lit("n"), F.col("id") % 50)).alias("name"), "id")
        got = limits.with_collision_suffix(named, "name", ["id"]).orderBy("id").collect()
        seen: dict = {}
        for r in named.orderBy("id").collect():
            n = seen[r.name] = seen.get(r.name, -1) + 1
            assert got[r.id].name == (r.name if n == 0 or r.name is None else "%s-%02d" % (r.name, n))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_models(spark):
    few = spark.createDataFrame([(1, b"ok"), (2, b"bad"), (3, b"ok")], "id int, content binary").coalesce(1)

    def batch(contents):
        if b"bad" in contents:
            raise ValueError("bad")
        return [[1.0] for _ in contents]

    assert [r.v for r in few.select(models.embed(batch)(F.col("content")).alias("v")).collect()] == [[1.0], None, [1.0]]
    assert [(r.v.value, r.v.error) for r in few.select(models.detect(batch, True)(F.col("content")).alias("v")).collect()] == [([1.0], None), (None, "ValueError('bad')"), ([1.0], None)]
    df = spark.createDataFrame([(1, b"ok"), (2, b"bad")], "id int, content binary")

    def model(content, prompt):
        if content == b"bad":
            raise ValueError("no")
        return '{"decision":"keep"}'

    rows = {r.id: r for r in models.judge(df, model, "p", wait=lambda s: None).collect()}
    assert rows[1].response and rows[1].error is None and rows[2].response is None and "no" in rows[2].error
    norm = models.normalise_image(lambda c: (c, ".jpg", 1, 2, "JPEG") if c == b"ok" else 1 / 0)
    assert [r.ok for r in df.select(norm(F.col("content")).alias("x")).select("x.*").collect()] == [True, False]


def test_streams(spark, tmp_path):
    df = spark.createDataFrame([(i % 5, i) for i in range(20)], "k int, i int")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.file_stream(spark, str(tmp_path / "in"), df.schema, 1)
    ingest.run_to_end(ingest.distinct_stream(stream(), ["k"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    for _ in range(2):
        ingest.ingest_new(stream(), str(tmp_path / "index"), "k", ["i"], str(tmp_path / "ck2")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "index")).collect()) == [0, 1, 2, 3, 4]


def test_stop_rule_counts():
    class State:
        v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    p = ingest.StopAfterIdlePages(2)
    p.state = State()
    frame = lambda rows: iter([pd.DataFrame(rows, columns=["page", "n_entries", "n_new"])])
    a = next(p.handleInputRows(("s",), frame([(0, 5, 2), (1, 5, 0)]), None)).iloc[0]
    assert (a.pages, a.saved, a.idle, a.stopped) == (2, 2, 1, False)
    b = next(p.handleInputRows(("s",), frame([(2, 5, 0), (3, 5, 9)]), None)).iloc[0]
    assert (b.pages, b.saved, b.idle, b.stopped) == (3, 2, 2, True)
