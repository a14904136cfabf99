import json

from pyspark.sql import functions as F

from siftworks.functions import models
from siftworks.plans import stages
from siftworks.sources import pages


def content(df):
    return df.withColumn("content", F.encode(F.regexp_replace("url", r"\?.*$", ""), "UTF-8"))


def test_keyword_crawl(spark):
    e = lambda u: {"objURL": u}
    fetch = pages.captured({"a b": [[e("http://1"), e("http://2")], [e("http://1"), e("ftp://x"), e("http://3")]], "c": [[e("http://4?x"), e("http://4?y")]]})
    known = spark.createDataFrame([(None, "http://2")], "sha1 string, url string").withColumn("url_md5", F.md5("url"))
    got = stages.keyword_crawl(spark, fetch, ["a b", "c"], known, limit_per_query=2)
    assert sorted((r.slug, r.url) for r in got.collect()) == [("a-b", "http://1"), ("a-b", "http://3"), ("c", "http://4?x"), ("c", "http://4?y")]
    got = stages.keyword_crawl(spark, fetch, ["c"], known, download=content)
    assert [r.url for r in got.collect()] == ["http://4?x"]
    sized = lambda df: content(df).withColumns({"width": F.lit(100), "height": F.lit(500)})
    assert stages.keyword_crawl(spark, fetch, ["c"], download=sized).count() == 0
    assert stages.keyword_crawl(spark, fetch, ["c"], download=sized, debug=True).count() == 1


def test_crawl_pages_until_enough_is_saved(spark):
    """Most entries are known or repeated, so the limit is reached on late pages only."""
    e = lambda k: {"objURL": f"http://{k}"}
    fetch = pages.captured({"q": [[e(k % 7) for k in range(p, p + 10)] if p < 20 else [e(100 + p)] for p in range(30)], "r": [[e(500)]]})
    known = spark.range(7).select(F.md5(F.concat(F.lit("http://"), "id")).alias("url_md5"), F.lit(None).cast("string").alias("sha1"))
    got = stages.keyword_crawl(spark, fetch, ["q", "r"], known, limit_per_query=4, page_size=10).collect()
    assert sorted(r.url for r in got) == [f"http://{100 + p}" for p in range(20, 24)] + ["http://500"]
    same = lambda df: df.withColumn("content", F.encode(F.lit("one"), "UTF-8"))
    assert stages.keyword_crawl(spark, fetch, ["q"], known, limit_per_query=4, page_size=10, download=same).count() == 1


def test_reverse_search(spark):
    fetch = pages.captured({"s": [[{"thumbUrl": f"http://{n}"} for n in range(4)]]})
    seeds = spark.createDataFrame([("s", 0)], "seed string, code long")
    codes = {"http://0": 0, "http://1": 0b11111, "http://2": (1 << 30) - 1, "http://3": 0b111111}
    coded = lambda df: content(df).withColumn("code", F.element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), F.col("url")).cast("long"))
    got = stages.reverse_search(spark, fetch, seeds, download=coded)
    assert sorted((r.url, r.distance) for r in got.collect()) == [("http://1", 5), ("http://3", 6)]
    assert stages.reverse_search(spark, fetch, seeds, download=coded, phash=False, limit_per_seed=3).count() == 3


def test_prefilter(spark):
    items = spark.createDataFrame([(f"p{i}", c) for i, c in enumerate([b"in", b"out", b"in", b"few"])], "path string, content binary")
    prompts = spark.createDataFrame([(n, v) for n, v in zip(("indoor", "outdoor", "tidy", "messy", "moderate"), ([1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [1.0, 0.0], [1.0, 0.0]))], "name string, prompt_vector array<float>")
    embed = models.embed(lambda b: [[0.0, 1.0] if c == b"out" else [1.0, 0.0] for c in b])
    detect = models.detect(lambda b: [[0.9] * (1 if c == b"few" else 9) for c in b])
    got = stages.prefilter(items, prompts, embed, detect, object_count_min=5)
    assert [(r.path, r.object_count, r.indoor) for r in got.collect()] == [("p0", 9, 1.0)]
    assert stages.prefilter(items, prompts, embed, limit=1).count() == 1


def test_fine_filter(spark):
    items = spark.createDataFrame([("a", "a.jpg", b"keep"), ("b", "b.jpg", b"low"), ("c", "c.jpg", b"bad"), ("d", "d.jpg", b"list")], "id string, image_path string, content binary")

    def model(content, prompt):
        if content == b"bad":
            raise ValueError("no answer")
        return "[1]" if content == b"list" else json.dumps({"decision": "keep", "score": 0.9 if content == b"keep" else 0.1, "object_tags": "x; X; y"})

    results, errors = stages.fine_filter(items, model, "prompt", wait=lambda s: None)
    assert sorted((r.id, r.decision, r.route, r.object_tags) for r in results.collect()) == [("a", "keep", "keep", ["x", "y"]), ("b", "keep", "reject", ["x", "y"])]
    assert {r.id: r.error for r in errors.collect()} == {"c": "ValueError('no answer')", "d": "no JSON object"}


def test_rebuild_index(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "d").mkdir(parents=True)
    (root / "d/a.jpg").write_bytes(b"a")
    (root / "d/a.json").write_text('{"sha1":"s","source":"http://s","final_url":"http://f"}')
    (root / "d/b.jpg").write_bytes(b"b")
    old = tmp_path / "_global_index.jsonl"
    old.write_text('{"sha1":"s","path":"d/a.jpg","url":"u"}\n{"sha1":"gone","path":"d/c.jpg"}\n')
    entries, changed = stages.rebuild_index(spark, str(root), str(old))
    got = {r.path: (r.sha1, r.url) for r in entries.collect()}
    assert got["d/a.jpg"] == ("s", "http://f") and got["d/b.jpg"][0] == "e9d71f5ee7c92d6dc9e92ffdad17b8bd49418f98"
    assert {r.path: r.change for r in changed.collect()} == {"d/a.jpg": "same", "d/b.jpg": "added", "d/c.jpg": "removed"}
    entries, _ = stages.rebuild_index(spark, str(root), kind="filtered")
    assert set(entries.columns) == {"sha1", "source", "target", "timestamp"}


def test_remove_seed_duplicates(spark):
    seeds = spark.createDataFrame([("s1", "x", 0)], "seed_id string, slug string, code long")
    items = spark.createDataFrame([("a", "x", 3), ("b", "x", 7), ("c", "y", 0)], "path string, slug string, code long")
    left, counts = stages.remove_seed_duplicates(items, seeds)
    assert sorted(r.path for r in left.collect()) == ["b", "c"] and {(r.seed_id, r.n_removed) for r in counts.collect()} == {("s1", 1), (None, 1)}
