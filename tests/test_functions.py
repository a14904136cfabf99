import hashlib
import json
import math

from pyspark.sql import functions as F

from siftworks.functions import text, vectors, verdict
from siftworks.operators import filters, scoring


def one(spark, expr, **values):
    schema = ", ".join(f"`{k}` {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def each(spark, f, items, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r["r"] for r in df.select("i", f(F.col("x")).alias("r")).orderBy("i").collect()]


def test_slug(spark):
    got = each(spark, text.slug, ["  室内 场景 日常 杂物 ", "A__b--C!!", "!!!", None, "Café Crème"])
    assert got == ["室内-场景-日常-杂物", "a__b-c", hashlib.sha1(b"!!!").hexdigest()[:12], None, "café-crème"]


def test_first_urls(spark):
    s = ("string", None)
    v = dict(h=("string", "ftp://x"), o=("string", "https://a"), t=s, r=("array<struct<ObjURL:string,FromURL:string>>", None))
    fields = [F.col(c) for c in "hot"]
    assert one(spark, text.first_valid_url(fields, F.col("r")), **v) == "https://a"
    assert one(spark, text.first_truthy_url(fields), **v) is None
    v["o"], v["r"] = s, ("array<struct<ObjURL:string,FromURL:string>>", [(None, "http://f")])
    assert one(spark, text.first_valid_url(fields, F.col("r")), **v) == "http://f"


def test_urls_and_pages(spark):
    assert each(spark, text.query_map, ["http://h/?a=1&b=&a=x%20y", "http://h/", None]) == [{"b": "", "a": "x y"}, {}, {}]
    assert one(spark, text.entry_image(F.col("o"), F.col("t"), F.col("m")), o=("string", "http://h/?imgurl=%2F%2Fi%2Fp.jpg&x=1"), t=("string", None), m=("string", "http://m")) == "https://i/p.jpg"
    assert one(spark, text.entry_image(F.col("o"), F.col("t"), F.col("m")), o=("string", None), t=("string", ""), m=("string", "http://m?a=1&amp;b")) == "http://m?a=1&b"
    page = '<a data-imgurl="//host/i.jpg">'
    assert each(spark, text.query_image, [page, "", None]) == ["https://host/i.jpg", None, None]
    assert each(spark, text.state_token, ["eyJzaW1pbGFyUmVzdWx0Ijp7InRva2VuIjoidCJ9fQ==", "###", "bm8="]) == ["t", None, None]
    context = one(spark, text.page_context(F.col("p"), main_url=F.col("u")), p=("string", '"token": "0123456789abcdef0" carousel: 5038 "image":"http://img12.host.com/a.jpg" '), u=("string", "http://h/?sign=s1"))
    assert (context.token, context.carousel, context.image, context.sign, context.ajax_params) == ("0123456789abcdef0", "5038", "http://img12.host.com/a.jpg", "s1", {})
    assert each(spark, text.image_urls, ["x http://a/b.jpg 'http://a/a.png' http://a/b.jpg"]) == [["http://a/a.png", "http://a/b.jpg"]]
    assert each(spark, text.unescape_all, ["a &eacute;&#x41; &amp;lt;", None]) == ["a éA &lt;", None]
    b = chr(92)  # escapes are put together here, so that no tool decodes them in this file
    said = [f"a{b}u0026b{b}/c{b}u003Dd", f"{b}ud83d{b}ude00x{b}u00E9", f"{b}ud83d{b}n", "plain", None, ""]
    assert each(spark, text.unescape_backslashes, said) == ["a&b/c=d", chr(0x1F600) + "x" + chr(0xE9), said[2], "plain", None, ""]
    ajax = f'"https:{b}/{b}/h{b}/ajax?a=1{b}u0026b=2"'
    assert one(spark, text.page_context(F.col("p")), p=("string", ajax)).ajax_params == {"a": "1", "b": "2"}
    assert one(spark, text.build_url("b", [("k", F.lit("a b"))], True)) == "b?k=a%20b"
    assert each(spark, text.deobfuscate, ["AzdH3Fw"]) == ["/a"]


def test_uploads(spark):
    got = each(spark, lambda c: text.upload_context(c, "http://h/s?sign={sign}"), ['{"data":{"querySign":"q","url":"http://p"}}', '{"data":{"sign":"s"}}', '{"data":{"url":"http://p?sign=u"}}', "x"])
    assert [(r.sign, r.page_url) for r in got] == [("q", "http://p"), ("s", "http://h/s?sign=s"), ("u", "http://p?sign=u"), (None, None)]
    assert len(one(spark, text.log_id())) == 19


def test_item_fields(spark):
    assert each(spark, text.page_size, ["10", "45", "99", "x", None]) == [30, 45, 60, 30, 30]
    assert one(spark, text.identifier([F.col("a"), F.col("b")], F.lit(7)), a=("string", None), b=("string", "")) == "row-00007"
    assert each(spark, lambda c: text.choose_sha1(F.lit(None).cast("string"), c), ["d/" + "A" * 40 + ".jpg", "d/x.jpg"]) == ["a" * 40, None]
    assert each(spark, text.mime, ["a.JPG", "b.tar.gz", "c"]) == ["image/jpeg", "application/octet-stream", "application/octet-stream"]
    assert len(one(spark, text.data_url(F.col("c"), F.lit("a.png")), c=("binary", b"x" * 300))) == len("data:image/png;base64,") + 400
    assert each(spark, lambda c: text.relative_path(c, "/r/"), ["/r/a/b", "/ra/b"]) == ["a/b", "/ra/b"]


def test_codes(spark):
    assert one(spark, vectors.pack_bits(F.col("b")), b=("array<boolean>", [True, False, True])) == 5
    assert one(spark, vectors.difference_hash(F.col("p")), p=("array<int>", list(range(72, 0, -1)))) == -1
    assert one(spark, vectors.difference_hash(F.col("p")), p=("array<int>", [1])) is None
    assert one(spark, vectors.hamming(F.lit(-1).cast("long"), F.lit(0).cast("long"))) == 64
    assert math.isclose(one(spark, vectors.cosine(F.col("a"), F.col("b")), a=("array<float>", [1.0, 0.0]), b=("array<float>", [1.0, 1.0])), math.sqrt(0.5))
    assert each(spark, vectors.object_count, [[0.5, 0.4], None], "array<double>") == [1, 0]


def test_filters(spark):
    assert each(spark, lambda c: filters.hash_band(c), [4, 5, 18, 19, None], "int") == [False, True, True, False, True]
    assert each(spark, lambda c: filters.indoor(F.lit(0.5), c), [0.5, 0.25, math.nan, None], "double") == [False, True, False, False]
    assert each(spark, filters.comment_or_blank, ["", " ", "#x", " #x", "x"]) == [True, True, True, False, False]
    assert each(spark, filters.non_empty_entry, ["{}", '{"a":1}', "[1]", "x", None]) == [False, True, False, False, False]
    assert each(spark, lambda c: filters.still_image(c, F.lit(False)), ["Pic", None, "video"]) == [True, True, False]
    assert one(spark, filters.size_and_aspect(F.lit(1000), F.lit(300))) is False
    assert one(spark, filters.size_and_aspect(F.lit(1000), F.lit(300), active=False)) is True


def test_verdicts(spark):
    assert each(spark, verdict.decision, [" KEEP ", "maybe", None]) == ["keep", "reject", "reject"]
    assert each(spark, verdict.score, ["0.7", "x", "1.5", "-1", None]) == [0.7, 0.0, 1.0, 0.0, 0.0]
    assert each(spark, verdict.reason, ["x" * 200, None]) == ["x" * 160, ""]
    assert each(spark, lambda c: verdict.tags_of_text(c, 8), ["Cup; cup/ Book、pen", None]) == [["cup", "book", "pen"], []]
    got = each(spark, verdict.normalise, ['{"decision":"keep","score":2,"room_tags":["A",null,5],"object_tags":7}', "[1]", "{", None])
    assert got[0].ok and (got[0].decision, got[0].score, got[0].room_tags, got[0].object_tags, got[0].reason) == ("keep", 1.0, ["a", "5"], [], "")
    assert [g.ok for g in got[1:]] == [False] * 3 and got[1].decision is None and got[1].error
    raw = json.loads(got[0].raw_response)
    assert raw == {"decision": "keep", "score": 1.0, "reason": "", "room_tags": ["a", "5"], "object_tags": []}
    assert json.loads(each(spark, verdict.normalise, ['{"x":{"y":[1,null]},"score":"7"}'])[0].raw_response) == {"x": {"y": [1, None]}, "decision": "reject", "score": 1.0, "reason": "", "room_tags": [], "object_tags": []}
    assert each(spark, verdict.response_text, ['{"output":[{"type":"reasoning"},{"content":[{"text":" "},{"text":{"value":"v"}},{"text":"z"}]}]}', '{"output":[{"content":7}],"output_text":"t"}', '{"message":{"content":5},"response":" r "}', '{"output":[]}']) == ["v", "t", "r", None]
    assert each(spark, verdict.response_text, ['{"message":{"content":" {} "}}', '{"output":[{"content":[{"text":"a"}]}]}', "x"]) == ["{}", "a", None]


def test_recorded_score_log_obeys_its_rule(spark, tmp_path):
    from siftworks.sources import files, sinks

    rows = [(f"{'%040x' % i}.jpg", 0.25, 0.2, 0.2, 0.3, 0.1, 9) for i in range(5)]
    df = spark.createDataFrame(rows, files.SCORE_LOG)
    sinks.score_log(df.where(filters.indoor(F.col("indoor"), F.col("outdoor"))), str(tmp_path / "log"))
    part = next(p for p in (tmp_path / "log").iterdir() if p.name.startswith("part-"))
    assert b"\r\n" in part.read_bytes()
    assert files.score_log(spark, str(tmp_path / "log")).count() == 5


def test_prompt_scores_have_one_column_each(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0])], "id int, embedding array<float>")
    prompts = spark.createDataFrame([("indoor", [1.0, 0.0]), ("outdoor", [0.0, 1.0]), ("other", [1.0, 1.0])], "name string, prompt_vector array<float>")
    row = scoring.prompt_scores(items, prompts).first()
    assert (row.indoor, row.outdoor, row.tidy) == (1.0, 0.0, None)
