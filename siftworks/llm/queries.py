"""The registered queries of this subpackage and, where SQL can state them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import ann, cover_tree, lm, packing, pieces, pii, quality, simhash, substring, urls
from .staging import stage


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", "kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    n = {f"n_{k}": count(k) for k in ("email", "ip", "card", "phone")}
    base = F.filter("spans", lambda x: x["kind"].isin("email", "ip", "card", "phone"))
    return out.select("doc_id", *(c.alias(k) for k, c in n.items()), F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = stage(quality.features(table(spark, sf_dir, "documents")), "features")
    model = quality.fit(feats.where(~quality.held_out()), table(spark, sf_dir, "labels"))
    out = quality.score(feats, model)
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("score", 9).alias("score"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.b FROM r JOIN l ON l.a = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON x = vec_id LEFT JOIN n ON a = vec_id
"""

OP6_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d),
h AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h FROM g),
f AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
s AS (SELECT h.doc_id, k FROM h JOIN f USING (h) WHERE least < h.doc_id),
e AS (SELECT doc_id, i, sum(t) OVER (PARTITION BY doc_id ORDER BY i) AS cover FROM (SELECT doc_id, i, sum(t) AS t FROM (SELECT doc_id, k AS i, 1 AS t FROM s UNION ALL SELECT doc_id, k + 50, -1 FROM s) GROUP BY 1, 2)),
y AS (SELECT x.doc_id, x.i, x.word, coalesce(e.cover, 0) > 0 AS gone FROM x ASOF LEFT JOIN e ON x.doc_id = e.doc_id AND x.i >= e.i)
SELECT d.doc_id, len(any_value(d.w)) AS n_words, count(*) FILTER (y.gone) AS n_removed,
  sha256(coalesce(string_agg(y.word, ' ' ORDER BY y.i) FILTER (NOT y.gone), '')) AS kept_sha256 FROM d LEFT JOIN y ON y.doc_id = d.doc_id GROUP BY d.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_cover_tree": op1_cover_tree, "op2_simhash": op2_simhash, "op3_pii": op3_pii, "op4_quality": op4_quality, "op5_lm": op5_lm, "op6_substring": op6_substring, "op7_urls": op7_urls, "op8_ann": op8_ann, "op9_sentencepiece": op9_sentencepiece, "op10_packing": op10_packing}


def oracle_sql() -> dict[str, str]:
    return {"op1_cover_tree": OP1_SQL, "op6_substring": OP6_SQL, "op7_urls": urls.oracle_sql()}
