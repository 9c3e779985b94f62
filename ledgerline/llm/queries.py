"""Registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.jaccard_join import ngram_jaccard
from ledgerline.llm.lm_score import lm_scores
from ledgerline.llm.packing import best_fit_packing
from ledgerline.llm.align import align, link_counts
from ledgerline.llm import bpe, quality, warc
from ledgerline.llm.decontaminate import contaminated
from ledgerline.llm.licenses import scan_licenses
from ledgerline.llm.merkle import document_manifest
from ledgerline.llm.pii import BASE, find_pii
from ledgerline.llm.substring_dedup import substring_dedup
from ledgerline.llm.topk_search import exact_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: A text counts as good from this score on.
QUALITY_BAR = 0.3


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents"))


@register("op2_lm_score")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP3_SQL = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as x from p),
b as (select *, max(page_id) over (partition by x) as first from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  {" || ".join(f"substr({B32}, 1 + ((cast('0x' || substr(x, {1 + 5 * i}, 5) as integer) >> {s}) & 31), 1)" for i in range(8) for s in (15, 10, 5, 0))} as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from b
"""


@register("op3_warc_round_trip", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _listing(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op4_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_listing(base), 256).alias("base_sha256"), _listing(spans).alias("spans"))


@register("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"))


def pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@register("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
                      F.size("factors").cast("bigint").alias("n_factors"))


OP9_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as q
  from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""


@register("op9_exact_top_k", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where("vec_id % 20 = 0"))


@register("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _leaf_sql(text: str) -> str:
    field = lambda c: f"coalesce(cast(octet_length(encode(cast({c} as varchar))) as varchar) || ':' || cast({c} as varchar), '-')"
    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11_SQL = f"""
with recursive
crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
          lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t),
docs as (
  select row_number() over () as r, doc_id, coalesce(':' || source, '') as tree, {_leaf_sql("text")} as h,
    case when xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
                              lambda a, c: xor(a >> 8, t[1 + (xor(a, c) & 255)])), 4294967295) % 5 = 0
         then {_leaf_sql(f"translate(text, '{LETTERS[0]}', '{LETTERS[1]}')")} end as h_now
  from documents, crc),
leaf as (select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as i, count(*) over (partition by tree) as n from docs),
low(tree, lvl, i, h, n) as (
  select tree, 0, i, h, n from leaf
  union all
  select tree, lvl + 1, i // 16, sha256(string_agg(h, '' order by i)), (n + 15) // 16 from low where n > 1 group by tree, lvl, i // 16, n),
subroot as (select tree, lvl, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from low where n = 1),
high(lvl, i, h, n) as (
  select 0, i, h, n from subroot
  union all
  select lvl + 1, i // 16, sha256(string_agg(h, '' order by i)), (n + 15) // 16 from high where n > 1 group by lvl, i // 16, n),
top as (select h from high where n = 1),
node as (select tree, lvl, i, h from low where n > 1
  union all select s.tree, s.lvl + g.lvl, g.i, g.h from subroot s cross join high g where g.n > 1),
spot as (select l.r, w.tree, w.lvl, case when w.lvl < s.lvl then l.i // power(16, w.lvl)::bigint else s.i // power(16, w.lvl - s.lvl)::bigint end as i
  from leaf l join subroot s using (tree) join (select distinct tree, lvl from node) w using (tree)),
run as (select p.r, p.lvl, p.i, list(x.h order by x.i) as hs, list(x.i order by x.i) as js
  from spot p join node x on x.tree = p.tree and x.lvl = p.lvl and x.i // 16 = p.i // 16 group by p.r, p.lvl, p.i),
proof as (select r, string_agg(array_to_string(list_transform(list_filter(list_zip(hs, js), lambda z: z[2] <> i), lambda z: z[1]), ''), '' order by lvl) as p
  from run group by r),
folded(r, lvl, h) as (
  select r, 0, coalesce(h_now, h) from leaf
  union all
  select f.r, f.lvl + 1, sha256(array_to_string(list_transform(list_zip(u.hs, u.js), lambda z: case when z[2] = u.i then f.h else z[1] end), ''))
  from folded f join run u on u.r = f.r and u.lvl = f.lvl),
last as (select r, max_by(h, lvl) as h from folded group by r)
select l.doc_id, l.h as leaf, s.h as subroot, top.h as root, sha256(coalesce(p.p, '')) as proof_sha256, z.h as folded_root, z.h = top.h as verified
from leaf l join subroot s using (tree) cross join top left join proof p on p.r = l.r join last z on z.r = l.r
"""


@register("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspect = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = document_manifest(table(spark, sf_dir, "documents"), suspect, {"text": F.translate("text", *LETTERS)})
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


@register("op12_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op13_align")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    aligned = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    found = link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
