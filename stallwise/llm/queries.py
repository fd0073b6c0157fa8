"""One query per operator: it applies the operator to its whole table and derives the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import alignment, bpe, classmodel, content, decontamination, jaccard, licenses, personal, quality, sharding, toxicity, tries, vectors, words

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def keep(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_class_bigrams")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classmodel.score(table(spark, sf_dir, "documents"), words.bucket_of_id("doc_id", 5) == 1)


@query("op2_license_windows")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.explode("licenses").alias("l")).select("doc_id", "l.*")


@query("op3_pairwise_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = words.bucket_of_id("doc_id", 5) == 0
    ranking = quality.learn(docs, table(spark, sf_dir, "labels"), "quality", ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score(F.col("text"), ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


@query("op4_edit_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


@query("op5_nearest_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = words.bucket_of_id("doc_id", 4) == 2
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    scored = toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity.score").alias("score"), F.col("toxicity.evidence.doc_id").alias("evidence")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


@query("op6_bootstrapped_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find(table(spark, sf_dir, "documents"))
    counts = [personal.count("base", kind).alias(f"n_{kind}") for kind in personal.KINDS]
    every = F.array_sort(F.array_union("base", "more"))
    return found.select("doc_id", *counts, F.sha2(personal.listed(F.col("base")), 256).alias("base_sha256"), personal.listed(every).alias("spans"))


@query("op7_pruned_graph_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op9_differencing_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.balanced(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op10_ngram_jaccard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"), k=3, percent=90)


@query("op11_tag_path_text")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = content.with_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op12_block_hash_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(tries.shared_starts(tries.turns(table(spark, sf_dir, "conversations"))))


# The CRC-32 of the id's digits, bit by bit; starts as digests of their turns' digests; subtrees by the smallest member's
# starts.
ORACLES["op12_block_hash_trie"] = r"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
), ids as (
  select conv_id, conv_id - conv_id % 20 as first_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, d: list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))
  )) % 4 as h
  from (select distinct conv_id from own)
), rebuilt as (
  select i.conv_id, 0 as part, o.place, o.role, o.text from ids i join own o on o.conv_id = i.first_id and o.place <= i.h
  union all
  select o.conv_id, 1, o.place, o.role, o.text from own o join ids i using (conv_id) where o.place > i.h
), placed as (
  select conv_id, row_number() over (partition by conv_id order by part, place) as depth, text,
    md5(concat(length(role), ':', role, text)) as own_key
  from rebuilt
), starts as (
  select conv_id, depth, text, md5(array_to_string(list(own_key) over (partition by conv_id order by depth), ',')) as key from placed
  union all
  select conv_id, 0, '', '' from ids
), linked as (
  select *, lag(key) over w as up, lead(key) over w is null as ends from starts window w as (partition by conv_id order by depth)
), nodes as (
  select depth, key, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs,
    (count(*) - 1) * any_value(len(regexp_extract_all(text, '[^ 	-]+'))) as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from linked group by depth, key
), children as (
  select depth - 1 as depth, up as key, count(*) as n_children from nodes where depth > 0 group by depth, up
), weighed as (
  select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (depth, key)
), sums as (
  select l.depth, l.key, sum(w.saved) as saved_tokens, count(*) filter (w.n_children = 0) as n_leaves
  from weighed w join linked l on l.conv_id = w.conv_id and l.depth <= w.depth group by l.depth, l.key
)
select w.conv_id, w.depth::bigint as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
  s.saved_tokens::bigint as saved_tokens, w.ends_sha256
from weighed w join sums s using (depth, key) left join weighed p on p.depth = w.depth - 1 and p.key = w.up
"""


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pieces = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(table(spark, sf_dir, "documents"), ranks, pieces, public_tokenizers.PATTERN)
