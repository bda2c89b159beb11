"""The corpus operators as registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returns_analytics.llm import (
    chat,
    decontaminate,
    fim,
    jaccard,
    langid,
    line_dedup,
    neighbours,
    packing,
    suffix_dedup,
    token_files,
    toxicity,
    vafile,
    warc,
)

#: Tokenizer files of the queries; parameters of their operators.
def _tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents"), digest=True)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        says.alias("text"),
    )
    return chat.digest(rows.unionByName(extra))


_OP3 = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)
),
written as (
  select *, 12 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;')) + 1
            + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + 11 as n
  from rows
),
joined as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
         coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
         sum(n) as n
  from written group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(n as bigint) as formatted_chars
from joined
"""


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(_table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.link(_table(spark, folder, "embeddings"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(_table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), _tokenizer())


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest(_table(spark, folder, "pages"))


_OP10 = """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
),
largest as (select hex, payload_bytes, max(page_id) as kept from payloads group by all),
written as (
  select p.*, kept,
         list_reduce(list_transform(range(0, 8), lambda k: list_reduce(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((cast('0x' || substr(hex, cast(5 * k + 1 as int), 5) as int) >> s) & 31), 1)),
           lambda a, b: a || b)), lambda a, b: a || b) as payload_digest
  from payloads p join largest using (hex, payload_bytes)
)
select page_id, payload_bytes, payload_digest,
       case when kept = page_id then 'response' else 'revisit' end as record_type,
       case when kept = page_id then null else kept end as refers_to, true as block_ok
from written
"""



def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.digest(_table(spark, folder, "embeddings"))


def _kmeans_sql(clusters: int = vafile.CLUSTERS, rounds: int = vafile.ROUNDS) -> str:
    """The rounds written out, every vector against every centroid."""
    steps = [
        """kept as (
  select row_number() over (order by sha256('2:' || vec_id::varchar), vec_id) as r, vec_id,
         list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"c0 as (select r - 1 as cluster, v from kept where r <= {clusters})",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} as (
  select vec_id, v, cluster, distance from (
    select k.vec_id, k.v, c.cluster,
           list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::bigint as distance
    from kept k, c{n} c
  ) qualify row_number() over (partition by vec_id order by distance, cluster) = 1
)"""
        )
        if n < rounds:
            steps.append(
                f"""t{n} as (
  select cluster, i, sum(x) as s, count(*) as n
  from (select cluster, unnest(range(1, 65)) as i, unnest(v) as x from a{n}) group by cluster, i
),
m{n} as (
  select cluster, list(((s - ((s % n) + n) % n) / n)::bigint order by i) as v from t{n} group by cluster
),
c{n + 1} as (select c.cluster, coalesce(m.v, c.v) as v from c{n} c left join m{n} m using (cluster))"""
            )
    return f"""
with {", ".join(steps)}
select a.vec_id, a.cluster::int as cluster, a.distance,
       sum(a.distance) over (partition by a.cluster)::bigint as cluster_inertia, sum(a.distance) over ()::bigint as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c using (cluster)
"""


def op12_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.digest(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digest(_table(spark, folder, "documents"))


_OP13 = """
with hashed as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || doc_id::varchar) as h
  from documents
),
cuts as (
  select *, cast('0x' || substr(h, 1, 8) as bigint) % (n + 1) as one, cast('0x' || substr(h, 9, 8) as bigint) % (n + 1) as two,
         cast('0x' || substr(h, 17, 8) as bigint) % 100 as three, cast('0x' || substr(h, 25, 8) as bigint) % 100 as four
  from hashed
),
parts as (
  select doc_id, text, n, least(one, two) as p, abs(one - two) as m,
         case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or three >= 90 then 'plain'
              when four < 20 then 'spm' else 'psm' end as form
  from cuts
),
cut as (
  select *, substr(text, 1, p) as prefix, substr(text, p + 1, m) as middle, substr(text, p + m + 1) as suffix from parts
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then p end as prefix_chars,
       case when form <> 'plain' then m end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_warc": op10_warc,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_token_id_output": op12_token_id_output,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLES: dict[str, str] = {
    "op3_chat_formatting": _OP3,
    "op10_warc": _OP10,
    "op11_centroid_clustering": _kmeans_sql(),
    "op13_fill_in_middle": _OP13,
}
