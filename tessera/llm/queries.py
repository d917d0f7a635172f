"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.collocations import collocations
from tessera.llm.common import n_words, store, table
from tessera.llm.embedding_dedup import embedding_dedup
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.graph_search import graph_search
from tessera.llm.lm_scoring import lm_score
from tessera.llm.mixing import mix, source_targets
from tessera.llm.near_dup import near_dup
from tessera.llm.packing import pack
from tessera.llm.quality import quality_scores
from tessera.llm.secret_scan import secret_scan
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.url_filter import url_filter
from tessera.llm.whitening import whiten

#: Fixed values of the contracts.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
WEIGHTS = [5.0, 2.0, 1.0]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation scores of all documents."""
    return lm_score(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trained quality scores of all documents."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored secret findings of all documents.  The candidate itself leaves
    the operator as a digest only."""
    found = secret_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "finding", F.sha2("candidate", 256).alias("candidate_sha256"),
                        F.length("candidate").alias("length"), "score", "held_out", "kept")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked vectors (cosine at least 0.9) of all embeddings."""
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised toxicity scores of all documents."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets agree in 75 of 100."""
    return near_dup(table(spark, sf_dir, "documents"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the fixed rules for all pages."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules)


def mix_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) mixed 5, 2, 1 over the sources: doc_id,
    size, source_size, target, taken."""
    sized = store(docs.select("doc_id", n_words(F.col("text")).alias("size"), "source"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    mixed = mix(sized.withColumn("sources", F.array("source")), WEIGHTS)
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    goal = source_targets(sizes, WEIGHTS, total)
    # One row per source, which mix() has bounded.
    return (mixed.withColumn("s", F.col("sources")[0])
            .join(F.broadcast(goal), F.col("s").eqNullSafe(F.col("source")))
            .select("doc_id", "size", "source_size", "target",
                    F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken")))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1."""
    return mix_documents(table(spark, sf_dir, "documents"))


def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings on their eight leading axes; a deviation that a
    long cannot hold is null here."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest others of every vector whose id 50 divides."""
    return graph_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lm_scoring,
    "op2_quality": quality,
    "op3_packing": packing,
    "op4_exact_dedup": exact_duplicates,
    "op5_secrets": secrets,
    "op6_embedding_dedup": near_vectors,
    "op7_toxicity": toxicity,
    "op8_near_dup": near_duplicates,
    "op9_url_filter": url_verdicts,
    "op10_mixing": mixing,
    "op11_whitening": whitened_vectors,
    "op12_collocations": phrases,
    "op13_graph_search": nearest_vectors,
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

SQL: dict[str, str] = {
    "op4_exact_dedup": """
select doc_id, max(doc_id) over t as keep_id, count(*) over t as group_size,
       doc_id is not distinct from max(doc_id) over t as kept, sha256(coalesce(text, '')) as text_sha256
from documents window t as (partition by coalesce(text, ''))""",
    "op9_url_filter": f"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path,
         row_number() over () as n
  from parts),
rules(r_host, r_path, verdict) as (values {_RULE_ROWS}),
best as (
  select n, arg_max(r_host || r_path, length(r_host) + length(r_path)) as rule,
         arg_max(verdict, length(r_host) + length(r_path)) as verdict
  from split join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
  group by n)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from split left join best using (n)""",
    "op12_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
runs as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from runs),
grams as (select lang, ws[i] as w1, ws[i + 1] as w2, ws[i + 2] as w3 from places),
one as (select lang, w1, count(*) as f from grams group by all),
two as (select lang, w1, w2, count(*) as a from grams where w2 is not null group by all having count(*) >= 10),
three as (select lang, w1, w2, w3, count(*) as a from grams where w3 is not null group by all having count(*) >= 10),
longer as (
  select lang, w1, w2, max(a) as most from (
    select lang, w1, w2, a from three union all select lang, w2, w3, a from three) group by all),
cuts as (
  select lang, w1 || ' ' || w2 as phrase, a, 1 as k, x.f as l, y.f as r
  from two left join longer using (lang, w1, w2) join one x using (lang, w1)
       join one y on y.lang = two.lang and y.w1 = two.w2
  where 100 * coalesce(most, 0) < 50 * a
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, x.f, y.a
  from three t join one x using (lang, w1) join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, x.a, y.f
  from three t join two x using (lang, w1, w2) join one y on y.lang = t.lang and y.w1 = t.w3),
scored as (select *, cast(1000000::hugeint * a * a // (l::hugeint * r) as bigint) as score from cuts),
weakest as (
  select *, row_number() over (partition by lang, phrase order by score, k) as turn from scored),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from weakest where turn = 1)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, score
from ranked join (select lang, sum(f) as n from one group by lang) using (lang) where rank <= 2000""",
}
