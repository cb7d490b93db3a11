"""The queries of this folder, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from conform.llm.byte_bpe import document_tokens
from conform.llm.divergence import source_divergence
from conform.llm.exact_dedup import document_duplicates
from conform.llm.fingerprints import document_fingerprints
from conform.llm.language_id import document_languages
from conform.llm.licenses import document_licenses
from conform.llm.ngram_join import similar_documents
from conform.llm.packing import document_sequences
from conform.llm.repeats import document_repeats
from conform.llm.secrets import document_secrets
from conform.llm.shards import document_shards
from conform.llm.toxicity import document_toxicity
from conform.llm.vector_codes import vector_codes
from conform.queries.registry import table

QUERIES = {}
ORACLE_SQL = {}


def _query(function, sql: str | None = None):
    QUERIES[function.__name__] = function
    if sql:
        ORACLE_SQL[function.__name__] = sql
    return function


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    documents = table(spark, sf_dir, "documents")
    return document_sequences(documents, vocabulary, public_tokenizers.PATTERN)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_repeats(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_secrets(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return document_tokens(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_duplicates(spark, f"{sf_dir}/documents.parquet")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_licenses(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(table(spark, sf_dir, "documents"))


_query(op1_packing)
_query(op2_ngram_join)
_query(op3_repeats)
_query(op4_toxicity)
_query(op5_secrets)
_query(op6_byte_bpe)
_query(
    op7_exact_dedup,
    r"""
    with texts as (
        select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body
        from documents
    )
    select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
           row_number() over (partition by body order by doc_id) = 1 as kept,
           sha256(body) as text_sha256
    from texts window same as (partition by body)
    """,
)
_query(op8_sharding)
_query(op9_licenses)
_query(op10_fingerprints)


def _rounds_sql(rounds: int) -> str:
    """Codebooks and assignments of each round, as named parts of one statement."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(
            f"""
    met{turn} as materialized (
        select p.row, p.part, min({{'far': list_sum(list_transform(list_zip(p.v, b.v),
               lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'entry': b.entry}}) as near
        from parts as p join book{turn} as b using (part) group by p.row, p.part
    )"""
        )
        if turn < rounds:
            steps.append(
                f"""
    book{turn + 1} as materialized (
        select part, entry, coalesce(n.v, b.v) as v
        from book{turn} as b left join (
            select part, entry, list(x order by i) as v
            from (select m.part, m.near.entry as entry, i,
                         floor(sum(p.v[i]) / count(*))::bigint as x
                  from met{turn} as m join parts as p using (row, part),
                       generate_series(1, len(p.v)) as g(i)
                  group by all)
            group by part, entry) as n using (part, entry)
    )"""
            )
    return ",".join(steps)


_query(
    op11_vector_codes,
    f"""
    with kept as materialized (
        select row_number() over (order by vec_id, embedding) as row, vec_id, label,
               list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
        from embeddings
        where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    parts as materialized (
        select row, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] as v
        from kept, range(4) as g(part)
    ),
    book0 as materialized (select part, row - 1 as entry, v from parts where row <= 256),
    {_rounds_sql(4)}
    select vec_id, string_agg(format('{{:02x}}', near.entry), '' order by part) as code,
           sum(near.far)::bigint as error,
           (sum(sum(near.far)) over (partition by label))::bigint as label_error,
           (select sha256(string_agg(x, ',' order by part, entry, i))
            from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as i
                  from book4)) as codebooks_sha256
    from met4 join kept using (row)
    group by row, vec_id, label
    """,
)
_query(
    op12_divergence,
    r"""
    with texts as (
        select coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
        from documents
    ),
    kept as materialized (
        select lang, term from (
            select lang, unnest(list_distinct(words)) as term from texts)
        group by all having count(*) >= 3
    ),
    sizes as (select lang, count(*) as size from kept group by lang),
    counted as materialized (
        select lang, source, term, count(*) as n
        from (select lang, source, unnest(words) as term from texts)
             join kept using (lang, term)
        group by all
    ),
    groups as materialized (
        select g.lang, g.source, coalesce(sum(n), 0) as mass
        from (select distinct lang, source from texts) as g
             left join counted as c on c.lang = g.lang and c.source = g.source
        group by all
    ),
    chances as materialized (
        select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
               (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.mass + s.size))::bigint
                   as p
        from groups as g join kept as k using (lang) join sizes as s using (lang)
             left join counted as c
                  on c.lang = g.lang and c.source = g.source and c.term = k.term
    ),
    whole as materialized (
        select lang, term,
               (1 + (1000000000::hugeint * (n + 1)) // (sum(n) over (partition by lang) + size))
                   ::bigint as q
        from (select lang, term, sum(n) as n from counted group by all)
             join sizes using (lang)
    ),
    pairs as (
        select a.lang, a.source, b.source as item,
               coalesce((select sum((p.p - q.p) * (p.p - q.p) // q.p)
                         from chances as p join chances as q using (lang, term)
                         where p.lang = a.lang and p.source = a.source and q.source = b.source),
                        0)::bigint as value
        from groups as a join groups as b on a.lang = b.lang and a.source <> b.source
    ),
    leaning as (
        select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value
        from chances join whole using (lang, term) where n > 0 and p > q
    )
    select lang, source, 'pair' as part, item, value,
           row_number() over (partition by lang, source order by value desc, item) as rank
    from pairs
    union all
    select lang, source, 'term', item, value,
           row_number() over (partition by lang, source order by value desc, item) as rank
    from leaning
    qualify rank <= 200
    """,
)
_query(op13_language_id)
