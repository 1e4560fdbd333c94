"""Registered queries of the training-data operators (production parameters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    ngram_join,
    page_text,
    prefix_audit,
    quality,
    secret_scan,
    sharding,
    simhash,
    suffix_dedup,
    token_store,
    url_filter,
)
from ledgerlift.llm.common import scratch_path, table


def op1_sharding(spark, sf_dir):
    out = sharding.interleave(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")


def op2_quality_rules(spark, sf_dir):
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "score")


def op3_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    """The text of a public tokenizer's file (about 2 MB; read on the driver)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op4_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_json())
    return token_store.read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


def op7_bpe(spark, sf_dir):
    return bpe.with_digests(bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_json()))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.with_digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op8_decontamination(spark, sf_dir):
    return decontaminate.contaminated_documents(table(spark, sf_dir, "documents"),
                                                table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_page_text(spark, sf_dir):
    return page_text.extract_text(table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end"))
    return hard_negatives.mine(rows)


def op13_source_divergence(spark, sf_dir):
    return prefix_audit.audit(table(spark, sf_dir, "documents"))


QUERIES = {"op1_sharding": op1_sharding, "op2_quality_rules": op2_quality_rules,
           "op3_ngram_jaccard_join": op3_ngram_jaccard_join, "op4_token_files": op4_token_files,
           "op5_url_filter": op5_url_filter, "op6_suffix_dedup": op6_suffix_dedup,
           "op7_bpe": op7_bpe, "op8_decontamination": op8_decontamination,
           "op9_page_text": op9_page_text, "op10_secret_scan": op10_secret_scan,
           "op11_simhash": op11_simhash, "op12_hard_negatives": op12_hard_negatives,
           "op13_source_divergence": op13_source_divergence}


_DUPLICATES_SQL = r"""
with recursive sets as (
  select doc_id, [x for x in string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
shingles as (
  select doc_id, list_distinct(case when len(w) >= 5
           then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from sets),
sizes as (select doc_id, len(s) as n from shingles),
tokens as materialized (select doc_id, unnest(s) as t from shingles),
common as materialized (select t from tokens group by t having count(*) > 1),
shared as materialized (select doc_id, md5(t) as t from tokens join common using (t)),
alive as (select doc_id, n from sizes join (select doc_id, count(*) as m from shared group by doc_id)
          using (doc_id) where 100 * m >= 75 * n),
part as materialized (select * from shared join alive using (doc_id)),
links as materialized (
  select x.doc_id as a, y.doc_id as b from part x join part y on x.t = y.t and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach as (
  select doc_id, doc_id as root from sizes
  union select l.b, r.root from reach r join links l on l.a = r.doc_id)
select doc_id, n as n_shingles, min(root) as component_id
from sizes join reach using (doc_id) group by doc_id, n
"""

_NEGATIVES_SQL = r"""
with rows as materialized (
  select row_number() over () as r, vec_id,
         case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
anchors as (select * from rows where vec_id % 100 = 0),
scored as materialized (
  select a.r as anchor, a.vec_id as anchor_id, x.r, x.vec_id, x.label = a.label as same,
         cast(list_inner_product(a.q, x.q) as bigint) as score
  from anchors a join rows x on a.r <> x.r),
positives as (
  select *, row_number() over (partition by anchor order by score desc, vec_id) as place
  from scored where same),
negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score,
         n.score as negative_score,
         row_number() over (partition by p.anchor, p.r order by n.score desc, n.vec_id) as place
  from positives p join scored n on n.anchor = p.anchor and not n.same
  where p.place <= 5 and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score
from negatives where place <= 10
"""

_DIVERGENCE_SQL = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
used as materialized (
  select d, lang, source, term, count(*) as c
  from (select d, lang, source, unnest(terms) as term from docs) group by all),
kept as materialized (select lang, term from used group by lang, term having count(*) >= 10),
sizes as (select lang, count(*) as v from kept group by lang),
counts as materialized (
  select lang, source, term, sum(c) as c from used join kept using (lang, term) group by all),
groups as (select distinct lang, source from docs),
sums as (select lang, source, sum(c) as n from counts group by lang, source),
shares as materialized (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
         cast(1 + (cast(1000000000 as hugeint) * (coalesce(c.c, 0) + 2)) // (coalesce(s.n, 0) + 2 * z.v) as hugeint) as p
  from groups g join kept k using (lang) join sizes z using (lang)
  left join sums s on s.lang = g.lang and s.source = g.source
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
whole as (
  select lang, term, cast(1 + (cast(1000000000 as hugeint) * (c + 2)) // (n + 2 * v) as hugeint) as q
  from (select lang, term, sum(c) as c from counts group by lang, term)
  join (select lang, sum(c) as n from counts group by lang) using (lang) join sizes using (lang)),
gaps as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join gaps g on g.lang = a.lang and g.source = a.source and g.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // (p + q) as value
  from shares join whole using (lang, term) where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as place
  from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(place as integer) as rank
from ranked where part = 'pair' or place <= 10
"""

ORACLE_SQL: dict[str, str] = {"op3_ngram_jaccard_join": _DUPLICATES_SQL, "op12_hard_negatives": _NEGATIVES_SQL,
                              "op13_source_divergence": _DIVERGENCE_SQL}
