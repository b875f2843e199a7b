"""The operators as queries over the given tables, and SQL checks where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, divergence, html_text, langid, minhash, passages, prefix_trie,
               quality, suffixes, toxicity, vectors, warc)
from .common import saved, table


#: The vocabulary file used by the queries.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    """Content of the public vocabulary file."""
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that nearly repeat one of an earlier document."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, vocabulary(), digests=True).drop("text")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, and where."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train(pages)).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every vector, and its number of links."""
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in which a damaged replica of the pages' archive differs, and where."""
    pages = table(spark, sf_dir, "pages")
    replicas = [saved(warc.leaves(warc.archive(p)), f"warc-{name}") for name, p in
                (("one", pages), ("other", warc.damaged_replica(pages)))]
    height = warc.height_for(*replicas)
    one, other = (warc.tree(r, height, "warc-tree") for r in replicas)
    damage = saved(warc.audit(one, other, height), "warc-damage")
    return warc.located(damage, replicas[0])


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat a string of 100 bytes standing earlier."""
    found = suffixes.repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page."""
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that set them apart."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations, with its subtree's totals."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    score = F.col("quality_score")
    return quality.score(documents, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"))


_OP8_SQL = """
with replica as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as one,
         coalesce(case page_id % 1009 when 17 then null
                    when 18 then left(html, greatest(length(html) - 1, 0))
                    when 19 then '~' || substring(html, 2) else html end, '') as other,
         page_id % 1009 = 17 as lost
  from pages),
sized as (
  select *, 99 + strlen(url) + strlen(one) + length(strlen(one)::varchar) as n_bytes,
         99 + strlen(url) + strlen(other) + length(strlen(other)::varchar) as other_size
  from replica),
placed as (
  select *, page_id // 256 as file,
         coalesce(sum(n_bytes) over (partition by page_id // 256 order by page_id
           rows between unbounded preceding and 1 preceding), 0)::bigint as "offset"
  from sized)
select page_id as position, file, "offset", n_bytes::bigint as n_bytes,
       (case when not lost then other_size end)::bigint as other_bytes,
       case when lost then 'missing' when n_bytes <> other_size then 'length'
            else 'content' end as damage
from placed where lost or one <> other
"""


_OP11_SQL = """
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
w as (
  select doc, lang, source,
         unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from d),
kept as (
  select lang, term, count(*)::hugeint as n from w group by all having count(distinct doc) >= 30),
langs as (select lang, count(*) as v, sum(n)::hugeint as total from kept group by all),
cells as (
  select w.lang, w.source, w.term, count(*)::hugeint as n
  from w join kept using (lang, term) group by all),
grouped as (
  select g.lang, g.source, coalesce(any_value(v), 0) as v,
         coalesce(any_value(l.total), 0) as lang_total, coalesce(sum(c.n), 0)::hugeint as total
  from (select distinct lang, source from d) g
  left join langs l on l.lang = g.lang
  left join cells c on c.lang = g.lang and c.source = g.source
  group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as p,
         1 + (1000000000 * (k.n + 5)) // (g.lang_total + 5 * g.v) as q
  from grouped g join kept k on k.lang = g.lang
  left join cells c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all),
ranked as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from grouped a join grouped b on a.lang = b.lang and a.source <> b.source
  left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, p - q from p where n > 0 and p > q),
numbered as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from ranked)
select lang, source, part, item, value::bigint as value, rank::int as rank
from numbered where part = 'pair' or rank <= 50
"""


_OP12_SQL = """
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first,
           coalesce(role, ''), sha256(coalesce(text, ''))) as i,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} as said
  from conversations where conv_id is not null),
c as (
  select conv_id, list(said order by i) as own,
         xor(list_reduce(list_prepend(4294967295::bigint,
               list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
             lambda state, byte: list_reduce(list_prepend(xor(state, byte), range(8)),
               lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 as h
  from t group by conv_id),
r as (
  select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) as path
  from c left join c b on b.conv_id = c.conv_id - c.conv_id % 5),
p as (
  select conv_id, path[1:d] as node, d as depth, d = len(path) as ends
  from (select conv_id, path, unnest(range(len(path) + 1)) as d from r)),
n as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
         (count(*) - 1) * any_value(coalesce(strlen(node[depth].text), 0)) as saved,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), ''))
           as ends_sha256
  from p group by all),
k as (select node[1:depth - 1] as node, count(*) as children from n where depth > 0 group by all),
f as (
  select n.*, coalesce(k.children, 0) as n_children from n left join k using (node)),
s as (
  select node[1:d] as node, sum(saved) as saved_tokens,
         count(*) filter (n_children = 0) as n_leaves
  from (select *, unnest(range(depth + 1)) as d from f) group by all)
select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       s.saved_tokens::bigint as saved_tokens, f.ends_sha256
from f join s using (node)
left join f u on f.depth > 0 and u.node = f.node[1:f.depth - 1]
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One callable (spark, sf_dir) -> DataFrame per operator."""
    return {
        "op1_passages": op1_passages,
        "op2_bpe": op2_bpe,
        "op3_decontaminate": op3_decontaminate,
        "op4_minhash": op4_minhash,
        "op5_html": op5_html,
        "op6_vectors": op6_vectors,
        "op7_toxicity": op7_toxicity,
        "op8_warc": op8_warc,
        "op9_suffixes": op9_suffixes,
        "op10_langid": op10_langid,
        "op11_divergence": op11_divergence,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_quality": op13_quality,
    }


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL, where SQL can express them."""
    return {"op8_warc": _OP8_SQL, "op11_divergence": _OP11_SQL,
            "op12_prefix_trie": _OP12_SQL}
