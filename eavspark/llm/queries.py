"""The operators' queries over the corpus tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.llm import (
    binpack, divergence, hosts, langid, lexical, mixing, neardup, neighbours, overlap, secrets, token_blocks, topk, toxicity,
)
from eavspark.llm.common import fold, table
from eavspark.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def held_out(folds: int, which: int):
    return F.coalesce(fold("doc_id", folds) == which, F.lit(False))


@query()
def op1_language_id(spark, sf_dir):
    """Profiles from the folds that are not held out; predictions for every document."""
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~held_out(4, 2)))
    return langid.predict(docs, profiles).withColumn("held_out", held_out(4, 2))


@query("""
    with v as (
        select vec_id, min(list_transform(embedding, x -> floor(x::double * 256))) as w
        from embeddings
        where vec_id is not null and embedding is not null
          and len(list_filter(embedding, x -> x is null or not isfinite(x))) = 0
        group by vec_id
    ), s as (
        select q.vec_id as query_id, c.vec_id, list_dot_product(q.w, c.w)::bigint as score
        from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
    )
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
           vec_id, score
    from s qualify rank <= 5
""")
def op2_top_k(spark, sf_dir):
    """The five nearest vectors by whole inner product, for ids divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op3_token_blocks(spark, sf_dir):
    """Every text's ids written as block files and read back."""
    docs = table(spark, sf_dir, "documents")
    return token_blocks.read(token_blocks.write(docs, token_blocks.default_tokenizer("word_bpe_49k.json")))


@query()
def op4_packing(spark, sf_dir):
    """Every text's tokens in as few sequences of 2048 as the search finds."""
    return binpack.pack(table(spark, sf_dir, "documents"), token_blocks.default_tokenizer("byte_bpe_50k.json"))


@query()
def op5_mixing(spark, sf_dir):
    """Sources mixed by weights 3, 1, 2 to 150% of all words, at most twice each."""
    found = mixing.shares(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_quality(spark, sf_dir):
    """Neighbours from the folds that are not held out; scores for every document."""
    docs = table(spark, sf_dir, "documents")
    model = neighbours.fit(docs.where(~held_out(3, 1)), table(spark, sf_dir, "labels"))
    return neighbours.predict(docs, model).withColumn("held_out", held_out(3, 1))


@query()
def op8_near_duplicates(spark, sf_dir):
    """Groups of texts whose 4-word shingles overlap by 80% or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query()
def op7_secrets(spark, sf_dir):
    """Secrets in every text and in what it carries encoded."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query()
def op9_host_rules(spark, sf_dir):
    """Rule failures by source, shrunk and joined back."""
    return hosts.host_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *hosts.MEASURES, "base_failed", "kept"
    )


@query()
def op6_toxicity(spark, sf_dir):
    """A chain low quality, toxic, both; ``toxic`` is the chain's verdict on the second."""
    docs = table(spark, sf_dir, "documents")
    toxic, low = F.col("toxic") == 1, F.col("quality") == 0
    model = toxicity.fit(
        docs.where(~held_out(4, 1)), table(spark, sf_dir, "labels"), {"low": low, "toxic": toxic, "toxic_low": toxic & low}
    )
    found = toxicity.predict(docs, model)
    return found.withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int")).withColumn("held_out", held_out(4, 1))


@query(r"""
    with d as (
        select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents
    ), o as (
        select doc, lang, source, unnest(terms) as term from d
    ), kept as (
        select lang, term, count(*) as n from o group by all having count(distinct doc) >= 30
    ), v as (
        select lang, count(*) as v, sum(n) as n from kept group by lang
    ), g as (
        select distinct lang, source from d
    ), c as (
        select o.lang, o.source, o.term, count(*) as n from o join kept using (lang, term) group by all
    ), t as (
        select lang, source, sum(n) as n from c group by all
    ), p as (
        select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
               1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * v.v) as p,
               1 + (1000000000::hugeint * (kept.n + 5)) // (v.n + 5 * v.v) as q
        from g join kept using (lang) join v using (lang)
        left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
        left join t on t.lang = g.lang and t.source = g.source
    ), pair as (
        select a.lang, a.source, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
        from g a join g b on a.lang = b.lang and a.source <> b.source
        left join p x on x.lang = a.lang and x.source = a.source
        left join p y on y.lang = a.lang and y.source = b.source and y.term = x.term
        group by all
    ), term as (
        select lang, source, term as item, p - q as value from p where n > 0 and p > q
    ), ranked as (
        select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
        from (select *, 'pair' as part from pair union all by name select *, 'term' as part from term)
    )
    select lang, source, part, item, value::bigint as value, rank::int as rank
    from ranked where part = 'pair' or rank <= 50
""")
def op12_source_divergence(spark, sf_dir):
    """How the sources of each language differ, over the terms of 30 documents or more."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query(r"""
    with d as (
        select doc_id, row_number() over () as doc,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents
    ), corpus as (
        select count(*)::bigint as docs, sum(len(terms))::bigint as length from d where len(terms) > 0
    ), item as (
        select item_id, item, term, count(*)::bigint as repeats from (
            select item_id, row_number() over () as item,
                   unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark) group by all
    ), tf as (
        select doc_id, doc, size, term, count(*)::bigint as tf
        from (select doc_id, doc, len(terms)::bigint as size, unnest(terms) as term from d)
        where term in (select term from item) group by all
    ), w as (
        select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
        from tf, corpus group by term, docs
    ), hit as (
        select item, item_id, doc, doc_id,
               sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * size * docs) // length))))::bigint as score
        from item join tf using (term) join w using (term), corpus group by all
    )
    select item_id, row_number() over (partition by item order by score desc, doc_id)::int as rank, doc_id, score
    from hit where score > 0 qualify rank <= 10
""")
def op13_lexical_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(r"""
    with recursive w as (
        select row_number() over () as doc, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x20\x09-\x0D]+') as w
        from documents
    ), s as (
        select doc, doc_id,
               case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
               end as s
        from w
    ), e as (
        select doc, len(s) as n, unnest(s) as t from s
    ), rare as (  -- only a shared shingle can link
        select doc, n, t from e where t in (select t from e group by t having count(*) > 1)
    ), l as (
        select x.doc as a, y.doc as b
        from rare x join rare y on x.t = y.t and x.doc <> y.doc and 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
        group by x.doc, y.doc, x.n, y.n
        having 100 * count(*) >= 90 * (x.n + y.n - count(*))
    ), reach as (
        select doc, doc as other from s union select r.doc, l.b from reach r join l on r.other = l.a
    ), root as (
        select reach.doc, min(s.doc_id) as component_id from reach join s on s.doc = reach.other group by reach.doc
    )
    select s.doc_id, len(s.s)::bigint as n_shingles, root.component_id from s join root using (doc)
""")
def op11_ngram_join(spark, sf_dir):
    """Groups of texts whose 3-word shingles overlap by 90% or more."""
    return overlap.jaccard_groups(table(spark, sf_dir, "documents"))
