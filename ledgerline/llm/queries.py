"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embeddings, exact_dedup, language, lexical, mixing, secrets, simhash, spelling, substring_dedup, suffix_dedup,
               token_files, toxicity)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _fold(of: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(column).cast("string")) % of


def _held_out(of: int, fold: int) -> Column:
    """Rows without an id are in no fold: false (their labels and lang are not learnt from either)."""
    return F.coalesce(_fold(of) == fold, F.lit(False))


def training_rows() -> Column:
    """The rows whose labels the toxicity model may learn from."""
    return _fold(5) != 0


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(_documents(spark, sf_dir), keep="largest")


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(_documents(spark, sf_dir), window=20)


def op3_toxicity(spark, sf_dir):
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, train_rows=training_rows())
    return toxicity.scores(docs, model).select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op4_simhash_near_dedup(spark, sf_dir):
    return simhash.near_groups(_documents(spark, sf_dir), shingle_words=3, radius=3)


# Fixed value: ids of the queries' tokenizer file.
VOCABULARY = 49408


def tokenizer_path() -> str:
    """The tokenizer file of the queries."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op5_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = language.train(docs, train_rows=_fold(4) != 2)
    return language.label(docs, model).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def secret_report(docs: DataFrame) -> DataFrame:
    """Spans as text, the base kinds counted and digested."""
    found = secrets.scan(docs, secrets.train(docs))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op6_secrets(spark, sf_dir):
    return secret_report(_documents(spark, sf_dir))


def op7_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.98)


def op8_token_files(spark, sf_dir):
    tokens = token_files.token_ids(_documents(spark, sf_dir), tokenizer_path(), VOCABULARY, end_id=2)
    blocks = token_files.write_blocks(tokens, VOCABULARY)
    return token_files.read_documents(blocks, with_tokens=False).withColumnRenamed("id", "doc_id")


def op9_mixing(spark, sf_dir):
    return mixing.Mix(_documents(spark, sf_dir)).taken()


def op10_bpe(spark, sf_dir):
    return bpe.round_trip(_documents(spark, sf_dir), tokenizer_path())


def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir), window=100)


def op12_lexical_search(spark, sf_dir):
    return lexical.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


def op13_spelling(spark, sf_dir):
    return spelling.variants(_documents(spark, sf_dir))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_language": op5_language,
    "op6_secrets": op6_secrets,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_token_files": op8_token_files,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling": op13_spelling,
}

ORACLE = {
    "op1_exact_dedup": """
        with t as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, text_sha256
        from t window same as (partition by text_sha256)
    """,
    "op2_substring_dedup": """
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
        win as (
            select doc_id, i, array_to_string(words[i:i + 19], ' ') as key
            from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from w where len(words) >= 20)),
        again as (
            select doc_id, i from (select doc_id, i, row_number() over (partition by key order by doc_id, i) as nth from win)
            where nth > 1),
        word as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as k from w),
        gone as (select distinct doc_id, i + d as k from again, range(20) t(d)),
        kept as (
            select word.doc_id, string_agg(word.word, ' ' order by word.k) as text, count(*) as n
            from word anti join gone on word.doc_id = gone.doc_id and word.k = gone.k group by word.doc_id)
        select w.doc_id, len(words) as n_words, len(words) - coalesce(kept.n, 0) as n_removed,
               sha256(coalesce(kept.text, '')) as kept_sha256
        from w left join kept on kept.doc_id = w.doc_id
    """,
    "op7_embedding_near_dedup": """
        with recursive v as (
            select vec_id, label, embedding::double[] as e from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
              and len(list_filter(embedding, lambda c: c <> 0)) > 0),
        link as (
            select a.vec_id as i, b.vec_id as j from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
            where list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(i, j) as (
            select i, j from link union select r.i, l.j from reach r join link l on r.j = l.i),
        first as (select i, min(j) as j from reach group by i),
        number as (select i, count(*) as n from link group by i)
        select e.vec_id, coalesce(n.n, 0) as n_links, least(e.vec_id, coalesce(f.j, e.vec_id)) as component_id,
               least(e.vec_id, coalesce(f.j, e.vec_id)) = e.vec_id as kept
        from embeddings e left join first f on f.i = e.vec_id left join number n on n.i = e.vec_id
    """,
    "op11_suffix_dedup": """
        with b as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        win as (
            select doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) as key
            from (select doc_id, h, unnest(range(0, (length(h) // 2)::bigint - 99)) as i from b)),
        again as (
            select doc_id, i from (select doc_id, i, row_number() over (partition by key order by doc_id, i) as nth from win)
            where nth > 1),
        -- repeats that overlap or touch form one removed run
        run as (
            select doc_id, min(i) as low, max(i) + 100 as high
            from (select doc_id, i, sum(new) over (partition by doc_id order by i) as r
                  from (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 100 then 0 else 1 end as new
                        from again))
            group by doc_id, r),
        edge as (
            select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as after from run),
        part as (
            select doc_id, string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' order by low) as kept, max(high) as last,
                   count(*) as n_spans, sum(high - low) as n_removed
            from edge join b using (doc_id) group by doc_id)
        select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
               coalesce(n_spans, 0)::bigint as n_spans,
               sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
        from b left join part using (doc_id)
    """,
    "op12_lexical_search": """
        with d as (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
            from documents where text is not null),
        size as (select doc_id, len(terms)::bigint as n from d where len(terms) > 0),
        whole as (select count(*) as docs, sum(n)::bigint as length from size),
        item as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
            from benchmark),
        tf as (
            select doc_id, term, count(*) as tf from (select doc_id, unnest(terms) as term from d)
            where term in (select term from item) group by doc_id, term),
        weight as (
            select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
            from (select term, count(*) as df from tf group by term), whole),
        gain as (
            select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))) as g
            from tf join size using (doc_id) join weight using (term), whole),
        score as (select item_id, doc_id, sum(g)::bigint as score from item join gain using (term) group by item_id, doc_id),
        placed as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as nth, doc_id, score
                   from score where score > 0)
        select item_id, nth::integer as rank, doc_id, score from placed where nth <= 50
    """,
}
