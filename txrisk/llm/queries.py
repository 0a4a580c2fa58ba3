"""One query per operator over its whole tables, in the form its contract fixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm import (
    bpe_codec, byte_bpe, decontaminate, kmeans_tree, language_id, lexical_search, paragraphs, quality, shards, simhash,
    spelling, warc,
)
from txrisk.llm.common import id_remainder, keep, table
from txrisk.llm.token_counts import token_counts

WORD_VOCABULARY, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = WORD_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs, id_remainder("doc_id", 4) != 2)
    found = language_id.identify(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), model)
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = keep(quality.document_statistics(table(spark, sf_dir, "documents")), "statistics")
    scores = quality.quality_scores(features, table(spark, sf_dir, "labels"), id_remainder("doc_id", 5) != 0)
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scores.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("cast(doc_id as bigint) doc_id", "text")
    return bpe_codec.codec_digests(docs, vocabulary_path()).drop("text")


def op7_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.balanced_shards(table(spark, sf_dir, "documents"), shards=16)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), deletion=31)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").selectExpr("cast(doc_id as bigint) doc_id", "text")
    return byte_bpe.codec_digests(docs, vocabulary_path(BYTE_RANKS), public_tokenizers.PATTERN).drop("text")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = [
    op1_token_counts, op2_language_id, op3_warc_chunks, op4_quality_classifier, op5_simhash_pigeonring,
    op6_bpe_codec, op7_balanced_shards, op8_kmeans_tree, op9_spaced_seeds, op10_paragraph_minhash,
    op11_spelling_variants, op12_byte_bpe, op13_lexical_search,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


# CRC-32 byte by byte: eight shifts make the table's entry of a byte.
CRC_TABLE = """
    crc_steps(i, x, k) as (
        select i, i, 0 from range(256) t(i)
        union all
        select i, case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, k + 1 from crc_steps where k < 8),
    crc_table as (select list(x order by i) as entries from crc_steps where k = 8)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can say: the others are tested against brute force."""
    return {
        "op3_warc_chunks": """
            with p as (select page_id, coalesce(html, '') h, strlen(coalesce(html, '')) n from pages),
            f as (select h, min(page_id) first from p where n >= 100 group by h)
            select p.page_id, n as payload_bytes, sha256(p.h) as payload_digest,
                   case when first is not null and first is distinct from page_id then 'revisit' else 'response' end as record_type,
                   case when first is distinct from page_id then first end as refers_to
            from p left join f on p.h = f.h and p.n >= 100
        """,
        "op11_spelling_variants": f"""
            with recursive {CRC_TABLE},
            runs as (
                select doc_id, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') as run, count(*) as times
                from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) as run from documents)
                where length(run) >= 7 group by 1, 2),
            named as (select *, doc_id || ':' || run as name, hex(doc_id || ':' || run) as digits from runs),
            hashed as (
                select run, times, xor(4294967295, list_reduce(
                    list_prepend(4294967295::bigint, list_transform(range(strlen(name)), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::bigint)),
                    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]::bigint))) as h
                from named, crc_table),
            changed as (
                select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
                    else run end as word, times
                from hashed),
            words as (select word, sum(times)::bigint as n from changed where length(word) >= 7 group by 1 having sum(times) >= 2),
            gaps as (
                select word, n, i as place, substr(word, 1, i - 1) || substr(word, i + 1) as rest
                from (select word, n, unnest(range(1, length(word) + 1))::int as i from words)),
            pairs as (
                select a.word, b.word as near, b.n as near_n from gaps a join gaps b using (place, rest) where a.word <> b.word
                union select a.word, b.word, b.n from gaps a join words b on a.rest = b.word
                union select b.word, a.word, a.n from gaps a join words b on a.rest = b.word),
            best as (
                select word, count(*) as n_near, min((-near_n, near)) as best from pairs group by 1),
            forms as (
                select w.word, w.n, coalesce(n_near, 0) as n_near,
                    case when -best[1] >= 10 * w.n then best[2] end as form, case when -best[1] >= 10 * w.n then -best[1] end as form_n
                from words w left join best using (word)),
            steps(word, root) as (
                select word, word from forms
                union all
                select s.word, f.form from steps s join forms f on f.word = s.root where f.form is not null)
            select f.word, form, r.root, n, n_near, form_n
            from forms f join (
                select s.word, s.root from steps s join forms e on e.word = s.root where e.form is null) r using (word)
        """,
        "op13_lexical_search": r"""
            with texts as (
                select row_number() over () as d, doc_id,
                    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
                from documents),
            docs as (select d, doc_id, len(terms) as n from texts where len(terms) > 0),
            total as (select count(*) as docs, sum(n)::hugeint as terms from docs),
            tf as (select d, term, count(*)::hugeint as tf from (select d, unnest(terms) as term from texts) group by 1, 2),
            wanted as (
                select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                from benchmark),
            weights as (
                select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::hugeint as w
                from (select term, count(*) as df from tf where term in (select term from wanted) group by 1), total),
            scores as (
                select item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) as score
                from wanted join weights using (term) join tf using (term) join docs using (d), total
                group by 1, 2, 3)
            select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score::bigint as score
            from scores where score > 0
            qualify rank <= 10
        """,
    }
