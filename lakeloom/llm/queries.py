"""The registered queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .decontaminate import contaminated
from .mixing import mixed
from .neardup import near_duplicates
from .pii import personal_data
from .quality import quality_scores
from .secrets import findings
from .simhash import simhash_duplicates
from .suffixes import repeated_passages
from .tokens import aligned
from .toxicity import toxicity_scores
from .warc import archived
from .winnow import fingerprints


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_secret_scan,
        op3_pii,
        op4_suffix_dedup,
        op5_warc,
        op6_quality,
        op7_toxicity,
        op8_winnowing,
        op9_minhash_neardup,
        op10_decontamination,
        op11_simhash_neardup,
        op12_phrase_collocations,
        op13_tokenizer_alignment,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc": """
        with sized as (
            select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as n from pages
        ),
        named as (
            select *, case when n >= 1000 and page_id is not null then max(page_id) over (partition by payload) end as newest from sized
        )
        select page_id, n::bigint as payload_bytes, sha1(payload) as payload_digest,
            case when newest <> page_id then 'revisit' else 'response' end as record_type,
            case when newest <> page_id then newest end as refers_to
        from named
    """,
    "op12_phrase_collocations": """
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
            from documents
        ),
        worded as (
            select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') as words from pieces
        ),
        grams as (
            select lang, k, array_to_string(words[i : i + k - 1], ' ') as phrase
            from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i from worded, (select unnest([1, 2, 3, 4]) as k) where len(words) >= k)
        ),
        totals as (select lang, count(*) as n from grams where k = 1 group by lang),
        counts as (select lang, k, phrase, count(*) as a from grams group by all having count(*) >= 30),
        cuts as (
            select lang, phrase, a, k, unnest(range(1, k)) as cut_after, string_split(phrase, ' ') as words from counts where k > 1
        ),
        scored as (
            select c.lang, c.phrase, c.a, c.k, c.cut_after, x.a as l, y.a as r, (2000000::hugeint * c.a) // (x.a + y.a) as score
            from cuts c
            join counts x on x.lang = c.lang and x.phrase = array_to_string(c.words[1 : c.cut_after], ' ')
            join counts y on y.lang = c.lang and y.phrase = array_to_string(c.words[c.cut_after + 1 : c.k], ' ')
        ),
        lowest as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, cut_after) = 1
        ),
        inside as (
            select lang, array_to_string(words[i : i + m - 1], ' ') as phrase, max(a) as cover
            from (select lang, words, a, m, unnest(range(1, k - m + 2)) as i
                  from (select lang, string_split(phrase, ' ') as words, a, k, unnest(range(2, k)) as m from counts where k > 2))
            group by all
        ),
        kept as (
            select s.* from lowest s left join inside i on i.lang = s.lang and i.phrase = s.phrase
            where i.cover is null or 100::hugeint * i.cover < 80::hugeint * s.a
        ),
        numbered as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
        select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
        from numbered join totals using (lang) where rank <= 2000
    """,
}
