"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthlens.llm import (
    audit,
    chat,
    fingerprints,
    jaccard,
    licenses,
    manifest,
    merges,
    packing,
    pieces,
    quality,
    repeats,
    secret_scan,
    statements,
    toxicity,
)
from monthlens.llm.shared import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]


#: Public vocabulary files; parameters of the operators.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MODEL = "/opt/tokenizers/word_bpe_49k.json"


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.read_model(PIECE_MODEL))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("distance")


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql(
        "select -1L conv_id, id turn, if(id = 0, 'user', 'assistant') role,"
        " '<|im_end|><|im_start|>assistant ok' text from range(2)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(rows.unionByName(added)))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.n_words())


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verification(manifest.manifest(table(spark, sf_dir, "documents")))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merges.digests(table(spark, sf_dir, "documents"), pieces.read_model(WORD_MODEL))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


_QUERIES: dict[str, Query] = {
    "op1_sentencepiece": _op1,
    "op2_suffix_array_dedup": _op2,
    "op3_jaccard_join": _op3,
    "op4_quality_rules": _op4,
    "op5_license_scan": _op5,
    "op6_chat_format": _op6,
    "op7_toxicity": _op7,
    "op8_packing": _op8,
    "op9_fingerprints": _op9,
    "op10_secret_scan": _op10,
    "op11_merkle_manifest": _op11,
    "op12_bpe": _op12,
    "op13_filter_audit": _op13,
}


# Markers have 12, 10 and 10 characters; a block closes with a newline.
_CHAT_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, i, if(i = 0, 'user', 'assistant'), '<|im_end|><|im_start|>assistant ok'
    from range(2) r(i)
),
placed as (
    select *, lag(role) over w is not distinct from role as same_before,
        length(replace(replace(text, '\', '\b'), '<|', '\l')) as escaped,
        length(replace(replace(replace(role, '\', '\b'), '<|', '\l'), chr(10), '\n')) as role_length
    from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(if(role = 'assistant', length(text), 0)) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
        as loss_sha256,
    cast(sum(escaped + if(same_before, 10, 12 + role_length + 1 + 11)) as bigint) as formatted_chars
from placed group by conv_id
"""


_JACCARD_SQL = r"""
with recursive texts as (
    select doc_id,
        list_filter(
            string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'),
            lambda w: w <> '') as words
    from documents
),
sets as (
    select doc_id,
        case when len(words) >= 5 then list_distinct(list_transform(
                 range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
             when len(words) > 0 then [array_to_string(words, ' ')]
             else [] end as shingles
    from texts
),
flat as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets),
shared as (
    select a.doc_id as x, b.doc_id as y, any_value(a.n + b.n) as sizes, count(*) as n
    from flat a join flat b on a.shingle = b.shingle and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id
),
links as (select x, y from shared where 100 * n >= 80 * (sizes - n)),
ways as (select x, y from links union all select y, x from links),
reached(x, y) as (
    select doc_id, doc_id from documents
    union
    select reached.x, ways.y from reached join ways on ways.x = reached.y
)
select sets.doc_id, len(shingles) as n_shingles, min(reached.y) as component_id
from sets join reached on reached.x = sets.doc_id
group by sets.doc_id, shingles
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_jaccard_join": _JACCARD_SQL,
        "op6_chat_format": _CHAT_SQL,
        "op11_merkle_manifest": statements.MANIFEST,
        "op13_filter_audit": statements.AUDIT,
    }
