"""One query per operator, with production parameters over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Items of fewer than five words, of which the tables have none, are left to the tests.
OP1 = r"""
with shingles as (
  select distinct kind, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s
  from (
    select 'd' as kind, doc_id as id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents
    union all
    select 'b', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from benchmark
  ) where len(w) >= 5
), sizes as (select id, count(*) as n from shingles where kind = 'b' group by id)
select d.id as doc_id, b.id as item_id, cast(any_value(n) as int) as item_shingles, cast(count(*) as int) as shared, count(*) / any_value(n) as containment
from shingles b join shingles d on d.s = b.s and d.kind = 'd' join sizes on sizes.id = b.id
where b.kind = 'b' group by d.id, b.id having count(*) >= 0.8 * any_value(n) - 1e-9
"""

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_contaminated

    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepieces import encode_column

    return encode_column(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER).drop("text")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii, fit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_pii(docs, fit(docs))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnsRenamed({"__lines": "n_lines", "__dropped": "n_dropped"})


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_graph import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bagminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, *fit(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1}
