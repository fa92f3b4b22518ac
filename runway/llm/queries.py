"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .best_fit import pack
from .html_extract import extract_pages
from .interleave_shards import interleave_shards
from .lexical_search import lexical_search
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .ngram_join import ngram_components
from .periodic_runs import periodic_runs, strongest
from .quality_classifier import score_quality
from .quality_rules import quality_rules
from .subspace_join import subspace_components
from .suffix_dedup import suffix_dedup


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The packing vocabulary, as the installed package names it."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_components(_table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2("__kept", 256).alias("kept_sha256"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave_shards(_table(spark, sf_dir, "documents"))
    return out.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), vocabulary_path())


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("cleaned")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.length)").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def planted_periods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text): every tenth document, by checksum of its id, repeats a
    stretch of its words up to the end.  A null id is left as it is."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for at, (doc_id, text) in enumerate(zip(ids, texts)):
            h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
            words = text.encode().split() if text and h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                texts[at] = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest columns of runs and remaining words."""
    for batch in batches:
        rows = []
        for runs, rest in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            runs = [(r["start"], r["length"], r["period"]) for r in runs]
            top = strongest(runs)
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            rows.append((len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                         hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest()))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.mapInArrow(planted_periods, docs.schema))
    return found.mapInArrow(run_digests, "doc_id long, n_runs long, start long, length long, period long, "
                                         "exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_subspace_pigeonhole, op2_line_dedup, op3_ngram_jaccard, op4_quality_classifier, op5_interleaved_shards,
        op6_best_fit_packing, op7_html_extraction, op8_mix_sources, op9_quality_rules, op10_license_scan, op11_suffix_dedup, op12_periodic_runs, op13_nra_search)}
