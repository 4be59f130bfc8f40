"""Queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reqmart.llm import (
    decontaminate,
    mixing,
    ngram_join,
    odd_sketch_dedup,
    ordinal_quality as quality,
    page_text,
    periodic_runs,
    projected_neighbours,
    secret_index,
    suffix_buckets,
    target_resampling,
    token_counts,
    token_files,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_source_mix(spark, sf_dir):
    """Words each document gives to the mix of sources."""
    mix = mixing.with_copies(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mix.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_token_files(spark, sf_dir):
    """Places, lengths and checksums of all documents' ids, from the token files that hold them."""
    return token_files.token_table(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


#: Documents are kept whose probability of the best grade reaches this.
LEAST_TAIL = 0.8


def graded(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The documents with their expected grade and the probability of the best one, by those that are labelled."""
    grade = quality.grade_of(F.col("quality"), F.col("toxic"))
    model = quality.fit(docs, labels.select("doc_id", grade.alias("grade")), grades=3)
    return model.score(docs, keep=keep)


@query
def op5_ordinal_quality(spark, sf_dir):
    """Expected grade of each document, and whether it is kept."""
    docs = graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return docs.select(
        "doc.doc_id", "expected_grade", F.col("tail").alias("p_best"), (F.col("tail") >= LEAST_TAIL).alias("kept")
    )


@query
def op7_odd_sketch_dedup(spark, sf_dir):
    """Near-duplicate class of each document."""
    classes = odd_sketch_dedup.classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op1_decontaminate(spark, sf_dir):
    """Documents and the benchmark items they contain."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_secret_index(spark, sf_dir):
    """Secrets in each document: counts of the base kinds, a digest of their spans, and all spans."""
    found = secret_index.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_index.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def joined(spans):
        def text(s):
            return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

        return F.array_join(F.transform(spans, text), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = map(of_kind, kinds)
    digest = F.sha2(joined(base), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), joined("spans").alias("spans"))


@query
def op2_page_text(spark, sf_dir):
    """Main text of each page."""
    text = page_text.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op3_token_counts(spark, sf_dir):
    """Unigram token count of each document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op8_projected_neighbours(spark, sf_dir):
    """The 20 nearest vectors of each query vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = projected_neighbours.neighbours(vectors)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op4_suffix_buckets(spark, sf_dir):
    """Bytes, removed bytes and runs, and a digest of what remains, per document."""
    cleaned = suffix_buckets.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_target_resampling(spark, sf_dir):
    """Importance weight of each document for the benchmark's words, and its place in the draw of a tenth."""
    return target_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of each document's words, some of which are made to repeat: number, longest run, digests."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), synthetic=True)

    def line(r):
        return F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))

    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    run = F.struct(first["start"].alias("start"), (-first["shorter"]).alias("length"), first["period"].alias("period"))
    return found.select("doc_id", "runs", "collapsed", run.alias("run")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "run.start", "run.length", "run.period",
        F.floor(F.expr("run.length * 1000 div run.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_ngram_join(spark, sf_dir):
    """Set size and class of each document by links of four-word shingle sets."""
    return ngram_join.linked(table(spark, sf_dir, "documents"))
