"""The registered queries of the operators: each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import (
    bpe,
    decontaminate,
    lattice,
    lines,
    minhash,
    prefixes,
    quality,
    runs,
    secrets,
    suffixes,
    trie_bpe,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The rules of op2: verdict, then host and path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='partwise-code-')}/partwise", "zip", root, "partwise")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op2_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every address, by rule or by the class of its aliases."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op3_lattice_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of embeddings at cosine 0.9."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the alignment's score and place."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_similar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that match an earlier line of the corpus to 0.8."""
    return lines.line_report(table(spark, sf_dir, "documents"))


@query
def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into seekable bundles and read back."""
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query
def op7_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: numbers of the base kinds, their digest, and all spans."""
    rules = [*secrets.BASE, *secrets.MORE]
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), rules)
    base = F.filter("found", lambda span: span["kind"] < len(secrets.BASE))

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda span: span["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.as_text(base, rules), 256).alias("base_sha256"),
        secrets.as_text(F.col("found"), rules).alias("spans"),
    )


@query
def op8_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without strings of 50 bytes that an earlier one has."""
    return suffixes.drop_repeats(table(spark, sf_dir, "documents"), window=50).select(
        "doc_id",
        (F.length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose two-word shingles agree to 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids, and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, VOCABULARY)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op11_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids by the tokenizer's file, and of the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = trie_bpe.encode(docs, TOKENIZER).drop("text")
    decoded = trie_bpe.decode(encoded, TOKENIZER)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of op12: every tenth document by a hash of its id goes on periodically from some word."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")

    def planted(words: Column) -> Column:
        n, g = F.size(words), F.floor(hashed / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        copies = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
        return F.concat_ws(" ", F.slice(words, 1, a), F.slice(F.flatten(copies), 1, n - a))

    # The transform over one element binds the words once.
    rewritten = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when(hashed % 10 == 0, rewritten).otherwise(text).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of words in every document, and what is left without their repeats."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.collapse_runs(docs, least=24, times=3)

    def first(a: Column, b: Column) -> Column:
        """The run with the greater exponent; of equal ones the one that comes first."""
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    rows = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    rest = F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1)))
    top = F.when(F.size("runs") > 0, F.aggregate(rest, F.get("runs", F.lit(0)), first))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(rows, lambda row: F.concat(row, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations, each behind the head of the one its id leads to."""
    turns = prefixes.digest_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    spliced, convs = prefixes.splice_heads(turns, base=conv - conv % 5, head=head, most=8)
    return prefixes.prefix_trie(spliced, convs)
