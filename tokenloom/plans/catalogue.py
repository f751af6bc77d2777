"""Every operator as a query over the given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.functions import vectors as vec
from tokenloom.operators import collate, counts, embeddings, ordering, similarity, subwords, windows
from tokenloom.params import Params
from tokenloom.plans import chain, stages
from tokenloom.session import materialise, shared_folder
from tokenloom.sources import lines, sinks
from tokenloom.sources.tables import read_documents as _docs
from tokenloom.sources.tables import read_table as _table

WINDOW = 4
DIMS = 50
TOP_K = 5

# A short merge table for queries whose SQL form needs the merges as literals.
FIXED_MERGES: subwords.Merges = [
    ("t", "h"), ("th", "e"), ("i", "n"), ("e", "r"), ("a", "n"), ("r", "e"), ("o", "n"), ("e", "n"),
    ("an", "d"), ("in", "g"), ("e", "s"), ("o", "r"), ("s", "t"), ("a", "l"), ("i", "t"), ("a", "r"),
    ("o", "u"), ("d", "e"), ("a", "t"), ("e", "d"), ("i", "on"), ("l", "e"), ("c", "h"), ("u", "n"),
]



def _wide_merges() -> subwords.Merges:
    """1,076 merges by rule: every two letters, then a consonant, a vowel and one of four endings."""
    letters, vowels = string.ascii_lowercase, "aeiou"
    pairs = [(a, b) for a in letters for b in letters]
    syllables = [c + v for c in letters if c not in vowels + "y" for v in vowels]
    return pairs + [(syllable, end) for end in "nrst" for syllable in syllables]


WIDE_MERGES = _wide_merges()

WORD_PARAMS = Params(tokeniser="word", embedding_size=DIMS, top_k=TOP_K)
SUBWORD_PARAMS = Params(tokeniser="subword", embedding_size=DIMS, top_k=TOP_K)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _joined(tokens: str) -> Column:
    return F.array_join(F.col(tokens).cast("array<string>"), ",")


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.global_index(counts.word_frequency(_docs(spark, sf)), "word")


def _word_segments(spark: SparkSession, sf: str) -> DataFrame:
    return windows.corpus_segments(_docs(spark, sf), tx.words(F.col("text")))


def _word_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.context_windows(_word_segments(spark, sf), WINDOW)


def _listing_windows(spark: SparkSession, sf: str, token: str = "idx") -> DataFrame:
    return windows.context_windows(windows.listing_segments(_vocabulary(spark, sf), token, WINDOW), WINDOW)


def _word_run(spark: SparkSession, sf: str) -> chain.Run:
    return chain.Run(_docs(spark, sf), WORD_PARAMS)


# Text and counts


@query
def normalised_text(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", tx.normalise(F.col("text")).alias("text"))


@query
def word_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return counts.word_occurrences(_docs(spark, sf))


@query
def word_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return counts.word_frequency(_docs(spark, sf))


@query
def pretoken_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return counts.pretoken_frequency(_docs(spark, sf))


@query
def subword_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = counts.pretoken_frequency(_docs(spark, sf))
    return subwords.pair_counts(counted.select(subwords.marked(F.col("piece")).alias("marks"), "frequency"))


@query
def subword_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return subwords.subword_frequency(_docs(spark, sf), FIXED_MERGES)


@query
def subword_frequency_wide(spark: SparkSession, sf: str) -> DataFrame:
    """As `subword_frequency`, over a vocabulary of more than a thousand pieces."""
    return subwords.subword_frequency(_docs(spark, sf), WIDE_MERGES)


@query
def subword_occurrence_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids encoded document by document, then counted: must equal the vocabulary-first count."""
    encoded = subwords.encode_documents(_docs(spark, sf), FIXED_MERGES)
    return counts.count_items(encoded, F.col("tokens"), "token")


@query
def subword_merges(spark: SparkSession, sf: str) -> DataFrame:
    return subwords.merges_frame(spark, subwords.train_merges(_docs(spark, sf), SUBWORD_PARAMS.n_merges))


@query
def subword_conservation(spark: SparkSession, sf: str) -> DataFrame:
    """Characters per language, counted from trained pieces: encoding must neither lose nor add any."""
    docs = _docs(spark, sf, "doc_id", "lang", "text")
    units = docs.select("lang", F.explode(tx.pretokens(F.col("text"))).alias("piece"))
    counted = materialise(units.groupBy("lang", "piece").agg(F.count("*").alias("frequency")))
    whole = counted.groupBy("piece").agg(F.sum("frequency").alias("frequency"))
    merges = subwords.merges_of_pieces(whole, SUBWORD_PARAMS.n_merges)
    pieces = counted.select("lang", "frequency", F.explode(subwords.encode_pieces(F.col("piece"), merges)).alias("p"))
    return pieces.groupBy("lang").agg(F.sum(F.col("frequency") * F.length("p")).alias("n_chars"))


# Windows


@query
def vocab_index(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(spark, sf).select("idx", "word")


@query
def context_windows_corpus(spark: SparkSession, sf: str) -> DataFrame:
    found = _word_windows(spark, sf)
    return found.select(F.col("seq").alias("doc_id"), "pos", _joined("input").alias("input"), "label")


@query
def context_windows_listing(spark: SparkSession, sf: str) -> DataFrame:
    found = _listing_windows(spark, sf, "word")
    return found.select(F.col("pos").alias("window_id"), _joined("input").alias("input"), "label")


@query
def flattened_windows(spark: SparkSession, sf: str) -> DataFrame:
    flat = windows.flattened_windows(_word_windows(spark, sf), WINDOW)
    return flat.select(F.col("seq").alias("doc_id"), "idx", _joined("tokens").alias("tokens"))


@query
def label_windows(spark: SparkSession, sf: str) -> DataFrame:
    flat = windows.label_windows(_word_windows(spark, sf), WINDOW)
    return flat.select(F.col("seq").alias("doc_id"), "idx", _joined("tokens").alias("tokens"))


@query
def training_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct second-level windows, over inputs and over labels, with their number."""
    found = windows.training_windows(_word_windows(spark, sf), WINDOW)
    return found.select(_joined("tokens").alias("tokens"), "weight")


@query
def window_positions(spark: SparkSession, sf: str) -> DataFrame:
    return counts.window_positions(_word_windows(spark, sf))


@query
def role_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.role_token_counts(_word_windows(spark, sf))


@query
def window_features(spark: SparkSession, sf: str) -> DataFrame:
    """Token-id windows over the vocabulary listing as features scaled by the largest id."""
    vocabulary = _vocabulary(spark, sf)
    found = windows.context_windows(windows.listing_segments(vocabulary, "idx", WINDOW), WINDOW)
    largest = vocabulary.agg(F.max("idx").alias("top"))
    features = vec.scaled_features(F.col("input"), F.col("top"))
    # The other side is one row by construction.
    scaled = found.join(F.broadcast(largest)).select("pos", features.alias("f"))
    columns = [F.round(F.col("f")[i], 8).alias(f"f{i}") for i in range(WINDOW)]
    return scaled.select(F.col("pos").alias("window_id"), *columns)


# Vectors


@query
def vector_norms(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select("vec_id", F.round(vec.norm(F.col("embedding")), 6).alias("norm"))


@query
def mean_vectors(spark: SparkSession, sf: str) -> DataFrame:
    means = vec.mean_vectors(_table(spark, sf, "embeddings"), "label", "embedding")
    return means.select("label", F.posexplode("vector").alias("dim", "m")).select(
        "label", "dim", F.round("m", 6).alias("mean")
    )


@query
def vector_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every vector with the mean vector of its label."""
    table = _table(spark, sf, "embeddings")
    means = vec.mean_vectors(table, "label", "embedding")
    score = vec.cosine(F.col("embedding"), F.col("vector"))
    return table.join(means, "label").select("vec_id", "label", F.round(score, 4).alias("score"))


@query
def dedup_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Three vectors per token in changing roles, reduced to one."""
    tagged = _table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 3).cast("long").alias("token"),
        F.when(F.col("label") % 2 == 0, "input").otherwise("label").alias("role"),
        F.col("embedding").alias("vector"),
    )
    chosen = embeddings.dedup_vectors(tagged)
    return chosen.select("token", "role", F.round(vec.norm(F.col("vector")), 6).alias("norm"))


def _similar_vectors(spark: SparkSession, sf: str) -> DataFrame:
    table = _table(spark, sf, "embeddings")
    return similarity.top_similar(table, "vec_id", "embedding", TOP_K)


def _ranked(found: DataFrame, key: str) -> DataFrame:
    return found.select(key, "rank", F.col("similar").alias("similar_token"), F.round("score", 4).alias("score"))


@query
def top_similar_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(_similar_vectors(spark, sf), "vec_id")


# Embeddings


@query
def cooccurrence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.cooccurrence_counts(_word_segments(spark, sf), WINDOW)


def _word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.context_vectors(_word_segments(spark, sf), WINDOW, DIMS)


@query
def token_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return _word_vectors(spark, sf).select("word", F.posexplode("vector").alias("dim", "value"))


@query
def token_embeddings_from_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same vectors by way of pair counts."""
    vectors = embeddings.random_index(cooccurrence_counts(spark, sf), DIMS)
    return vectors.select("word", F.posexplode("vector").alias("dim", "value"))


@query
def top_similar_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(similarity.top_similar(_word_vectors(spark, sf), "word", "vector", TOP_K), "word")


def _long_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.select("token", F.posexplode("vector").alias("dim", "value"))


def _autoencoded(spark: SparkSession, sf: str, readout: str) -> DataFrame:
    params = Params(embedding="autoencoder", embedding_size=DIMS, readout=readout)
    return _long_vectors(chain.Run(_docs(spark, sf), params, FIXED_MERGES).result("embedding"))


@query
def token_embeddings_autoencoder(spark: SparkSession, sf: str) -> DataFrame:
    return _autoencoded(spark, sf, "hidden")


@query
def token_embeddings_autoencoder_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _autoencoded(spark, sf, "weights")


# Collation and report


def _flat_record(collated: DataFrame) -> DataFrame:
    similar = F.coalesce(F.array_join("similar", ","), F.lit("N/A"))
    return collated.select("word", F.col("token").alias("intToken"), "frequency", similar.alias("similar_tokens"))


@query
def collated_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain over words: counts, co-occurrence vectors, neighbours, one record per token."""
    return _flat_record(_word_run(spark, sf).result("statistics_collated"))


@query
def collated_subwords(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain over subwords of the fixed merge table."""
    this = chain.Run(_docs(spark, sf), SUBWORD_PARAMS, FIXED_MERGES)
    return _flat_record(this.result("statistics_collated"))


def _outer_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Word counts under their ids, and vector neighbours under ids half of which lie beyond those of the words."""
    vocabulary = _vocabulary(spark, sf)
    frequencies = vocabulary.select("word", F.col("idx").alias("token"), "frequency")
    similar = _similar_vectors(spark, sf)
    tokens = F.when(F.col("vec_id") % 2 == 0, F.col("vec_id")).otherwise(-F.col("vec_id"))
    neighbours = collate.neighbour_lists(similar.select(tokens.alias("token"), "rank", "similar"))
    return frequencies, neighbours


@query
def collated_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Collation where tokens are missing on either side."""
    return _flat_record(collate.collate(*_outer_sides(spark, sf)))


@query
def collated_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Collation where two words and two neighbour lists share a token."""
    half = F.floor(F.col("token") / 2).cast("long").alias("token")
    frequencies = _vocabulary(spark, sf).withColumnRenamed("idx", "token").select("word", half, "frequency")
    lists = collate.neighbour_lists(_similar_vectors(spark, sf).withColumnRenamed("vec_id", "token"))
    return _flat_record(collate.collate(frequencies, lists.select(half, "similar")))


@query
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return collate.tagged_union(*_outer_sides(spark, sf))


@query
def ordered_output(spark: SparkSession, sf: str) -> DataFrame:
    """The rank of each token when output is ordered by the token's text, as the report is."""
    vocabulary = _vocabulary(spark, sf).select("word", F.col("idx").cast("string").alias("token"))
    return ordering.global_index(vocabulary, "token", name="place")


@query
def report_json(spark: SparkSession, sf: str) -> DataFrame:
    return collate.report_json(collate.collate(*_outer_sides(spark, sf)))


@query
def report_yaml(spark: SparkSession, sf: str) -> DataFrame:
    return collate.report_yaml(collate.collate(*_outer_sides(spark, sf)))


@query
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every stage of a run over words, observed while they are written."""
    counted: dict[str, int] = {}
    chain.run(spark, _docs(spark, sf), WORD_PARAMS, f"{shared_folder(spark)}/files/{uuid.uuid4().hex}", counts_of=counted)
    return spark.createDataFrame(list(counted.items()), "stage string, n long")


# Line formats


def _frequency_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Token-frequency lines of every word; by id some have a field too many, too few, trailing tabs or a bad number."""
    v = _vocabulary(spark, sf).select("word", F.col("idx").cast("string").alias("t"), "frequency", "idx")
    number = F.when(F.col("idx") % 7 == 3, F.lit("many")).otherwise(F.col("frequency").cast("string"))
    tab = F.lit("\t")
    whole = F.concat("word", tab, "t", tab, number)
    shapes = (
        F.when(F.col("idx") % 5 == 1, F.concat(whole, F.lit("\textra")))
        .when(F.col("idx") % 5 == 2, F.concat("word", tab, "t", tab))
        .when(F.col("idx") % 5 == 3, F.concat("word", tab, tab))
        .when(F.col("idx") % 5 == 4, F.concat(whole, F.lit("\t\t")))
        .otherwise(whole)
    )
    return v.select(shapes.alias("value"))


@query
def tsv_parse_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return lines.parse_tokens(_frequency_lines(spark, sf))


@query
def tsv_parse_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return lines.parse_frequencies(_frequency_lines(spark, sf))


def _window_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Both lines of every listing window, and for every window one line without a second field."""
    found = _listing_windows(spark, sf)
    bad = F.concat(F.lit("input_"), F.col("pos").cast("string"), F.lit("\t"))
    return sinks.render_windows(found).unionByName(found.select(bad.alias("value")))


@query
def tsv_parse_windows(spark: SparkSession, sf: str) -> DataFrame:
    paired = lines.pair_windows(lines.parse_windows(_window_lines(spark, sf)))
    return paired.select("idx", _joined("input").alias("input"), "label")


def _vector_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A line per vector, one in three of them with a field too many."""
    table = _table(spark, sf, "embeddings")
    extra = F.when(F.col("vec_id") % 3 == 0, F.lit("\textra")).otherwise(F.lit(""))
    text = sinks.render_vector(F.col("embedding"))
    return table.select(F.concat(F.col("vec_id").cast("string"), F.lit("\t"), text, extra).alias("value"))


@query
def tsv_parse_vectors(spark: SparkSession, sf: str) -> DataFrame:
    parsed = lines.parse_vectors(_vector_lines(spark, sf))
    return parsed.select("token", F.posexplode("vector").alias("dim", "v")).select(
        "token", "dim", F.col("v").cast("double").alias("value")
    )


@query
def packed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors packed into ``token|[…]`` strings and read back."""
    table = _table(spark, sf, "embeddings")
    text = sinks.render_vector(F.col("embedding"))
    packed = table.select(lines.pack_vector(F.col("vec_id").cast("string"), text).alias("value"))
    parsed = lines.parse_packed_vectors(packed)
    return parsed.select("token", F.round(vec.norm(F.col("vector")), 6).alias("norm"))


def _similar_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbour lines of every vector, each with a pair that has no score."""
    rendered = sinks.render_similar(_similar_vectors(spark, sf), token="vec_id")
    return rendered.select(F.concat("value", F.lit(", oops")).alias("value"))


@query
def tsv_parse_similar(spark: SparkSession, sf: str) -> DataFrame:
    parsed = lines.parse_similar(_similar_lines(spark, sf))
    return parsed.select("token", F.posexplode("similar").alias("place", "similar_token"))


@query
def tsv_render_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.render_frequencies(_vocabulary(spark, sf).withColumnRenamed("idx", "token"))


@query
def tsv_render_windows(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.render_windows(_listing_windows(spark, sf))


@query
def tsv_render_vectors(spark: SparkSession, sf: str) -> DataFrame:
    table = _table(spark, sf, "embeddings")
    return sinks.render_vectors(table, token="vec_id", vector="embedding", number_format="%.6f")


@query
def tsv_render_similar(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.render_similar(_similar_vectors(spark, sf), token="vec_id")


@query
def malformed_counts(spark: SparkSession, sf: str) -> DataFrame:
    frequency = _frequency_lines(spark, sf)
    found = [lines.count_malformed(frequency, kind) for kind in ("tokens", "frequencies")]
    found.append(lines.count_malformed(_window_lines(spark, sf), "windows"))
    found.append(lines.count_malformed(_vector_lines(spark, sf), "vectors"))
    merged = found[0]
    for frame in found[1:]:
        merged = merged.unionByName(frame)
    return merged


# Files: from text lines to the lines of a stage or the report, through folders


def _text_files(spark: SparkSession, sf: str, table: str = "documents") -> tuple[str, str]:
    """The texts of a table as a folder of lines, and a new folder for what is made of them."""
    base = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    sinks.write_lines(_table(spark, sf, table).select(F.col("text").alias("value")), f"{base}/text")
    return f"{base}/text", f"{base}/out"


def _tokenised_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    source, out = _text_files(spark, sf)
    stages.tokenise_files(spark, source, f"{out}/tokenization", WORD_PARAMS)
    return f"{out}/tokenization", out


@query
def files_tokenised(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _tokenised_files(spark, sf)
    return lines.parse_frequencies(lines.read_lines(spark, path))


@query
def files_windows(spark: SparkSession, sf: str) -> DataFrame:
    path, out = _tokenised_files(spark, sf)
    stages.window_files(spark, path, f"{out}/windows", WORD_PARAMS)
    return lines.read_lines(spark, f"{out}/windows")


@query
def files_similar(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors of the table as lines, and the lines of their neighbours."""
    base = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    vectors = sinks.render_vectors(_table(spark, sf, "embeddings"), token="vec_id", vector="embedding")
    sinks.write_lines(vectors, f"{base}/vectors")
    stages.similarity_files(spark, f"{base}/vectors", f"{base}/similar", WORD_PARAMS)
    return lines.parse_similar(lines.read_lines(spark, f"{base}/similar")).select(
        "token", F.size("similar").cast("long").alias("n_similar")
    )


@query
def files_overwritten(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier run left in the folder is gone, and the folder has as many files as were asked for."""
    path, _ = _tokenised_files(spark, sf)
    vocabulary = _vocabulary(spark, sf).select(F.col("word").alias("value"))
    sinks.write_lines(vocabulary, path, partitions=3, order="value")
    found = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    return found.groupBy("file").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).agg(
        F.count("*").alias("n_files"), F.sum("n").alias("n_lines"), F.min("low").alias("first"), F.max("high").alias("last")
    )


@query
def files_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """A second write of the tokens fails in one of its rows; what the first one left is whole."""
    path, _ = _tokenised_files(spark, sf)
    broken = F.when(F.col("idx") == 0, F.raise_error(F.lit("broken row"))).otherwise(F.col("word"))
    try:
        sinks.write_lines(_vocabulary(spark, sf).select(broken.cast("string").alias("value")), path)
    except PySparkException:
        return lines.parse_frequencies(lines.read_lines(spark, path))
    raise AssertionError("the broken row was written")


@query
def files_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Splits and lines of one file of all texts, for several sizes of a split."""
    path = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    sinks.write_lines(_table(spark, sf, "documents").select(F.col("text").alias("value")), path, partitions=1)
    found = []
    for split_mb in (1, 2, 4):
        read = lines.read_lines(spark, path, replace(WORD_PARAMS, split_mb=split_mb))
        starts = read.select(F.col("_metadata.file_block_start").alias("start"))
        # Frames of one plan share one setting, so each is read by itself: one row of numbers.
        found.append((split_mb, *starts.agg(F.countDistinct("start"), F.count("*")).first()))
    return spark.createDataFrame(found, "split_mb int, n_splits long, n_lines long")


@query
def files_report(spark: SparkSession, sf: str) -> DataFrame:
    """A shorter list of stages run file by file; the report's records are read back whole."""
    source, out = _text_files(spark, sf)
    return _records(spark, stages.run_files(spark, source, out, replace(WORD_PARAMS, stages=("tokenization",))))


@query
def files_chain(spark: SparkSession, sf: str) -> DataFrame:
    """All stages over the benchmark's texts, each reading the lines that the one before it wrote."""
    source, out = _text_files(spark, sf, "benchmark")
    return _records(spark, stages.run_files(spark, source, out, WORD_PARAMS))


def _records(spark: SparkSession, report: str) -> DataFrame:
    records = spark.read.text(report, lineSep="\n\n").filter(F.length("value") > 0)
    return records.select(F.rtrim("value", F.lit("\n")).alias("record"))
