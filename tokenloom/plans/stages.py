"""Single stages from line files to line files, so that any of them can be run alone or be replaced.

Each reads what the stage before it wrote, replaces its target, and leaves malformed lines out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators import collate, embeddings, ordering, similarity, subwords, windows
from tokenloom.params import Params
from tokenloom.plans import chain
from tokenloom.session import materialise
from tokenloom.sources import lines, sinks


def tokenise_files(
    spark: SparkSession, source: str, target: str, params: Params = Params(), merges: subwords.Merges | None = None
) -> None:
    """Text lines to ``word \\t token \\t frequency``."""
    docs = chain.documents_from_lines(lines.read_lines(spark, source, params))
    counted = chain.tokenization(chain.Run(docs, params, merges))
    sinks.write_lines(sinks.render_frequencies(counted, params), target, params.output_partitions)


def window_files(spark: SparkSession, source: str, target: str, params: Params = Params()) -> None:
    """Token-frequency lines to window and label lines, sliding over the tokens in the order of their lines' text."""
    raw = lines.read_lines(spark, source, params)
    good = raw.filter(lines.well_formed(F.col("value"), "tokens", params))
    token = F.get(lines.fields(F.col("value"), params.field_delimiter), F.lit(params.token_index))
    # The line's own number keeps equal lines apart, so that many of them can still be split over tasks.
    numbered = good.select("value", F.monotonically_increasing_id().alias("line"), token.alias("token"))
    listing = ordering.global_index(numbered, "value", "line")
    segments = windows.listing_segments(listing, "token", params.window_size)
    found = windows.context_windows(segments, params.window_size)
    sinks.write_lines(sinks.render_windows(found, params), target, params.output_partitions)


def read_windows(spark: SparkSession, source: str, params: Params = Params()) -> DataFrame:
    """Window and label lines as ``(seq, pos, input, label, is_last)``. An index is ``pos`` or ``seq_pos``."""
    paired = lines.pair_windows(lines.parse_windows(lines.read_lines(spark, source, params), params))
    parts = F.split(F.col("idx"), "_")
    numbered = materialise(
        paired.select(
            F.when(F.size(parts) > 1, parts[0]).otherwise("0").cast("long").alias("seq"),
            F.element_at(parts, -1).cast("long").alias("pos"),
            "input",
            "label",
        )
    )
    # The last window of a sequence is the one that no other follows; looked up by place, not gathered by sequence.
    followed = numbered.select("seq", (F.col("pos") - 1).alias("pos"), F.lit(False).alias("last"))
    return numbered.join(followed, ["seq", "pos"], "left").select(
        "seq", "pos", "input", "label", F.coalesce("last", F.lit(True)).alias("is_last")
    )


def window_segments(found: DataFrame, more: bool = False) -> DataFrame:
    """Windows as segments: each owns its first token, and the last of a sequence all of them.

    With ``more``, windows that another one follows show a token beyond their label, which tells them from the last.
    """
    tokens = F.concat("input", F.array("label"))
    owned = F.when(F.col("is_last"), F.size(tokens)).otherwise(F.lit(1))
    if more:
        tokens = F.when(F.col("is_last"), tokens).otherwise(F.concat(tokens, F.array("label")))
    return found.select("seq", F.col("pos").alias("start"), owned.alias("owned"), tokens.alias("tokens"))


def embed_files(spark: SparkSession, source: str, target: str, params: Params = Params()) -> None:
    """Window and label lines to ``token \\t [vector]``."""
    found = read_windows(spark, source, params)
    if params.embedding == "autoencoder":
        vectors = chain.autoencoder_vectors(window_segments(found, more=True), params)
    elif params.embedding == "cooccurrence":
        segments = window_segments(found)
        vectors = embeddings.context_vectors(segments, params.embedding_window, params.embedding_size)
        vectors = vectors.withColumnRenamed("word", "token")
    else:
        raise ValueError(f"no embedding {params.embedding} from windows")
    sinks.write_lines(sinks.render_vectors(vectors, params), target, params.output_partitions)


def similarity_files(spark: SparkSession, source: str, target: str, params: Params = Params()) -> None:
    """Vector lines to ``token \\t t(score),…``. Of several vectors for a token one is chosen by a fixed rule."""
    parsed = lines.parse_vectors(lines.read_lines(spark, source, params), params)
    unique = embeddings.dedup_vectors(parsed.withColumn("role", F.lit("input")))
    found = similarity.top_similar(unique, "token", "vector", params.top_k, params.chunk_bytes)
    sinks.write_lines(sinks.render_similar(found, params), target, params.output_partitions)


def collate_files(
    spark: SparkSession, frequencies: str, similar: str, target: str, params: Params = Params()
) -> DataFrame:
    """Token-frequency lines and neighbour lines to the report, sorted by token; returns the records."""
    counted = lines.parse_frequencies(lines.read_lines(spark, frequencies, params), params)
    neighbours = lines.parse_similar(lines.read_lines(spark, similar, params), params)
    collated = collate.collate(counted, neighbours, params)
    report = collate.report_yaml(collated, params).select("token", F.col("text").alias("value"))
    sinks.write_lines(report, target, params.output_partitions, "token")
    return collated


FILE_STAGES: dict[str, Callable[..., None]] = {
    "tokenization": tokenise_files,
    "sliding_window": window_files,
    "embedding": embed_files,
    "semantic_similarity": similarity_files,
}


def _committed(output_base: str, stage: str) -> str:
    return f"{output_base}/_committed/{stage}"


def run_files(spark: SparkSession, source: str, output_base: str, params: Params = Params(), resume: bool = False) -> str:
    """Run the configured stages file by file, then the final merge; returns the report's path.

    A stage that fails raises; its output and those after it stay as they were. Stages that end are noted in
    ``<output_base>/_committed``, with a digest of what they were run with. With ``resume``, leading stages noted with
    the same digest are not run again. Sources must not have changed since; their content is not looked at.
    """
    current, fresh = source, not resume
    for i, stage in enumerate((*params.stages, params.final_stage)):
        target, note = f"{output_base}/{stage}", _committed(output_base, stage)
        digest = hashlib.sha256(repr((source, params, params.stages[: i + 1], stage)).encode()).hexdigest()
        if not fresh and sinks.exists(spark, target) and sinks.exists(spark, note) and spark.read.text(note).first().value == digest:
            current = target
            continue
        if not fresh or i == 0:
            # From here on nothing that was noted before holds.
            for later in (*params.stages[i:], params.final_stage):
                sinks._remove(spark, _committed(output_base, later))
        fresh = True
        if stage == params.final_stage:
            collate_files(spark, f"{output_base}/{params.stages[0]}", current, target, params)
        else:
            FILE_STAGES[stage](spark, current, target, params)
            current = target
        sinks.write_lines(spark.createDataFrame([(digest,)], "value string").coalesce(1), note)
    return f"{output_base}/{params.final_stage}"
