"""Every tunable of the token-statistics chain, with its default."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Reading and writing
    split_mb: int = 100
    field_delimiter: str = "\t"
    output_partitions: int | None = None

    # Text to tokens
    preprocessing_regex: str = r"[^a-z0-9\s]"
    tokeniser: str = "subword"  # or "word"
    n_merges: int = 64
    min_count: int = 1

    # Context windows
    window_size: int = 4
    token_index: int = 1
    order: str = "corpus"  # or "listing": slide over the sorted vocabulary listing

    # Embeddings
    embedding: str = "cooccurrence"  # or "autoencoder"
    embedding_window: int = 4
    embedding_size: int = 50
    activation: str = "TANH"
    output_activation: str = "IDENTITY"
    loss: str = "MSE"
    learning_rate: float = 1e-3
    epochs: int = 1
    batch: int = 256  # windows of one training step
    local_steps: int = 64  # steps that a part of the corpus takes between two averages
    rounds: int = 4  # averages of an epoch
    readout: str = "hidden"  # or "weights"
    seed: int = 42

    # Similarity
    embedding_delimiter: str = "|"
    top_k: int = 5
    similarity_format: str = "%.4f"

    # Collation and report
    similarity_pair_delimiter: str = ","
    similarity_score_delimiter: str = "("
    na_value: str = "N/A"
    word_key: str = "word"
    int_token_key: str = "intToken"
    frequency_key: str = "frequency"
    similar_tokens_key: str = "semanticallySimilarTokens"

    # Stages, in order; the collated report always reads the first and the last of them.
    stages: tuple[str, ...] = ("tokenization", "sliding_window", "embedding", "semantic_similarity")
    final_stage: str = "statistics_collated"

    # Bytes of vectors in a stretch; a task of the similarity search compares two of them.
    chunk_bytes: int = 16 << 20

    @property
    def look_ahead(self) -> int:
        """Tokens that a segment must know beyond its own."""
        return max(self.window_size, self.embedding_window) + 1
