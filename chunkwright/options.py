"""Settings of a run."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass


#: Blocks a table of vectors is cut into; more only where a block would exceed ``block_bytes``.
_BLOCKS = 16


@dataclass(frozen=True)
class Options:
    # The defaults a user of the original settings file expects.
    min_tokens: int = 5
    max_tokens: int = 350
    duplicate_cosine: float = 0.98
    sample_rate: float = 1.0
    sample_unit: str = "chunks"
    target_queries: int = 0
    num_distractors: int = 3
    golden_chunks: int = 1  # of one document, in a bundle
    query_types: tuple[str, ...] = ("factual", "keyword")
    embed_dim: int | None = None
    seed: int = 42
    temperature: float = 0.5
    answer_tokens: int = 32
    model: str = ""
    template_version: str = "1"
    ivf_nlist: int = 1024
    ivf_nprobe: int = 64
    min_margin: float = 0.5
    min_golden_coverage: float = 0.6
    min_coverage_gap: float = 0.2
    escalation_rate: float = 0.1
    judge_threshold: float = 0.8

    # Choices of this engine.
    duplicate_policy: str = "any_earlier"  # or "greedy"
    distractor_pool: str = "validated"  # or "pre_dedup"
    strategy: str = "exact"  # or "ivf", "hybrid", "external"
    on_missing_score: str = "accept"  # or "reject"
    stop_words: tuple[str, ...] = ()
    block_rows: int = 8192  # of a small table; larger ones have _BLOCKS blocks, more where block_bytes says so
    block_bytes: int = 64 * 1024 * 1024
    max_pivots: int = 1024  # cells of the vector joins; bounds cost, never the result
    hybrid_vector_extra: int = 5  # rows of either list beyond those asked for
    hybrid_text_extra: int = 10
    ivf_training_rows: int = 256  # sampled for each of the ivf_nlist centres
    broadcast_bytes: int = 64 * 1024 * 1024
    broadcast_rows: int = 20_000

    def __post_init__(self) -> None:
        allowed = {
            "sample_unit": ("chunks", "documents"),
            "duplicate_policy": ("any_earlier", "greedy"),
            "distractor_pool": ("validated", "pre_dedup"),
            "strategy": ("exact", "ivf", "hybrid", "external"),
            "on_missing_score": ("accept", "reject"),
        }
        for field, values in allowed.items():
            if getattr(self, field) not in values:
                raise ValueError(f"{field}={getattr(self, field)!r}; expected one of {values}")
        if self.golden_chunks < 1:
            raise ValueError(f"golden_chunks={self.golden_chunks}; expected at least 1")

    def rows_per_block(self, dim: int, rows: int = 0) -> int:
        """Rows sent together of a table of ``rows``: a share of them, so that what is sent grows as the table does."""
        most = max(256, self.block_bytes // (8 * max(dim, 1)))
        return min(most, max(self.block_rows, -(-rows // _BLOCKS)))

    def config_hash(self) -> str:
        """Short digest of the ``_STALE`` settings: other values of theirs need other answers."""
        digest = hashlib.blake2b(digest_size=8)
        for name in _STALE:
            part = f"{name}={getattr(self, name)!r}".encode()
            digest.update(len(part).to_bytes(4, "big") + part)
        return digest.hexdigest()


#: Settings that make a stored answer stale when they change.
_STALE = (
    "model",
    "template_version",
    "query_types",
    "temperature",
    "answer_tokens",
    "min_tokens",
    "max_tokens",
    "duplicate_cosine",
)
