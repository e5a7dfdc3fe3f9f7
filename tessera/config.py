"""Settings of a linkage run, passed as an argument everywhere."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Settings:
    """Defaults of retrieval, training, tuning and evaluation."""

    top_k: int = 10
    min_score: float = 0.05
    most_candidates: int = 30
    name_weight: float = 0.6
    address_weight: float = 0.4
    gram_sizes: tuple[int, ...] = (2, 3)
    vocabulary_cap: int = 300_000
    use_country: bool = True
    negatives_per_positive: int = 5
    negatives_without_positive: int = 2
    validation_share: float = 0.1
    seed: int = 42
    threshold_first: float = 0.1
    threshold_step: float = 0.01
    threshold_points: int = 81
    default_threshold: float = 0.5
    trees: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    least_rows: int = 50
    row_share: float = 0.8
    column_share: float = 0.8
    tolerance: float = 0.001
    retrain: bool = False
    refit: bool = False
    regenerate: bool = False

    def key(self, *parts: str) -> str:
        """Name of what these settings and ``parts`` (such as a split) make; flags that only force work don't count."""
        kept = {k: v for k, v in asdict(self).items() if k not in ("retrain", "refit", "regenerate")}
        return hashlib.sha256(repr((sorted(kept.items()), parts)).encode()).hexdigest()[:16]
