"""Parameters of the story pipeline, with the defaults of the news job."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    sample_size: int = 500
    time_window_days: int = 3
    alpha_ent: float = 0.27
    alpha_place: float = 0.05
    time_bonus: float = 0.05
    assign_thresh: float = 0.74
    top_k_attach: int = 20
    topic_min_sim: float = 0.30
    topic_margin: float = 0.04
    topic_secondary_min: float = 0.28
    topic_max_candidates: int = 3
    zh_dup_ngram: int = 3
    zh_dup_max_hamming: int = 3
    zh_dup_refine_n: int = 5
    zh_dup_min_j: float = 0.90
    zh_dup_tie_secs: int = 60
    embed_max_chars: int = 380
    cluster_history_days: int = 10
    #: "now" of a run, epoch seconds: never the clock's, so that a run can be repeated.
    now: int = 1706659200

    @classmethod
    def from_env(cls) -> Params:
        """Defaults, replaced by environment variables of the same name in capitals."""
        found = {f.name: type(f.default)(os.environ[f.name.upper()]) for f in fields(cls) if os.environ.get(f.name.upper())}
        return cls(**found)
