"""Pipeline settings as one frozen dataclass.

Fixed values that must equal the source system's defaults are grouped here.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    # -- fixed values: source filters and join tolerances --------------------
    game_type_filter: str = "Live Casino"
    bet_status_filter: str = "SETTLED"
    session_source_filter: str | None = "livecasino"
    session_join_tolerance_min: int = 60
    device_join_tolerance_hours: int = 24
    # -- fixed values: game name normalisation map --------------------------
    game_name_map: dict = field(
        default_factory=lambda: {
            "998:baccarat": "Baccarat",
            "Football studio": "Football Studio",
        }
    )
    # -- fixed values: model hyper-parameters --------------------------------
    no_components: int = 32
    learning_rate: float = 0.03
    item_alpha: float = 1e-6
    user_alpha: float = 1e-6
    n_epochs: int = 20
    seed: int = 42
    eval_k: int = 5
    # -- fixed values: feature store / graph export --------------------------
    feature_ttl_seconds: int = 90000
    graph_batch_size: int = 500
    # -- fixed values: diagnostics -------------------------------------------
    top_attribution_features: int = 8
    stability_samples: int = 6
    stability_fraction: float = 0.7
    permutation_top_features: int = 8
    ablation_top_features: int = 3
    local_explanation_users: int = 4
    local_explanation_features: int = 6
    # -- scale knobs (not part of the source system) -------------------------
    # Width of the time buckets used to split hot users in per-user windows.
    window_bucket_seconds: int = 86400
    # Bytes of item vectors in one scoring block.
    item_block_bytes: int = 2 << 20
    # Most (user, game) pairs one WARP shard trains on per epoch; the shard
    # count grows with the data so no task holds an unbounded share.
    warp_rows_per_shard: int = 131_072


DEFAULT = Settings()
