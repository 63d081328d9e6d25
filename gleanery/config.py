"""Every threshold of the engine, in one place."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class EngineConfig:
    """Fixed values of the domain; from_env() lets the environment override single ones."""

    key_length: int = 40
    token_length: int = 4
    short_title_tokens: int = 2
    series_cap: int = 60
    listed_dates: int = 5
    label_weekdays: int = 3
    segment_max_chars: int = 4000
    segment_target_paragraphs: int = 6
    card_siblings: int = 3
    card_min_chars: int = 40
    card_max_chars: int = 6000
    card_chrome_limit: float = 0.5
    batch_chars: int = 40_000
    batch_overhead: int = 12
    digest_chars: int = 3900
    container_days: int = 8
    container_probes: int = 3
    container_children: int = 2
    followups_per_source: int = 7
    followups_per_run: int = 400
    same_page_days: int = 30
    blocked_limit: int = 3
    blocked_recheck_days: int = 14
    registry_keep_days: int = 90
    host_limit: int = 3
    host_recheck_days: int = 30
    author_limit: int = 3
    author_mute_days: int = 30
    block_empty_days: int = 14
    block_keep_days: int = 30
    event_page_days: int = 7
    poster_empty_days: int = 30
    group_limit_max: int = 50
    group_limit_min: int = 5
    group_margin: float = 0.2
    price_ceiling: float = 0.02
    min_runs: int = 5
    mute_days: int = 30
    town_floor: int = 1
    probation_share: float = 0.15
    monthly_budget: float = 15.0
    record_rate: float = 0.0015
    query_rate: float = 0.001
    min_confidence: float = 0.5
    miss_limit: int = 2
    template_group: int = 3
    stem_length: int = 5
    rare_weight: int = 3
    common_weight: int = 1
    covered_score: int = 3
    geo_margin_km: float = 25.0
    new_links: int = 2
    repertoire: tuple[str, ...] = ("repertuar", "repertoire", "spektakle", "seanse")

    @classmethod
    def from_env(cls, prefix: str = "GLEANERY_") -> EngineConfig:
        """Defaults, with numbers that the environment names; what isn't a number leaves the default."""
        config = cls()
        for f in fields(cls):
            raw, default = os.environ.get(prefix + f.name.upper()), getattr(config, f.name)
            if raw is None:
                continue
            try:
                config = replace(config, **{f.name: tuple(raw.split(",")) if isinstance(default, tuple) else type(default)(raw)})
            except ValueError:
                continue
        return config


CONFIG = EngineConfig()
