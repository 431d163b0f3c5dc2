"""Parameters of the live jobs: defaults with any given values on top."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class JobParams:
    """Knobs of the live jobs.  Defaults are fixed values."""

    sma_window: int = 20
    rsi_window: int = 14
    starting_cash: float = 100_000.0
    min_ai_confidence: int = 0
    trade_size_shares: int = 1
    auto_trade: bool = False
    position_sizing: str = "fixed"
    risk_pct: float = 0.05
    use_rsi: bool = True
    use_macd: bool = True
    use_volume: bool = True
    base_price: float | None = 100.0
    max_live_return: float = 0.10
    volume_threshold: float = 15_000_000.0
    shock_threshold: float = 2.0
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    replay_errors: int = 50

    @classmethod
    def from_mapping(cls, values: dict) -> "JobParams":
        """Defaults overlaid with ``values``; keys that are not knobs are ignored."""
        known = {f.name for f in fields(cls)}
        return replace(cls(), **{k: v for k, v in values.items() if k in known})

    @classmethod
    def from_json(cls, text: str) -> "JobParams":
        return cls.from_mapping(json.loads(text))
