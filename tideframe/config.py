"""Parameters of the engine, and the tree of settings a deployment is read from."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class FeatureConfig:
    """Parameters of the order-book features and bars. Horizons and durations are seconds."""

    horizons: tuple[int, ...] = (5, 15, 60, 300, 900)
    bar_durations: tuple[int, ...] = (60, 300, 900, 3600)
    hf_emit_interval: float = 1.0
    max_levels: int = 20
    ofi_levels: int = 10
    ofi_decay_alpha: float = 0.5
    bands_bps: tuple[int, ...] = (5, 10, 25, 50, 100)
    keep_raw_arrays: bool = False
    tight_spread_threshold: float = 1e-4
    use_dynamic_spread_regime: bool = True
    spread_regime_window: int = 300
    spread_tight_percentile: float = 0.2
    spread_wide_percentile: float = 0.8
    kyle_lambda_window: int = 300
    depth_window: int = 300
    slope_window: int = 60
    vpin_bucket_count: int = 50
    vpin_window_buckets: int = 50
    #: Evict trades from the flow windows at snapshots too, not only at the last trade.
    evict_on_snapshot: bool = False

    @classmethod
    def from_options(cls, options: dict) -> "FeatureConfig":
        """Options by name; ``hf_sample_interval`` is another name of ``hf_emit_interval``; unknown ones are dropped."""
        known = {f.name for f in dataclasses.fields(cls)}
        got = {"hf_emit_interval" if k == "hf_sample_interval" else k: v for k, v in options.items()}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in got.items() if k in known})


@dataclass
class ChannelConfig:
    enabled: bool = True
    partition_cols: list[str] = field(default_factory=lambda: ["exchange", "symbol", "date"])
    processor_options: dict = field(default_factory=dict)


@dataclass
class Config:
    """Storage paths, ingestion bounds and channels."""

    raw_dir: str = "data/raw"
    processed_dir: str = "data/processed"
    sources: dict = field(default_factory=dict)
    segment_max_mb: int = 100
    max_files_per_trigger: int = 100
    poll_seconds: int = 30
    compression: str = "zstd"
    delete_after_processing: bool = True
    channels: dict[str, ChannelConfig] = field(default_factory=lambda: {c: ChannelConfig() for c in ("ticker", "trades", "orderbook")})

    def layout(self, source: str) -> dict[str, str]:
        """Folders of a source: raw/{active,ready,processing}/source and processed/source."""
        return {k: f"{self.raw_dir}/{k}/{source}" for k in ("active", "ready", "processing")} | {"processed": f"{self.processed_dir}/{source}"}

    def enabled_channels(self) -> list[str]:
        return [c for c, o in self.channels.items() if o.enabled]

    @classmethod
    def from_dict(cls, tree: dict) -> "Config":
        ch = {k: ChannelConfig(**v) for k, v in tree.get("channels", {}).items()}
        return cls(**{k: v for k, v in tree.items() if k in {f.name for f in dataclasses.fields(cls)} and k != "channels"}, **({"channels": ch} if ch else {}))

    def to_dict(self) -> dict:
        return dataclasses.asdict(self)


#: Variable that names the settings file; then a file in the working folder, then one in the home folder.
CONFIG_VARIABLE = "TIDEFRAME_CONFIG"


def _read(path: Path) -> dict:
    text = path.read_text()
    if path.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: reading YAML needs the yaml package; JSON is read without") from e
        return yaml.safe_load(text) or {}
    return json.loads(text)


def load_config(path: str | None = None) -> Config:
    """The first settings file found, or the defaults."""
    named = path or os.environ.get(CONFIG_VARIABLE)
    places = [Path(named)] if named else [p for d in (Path("config"), Path.home() / ".tideframe") for p in (d / "config.yaml", d / "config.json")]
    for p in places:
        if p.exists():
            return Config.from_dict(_read(p))
    if named:
        raise FileNotFoundError(named)
    return Config()


def write_example(path: str) -> None:
    """A settings file with every default, as JSON."""
    Path(path).write_text(json.dumps(Config().to_dict(), indent=2))
