"""Where layered tables live and in which format they are stored."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LayerConfig:
    """Immutable storage settings, passed in by the caller.

    ``format`` is any Spark table format. ``parquet`` works everywhere; ``delta``
    needs the Delta jars on the cluster's class path.
    """

    base_path: str
    format: str = "parquet"

    def __post_init__(self) -> None:
        if not self.base_path:
            raise ValueError("base_path must not be empty")
        object.__setattr__(self, "base_path", self.base_path.rstrip("/") or "/")

    @classmethod
    def on_adls(cls, container: str, account: str, format: str = "delta") -> LayerConfig:
        """Settings for a container of an ADLS Gen2 account."""
        return cls(f"abfss://{container}@{account}.dfs.core.windows.net", format)

    def layer_path(self, layer: str, table: str | None = None) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return self._below(layer, table)

    def checkpoint_path(self, job: str | None = None) -> str:
        return self._below("checkpoints", job)

    def temp_path(self, name: str | None = None) -> str:
        return self._below("temp", name)

    def as_dict(self) -> dict[str, str]:
        paths = {f"{layer}_path": self.layer_path(layer) for layer in LAYERS}
        return {
            "base_path": self.base_path,
            "format": self.format,
            **paths,
            "checkpoint_path": self.checkpoint_path(),
            "temp_path": self.temp_path(),
        }

    def _below(self, *parts: str | None) -> str:
        return "/".join([self.base_path.rstrip("/"), *(p for p in parts if p)])
