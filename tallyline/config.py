"""Settings of an ingest: limits, folders and proxies."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path

#: The order in which environment variables name a proxy.
PROXY_VARIABLES = ("HTTP_PROXY", "HTTPS_PROXY", "http_proxy", "https_proxy")


def _named(env: Mapping[str, str], names: tuple[str, ...]) -> str | None:
    return next((value for name in names if (value := (env.get(name) or "").strip())), None)


@dataclass(frozen=True)
class Settings:
    currency: str = "BTC"
    proxy: str | None = None
    base_dir: Path = field(default=Path("data/BTC"))
    chunk_size: int = 10_000
    max_rps: int = 20
    max_workers: int = 40
    url: str = ""

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """The currency (blank: BTC) and proxy of the environment; data under ./data/<currency>."""
        env = os.environ if env is None else env
        currency = (env.get("CURRENCY") or "").strip() or "BTC"
        return cls(currency=currency, proxy=_named(env, PROXY_VARIABLES), base_dir=Path("data") / currency)

    def at(self, base_dir: str | os.PathLike | None) -> Settings:
        """These settings with files directly under ``base_dir``; unchanged where that is empty."""
        return replace(self, base_dir=Path(base_dir)) if base_dir else self

    def raw_dir(self, kind: str) -> Path:
        return self.base_dir / kind

    def ledger_file(self, kind: str) -> Path:
        return self.base_dir / f"{kind}.db"

    def compacted(self, kind: str) -> Path:
        return self.base_dir / f"{kind}.parquet"
