"""Default settings in one place; the environment may override them by upper-case name."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 1000
    chunk_overlap: int = 200
    batch_tokens: int = 8000
    batch_items: int = 2048
    requests_per_minute: int = 3000
    tokens_per_minute: int = 900_000
    max_retries: int = 3
    retry_base_seconds: float = 1.0
    retry_max_seconds: float = 60.0
    top_k: int = 10
    least_characters: int = 10
    least_characters_for_extraction: int = 30
    most_characters_for_extraction: int = 60_000
    embedding_dimension: int = 384

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        return cls(**{f.name: type(f.default)(env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env})
