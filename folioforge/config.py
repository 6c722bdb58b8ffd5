"""Settings of an index: how its collection is named and compared, and how texts are tokenized and encoded."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

DISTANCES = ("Cosine", "Dot", "Euclidean")
PREFIX = "FOLIOFORGE_"


@dataclass(frozen=True)
class Settings:
    name: str = "documents"
    language: str = "ko"
    version: str = "v2"
    distance: str = "Cosine"
    batch_size: int = 32
    late_interaction_batch_size: int = 1
    file_names: tuple[str, ...] = ()

    def __post_init__(self):
        if self.distance not in DISTANCES:
            raise ValueError(f"no distance {self.distance!r}")

    @classmethod
    def of_environment(cls, environment: Mapping[str, str] = os.environ, **given) -> Settings:
        """Each setting as given, or (where that is None) by FOLIOFORGE_<NAME> in the environment, or its default."""
        found = {}
        for f in fields(cls):
            value = given.get(f.name)
            if value is None:
                value = environment.get(PREFIX + f.name.upper())
            if value is not None:
                found[f.name] = file_names(value) if f.name == "file_names" else type(f.default)(value)
        return cls(**found)

    @property
    def safe_version(self) -> str:
        return re.sub(r"[^a-zA-Z0-9._-]", "_", self.version.strip()) or "v1"

    @property
    def collection(self) -> str:
        return f"{self.name}_{self.safe_version}_{self.language}"


def file_names(value: str | list[str] | tuple[str, ...] | None) -> tuple[str, ...]:
    """A list of names, given as one or as comma-separated text."""
    parts = value.split(",") if isinstance(value, str) else (value or [])
    return tuple(p.strip() for p in parts if p and p.strip())
