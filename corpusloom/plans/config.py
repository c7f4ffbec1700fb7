"""Configuration of a curation run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any, TypeVar

from corpusloom.operators.fuzzy import FuzzyConfig
from corpusloom.operators.semantic import SemanticConfig

C = TypeVar("C")


@dataclass(frozen=True)
class CurationConfig:
    """Stage switches and their parameters; the order of stages is fixed."""

    text_field: str = "text"
    id_field: str = "id"
    language: str = ""
    cleaning: bool = False
    lid: bool = False
    heuristic: bool = False
    heuristic_min_words: int = 50
    pii: bool = False
    pii_entities: tuple[str, ...] = ("PHONE_NUMBER", "EMAIL_ADDRESS", "IP_ADDRESS")
    pii_anonymize_action: str = "replace"
    #: Further entities, or other patterns for known ones: name and regular expression.
    pii_patterns: tuple[tuple[str, str], ...] = ()
    exact: bool = False
    fuzzy: bool = False
    fuzzy_config: FuzzyConfig = field(default_factory=FuzzyConfig)
    semantic: bool = False
    semantic_config: SemanticConfig = field(default_factory=SemanticConfig)


def from_mapping(cls: type[C], values: Mapping[str, Any]) -> C:
    """Build a config dataclass; an unknown key is an error, not a silent default."""
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings for {cls.__name__}: {unknown}")
    return cls(**values)


def from_yaml(cls: type[C], path: str) -> C:
    import yaml

    with open(path, encoding="utf-8") as file:
        return from_mapping(cls, yaml.safe_load(file) or {})
