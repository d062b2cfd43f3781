"""Cleaning configuration.

A frozen dataclass built on the driver. Each flag decides at plan-building time
whether a cleaning step adds expressions to the plan at all, so a disabled step
costs nothing. ``merge`` applies a per-call override on top of the settings
(flat ``typo_*`` keys and the nested ``typo_correction`` block are both
honoured; unset keys keep the settings' values).
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from typing import Any, Mapping

# Entity types kept on the cleaned text (fixed values of the shipped settings).
DEFAULT_ENTITY_TYPES = ("PERSON", "ORG", "GPE", "LOC", "DATE", "TIME", "MONEY", "PERCENT")


@dataclass(frozen=True)
class CleaningConfig:
    # Setting names and their defaults.
    remove_html_tags: bool = True
    normalize_whitespace: bool = True
    fix_encoding: bool = True
    normalize_punctuation: bool = True
    normalize_unicode_dashes: bool = True
    normalize_smart_quotes: bool = True
    remove_excessive_punctuation: bool = True
    add_space_after_punctuation: bool = True
    standardize_units: bool = True
    standardize_currency: bool = True
    enable_typo_correction: bool = True
    typo_min_length: int = 3
    typo_max_length: int = 15
    typo_skip_capitalized: bool = True
    typo_skip_mixed_case: bool = True
    typo_use_ner: bool = True
    typo_confidence: float = 0.7
    # Extra user steps, by registry name, run after the built-in chain
    # (before the final whitespace pass).
    extra_steps: tuple[str, ...] = field(default_factory=tuple)

    @staticmethod
    def settings_default() -> "CleaningConfig":
        """The shipped settings file: everything on, minimum typo length 2."""
        return CleaningConfig(typo_min_length=2)

    def merge(self, override: Mapping[str, Any] | None) -> "CleaningConfig":
        if not override:
            return self
        names = {f.name for f in fields(self)}
        upd: dict[str, Any] = {}
        nested = override.get("typo_correction") or {}
        # Names inside the nested block.
        nested_map = {
            "min_word_length": "typo_min_length",
            "max_word_length": "typo_max_length",
            "skip_capitalized_words": "typo_skip_capitalized",
            "skip_mixed_case": "typo_skip_mixed_case",
            "use_ner_entities": "typo_use_ner",
            "confidence_threshold": "typo_confidence",
        }
        for k, v in nested.items():
            if k in nested_map and v is not None:
                upd[nested_map[k]] = v
        for k, v in override.items():
            if k in names and v is not None:
                upd[k] = tuple(v) if k == "extra_steps" else v
        return replace(self, **upd)

    @property
    def typo_max_len_diff(self) -> float:
        return (1.0 - self.typo_confidence) * 10


@dataclass(frozen=True)
class PipelineConfig:
    """Settings of the full preprocess job beyond text cleaning."""

    cleaning: CleaningConfig = field(default_factory=CleaningConfig.settings_default)
    entity_recognition: bool = True
    entity_types: tuple[str, ...] = DEFAULT_ENTITY_TYPES
    language_min_chars: int = 10
    words_per_minute: int = 200
    # Write shared intermediates to the checkpoint folder instead of letting
    # each plan branch recompute the text chain.
    materialize: bool = True
