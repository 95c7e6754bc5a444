"""Parameters of the engine, with the reference defaults, and their hashes."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass


def canonical_hash(value) -> str:
    """SHA-256 of canonical JSON (sorted keys, compact, ASCII)."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class FilterPolicy:
    #: Names and defaults are what the policy's hash is made of; the terms keep a short review.
    policy_version: str = "eligibility-v1"
    large_corpus_threshold: int = 10_000
    short_character_threshold: int = 10
    short_word_threshold: int = 3
    repeated_character_ratio: float = 0.8
    repeated_token_threshold: int = 3
    high_signal_terms: tuple[str, ...] = ("bug", "crash", "error", "lag", "love", "hate", "refund", "refundé", "おすすめ", "喜欢", "плохо", "ошибка")

    def folded_terms(self) -> list[str]:
        return sorted(term.casefold() for term in self.high_signal_terms)

    def hash(self) -> str:
        """Depends on what the policy means, not on the order or case of its terms."""
        return canonical_hash(asdict(self) | {"high_signal_terms": self.folded_terms()})


@dataclass(frozen=True)
class BatchLimits:
    max_items: int = 20
    max_tokens: int = 6000
    max_output_tokens: int = 4096
    min_split_items: int = 1

    def __post_init__(self):
        if min(self.max_items, self.max_tokens, self.min_split_items) < 1:
            raise ValueError("batch limits must be positive")


@dataclass(frozen=True)
class Selection:
    scope: str = "unclassified-only"
    seed: int = 0
    full_corpus_threshold: int = 10_000
    ceiling: int = 0


@dataclass(frozen=True)
class EvidenceLimits:
    limit: int = 12
    per_language: int = 3
    max_chars: int = 280

    def __post_init__(self):
        if min(self.limit, self.per_language, self.max_chars) < 1:
            raise ValueError("evidence limits must be positive")


@dataclass(frozen=True)
class Cohorts:
    early_below: int = 60
    established_below: int = 600


@dataclass(frozen=True)
class BriefLimits:
    """Most items of a recommendation set and of the payload behind it."""

    metrics: int = 120
    evidence: int = 24
    findings: int = 8
    priorities: int = 10
    risks: int = 8
    vulnerabilities: int = 8


def configuration_hash(*parts) -> str:
    """Of all parameters of a run (the classes above), by their names; independent of their order."""
    return canonical_hash({type(p).__name__: asdict(p) for p in parts})


def prompt_hash(version: str, *texts: str) -> str:
    """Of a prompt's version and texts, without regard to white space at line ends and around them."""
    return canonical_hash([version, *["\n".join(line.rstrip() for line in t.strip().splitlines()) for t in texts]])


#: Label sets of the structured result.
POSTURES = ("advocacy", "satisfied", "qualified_satisfaction", "mixed", "frustrated_but_engaged", "rejection", "unclear")
SENTIMENTS = ("positive", "negative", "mixed", "neutral")
ABANDONMENT_TYPES = ("refund", "uninstall", "stopped_playing", "abandoned", "other")
FRICTION = ("rejection", "frustrated_but_engaged")
COHORT_NAMES = ("early", "established", "long", "unknown")
