"""A settings file as the parameters of the stages: one table of keys, and a check of what is set."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from ..operators.generation import Provider, constant_provider, http_provider
from ..operators.retrieval import RetrievalConfig
from .pipeline import EvidenceConfig, ExportConfig, RewriteConfig

# --- fixed values: keys of the file and the parameters they set --------------------------------
EVIDENCE = {"filters.min_evidence_chars": "least", "filters.max_evidence_chars": "most"}
RETRIEVAL = {
    "embedding.candidate_pool_k": "pool", "embedding.final_top_k": "top", "embedding.min_score": "min_score", "embedding.symptom_weight": "symptom_weight",
    "embedding.system_match_bonus": "system_bonus", "embedding.system_mismatch_penalty": "system_penalty", "embedding.powertrain_mismatch_penalty": "powertrain_penalty",
    "embedding.diversity_score_margin": "diversity_margin", "embedding.dtc_boost": "code_boost", "embedding.dedup_similarity": "dedup_similarity",
}
REWRITE = {"filters.max_base_answer_chars": "base_chars", "filters.max_evidence_chars": "evidence_chars", "generation.provider": "provider_name"}
EXPORT = {"seed": "seed", "export.max_conversation_chars": "max_chars", "export.max_tokens": "max_tokens", "export.review_samples_per_route": "review_per_group"}
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    evidence: EvidenceConfig = EvidenceConfig()
    retrieval: RetrievalConfig = RetrievalConfig()
    rewrite: RewriteConfig = RewriteConfig()
    export: ExportConfig = field(default_factory=ExportConfig)
    #: (train, validation) shares in percent by source
    splits: dict = field(default_factory=lambda: {"d1": (90, 5), "d2": (90, 5), "d4": (80, 10)})
    #: ready-made samples taken along; None: none of them, 0: all
    legacy: int | None = 100
    recall: dict = field(default_factory=dict)


def value_of(settings: dict, key: str):
    """(whether the key is set, its value); dots go into nested groups."""
    at = settings
    for part in key.split("."):
        if not isinstance(at, dict) or part not in at:
            return False, None
        at = at[part]
    return True, at


def applied(base, settings: dict, keys: dict[str, str]):
    """The parameters with those that the file sets in place."""
    found = {name: value_of(settings, key) for key, name in keys.items()}
    return replace(base, **{name: v for name, (there, v) in found.items() if there})


def parameters(settings: dict) -> Settings:
    """All stages' parameters; what the file leaves out keeps its default, and impossible values are refused by the parameters' own checks."""
    base = Settings()
    caps = {split: n for split in ("validation", "test") for there, n in [value_of(settings, f"export.{split}_limit")] if there}
    export = applied(base.export, settings, EXPORT)
    shares = {}
    for source, (train, validation) in base.splits.items():
        given = [value_of(settings, f"splits.{source}_{part}") for part in ("train", "validation")]
        shares[source] = tuple(v if there else d for (there, v), d in zip(given, (train, validation)))
        if min(shares[source]) < 0 or sum(shares[source]) > 100:
            raise ValueError(f"splits of {source}: {shares[source]}")
    there, number = value_of(settings, "export.legacy_sft_limit")
    wanted = value_of(settings, "export.include_legacy_sft")
    return Settings(
        seed=settings.get("seed", base.seed), evidence=applied(base.evidence, settings, EVIDENCE), retrieval=applied(base.retrieval, settings, RETRIEVAL), rewrite=applied(base.rewrite, settings, REWRITE),
        export=replace(export, caps={**export.caps, **caps}), splits=shares, legacy=None if wanted == (True, False) else number if there else base.legacy, recall=settings.get("semantic_recall", {}),
    )


def provider_of(settings: dict, mock: dict) -> Provider:
    """The provider that the file names: ``mock`` with the given answer, or an address whose model, base and key stand in the environment."""
    group = settings.get("generation", {})
    if group.get("provider", "mock") == "mock":
        return constant_provider(mock)
    model, base, secret = (os.environ.get(group.get(k, d), "") for k, d in (("model_env", "LLM_MODEL"), ("base_url_env", "LLM_BASE_URL"), ("api_key_env", "LLM_API_KEY")))
    if not (model and base and secret):
        raise ValueError("model, base address and key of the provider must be set")
    return http_provider(base, model, secret, temperature=group.get("temperature", 0.1), attempts=group.get("attempts", 3))
