import pytest

from loomwright.plans import settings as S

GIVEN = {
    "seed": 7, "splits": {"d1_train": 80, "d1_validation": 10}, "filters": {"min_evidence_chars": 50, "max_base_answer_chars": 100}, "embedding": {"min_score": None, "final_top_k": 3, "dtc_boost": 0.1},
    "export": {"validation_limit": 10, "max_tokens": 99, "legacy_sft_limit": 0}, "semantic_recall": {"enabled": False}, "generation": {"provider": "mock"},
}


def test_parameters():
    p = S.parameters(GIVEN)
    assert (p.seed, p.export.seed, p.evidence.least, p.evidence.most, p.rewrite.base_chars) == (7, 7, 50, 6000, 100)
    assert p.retrieval.min_score is None and p.retrieval.top == 3 and p.retrieval.code_boost == 0.1 and p.retrieval.pool == 50
    assert p.export.caps == {"validation": 10, "test": 200} and p.export.max_tokens == 99 and p.legacy == 0
    assert p.splits == {"d1": (80, 10), "d2": (90, 5), "d4": (80, 10)} and p.recall == {"enabled": False}
    assert S.parameters({}) == S.Settings() and S.parameters({"export": {"include_legacy_sft": False}}).legacy is None


@pytest.mark.parametrize("bad", [{"embedding": {"candidate_pool_k": 0}}, {"embedding": {"symptom_weight": 2}}, {"splits": {"d4_train": 95, "d4_validation": 10}}])
def test_refused(bad):
    with pytest.raises(ValueError):
        S.parameters(bad)


def test_provider(monkeypatch):
    assert S.provider_of(GIVEN, {"a": 1})(["x"]) == ['{"a": 1}']
    for k in ("LLM_MODEL", "LLM_BASE_URL", "LLM_API_KEY"):
        monkeypatch.delenv(k, raising=False)
    with pytest.raises(ValueError):
        S.provider_of({"generation": {"provider": "api"}}, {})
