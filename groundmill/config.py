"""Settings of a run, with overrides from the environment."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

#: Items of an annual report and the names their sections go by.
SECTION_NAMES = {
    "1": "Business",
    "1A": "Risk Factors",
    "1B": "Unresolved Staff Comments",
    "1C": "Cybersecurity",
    "2": "Properties",
    "3": "Legal Proceedings",
    "4": "Mine Safety Disclosures",
    "5": "Market for Registrant's Common Equity",
    "6": "Selected Financial Data",
    "7": "Management's Discussion and Analysis (MD&A)",
    "7A": "Quantitative and Qualitative Disclosures About Market Risk",
    "8": "Financial Statements and Supplementary Data",
    "9": "Changes in and Disagreements with Accountants",
    "9A": "Controls and Procedures",
    "9B": "Other Information",
    "10": "Directors, Executive Officers and Corporate Governance",
    "11": "Executive Compensation",
    "12": "Security Ownership of Certain Beneficial Owners",
    "13": "Certain Relationships and Related Transactions",
    "14": "Principal Accountant Fees and Services",
    "15": "Exhibits and Financial Statement Schedules",
    "16": "Form 10-K Summary",
}
#: Sections that hold next to nothing to ask about.
LOW_SIGNAL = ("1B", "4", "9", "9B", "15", "16")
#: Names by form and item; of quarterly reports the numbers of both parts, of which the first wins. Other forms keep the titles of their headings.
FORMS = {
    "10-K": SECTION_NAMES,
    "10-Q": {
        "1": "Financial Statements",
        "1A": "Risk Factors",
        "2": "Management's Discussion and Analysis (MD&A)",
        "3": "Quantitative and Qualitative Disclosures About Market Risk",
        "4": "Controls and Procedures",
        "5": "Other Information",
        "6": "Exhibits",
    },
}
#: Items by form that hold next to nothing to ask about.
LOW_SIGNAL_BY_FORM = {"10-K": LOW_SIGNAL, "10-Q": ("5", "6")}


@dataclass(frozen=True)
class Config:
    """``from_env`` reads each setting's variable when it is called; numbers that cannot be read keep their default.

    ``verify_all`` judges pairs that fail the grounding check too; ``dense_index`` numbers pairs after malformed
    ones were dropped, which shifts captured verdicts, instead of by their position in the generation. Names of
    settings, variables and defaults are fixed values; ``api_url``, ``api_key`` and the limits of requests
    (``completion.Limits``) are this engine's own.
    """

    user_agent: str = field(default="groundmill contact@example.com", metadata={"env": "SEC_USER_AGENT"})
    pause_seconds: float = field(default=0.2, metadata={"env": "SEC_RATE_LIMIT_S"})
    generation_model: str = field(default="generator", metadata={"env": "QA_GEN_MODEL"})
    verification_model: str = field(default="verifier", metadata={"env": "QA_VERIFY_MODEL"})
    api_url: str = field(default="", metadata={"env": "QA_API_URL"})
    api_key: str = field(default="", metadata={"env": "QA_API_KEY"}, repr=False)
    requests_in_flight: int = field(default=8, metadata={"env": "QA_REQUESTS_IN_FLIGHT"})
    tokens_per_minute: int = field(default=0, metadata={"env": "QA_TOKENS_PER_MINUTE"})
    completion_tasks: int = field(default=0, metadata={"env": "QA_COMPLETION_TASKS"})
    max_output_tokens: int = field(default=4096, metadata={"env": "QA_MAX_OUTPUT_TOKENS"})
    temperature: float = field(default=0.4, metadata={"env": "QA_TEMPERATURE"})
    max_chunk_chars: int = field(default=6000, metadata={"env": "QA_MAX_CHUNK_CHARS"})
    min_chunk_chars: int = field(default=600, metadata={"env": "QA_MIN_CHUNK_CHARS"})
    chunk_overlap_chars: int = field(default=250, metadata={"env": "QA_CHUNK_OVERLAP_CHARS"})
    questions_per_chunk: int = field(default=5, metadata={"env": "QA_QUESTIONS_PER_CHUNK"})
    target_pairs: int = field(default=120, metadata={"env": "QA_TARGET_PAIRS"})
    max_chunks: int | None = None
    form: str = "10-K"
    min_passage_overlap: float = field(default=0.6, metadata={"env": "QA_MIN_PASSAGE_OVERLAP"})
    accept_verdicts: tuple[str, ...] = ("SUPPORTED",)
    require_verbatim_source: bool = True
    verify_all: bool = False
    dense_index: bool = False
    data_dir: str = field(default="data", metadata={"env": "QA_DATA_DIR"})
    output_dir: str = field(default="output", metadata={"env": "QA_OUTPUT_DIR"})
    cache_dir: str = field(default=".cache", metadata={"env": "QA_CACHE_DIR"})
    run_name: str = field(default="dataset", metadata={"env": "QA_RUN_NAME"})

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **given) -> Config:
        env = os.environ if env is None else env
        for name, f in cls.__dataclass_fields__.items():
            if name in given or env.get(f.metadata.get("env", ""), "") == "":
                continue
            kind: Callable = type(f.default)
            try:
                given[name] = kind(env[f.metadata["env"]])
            except ValueError:
                continue
        return cls(**given)

    def to_dict(self) -> dict:
        """All settings but the key of the server."""
        return {k: v for k, v in asdict(self).items() if k != "api_key"}
