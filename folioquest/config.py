"""Settings of a run, from arguments and the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    chunk_size: int = 500
    chunk_overlap: int = 100
    ocr_lang: str = "en"
    use_table_recognition: bool = True
    num_samples: int = 100
    model_name: str = "offline"
    temperature: float = 0.7
    max_retries: int = 3
    batch_size: int = 5
    document_domain: str = "general"
    language: str = "pt-BR"
    use_llm_pipeline: bool = True
    slicer_model: str = "offline"
    topic_model: str = "offline"
    embedding_model: str = "hashing"
    #: Where models other than the offline ones are asked, and the variable that holds the key.
    chat_url: str = ""
    embedding_url: str = ""
    key_variable: str = "API_KEY"
    balance_per_document: bool = True
    balance_true_false: bool = True
    related_cut: float = 0.5
    related_chunks: int = 3
    #: Related leaves by an index, for more leaves than can all be compared with each other.
    related_index: bool = False
    seed: int = 0
    output_path: str = "dataset.json"
    log_path: str = "pipeline.log"
    #: A table; one nested file if it ends in .json.
    tree_path: str = "tree/topic_tree"
    parsed_path: str = "tree/parsed"
    slicer_cache_dir: str = "tree/sliced"

    def __post_init__(self):
        if self.chunk_size <= 0 or self.num_samples < 0 or self.batch_size <= 0:
            raise ValueError("chunk_size and batch_size must be positive and num_samples not negative")


def _typed(value: str, kind: type):
    """Booleans are true for "true" alone, in any case."""
    return value.lower() == "true" if kind is bool else kind(value)


def from_env(env: dict[str, str] | None = None, **overrides) -> Config:
    """Defaults, then the variables named like the settings in capitals, then arguments that aren't None."""
    env = os.environ if env is None else env
    base, found = Config(), {}
    for f in fields(Config):
        kind = type(getattr(base, f.name))
        if (value := env.get(f.name.upper())) is not None:
            found[f.name] = _typed(value, kind)
    return replace(base, **found | {k: v for k, v in overrides.items() if v is not None})


def read_env_file(path: str) -> dict[str, str]:
    """KEY=value lines; comments and quotes around values are left out. A missing file has none."""
    out: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and not key.startswith("#"):
                    out[key.strip()] = value.strip().strip("\"'")
    return out
