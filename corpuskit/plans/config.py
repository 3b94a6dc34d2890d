"""Configuration: defaults, deep-merged with a YAML file for each call."""

from __future__ import annotations

import copy
from pathlib import Path

DEFAULTS: dict = {
    "mode": "full",
    "platform": dict(input_path="data/input/", type="generic"),
    "data_processing": {"type": "default", "filter_words": [], "role_transfer": {"assistant_to_user": [], "user_to_assistant": []}, "compat": "intended"},
    "cleaning": {"exact_dedup_enabled": True, "max_length": 32768, "min_length": None, "stopwords_enabled": True, "url_filter_enabled": True, "language_filter_enabled": True, "paragraph_filter_enabled": True, "languages": [], "custom_stopwords": [], "stopwords_file": None, "max_stopword_ratio": 0.5, "min_word_count": 20},
    "filtering": {"fasttext_enabled": False, "kenlm_enabled": False, "logistic_regression_enabled": False, "language_model_path": None, "perplexity_model_path": None, "quality_threshold": 0.5, "target_languages": "en zh".split(), "save_quality_metrics": True},
    "formatting": {
        "clean_html": True, "fix_unicode": True, "normalize_dates": False, "date_format": "MM/DD", "replace_dates": False, "date_replacement": "[DATE]", "replace_urls": False, "url_replacement": "[URL]",
        "replace_emails": False, "email_replacement": "[EMAIL]", "replace_numbers": False, "number_replacement": "[NUMBER]", "remove_punctuation": False, "normalize_whitespace": True, "lowercase": False,
    },
    "deduplication": {"band_size": 8, "method": "minhash_lsh", "ngram_size": 5, "enabled": True, "threshold": 0.8, "num_permutations": 128},
    "output": {"conversation_path": "data/output/conversations", "qa_path": "data/output/qa", "by_folder_path": None, "counters_path": None},
}


def merged(base: dict, over: dict | None) -> dict:
    """``over`` laid on a copy of ``base``; a null leaves a section or list as it is."""
    out = copy.deepcopy(base)
    for k, v in (over or {}).items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = merged(out[k], v)
        elif v is not None or not isinstance(out.get(k), (dict, list)):
            out[k] = v
    return out


def load(path: str | None = None, over: dict | None = None) -> dict:
    """Defaults, then the file, then ``over``. A file that can't be read is an error."""
    import yaml

    text = Path(path).read_text(encoding="utf-8") if path else ""
    return merged(merged(DEFAULTS, yaml.safe_load(text)), over)


def save(conf: dict, path: str) -> None:
    import yaml

    Path(path).write_text(yaml.safe_dump(conf, allow_unicode=True, sort_keys=False), encoding="utf-8")
