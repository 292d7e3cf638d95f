"""Settings: defaults, then a YAML or JSON file, then the environment."""

from __future__ import annotations

import copy
import json
import os

# Defaults of the settings.
DEFAULTS = {
    "output": {"root": "output", "seen": None},
    "clean": {"min_length": 8, "max_length": 500, "check_leak": True, "min_script_ratio": 0.3, "max_repeat_ratio": 0.3, "min_score": 0.6, "dedup": "exact", "ngram": 3, "jaccard": 0.85},
    "generation": {
        "dry_run": False, "max_workers": 5, "at_once": 1, "retries": 3, "delay": 2.0, "model": "gpt-4o-mini", "base_url": "https://api.openai.com/v1", "api_key": "",
        "temperature": 0.85, "top_p": 0.95, "max_tokens": 2048, "frequency_penalty": 0.3, "timeout": 60.0, "resume": True,
        "stage1": {"samples_per_label": 150, "batch": 5}, "stage2": {"samples_per_label": 700, "batch": 10, "simple_ratio": 0.4}, "stage3": {"samples_per_pair": 25, "batch": 5},
    },
    "pairs": {"threshold": 0.3, "per_label": 5},
    "merge": {"per_label": 1000, "weights": [0.15, 0.70, 0.15], "max_total": None, "seed": 42},
    "split": {"ratios": [0.8, 0.1, 0.1], "stratified": True, "seed": 42},
}
ENVIRONMENT = {
    "OPENAI_API_KEY": ("generation", "api_key"), "OPENAI_BASE_URL": ("generation", "base_url"), "LLM_MODEL": ("generation", "model"),
    "DRY_RUN": ("generation", "dry_run"), "OUTPUT_DIR": ("output", "root"), "MAX_WORKERS": ("generation", "max_workers"),
}


def overlaid(base: dict, over: dict) -> dict:
    """base with over's values; dictionaries are merged, anything else replaced."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = overlaid(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def load(path: str | None = None, env: dict[str, str] | None = None) -> dict:
    cfg = copy.deepcopy(DEFAULTS)
    if path:
        with open(path, encoding="utf-8") as f:
            if path.endswith(".json"):
                read = json.load(f)
            else:
                import yaml

                read = yaml.safe_load(f)
        cfg = overlaid(cfg, read or {})
    for name, (section, key) in ENVIRONMENT.items():
        value = (os.environ if env is None else env).get(name)
        if value is not None:
            was = cfg[section].get(key)
            cfg[section][key] = value.lower() in ("true", "1", "yes") if isinstance(was, bool) else int(value) if isinstance(was, int) else value
    check(cfg)
    return cfg


def check(cfg: dict) -> None:
    """Sums must be 1 as exactly as the splitter asks; stage 1 needs ten rows a label."""
    for name, parts in (("split.ratios", cfg["split"]["ratios"]), ("merge.weights", cfg["merge"]["weights"])):
        if abs(sum(parts) - 1) >= 1e-6:
            raise ValueError(f"{name} must sum to 1")
    if cfg["generation"]["stage1"]["samples_per_label"] < 10:
        raise ValueError("generation.stage1.samples_per_label must be at least 10")
