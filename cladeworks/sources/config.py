"""Configuration files: YAML, TOML or JSON, nested sections flattened; command line over file over defaults. Driver side."""

from __future__ import annotations

import json
import tomllib
from pathlib import Path


def load(path: str) -> dict:
    """A configuration as one flat dictionary."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".toml"):
        data = tomllib.loads(text)
    elif path.endswith(".json"):
        data = json.loads(text)
    else:
        import yaml

        data = yaml.safe_load(text) or {}
    return flatten(data)


def flatten(data: dict) -> dict:
    """Sections named parameters or *_config merge into the top; adaptive values stay only if a user_ key set them."""
    out: dict = {}
    for key, value in data.items():
        if isinstance(value, dict) and (key == "parameters" or key.endswith("_config")):
            out |= flatten(value)
        else:
            out[key] = value
    adaptive = out.pop("adaptive", None) or {}
    return {k: v for k, v in out.items() if k not in adaptive or f"user_{k}" in out} | {k[5:]: v for k, v in out.items() if k.startswith("user_")}


def merge(defaults: dict, from_file: dict, given: dict) -> dict:
    """Values given by the user (not None) over the file's over defaults."""
    return defaults | {k: v for k, v in from_file.items() if v is not None} | {k: v for k, v in given.items() if v is not None}


def must_pass_rules(path: str) -> list[tuple[str, str, str, int]]:
    """(rule, relation, level, min_taxa) of a rule file; a malformed file is an error, an empty one has no rules."""
    rules = load(path).get("must_pass") or []
    return [(f"rule{i}", r["relation"], r["level"], int(r.get("min_taxa", 2))) for i, r in enumerate(rules, 1)]
