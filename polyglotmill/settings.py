"""Settings of a translation run: defaults, a file, environment, command line; checked, and fingerprinted.

Later sources win: defaults, then the file, then dotted overrides. The
fingerprint covers what changes results only, so another output folder does
not keep a run from being resumed.
"""

from __future__ import annotations

import argparse
import copy
import hashlib
import json

from .functions import dimensions as d
from .sources.readers import load_config

#: Default settings.
DEFAULTS: dict = {
    "input": {"source": None, "subset": None, "split": "train", "mirror": None, "source_text_column": "turns", "id_column": "id", "metadata_columns": ["category"], "source_language": "en"},
    "target_languages": list(d.TARGET_LANGUAGES),
    "custom_languages": [],
    "tiers": {
        "tier1": {"enabled": True, "backend": "offline:lower", "model": "auto", "batch_size": 32, "device": "auto", "calls_per_second": None},
        "tier2": {"enabled": True, "backend": "offline:reverse", "fallback_order": [], "model": {}, "max_concurrent": 10, "calls_per_second": None},
        "tier3": {"enabled": True, "metrics": ["length_ratio"], "thresholds": dict(d.THRESHOLDS)},
    },
    "output": {"directory": "./output", "format": "parquet", "push_to_hub": False, "hub_repo_id": None},
    "checkpoint": {"enabled": True, "directory": "./checkpoints"},
    "logging": {"level": "INFO"},
}
SEMANTIC = ("input", "target_languages", "custom_languages", "tiers")


def merged(base: dict, over: dict) -> dict:
    """base with the values of over; dictionaries merge, all else is replaced. Neither is changed."""
    out = dict(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else copy.deepcopy(value)
    return out


def nested(dotted: dict[str, object]) -> dict:
    """{"a.b": 1} -> {"a": {"b": 1}}"""
    out: dict = {}
    for path, value in dotted.items():
        for part in reversed(path.split(".")):
            value = {part: value}
        out = merged(out, value)
    return out


def checked(settings: dict) -> dict:
    if not settings["tiers"]["tier1"]["enabled"]:
        raise ValueError("tier 1 can't be turned off: later tiers build on its drafts")
    if settings["output"]["format"] not in ("parquet", "jsonl", "csv"):
        raise ValueError(f"unknown output format {settings['output']['format']!r}")
    return settings


def resolve(path: str | None = None, overrides: dict[str, object] | None = None) -> dict:
    out = merged(DEFAULTS, load_config(path)) if path else merged(DEFAULTS, {})
    return checked(merged(out, nested(overrides or {})))


def fingerprint(settings: dict) -> str:
    """16 hex digits of the SHA-256 of the canonical JSON of the sections that change results."""
    canonical = json.dumps({k: settings[k] for k in SEMANTIC}, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canonical.encode()).hexdigest()[:16]


def boolean(text: str) -> bool:
    known = dict.fromkeys(("true", "1", "yes"), True) | dict.fromkeys(("false", "0", "no"), False)
    if text.lower() not in known:
        raise argparse.ArgumentTypeError(f"{text!r} is neither true nor false")
    return known[text.lower()]


def listed(text: str) -> list[str]:
    return [x for x in map(str.strip, text.split(",")) if x]


def language_spec(text: str) -> dict:
    """nllb_code:iso:bcp47:name:script"""
    parts = text.split(":")
    if len(parts) < 5:
        raise argparse.ArgumentTypeError(f"{text!r} is not nllb_code:iso:bcp47:name:script")
    return dict(zip(("nllb_code", "iso", "bcp47", "display_name", "script"), parts))


#: Flags, the setting that each one overrides, and how its value is read.
FLAGS = [
    ("source", "input.source", str), ("source-language", "input.source_language", str), ("source-text-column", "input.source_text_column", str), ("id-column", "input.id_column", str),
    ("target-languages", "target_languages", listed), ("tier1-backend", "tiers.tier1.backend", str), ("tier1-model", "tiers.tier1.model", str), ("batch-size", "tiers.tier1.batch_size", int),
    ("device", "tiers.tier1.device", str), ("tier2-enabled", "tiers.tier2.enabled", boolean), ("tier2-backend", "tiers.tier2.backend", str), ("tier2-fallback", "tiers.tier2.fallback_order", listed),
    ("max-concurrent", "tiers.tier2.max_concurrent", int), ("tier3-enabled", "tiers.tier3.enabled", boolean), ("tier3-metrics", "tiers.tier3.metrics", listed),
    ("output-dir", "output.directory", str), ("output-format", "output.format", str), ("hub-repo-id", "output.hub_repo_id", str), ("log-level", "logging.level", str),
]


def from_arguments(argv: list[str]) -> tuple[dict, bool, bool]:
    """(settings, resume, force) of a command line."""
    parser = argparse.ArgumentParser(prog="polyglotmill")
    run = parser.add_subparsers(dest="command", required=True).add_parser("translate")
    run.add_argument("--config", "-c")
    for name, _, kind in FLAGS:
        run.add_argument(f"--{name}", type=kind)
    run.add_argument("--tier2-model")
    run.add_argument("--add-language", type=language_spec, action="append", default=[])
    for name in ("push-to-hub", "resume", "force-resume"):
        run.add_argument(f"--{name}", action="store_true")
    given = vars(parser.parse_args(argv))
    dotted = {path: given[name.replace("-", "_")] for name, path, _ in FLAGS if given[name.replace("-", "_")] is not None}
    if given["push_to_hub"]:
        dotted["output.push_to_hub"] = True
    settings = resolve(given["config"], dotted)
    if given["tier2_model"]:
        settings["tiers"]["tier2"]["model"][settings["tiers"]["tier2"]["backend"]] = given["tier2_model"]
    settings["custom_languages"] = settings["custom_languages"] + given["add_language"]
    return settings, given["resume"], given["force_resume"]
