"""Filter profiles from a configuration file, with the built-in ones for whatever it leaves out."""

from __future__ import annotations

import os

from resinv.functions import fixed as X


def load_profiles(path: str | None) -> tuple[dict[str, dict], str]:
    """Profiles and the name of the default one; a missing file gives the built-in profiles.

    The file is YAML with ``filtering_profiles`` (db_keywords, linguistic_bypass_threshold, setfit_threshold,
    require_url) and ``default_profile``; a default that is no profile falls back to ``balanced``.
    """
    profiles = {k: dict(v) for k, v in X.PROFILES.items()}
    if not path or not os.path.exists(path):
        return profiles, "balanced"
    import yaml

    with open(path) as f:
        config = yaml.safe_load(f) or {}
    for name, given in (config.get("filtering_profiles") or {}).items():
        base = profiles.get(name, profiles["balanced"])
        profiles[name] = {
            "keywords": list(given.get("db_keywords", base["keywords"])),
            "bypass": float(given.get("linguistic_bypass_threshold", base["bypass"])),
            "setfit": float(given.get("setfit_threshold", base["setfit"])),
            "require_url": bool(given.get("require_url", base["require_url"])),
        }
    default = config.get("default_profile")
    return profiles, default if default in profiles else "balanced"
