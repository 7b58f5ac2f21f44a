"""Name-level helpers (schema work on the driver, no data touched)."""

from __future__ import annotations

import re

# Feature-store name rule (fixed value): letters/digits, single '-' or '_'
# separators, 1 to 64 characters.
FEATURE_NAME_RULE = r"[a-zA-Z0-9]([-_]*[a-zA-Z0-9]){0,63}"

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]+")


def sanitize_name(name: str) -> str:
    """Every run of non-alphanumerics -> '_', then strip '_' at both ends."""
    return _NON_ALNUM.sub("_", name).strip("_")


def sanitize_names(names: list[str]) -> list[str]:
    """Sanitise a list of names; raise when two names collide afterwards."""
    out = [sanitize_name(n) for n in names]
    seen: dict[str, str] = {}
    for orig, new in zip(names, out):
        if new in seen:
            raise ValueError(f"column names {seen[new]!r} and {orig!r} both sanitise to {new!r}")
        seen[new] = orig
    return out


def is_valid_feature_name(name: str) -> bool:
    return re.fullmatch(FEATURE_NAME_RULE, name) is not None
