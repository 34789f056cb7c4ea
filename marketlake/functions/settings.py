"""Strict parsing of job settings given as text.

A value that is not exactly of its kind is an error that names the setting,
never a silent default; an absent or blank value is the default.
"""

from __future__ import annotations

import math

WORDS = {"true": True, "1": True, "yes": True, "on": True, "false": False, "0": False, "no": False, "off": False}


def _text(value) -> str | None:
    text = None if value is None else str(value).strip()
    return text or None


def parse_bool(name: str, value, default: bool) -> bool:
    text = _text(value)
    if text is None:
        return default
    if text.lower() not in WORDS:
        raise ValueError(f"{name} must be true or false, not {value!r}")
    return WORDS[text.lower()]


def parse_int(name: str, value, default: int | None, least: int | None = None) -> int | None:
    text = _text(value)
    if text is None:
        return default
    if not text.lstrip("+-").isascii() or not text.lstrip("+-").isdigit() or len(text) - len(text.lstrip("+-")) > 1:
        raise ValueError(f"{name} must be a whole number, not {value!r}")
    n = int(text)
    if least is not None and n < least:
        raise ValueError(f"{name} must be at least {least}, not {n}")
    return n


def parse_float(name: str, value, default: float | None, least: float | None = None) -> float | None:
    text = _text(value)
    if text is None:
        return default
    try:
        x = float(text)
    except ValueError:
        x = math.nan
    if not math.isfinite(x):
        raise ValueError(f"{name} must be a finite number, not {value!r}")
    if least is not None and x < least:
        raise ValueError(f"{name} must be at least {least}, not {x}")
    return x


def parse_list(value) -> list[str]:
    """Comma-separated names, trimmed, without blanks and repeats, in order."""
    return list(dict.fromkeys(x.strip() for x in str(value or "").split(",") if x.strip()))
