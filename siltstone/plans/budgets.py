"""Budgets and settings: small, sequential arithmetic on the driver."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any
from urllib.parse import unquote, urlsplit

from .values import COUNTRIES


def allocate_budget(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Shares by weight, rounded half-even, never over what is left; the last key takes the rest."""
    whole, left, out = sum(weights.values()) or 1.0, total, {}
    last = next(reversed(weights), None)
    for key, weight in weights.items():
        out[key] = left if key == last else min(round(total * weight / whole), left)
        left -= out[key]
    return out


def load_priorities(path: str | None = None, countries: Iterable[str] | None = None) -> dict[str, float]:
    """tld -> weight from a JSON file, or weight 1 for each of the countries; lower case on both sides."""
    if path and Path(path).exists():
        return {k.lower(): float(v) for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}
    return {c.lower(): 1.0 for c in countries or COUNTRIES}


def jdbc_options(dsn: str) -> dict[str, str]:
    """mysql://user:password@host:port/database as options of the JDBC source."""
    parts = urlsplit(dsn)
    if parts.scheme not in ("mysql", "mysql+pymysql") or not parts.hostname or not parts.path.strip("/"):
        raise ValueError("expected mysql://user:password@host[:port]/database")
    return {
        "url": f"jdbc:mysql://{parts.hostname}:{parts.port or 3306}/{unquote(parts.path.lstrip('/'))}",
        "user": unquote(parts.username or ""),
        "password": unquote(parts.password or ""),
        "driver": "com.mysql.cj.jdbc.Driver",
    }


def settings(file: Mapping[str, Any] | None = None, environ: Mapping[str, str] | None = None, **given: Any) -> dict[str, Any]:
    """Options: file < PIPELINE_* environment < explicit; comment keys of the file are dropped."""
    out = {k: v for k, v in (file or {}).items() if not k.startswith(("comment", "_"))}
    out |= {k[9:].lower(): v for k, v in (environ or {}).items() if k.startswith("PIPELINE_") and v != ""}
    return out | {k: v for k, v in given.items() if v is not None}
