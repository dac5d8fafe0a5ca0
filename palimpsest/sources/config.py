"""Configuration of series and documents: YAML files merged by precedence, on the driver."""

from __future__ import annotations

from copy import deepcopy
from functools import reduce
from pathlib import Path, PurePosixPath
from typing import Any

#: Fields of a series that hold for its documents.
SERIES_FIELDS = ("series_name", "document_family", "document_domain", "document_subdomain", "publisher", "publication_place", "language")


def load(path: str | Path | None) -> dict[str, Any]:
    if not path:
        return {}
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def merge(*configs: dict[str, Any] | None) -> dict[str, Any]:
    """Nested dictionaries merged, later ones win, none is changed; empty ones are passed over."""

    def two(a: dict, b: dict) -> dict:
        both = {k: two(a[k], b[k]) for k in a.keys() & b.keys() if isinstance(a[k], dict) and isinstance(b[k], dict)}
        return {**a, **deepcopy(b), **both}

    return reduce(two, (c for c in configs if c), {})


def _wrapped(value: Any) -> dict[str, Any]:
    if not isinstance(value, dict):
        return {}
    return value if {"document", "parser", "fallbacks"} & value.keys() else {"document": value}


def _named_in(documents: Any, name: str, relative: str) -> dict[str, Any]:
    """The override for a file: by name, stem, then relative path (this order breaks ties)."""
    keys = [name, PurePosixPath(name).stem, relative, relative.replace("\\", "/")]
    if isinstance(documents, dict):
        return next((_wrapped(documents[k]) for k in keys if documents.get(k)), {})
    for item in documents if isinstance(documents, list) else []:
        if isinstance(item, dict) and set(keys) & {str(item.get(k, "")) for k in ("source_file", "file", "filename", "stem", "pdf")}:
            return _wrapped(item)
    return {}


def for_document(name: str, series_config: dict[str, Any] | None = None, config_dir: str | Path | None = None, relative: str | None = None) -> dict[str, Any]:
    """Effective configuration of one file: series defaults < document defaults < override by name < own file."""
    config = series_config or {}
    series = config.get("series") or {}
    given = {k: series.get(k) for k in SERIES_FIELDS}
    given["document_family"] = given["document_family"] or given["series_name"]
    own = {k: v for k, v in given.items() if v not in (None, "")}
    fallback = {k: own[k] for k in ("series_name", "document_family", "document_domain", "document_subdomain") if k in own}
    fallback |= {k: series[f"default_{k}"] for k in ("document_category", "document_type") if series.get(f"default_{k}") not in (None, "")}
    base = {"document": own, "parser": config.get("parser") or {}, "fallbacks": config.get("fallbacks") or {}}
    file_config: dict[str, Any] = {}
    if config_dir:
        stem = PurePosixPath(name).stem
        hit = next((p for p in (Path(config_dir) / f"{x}.{e}" for e in ("yaml", "yml") for x in (name, stem)) if p.exists()), None)
        file_config = load(hit)
    defaults = {"document": config["document_defaults"]} if config.get("document_defaults") else None
    return merge(base, {"fallbacks": fallback}, defaults, _named_in(config.get("documents"), name, relative or name), file_config)


def as_table(spark, names: list[str], series_config: dict[str, Any] | None = None, config_dir: str | Path | None = None):
    """source_file and the document fields that the configuration forces, as a small table."""
    rows = [{"source_file": n} | {k: None if v is None else str(v) for k, v in (for_document(n, series_config, config_dir).get("document") or {}).items()} for n in names]
    cols = sorted({k for r in rows for k in r} | {"source_file"})
    return spark.createDataFrame([[r.get(c) for c in cols] for r in rows], ", ".join(f"{c} string" for c in cols))
