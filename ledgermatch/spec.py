"""Job arguments and their validation (the rules of the YAML config, as data).

``JobSpec.from_dict`` accepts the same nested mapping the original tool read
from YAML: ``sources.{internal,external}``, ``matching``, ``tolerances``
(top level, or nested under ``matching`` as in the streaming example),
``output`` and, for streams, ``window``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from ledgermatch.operators.reconcile import MatchSpec

FILE_TYPES = ("file", "csv", "psv", "parquet")
DATABASE_TYPES = ("bigquery", "redshift", "jdbc")
STREAM_TYPES = ("kafka",)


@dataclass(frozen=True)
class SourceSpec:
    type: str
    path: str | None = None
    query: str | None = None
    connection: dict = field(default_factory=dict)
    topic: str | None = None
    group_id: str | None = None
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class OutputSpec:
    path: str
    reconciled_file: str
    unmatched_internal_file: str
    unmatched_external_file: str
    format: str = "csv"


@dataclass(frozen=True)
class WindowSpec:
    type: str = "tumbling"
    size: str = "1h"
    slide: str | None = None
    grace: str = "0 seconds"

    def __post_init__(self):
        if self.type not in ("tumbling", "sliding"):
            raise ValueError(f"window type must be 'tumbling' or 'sliding', not {self.type!r}")
        if self.type == "sliding" and not self.slide:
            raise ValueError("a sliding window needs 'slide'")


@dataclass(frozen=True)
class JobSpec:
    internal: SourceSpec
    external: SourceSpec
    matching: MatchSpec
    output: OutputSpec
    window: WindowSpec | None = None
    state_path: str | None = None

    @staticmethod
    def from_dict(config: dict[str, Any]) -> "JobSpec":
        validate(config)
        srcs = config["sources"]
        m = config["matching"]
        tol = {**m.get("tolerances", {}), **config.get("tolerances", {})}
        matching = MatchSpec(
            match_on=tuple(m["match_on"] or ()),
            internal_key=m["internal_key"],
            external_key=m["external_key"],
            amount_tolerance=float(tol.get("amount", 0.0)),
            date_tolerance_days=int(tol.get("days", 0)),
            mode=m.get("mode", "filter"),
            strict=bool(m.get("strict", False)),
            null_safe_keys=bool(m.get("null_safe_keys", True)),
        )
        out = config["output"]
        window = None
        if "window" in config:
            w = config["window"]
            window = WindowSpec(w.get("type", "tumbling"), _duration(w.get("size", "1h")),
                                _duration(w["slide"]) if w.get("slide") else None,
                                _duration(w.get("grace", "0s")))
        return JobSpec(
            internal=_source(srcs["internal"]),
            external=_source(srcs["external"]),
            matching=matching,
            output=OutputSpec(out["path"], out["reconciled_file"], out["unmatched_internal_file"],
                              out["unmatched_external_file"], out.get("format", "csv")),
            window=window,
            state_path=config.get("state", {}).get("storage_path"),
        )


def _source(cfg: dict) -> SourceSpec:
    known = {"type", "path", "query", "connection", "topic", "group_id"}
    return SourceSpec(cfg["type"], cfg.get("path"), cfg.get("query"), dict(cfg.get("connection") or {}),
                      cfg.get("topic"), cfg.get("group_id"), {k: v for k, v in cfg.items() if k not in known})


_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}


def _duration(text: str) -> str:
    """'1h' / '10m' / '24h' to Spark's interval text ('1 hours')."""
    t = str(text).strip()
    if t and t[-1] in _UNITS and t[:-1].isdigit():
        return f"{t[:-1]} {_UNITS[t[-1]]}"
    return t


_NEEDS = {  # what each kind of source cannot be read without
    **dict.fromkeys(FILE_TYPES, ("path",)),
    **dict.fromkeys(DATABASE_TYPES, ("query", "connection")),
    **dict.fromkeys(STREAM_TYPES, ("topic", "connection.bootstrap_servers")),
}
_SECTIONS = {
    "matching": ("match_on", "internal_key", "external_key"),
    "output": ("path", "reconciled_file", "unmatched_internal_file", "unmatched_external_file"),
}


def _absent(section: Any, names: tuple[str, ...]) -> list[str]:
    """Which of the dotted names a nested mapping lacks."""
    def has(name: str) -> bool:
        at = section
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                return False
            at = at[part]
        return True

    return [n for n in names if not has(n)]


def faults(config: dict[str, Any]) -> list[str]:
    """Everything that keeps a configuration from being a job, by dotted name."""
    found = _absent(config, ("sources", *_SECTIONS))
    for side in ("internal", "external"):
        at = f"sources.{side}"
        if _absent(config, ("sources",)) or (missing := _absent(config, (at, f"{at}.type"))):
            found += missing[:1] if "sources" in config else []
            continue
        source = config["sources"][side]
        if source["type"] not in _NEEDS:
            found.append(f"{at}.type (unknown type {source['type']!r})")
        found += [f"{at}.{n}" for n in _absent(source, _NEEDS.get(source["type"], ()))]
    for section, names in _SECTIONS.items():
        if section in config:
            found += [f"{section}.{n}" for n in _absent(config[section], names)]
    return found


def validate(config: dict[str, Any]) -> None:
    """Raise one ``ValueError`` that lists all faults of the configuration."""
    if found := faults(config):
        raise ValueError("job configuration lacks or misstates: " + ", ".join(found))
