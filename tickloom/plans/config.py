"""The job description: a TOML file with global settings and one [[replays]] entry for each input and its output."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from ..errors import Error, ReplayError
from ..functions.times import NO_END, NO_START, parse_datetime_ns, parse_ts_value

KINDS, FORMATS = ("book", "trade"), ("csv", "json", "auto")
#: Names of log levels (fixed values), as numbers of the logging module.
LEVELS = {"trace": 5, "debug": 10, "info": 20, "warn": 30, "warning": 30, "error": 40, "err": 40, "critical": 50, "off": 100}


@dataclass(frozen=True)
class Input:
    format: str = "csv"
    dir: str = ""
    kind: str = "book"


@dataclass(frozen=True)
class Output:
    path: str = ""
    create: bool = True


@dataclass(frozen=True)
class Replay:
    input: Input
    output: Output
    start_ns: int = NO_START
    end_ns: int = NO_END


@dataclass(frozen=True)
class Config:
    realtime: float = 1.0
    init_ts: int | None = None
    replays: tuple[Replay, ...] = field(default_factory=tuple)
    log_level: str = "info"
    progress_sec: int = 5


def _invalid(why: str) -> ReplayError:
    return ReplayError(Error.CONFIG_INVALID, why)


def _value(table: dict, key: str, kind: type | tuple, default: Any) -> Any:
    """The value of a key, the default if it is missing or of another type."""
    found = table.get(key, default)
    return found if isinstance(found, kind) and (kind is bool or not isinstance(found, bool)) else default


def _moment(table: dict, key: str, empty: int) -> int:
    text = table.get(key, "")
    if not isinstance(text, str):  # an unquoted TOML date must not silently mean "no bound"
        raise _invalid(f"{key} must be a string")
    found = parse_datetime_ns(text, empty)
    if found is None:
        raise _invalid(f"{key}={text!r} is no UTC time like 2026-06-23 09:00:00")
    return found


def _replay(number: int, entry: Any) -> Replay:
    if not isinstance(entry, dict) or not isinstance(entry.get("input"), dict) or not isinstance(entry.get("output"), dict):
        raise _invalid(f"replay {number} needs input and output tables")
    i, o = entry["input"], entry["output"]
    return Replay(
        Input(_value(i, "format", str, "csv"), _value(i, "dir", str, ""), _value(i, "kind", str, "book")),
        Output(_value(o, "path", str, ""), _value(o, "create", bool, True)),
        _moment(entry, "start", NO_START),
        _moment(entry, "end", NO_END),
    )


def check(cfg: Config) -> Config:
    if not 0.0 <= cfg.realtime <= 1.0:  # NaN fails too
        raise _invalid(f"realtime={cfg.realtime} isn't in [0, 1]")
    if not cfg.replays:
        raise _invalid("at least one [[replays]] entry is needed")
    paths = set()
    for n, r in enumerate(cfg.replays):
        if r.input.kind not in KINDS:
            raise _invalid(f"replay {n}: kind {r.input.kind!r} is neither book nor trade")
        if r.input.format not in FORMATS:
            raise _invalid(f"replay {n}: format {r.input.format!r} is none of csv, json, auto")
        if not r.output.path:
            raise _invalid(f"replay {n}: output.path is empty")
        if r.output.path in paths:
            raise _invalid(f"replay {n}: output.path {r.output.path!r} is taken by an earlier entry")
        paths.add(r.output.path)
        if r.start_ns > r.end_ns:
            raise _invalid(f"replay {n}: start is after end")
    return cfg


def parse_config(table: dict) -> Config:
    init = table.get("init_ts")
    if isinstance(init, str):
        at = parse_ts_value(init)
        if at is None and init != "":
            raise _invalid(f"init_ts={init!r}")
        init = at
    elif not isinstance(init, int) or isinstance(init, bool):
        init = None
    log = table.get("log") if isinstance(table.get("log"), dict) else {}
    entries = table.get("replays") if isinstance(table.get("replays"), list) else []
    return check(Config(
        float(_value(table, "realtime", (int, float), 1.0)), init, tuple(_replay(n, e) for n, e in enumerate(entries)),
        _value(log, "level", str, "info"), _value(log, "progress_sec", int, 5),
    ))


def load_config(path: str) -> Config:
    if not Path(path).exists():
        raise ReplayError(Error.CONFIG_NOT_FOUND, path)
    try:
        table = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    except (tomllib.TOMLDecodeError, UnicodeDecodeError) as e:
        raise ReplayError(Error.CONFIG_PARSE, str(e)) from e
    return parse_config(table)


def overridden(cfg: Config, realtime: float | None = None, init_ts: str | None = None, log_level: str | None = None, progress_sec: int | None = None) -> Config:
    """cfg with global settings replaced and checked again; init_ts "" goes back to the first event."""
    given: dict[str, Any] = {k: v for k, v in (("realtime", realtime), ("log_level", log_level), ("progress_sec", progress_sec)) if v is not None}
    if init_ts is not None:
        given["init_ts"] = parse_ts_value(init_ts)
        if given["init_ts"] is None and init_ts != "":
            raise _invalid(f"init_ts={init_ts!r}")
    return check(replace(cfg, **given))
