"""Which outputs a run has, and what they are called."""

from __future__ import annotations

from collections.abc import Iterable
from enum import Enum


class Output(Enum):
    """Outputs of a run."""

    VALID = "valid"
    FAILED = "failed"
    PUBLISHER = "publisher"
    CROSSREF = "crossref"
    MINED = "mined"


def parse_output(name: str) -> Output:
    """The output of that name, in any letter case."""
    try:
        return Output(name.lower())
    except ValueError:
        raise ValueError(f"Invalid output type: '{name}'; valid are {', '.join(o.value for o in Output)}") from None


def parse_outputs(names: Iterable[str]) -> set[Output]:
    """The outputs of that names; none, or "all" among them, means all, whatever else is named."""
    names = list(names)
    if not names or any(n.lower() == "all" for n in names):
        return set(Output)
    return {parse_output(n) for n in names}


def input_stem(path: str) -> str:
    """The last part of a path without a known extension."""
    name = path.rstrip("/").rpartition("/")[2] or "output"
    for extension in (".tar.gz", ".jsonl.gz", ".jsonl", ".json"):
        if name.endswith(extension):
            return name.removesuffix(extension)
    return name


def output_paths(outputs: Iterable[Output], output_dir: str, stem: str) -> dict[Output, str]:
    """The path of each selected output."""
    return {o: f"{output_dir.rstrip('/')}/{stem}_{o.value}.jsonl" for o in outputs}


#: Names of log levels that Spark spells otherwise.
LOG_LEVELS = {"OFF": "OFF", "DEBUG": "DEBUG", "INFO": "INFO", "WARN": "WARN", "WARNING": "WARN", "ERROR": "ERROR"}


def log_level(name: str) -> str:
    """Spark's name of a log level; INFO for one it has not."""
    return LOG_LEVELS.get(name.upper(), "INFO")
