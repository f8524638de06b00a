"""What kind of input a path is, on any file system that Spark can reach."""

from __future__ import annotations

import os
from collections.abc import Callable
from enum import Enum

from pyspark.sql import SparkSession

from citeloom.session import hadoop_path


class WorksInput(Enum):
    """Kinds of input with work documents."""

    TAR_GZ = "tar.gz archive"
    JSON_DIRECTORY = "directory of .json files"
    JSON_FILE = ".json file"


class RegistryInput(Enum):
    """Kinds of input with registry records."""

    JSONL_GZ = ".jsonl.gz file"
    JSONL = ".jsonl file"
    FLAT_DIRECTORY = "directory of .jsonl[.gz] files"
    NESTED_SNAPSHOT = "directory of updated_* directories"


#: What stands at a path: (names of files, names of directories) of a directory, None for a file.
Listing = Callable[[str], tuple[list[str], list[str]] | None]


def local_listing(path: str) -> tuple[list[str], list[str]] | None:
    """What stands at a path of this machine."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"There is nothing at {path}")
    if os.path.isfile(path):
        return None
    with os.scandir(path) as entries:
        found = [(e.name, e.is_dir()) for e in entries]
    return [n for n, is_dir in found if not is_dir], [n for n, is_dir in found if is_dir]


def spark_listing(spark: SparkSession) -> Listing:
    """What stands at a path as Spark reads it: on the default file system, or on that of the path's scheme."""

    def listing(path: str) -> tuple[list[str], list[str]] | None:
        files, target = hadoop_path(spark, path)
        if not files.exists(target):
            raise FileNotFoundError(f"There is nothing at {path}")
        if not files.getFileStatus(target).isDirectory():
            return None
        found = [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(target)]
        return [n for n, is_dir in found if not is_dir], [n for n, is_dir in found if is_dir]

    return listing


def _by_ending(path: str, endings: dict[str, Enum]) -> Enum:
    for ending, kind in endings.items():
        if path.lower().endswith(ending):
            return kind
    raise ValueError(f"{path} is none of {', '.join(endings)}; Unrecognized file type")


def _formats(path: str, files: list[str]) -> tuple[bool, bool]:
    """Whether a directory has .json files, and whether it has .jsonl or .jsonl.gz files; both are an error."""
    has_json = any(os.path.splitext(n)[1] == ".json" for n in files)
    has_lines = any(n.lower().endswith((".jsonl", ".jsonl.gz")) for n in files)
    if has_json and has_lines:
        raise ValueError(f"Ambiguous: {path} holds documents (.json) as well as lines (.jsonl); name one file, or keep the two apart")
    return has_json, has_lines


def detect_works(path: str, listing: Listing = local_listing) -> WorksInput:
    """The kind of a path with work documents; an error says what is wrong with any other path."""
    found = listing(path)
    if found is None:
        return _by_ending(path, {".tar.gz": WorksInput.TAR_GZ, ".json": WorksInput.JSON_FILE})
    if _formats(path, found[0])[0]:
        return WorksInput.JSON_DIRECTORY
    raise ValueError(f"No documents: {path} does not contain any file named *.json" if found[0] else f"There are no processable files in {path}")


def detect_registry(path: str, listing: Listing = local_listing) -> RegistryInput:
    """The kind of a path with registry records; an error says what is wrong with any other path."""
    found = listing(path)
    if found is None:
        return _by_ending(path, {".jsonl.gz": RegistryInput.JSONL_GZ, ".jsonl": RegistryInput.JSONL})
    if any(n.startswith("updated_") for n in found[1]):
        return RegistryInput.NESTED_SNAPSHOT
    if _formats(path, found[0])[1]:
        return RegistryInput.FLAT_DIRECTORY
    raise ValueError(f"No records: {path} does not contain any file named *.jsonl or *.jsonl.gz")
