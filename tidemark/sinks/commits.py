"""Versions of a published folder: each commit makes the next one, if no other run has.

A version is a small JSON file that names everything it consists of. It is made
after its data, and only if there is none of its number yet; of two runs that began from
the same version the second gets a ``Conflict`` and leaves what is published as it is.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession

from tidemark.sinks.files import create_text, delete, modified, names_in, read_text

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another run has published since this one began."""


def _path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/{VERSIONS}/{version:012d}.json"


def versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{folder.rstrip('/')}/{VERSIONS}") if n.endswith(".json"))


def read_version(spark: SparkSession, folder: str, version: int) -> dict | None:
    """A version's content; None if it was never written to its end."""
    text = read_text(spark, _path(folder, version))
    try:
        return None if text is None else json.loads(text)
    except ValueError:
        return None


def head(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The highest number in use (0: none), and the content of the newest whole version."""
    known = versions(spark, folder)
    contents = (read_version(spark, folder, v) for v in reversed(known))
    return (known[-1] if known else 0), next((c for c in contents if c is not None), None)


def commit(spark: SparkSession, folder: str, content: dict, begun_at: int) -> dict:
    """Publish ``content`` as the version after ``begun_at``, the number that ``head`` gave when the run began."""
    content = {"version": begun_at + 1, **content}
    if not create_text(spark, _path(folder, begun_at + 1), json.dumps(content, indent=2)):
        raise Conflict(f"version {begun_at + 1} was published by another run; begin again from it")
    return content


def snapshots_of(content: dict) -> set[str]:
    """The snapshots that a version names."""
    parts = [e["snapshot"] for table in content.get("parts", {}).values() for e in table.values()]
    return {*parts, *(t["snapshot"] for t in content.get("tables", {}).values())}


def sweep(spark: SparkSession, folder: str, keep: int = 3, grace: float = 7 * 86400, now: float | None = None) -> list[str]:
    """Delete the snapshots that none of the newest ``keep`` versions names, and the versions before these.

    A snapshot younger than ``grace`` seconds stays: its run may be about to
    commit it, or a reader of an older version may hold it. Returns what was deleted.
    """
    now = time.time() if now is None else now
    known = versions(spark, folder)
    kept, old = known[-keep:] if keep else [], known[:-keep] if keep else known
    contents = [c for c in (read_version(spark, folder, v) for v in kept) if c is not None]
    if not contents:
        return []
    named = set().union(*map(snapshots_of, contents))
    base = folder.rstrip("/")
    gone = [n for n in names_in(spark, base) if n.startswith("snapshot-") and n not in named and now - modified(spark, f"{base}/{n}") >= grace]
    for name in gone:
        delete(spark, f"{base}/{name}")
    for version in old:
        if now - modified(spark, _path(folder, version)) >= grace:
            delete(spark, _path(folder, version))
    return gone
