"""Publication of what a run wrote: all tables or none.

A run writes to folders of its own beside the tables that are in use. Only when every table is there, and the counts
agree, it writes a small manifest that says what is to be moved where, moves the tables into place, and marks the
manifest as published, last of all. A run that fails before leaves the old tables as they are; one that dies while
tables are moved is finished by whoever looks next (`settle`), since every step can be repeated.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from starmart import session

MANIFEST = "_manifest.json"


class Unbalanced(RuntimeError):
    """Counts of a run that have to agree do not."""


def folder(root: str, run: str) -> str:
    """Where a run writes the tables of a folder; readers of that folder pass over it."""
    return f"{root}/_run_{run}"


def balance(ledger: Mapping[str, int]) -> None:
    """Raise unless every raw row is clean or rejected, and all tables that count rows came to the same counts."""
    agree = (("raw", ("clean", "rejected")), ("raw", ("judged",)), ("rejected", ("summarised",)), ("rejected", ("counted_rejected",)))
    wrong = [
        f"{total} {ledger[total]} is not " + " + ".join(f"{part} {ledger[part]}" for part in parts)
        for total, parts in agree
        if ledger[total] != sum(ledger[part] for part in parts)
    ]
    if wrong:
        raise Unbalanced("; ".join(wrong))


def publish(
    spark: SparkSession,
    root: str,
    run: str,
    moves: Mapping[str, str],
    gone: Sequence[str],
    folders: Sequence[str],
    ledger: Mapping[str, int],
    rows: Mapping[str, int],
) -> None:
    """Move tables from the run's folders into place (`moves`: from, to), remove tables that the run has not (`gone`)."""
    found = {"run": run, "state": "publishing", "moves": dict(moves), "gone": list(gone), "folders": list(folders)}
    session.write_text(spark, f"{root}/{MANIFEST}", json.dumps(found | {"ledger": dict(ledger), "rows": dict(rows)}))
    settle(spark, root)


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The manifest of a folder, if a run has published there."""
    text = session.read_text(spark, f"{root.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)


def settle(spark: SparkSession, root: str) -> dict | None:
    """Finish a publication that was begun; says what is published."""
    found = manifest(spark, root)
    if found is None or found["state"] == "published":
        return found
    for source, target in found["moves"].items():
        if session.exists(spark, source):  # else it was moved already
            session.move(spark, source, target)
    for path in (*found["gone"], *found["folders"]):
        session.remove(spark, path)
    found["state"] = "published"
    session.write_text(spark, f"{root.rstrip('/')}/{MANIFEST}", json.dumps(found))
    return found
