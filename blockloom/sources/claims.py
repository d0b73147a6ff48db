"""Claims: pieces of a plan that several jobs share, each worked on by one of them at a time."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from blockloom.sources import snapshots


@dataclass(frozen=True)
class Claim:
    """The right to one piece of work. ``number`` counts its holders, so that the last one is known."""

    folder: str
    number: int
    owner: str


def _last(spark: SparkSession, folder: str) -> int:
    path, files = snapshots.file_system(spark, folder)
    if not files.exists(path):
        return -1
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return max((int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith(".")), default=-1)


def take(spark: SparkSession, claims: str, piece: str, seconds: float) -> Claim | None:
    """Claim a piece for so long; None while another job holds it.

    A claim that has run out is taken over under the next number; of several that try, one gets it. Clocks of the jobs
    may differ by less than the time of a claim.
    """
    folder = f"{claims.rstrip('/')}/{piece}"
    last = _last(spark, folder)
    if last >= 0 and json.loads(snapshots.read_text(spark, f"{folder}/{last}.json"))["until"] > time.time():
        return None
    claim = Claim(folder, last + 1, uuid.uuid4().hex)
    text = json.dumps({"owner": claim.owner, "until": time.time() + seconds})
    return claim if snapshots.create_once(spark, f"{folder}/{claim.number}.json", text) else None


def is_held(spark: SparkSession, claim: Claim) -> bool:
    """Whether nobody has taken the piece over; a job asks before it records the work as its own."""
    return _last(spark, claim.folder) == claim.number


def give_back(spark: SparkSession, claim: Claim) -> None:
    """Let others take the piece at once: after a failure, or when it turned out to be done."""
    if is_held(spark, claim):
        snapshots.create_once(spark, f"{claim.folder}/{claim.number + 1}.json", json.dumps({"owner": "", "until": 0}))
