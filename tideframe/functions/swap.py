"""Files and folders of a dataset exchanged for new ones, so that no failure loses or doubles a row.

New content is staged below the dataset. A marker file then holds every move that is to be made; moves put the old content aside and the
new in its place. If one fails, those made are taken back; should that fail too, or the process end, marker, staging and old content
stay where they are, other writers are refused, and ``recover`` takes the moves back. The old content is deleted only when all
moves are made and what a reader finds was counted; the marker goes last.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tideframe.functions import fs

MARKER = "_swap_in_progress"
#: Groups of moves made at the same time.
AT_ONCE = 16


class Swap:
    """One exchange at ``path``; with ``aside`` the old content is kept there, as a backup."""

    def __init__(self, spark: SparkSession, path: str, aside: str | None = None):
        self.spark, self.path, tag = spark, path.rstrip("/"), uuid.uuid4().hex[:8]
        self.tag, self.marker, self.staging = tag, f"{self.path}/{MARKER}", f"{self.path}/_staging_{tag}"
        self.keep, self.old = aside is not None, f"{aside or self.path + '/_old'}_{tag}"
        self.done: list[tuple[str, str]] = []
        if fs.has_text(spark, self.marker):
            raise RuntimeError(f"{self.path}: another change is under way or was interrupted ({MARKER}); swap.recover takes an interrupted one back")
        self._tell("staging", [])

    def _tell(self, phase: str, moves: list) -> None:
        fs.write_text(self.spark, self.marker, json.dumps({"phase": phase, "staging": self.staging, "old": self.old, "keep": self.keep, "moves": moves}))

    def make(self, groups: list[list[tuple[str, str]]], isolate: bool = False) -> list[int]:
        """Make the moves (from, to), each group in order; gives the numbers of the groups that failed.

        A group that fails is taken back, and all others with it unless ``isolate``.
        """
        self._tell("moving", [m for g in groups for m in g])

        def one(moves: list) -> tuple[list, Exception | None]:
            made: list = []
            try:
                for a, b in moves:
                    fs.rename(self.spark, a, b)
                    made.append((a, b))
            except Exception as e:
                self._back(made)
                return [], e
            return made, None

        with ThreadPoolExecutor(AT_ONCE) as pool:
            results = list(pool.map(one, groups))
        self.done = [m for made, _ in results for m in made]
        errors = [(i, e) for i, (_, e) in enumerate(results) if e is not None]
        if errors and not isolate:
            self.undo()
            raise RuntimeError(f"{self.path}: nothing was changed: {errors[0][1]}") from errors[0][1]
        return [i for i, _ in errors]

    def _back(self, moves: list) -> None:
        for a, b in reversed(moves):
            fs.drop_empty(self.spark, a)  # a folder made for files that have left it again
            fs.rename(self.spark, b, a)

    def undo(self) -> None:
        """Take the moves back and leave the dataset as it was."""
        self._back(self.done)
        self.done = []
        self.abandon()

    def abandon(self) -> None:
        """End an exchange none of whose moves stand."""
        fs.delete(self.spark, self.staging)
        fs.delete(self.spark, self.marker)

    def finish(self) -> None:
        self._tell("done", [])
        _clear(self.spark, self.marker, self.staging, None if self.keep else self.old)


def _clear(spark: SparkSession, marker: str, staging: str, old: str | None) -> None:
    if old:
        fs.delete(spark, old)
    fs.delete(spark, staging)
    fs.delete(spark, marker)
    fs.delete(spark, marker + ".tmp")


def recover(spark: SparkSession, path: str) -> str:
    """Bring a dataset back to what it was before an exchange that broke off (or end one that was complete); gives the phase it was in, or ''.

    May be repeated if it breaks off itself. Not to be called while another writer is at work.
    """
    marker = f"{path.rstrip('/')}/{MARKER}"
    if not fs.has_text(spark, marker):
        return ""
    s = json.loads(fs.read_text(spark, marker))
    if s["phase"] == "moving":
        for a, b in reversed(s["moves"]):
            fs.drop_empty(spark, a)
            if fs.exists(spark, b) and not fs.exists(spark, a):
                fs.rename(spark, b, a)
    _clear(spark, marker, s["staging"], s["old"] if s["phase"] == "done" and not s["keep"] else None)
    spark.catalog.refreshByPath(path)
    return s["phase"]
