"""The control table of a transfer run: a durable log of what each table has reached.

Every table of a run goes through

    claimed -> landing -> landed -> loading -> committed        (or failed, with its error)

Each step is a small file in ``<target>/_ferry_runs/<run>/``, numbered for each table and
made by a rename that never overwrites, so two drivers cannot both take a step.
``landing`` and ``loading`` are written when the files are finished and about to be
moved into place, and name the folder they are in: a run that is broken off there only
has to move the rest. So a run that died can be started again under the same id: what
was committed is not loaded again, what was about to be published is published once,
and everything else starts anew.

The log holds a few lines for each table, none for its rows.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.sources.delimited import _read_small, file_names, write_once

FOLDER = "_ferry_runs"
KIND = ("item string, step long, state string, attempt long, owner string, at timestamp_ntz, rows_landed long, rows_loaded long, "
        "error string")


class Claimed(RuntimeError):
    """Another run works on the table, or did when it was broken off."""


class WorkLog:
    def __init__(self, spark: SparkSession, root: str, run_id: str, takeover: bool = False):
        """``takeover``: unfinished tables of an earlier owner of this run are taken over (it is known to be dead)."""
        self.spark, self.takeover = spark, takeover
        self.folder = f"{root.rstrip('/')}/{FOLDER}/{quote(run_id, safe='')}"
        self.owner = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"

    def last(self, item: str) -> dict | None:
        """The newest step of a table."""
        start = quote(item, safe="") + "."
        names = [n for n in file_names(self.spark, self.folder) if n.startswith(start) and n[len(start):-5].isdigit()]
        return _read_small(self.spark, f"{self.folder}/{names[-1]}") if names else None

    def record(self, item: str, state: str, **facts) -> dict:
        """Take the next step; facts of earlier steps of the attempt stay known."""
        before = self.last(item) or {"step": 0, "attempt": 0}
        if before.get("owner", self.owner) != self.owner and state != "claimed":
            raise Claimed(f"{item} has been taken over by {before['owner']}")
        step = {**before, "item": item, "step": before["step"] + 1, "state": state, "owner": self.owner,
                "at": datetime.now().isoformat(timespec="microseconds"), **facts}
        if not write_once(self.spark, f"{self.folder}/{quote(item, safe='')}.{step['step']:06d}.json", step):
            raise Claimed(f"{item} has been taken by another run")
        return step

    def claim(self, item: str) -> dict:
        """Take a table; returns the step the work has to go on from (``claimed``: from the beginning)."""
        before = self.last(item)
        if before is None or before["state"] == "failed":
            return self.record(item, "claimed", attempt=(before or {"attempt": 0})["attempt"] + 1, error=None)
        if before["state"] == "committed" or before["owner"] == self.owner:
            return before
        if not self.takeover:
            raise Claimed(f"{item} is {before['state']} by {before['owner']} since {before['at']}")
        if before["state"] == "claimed":
            return self.record(item, "claimed", attempt=before["attempt"] + 1)
        # The finished files are known, so the work goes on where it was broken off.
        self.record(item, "claimed", attempt=before["attempt"] + 1)
        return self.record(item, before["state"])

    def frame(self) -> DataFrame:
        """The control table: the newest step of every table of the run."""
        if not file_names(self.spark, self.folder):
            return self.spark.createDataFrame([], KIND)
        steps = self.spark.read.schema(KIND).json(f"{self.folder}/*.json")
        return steps.groupBy("item").agg(F.max_by(F.struct(*[c for c in steps.columns if c != "item"]), "step").alias("s")) \
            .select("item", "s.*").orderBy("item")
