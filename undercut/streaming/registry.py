"""Names of streaming queries that outlast their drivers: generations, checkpoints and outputs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from undercut.sources.files import Files
from undercut.streaming.deployment import active_queries, stop


@dataclass(frozen=True)
class Generation:
    name: str
    number: int
    output: str
    checkpoint: str


#: Starts the query of a generation under a name, from its checkpoint or the earliest record.
Starter = Callable[[str, Generation], StreamingQuery]


class Registry:
    """Below a folder, for each name: ``generation-<n>.json`` and, once it has caught up, ``ready-<n>.json``.

    Files are made whole and never replaced, so that two drivers agree on every generation.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path, Files(spark, path)

    def _numbers(self, name: str, kind: str) -> list[int]:
        names = self.files.children(f"{self.path}/{name}")
        return sorted(int(n[len(kind) + 1 : -5]) for n in names if n.startswith(f"{kind}-"))

    def generation(self, name: str, number: int) -> Generation:
        return Generation(**json.loads(self.files.read(f"{self.path}/{name}/generation-{number}.json")))

    def newest(self, name: str) -> Generation | None:
        numbers = self._numbers(name, "generation")
        return self.generation(name, numbers[-1]) if numbers else None

    def _next(self, name: str) -> Generation:
        """A generation with an output and a checkpoint of its own; that of a faster driver, if there is one."""
        number = max(self._numbers(name, "generation"), default=-1) + 1
        place = f"{self.path}/{name}/data-{number}-{uuid.uuid4().hex}"
        made = Generation(name, number, f"{place}/output", f"{place}/checkpoint")
        self.files.make(f"{self.path}/{name}")
        self.files.put_if_absent(f"{self.path}/{name}/generation-{number}.json", json.dumps(vars(made)))
        return self.generation(name, number)

    def deploy(self, name: str, start: Starter) -> StreamingQuery:
        """The running query of a name; one that does not run goes on from its generation's checkpoint."""
        return active_queries(self.spark).get(name) or start(name, self.newest(name) or self._next(name))

    def redeploy(self, name: str, start: Starter) -> StreamingQuery:
        """Drop a query and start its changed definition on all records, as a new generation.

        What the dropped generation wrote is what readers get until ``mark_ready``.
        """
        stop(self.spark, [name])
        return start(name, self._next(name))

    def mark_ready(self, name: str) -> Generation:
        """The newest generation has caught up: readers go to its output from now on."""
        newest = self.newest(name)
        if newest is None:
            raise KeyError(name)
        self.files.put_if_absent(f"{self.path}/{name}/ready-{newest.number}.json", "{}")
        return newest

    def output(self, name: str) -> str:
        """Where to read a name: the newest generation that has caught up, else the first."""
        numbers = self._numbers(name, "ready") or self._numbers(name, "generation")[:1]
        if not numbers:
            raise KeyError(name)
        return self.generation(name, numbers[-1]).output
