"""Numbered frames that a stream leaves, one per batch, folded in tiers as they add up.

Tier 0 holds single batches; a folder of tier k stands for FOLD**k batches in a row. When a run of FOLD
folders of a tier is complete they are added up into one of the next. So the folders that a reader opens,
and those that lie there, grow with the logarithm of the number of batches. Folded ones stay until the
next run of their tier is folded: a reader that listed the folders before has that long to read them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loglode.sources.folders import Folders

#: Folders of a tier that are folded into one.
FOLD = 32
SCHEMA = "_schema.json"


class Tiers:
    """The frames below a path; ``merge`` adds up several into one of the same columns."""

    def __init__(
        self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame] | None = None, fold: int | None = None
    ):
        self.spark, self.path, self.merge = spark, path.rstrip("/"), merge
        self.fold = fold or FOLD
        self.folders = Folders(spark, self.path)

    def declare(self, schema: StructType) -> None:
        """Note the columns, so that there is an empty frame before the first batch."""
        self.folders.publish(SCHEMA, json.dumps(schema.jsonValue()))

    def add(self, frame: DataFrame, number: int) -> None:
        """Write the frame of a batch, in the place of what an earlier attempt at it left, and fold."""
        self.put(frame, _name(0, number))
        tier, done = 0, number + 1
        while done % self.fold == 0:
            done //= self.fold
            self.fold_run(tier, done - 1)
            tier += 1

    def put(self, frame: DataFrame, name: str) -> None:
        """Write a folder that appears whole; where two attempts meet, one of them stays."""
        draft = f"_{name}-{uuid.uuid4().hex}"
        frame.write.parquet(f"{self.path}/{draft}")
        self.folders.remove(name)
        self.folders.move(draft, name)

    def fold_run(self, tier: int, run: int) -> None:
        """Add up one run of a tier; doing it again changes nothing."""
        target = _name(tier + 1, run)
        own = [(tier, i) for i in range(run * self.fold, (run + 1) * self.fold)]
        names = set(self.listed())
        if (tier + 1, run) not in names and names & set(own):
            parts = self.read(sorted(names & set(own)))
            self.put(self.merge(parts).coalesce(1), target)
        for at, number in names:
            if at == tier and number < run * self.fold:
                self.folders.remove(_name(at, number))

    def listed(self) -> list[tuple[int, int]]:
        """Tier and number of the folders that are complete."""
        found = [name for name in self.folders.named("tier=") if self.folders.exists(f"{name}/_SUCCESS")]
        return [tuple(int(x) for x in name.removeprefix("tier=").split("-")) for name in found]

    def chosen(self) -> list[tuple[int, int]]:
        """The fewest folders that stand for every batch once: those in no complete one of a higher tier."""
        names = set(self.listed())
        top = max((tier for tier, _ in names), default=0)

        def covered(tier: int, number: int) -> bool:
            return any((above, number // self.fold ** (above - tier)) in names for above in range(tier + 1, top + 1))

        return sorted(x for x in names if not covered(*x))

    def read(self, names: list[tuple[int, int]]) -> DataFrame:
        paths = [f"{self.path}/{_name(*name)}" for name in names]
        schema = self.schema()
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*paths)

    def schema(self) -> StructType | None:
        if not self.folders.exists(SCHEMA):
            return None
        return StructType.fromJson(json.loads(self.folders.read(SCHEMA)))

    def frame(self) -> DataFrame:
        """All that the batches left; without any, an empty frame of the declared columns."""
        for left in (4, 3, 2, 1, 0):
            names = self.chosen()
            if not names:
                schema = self.schema()
                if schema is None:
                    raise FileNotFoundError(f"no stream has begun to write to {self.path}")
                return self.spark.createDataFrame([], schema)
            try:
                return self.read(names)
            except Exception as problem:
                if not left or "PATH_NOT_FOUND" not in str(problem):
                    raise


def _name(tier: int, number: int) -> str:
    return f"tier={tier}-{number:012d}"
