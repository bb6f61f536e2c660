"""Tables of immutable files under one commit marker.

A table's manifest names the files that it consists of. A change writes new files beside the old
ones and then the next manifest, whole and under its own number; until that is there nothing has
changed, and what a change that was cut off leaves behind belongs to no version. A reader takes one
manifest and so sees one version, however the table goes on. Files that a version no longer
has are kept for ``KEEP`` more versions, for readers that still use them.

The manifest also remembers the last batch of every run that it holds, so a replayed batch is known.
One writer at a time; a second one finds its number taken and fails.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from sightline.sources import folders
from sightline.streaming.run import Batch

#: Versions for which replaced files stay.
KEEP = 2


@dataclass
class Manifest:
    """One version: what it consists of (``parts``), its batches, and files it no longer has."""

    version: int = -1
    parts: dict = field(default_factory=dict)
    handled: dict[str, int] = field(default_factory=dict)
    retired: list[tuple[str, int]] = field(default_factory=list)

    def holds(self, batch: Batch) -> bool:
        """Whether a batch is part of this version; batches of a run come in the order of their numbers."""
        return batch.number <= self.handled.get(batch.run, -1)


class Snapshots:
    """The manifests of the table at ``path``, in ``path/commits``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def versions(self, spark: SparkSession) -> list[int]:
        names = folders.names(spark, f"{self.path}/commits")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def at(self, spark: SparkSession, version: int) -> Manifest:
        """A version that is still kept."""
        known = json.loads(folders.read_text(spark, self._file(version)))
        return Manifest(version, known["parts"], known["handled"], [tuple(r) for r in known["retired"]])

    def newest(self, spark: SparkSession) -> Manifest:
        versions = self.versions(spark)
        return self.at(spark, versions[-1]) if versions else Manifest()

    def commit(
        self, spark: SparkSession, before: Manifest, parts: dict, batch: Batch | None = None, gone: list[str] | None = None
    ) -> Manifest:
        """Make ``parts`` the version after ``before``; ``gone`` are paths it no longer has."""
        version = before.version + 1
        handled = {**before.handled, **({batch.run: batch.number} if batch else {})}
        retired = [*before.retired, *((path, version) for path in gone or [])]
        due = [path for path, since in retired if since <= version - KEEP]
        kept = [(path, since) for path, since in retired if since > version - KEEP]
        known = {"parts": parts, "handled": handled, "retired": kept}
        folders.write_text(spark, self._file(version), json.dumps(known))
        # only now: a version that was not committed still needs them
        for path in due:
            folders.remove(spark, f"{self.path}/{path}")
            above = path.rpartition("/")[0]
            while "/" in above and all(n.startswith(("_", ".")) for n in folders.names(spark, f"{self.path}/{above}")):
                folders.remove(spark, f"{self.path}/{above}")
                above = above.rpartition("/")[0]
        for old in self.versions(spark):
            if old < version - KEEP:
                folders.remove(spark, self._file(old))
        return Manifest(version, parts, handled, kept)

    def _file(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"
