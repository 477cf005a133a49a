"""Journal of a run: which steps are done, the versions that they read and wrote, and their rows.

It is a small file in the lake, replaced after every step. A run that failed goes on from it: a step is not repeated while
the versions that it read and the one that it wrote are still the current ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from threading import Lock

from pyspark.sql import DataFrame

from ordermill.plans import files
from ordermill.plans.lake import Lake

Table = tuple[str, str]


class Journal:
    def __init__(self, lake: Lake, settings: Mapping[str, object]) -> None:
        """``settings`` tell whether an unfinished run is the same one; None matches what that run settled on."""
        self.lake, self.path, self._lock = lake, f"{lake.root}/_journal", Lock()
        text = files.read_text(lake.spark, self.path)
        before = json.loads(text) if text else {"finished": True}
        same = not before["finished"] and all(value is None or before["settings"].get(name) == value for name, value in settings.items())
        self.resumed = same
        self.state = before if same else {"settings": dict(settings), "finished": False, "steps": {}}
        self._save()

    def _save(self) -> None:
        files.replace_text(self.lake.spark, self.path, json.dumps(self.state))

    def setting(self, name: str, settle: Callable[[], object]) -> object:
        """A setting; one that was left open is settled now and stays so when the run goes on."""
        if self.state["settings"].get(name) is None:
            self.state["settings"][name] = settle()
            self._save()
        return self.state["settings"][name]

    def step(self, name: str, reads: Mapping[str, object], wrote: Iterable[Table], action: Callable[[], object]) -> bool:
        """Do ``action``, which writes the tables ``wrote``, unless it is done with the same ``reads``; True if it ran."""
        wrote = list(wrote)
        done = self.state["steps"].get(name)
        if done and done["reads"] == dict(reads) and done["wrote"] == self._versions(wrote):
            return False
        action()
        rows = {"/".join(t): self.lake.read(*t).count() for t in wrote if self.lake.exists(*t)}
        with self._lock:
            self.state["steps"][name] = {"reads": dict(reads), "wrote": self._versions(wrote), "rows": rows}
            self._save()
        return True

    def table(self, table: Table, reads: Iterable[Table], build: Callable[[], DataFrame]) -> DataFrame:
        """One stored table, built by ``build`` from the tables ``reads`` unless it is done."""
        self.step("/".join(table), self._versions(reads), [table], build)
        return self.lake.read(*table)

    def finish(self) -> None:
        self.state["finished"] = True
        self._save()

    def _versions(self, tables: Iterable[Table]) -> dict[str, str | None]:
        return {"/".join(t): self.lake.version(*t) for t in tables}
