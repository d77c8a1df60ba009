"""A stage graph that resumes: which steps of a run are done is kept in a small JSON file.

Its folder may be on any file system that Arrow reads; on a cluster take one that outlives the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ..sources.connectors import BatchClient, wait
from ..sources.files import names_in, read_json, write_json


def new_run(folder: str, config: dict, steps: list[str], now: datetime | None = None) -> dict:
    """A run of all steps pending; its name sorts by minute and cannot collide."""
    name = f"run_{(now or datetime.now()):%y%m%d_%H%M}_{uuid.uuid4().hex[:6]}"
    run = {"run": name, "config": config, "steps": dict.fromkeys(steps, "pending")}
    save(folder, run)
    return run


def save(folder: str, run: dict) -> None:
    write_json(f"{folder}/status_{run['run']}.json", run)


def _latest(folder: str, start: str) -> list[dict]:
    names = [n for n in names_in(folder) if n.startswith(start) and n.endswith(".json")]
    return [read_json(f"{folder}/{n}") for n in reversed(names)]


def incomplete(folder: str) -> dict | None:
    """The latest run with a step that is not done."""
    return next((r for r in _latest(folder, "status_") if any(v != "done" for v in r["steps"].values())), None)


def incomplete_batch(folder: str, kind: str) -> dict | None:
    """The latest request batch of a kind that has not been completed."""
    return next((b for b in _latest(folder, f"batch_{kind}_") if not b.get("completed_at")), None)


def submitted(folder: str, kind: str, client: BatchClient, requests: DataFrame, poll: float) -> tuple[str, Callable[[], None]]:
    """The ended batch of a kind, and what marks it completed once its answers are stored.

    The intent is written before anything is sent, the service's id after.  A batch that was sent and not
    completed is waited for.  After a crash between the two a client that has ``find`` is asked for the intent's
    key, under which it sends (``submit(requests, key)``); one without has to know its requests again, as
    ``ExecutorBatches`` does.
    """
    found = incomplete_batch(folder, kind)
    if not found:
        key = uuid.uuid4().hex
        found = {"batch": None, "key": key, "kind": kind, "file": f"batch_{kind}_{datetime.now():%y%m%d_%H%M%S}_{key[:6]}.json", "completed_at": None}
        write_json(f"{folder}/{found['file']}", found)
    elif not found["batch"] and hasattr(client, "find"):
        found["batch"] = client.find(found["key"])
    if not found["batch"]:
        found["batch"] = client.submit(requests, found["key"]) if hasattr(client, "find") else client.submit(requests)
    write_json(f"{folder}/{found['file']}", found)
    wait(client, found["batch"], poll)

    def completed() -> None:
        write_json(f"{folder}/{found['file']}", found | {"completed_at": datetime.now().isoformat()})

    return found["batch"], completed


@dataclass
class Pipeline:
    """Steps (name, function of the run) in order; a step that fails leaves those before it done."""

    folder: str
    steps: list[tuple[str, Callable[[dict], None]]]

    def run(self, config: dict, resume: bool = True) -> dict:
        run = incomplete(self.folder) if resume else None
        run = run or new_run(self.folder, config, [n for n, _ in self.steps])
        for name, step in self.steps:
            if run["steps"].get(name) != "done":
                step(run)
                run["steps"][name] = "done"
                save(self.folder, run)
        return run
