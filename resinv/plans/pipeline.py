"""The phases as stages over named tables, run in their fixed order inside one session folder."""

from __future__ import annotations

import json
import random
import re
import string
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from resinv.functions import fixed as X
from resinv.sources import files

# Fixed value: the order in which phases run; deduplication precedes scanning so that fewer URLs are scanned.
ORDER = [2, 3, 4, 5, 7, 6, 8, 9]
SESSION = re.compile(r"^\d{4}-\d{2}-\d{2}-\d{6}-[a-z0-9]{5}$")


@dataclass(frozen=True)
class Stage:
    """A step of a phase: reads the named tables, returns the table it is named after."""

    phase: int
    name: str
    inputs: tuple[str, ...]
    run: Callable[..., DataFrame]
    per_profile: bool = False


@dataclass
class Session:
    """A folder with one parquet table per stage, a log and a description, on any file system."""

    spark: SparkSession
    root: str
    log: list[dict] = field(default_factory=list)

    @classmethod
    def new(cls, spark: SparkSession, results: str, inputs: dict[str, DataFrame] | None = None, note: str = "") -> Session:
        tail = "".join(random.choices(string.ascii_lowercase + string.digits, k=5))
        s = cls(spark, f"{results}/{datetime.now():%Y-%m-%d-%H%M%S}-{tail}")
        files.make(spark, s.root)
        for name, df in (inputs or {}).items():
            df.write.parquet(s.path(name))
        s.describe(created=f"{datetime.now():%Y-%m-%d %H:%M:%S}", note=note, inputs=sorted(inputs or {}))
        return s

    @classmethod
    def all(cls, spark: SparkSession, results: str) -> list[Session]:
        """All sessions of a folder, the oldest first."""
        found = [p for p, _ in files.listed(spark, f"{results}/*") if SESSION.match(p.rsplit("/", 1)[-1])]
        return [cls(spark, p) for p in sorted(found)]

    @classmethod
    def latest(cls, spark: SparkSession, results: str) -> Session | None:
        found = cls.all(spark, results)
        return found[-1] if found else None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def has(self, name: str) -> bool:
        return files.exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def description(self) -> dict:
        """What is known of the session: when it was made, its inputs, and the stages done with time and duration."""
        path = f"{self.root}/session.json"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else {}

    def describe(self, **values: object) -> None:
        files.write_text(self.spark, f"{self.root}/session.json", json.dumps(self.description() | values, indent=2))

    def complete(self, stage: str, took: str) -> None:
        steps = self.description().get("steps", {})
        self.describe(steps=steps | {stage: {"done": f"{datetime.now():%Y-%m-%d %H:%M:%S}", "took": took}})

    def save_log(self) -> None:
        done = sum(e["status"] == "done" for e in self.log)
        files.write_text(self.spark, f"{self.root}/execution_log.json", json.dumps({"stages": self.log, "done": done, "failed": sum(e["status"] == "failed" for e in self.log)}, indent=2))


def status(session: Session, stages: list[Stage], profiles: list[str] | None = None) -> list[dict]:
    """Per stage whether its table is there, its inputs are, and when it was done."""
    steps = session.description().get("steps", {})
    out = []
    for stage in stages:
        for profile in (profiles or ["balanced"]) if stage.per_profile else [None]:
            name = f"{stage.name}_{profile}" if profile else stage.name
            ready = all(session.has(i.format(profile=profile)) for i in stage.inputs)
            state = "done" if session.has(name) else "ready" if ready else "waiting"
            out.append({"phase": stage.phase, "stage": name, "state": state, **steps.get(name, {})})
    return out


def phases_to_run(only: int | None = None, start: int | None = None, end: int | None = None) -> list[int]:
    """One phase, or a range in running order (not in numeric order)."""
    for p in (only, start, end):
        if p is not None and p not in ORDER:
            raise ValueError(f"no phase {p}")
    if only is not None:
        return [only]
    a = ORDER.index(start) if start is not None else 0
    b = ORDER.index(end) if end is not None else len(ORDER) - 1
    return ORDER[a : b + 1]


def parse_profiles(text: str, known: dict[str, dict] | None = None) -> list[str]:
    """Names of profiles, ``all`` for all; ``known`` are those of a configuration, else the built-in ones."""
    known = X.PROFILES if known is None else known
    names = [n.strip() for n in text.split(",") if n.strip()]
    names = list(known) if names == ["all"] else names
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown profiles: {', '.join(unknown)}")
    return names


def duration(seconds: float) -> str:
    s = int(seconds)
    return f"{s // 3600}h {s % 3600 // 60}m {s % 60}s" if s >= 3600 else f"{s // 60}m {s % 60}s" if s >= 60 else f"{s}s"


def run_pipeline(
    session: Session,
    stages: list[Stage],
    phases: list[int] | None = None,
    profiles: list[str] | None = None,
    resume: bool = True,
    dry_run: bool = False,
    continue_on_error: bool = False,
    pause: Callable[[int], bool] | None = None,
    only: str | None = None,
) -> list[dict]:
    """Runs the stages of the phases; a stage whose table is there is skipped on resume.

    ``only`` runs one stage of the phases, so that a phase can be run step by step.  ``pause`` is asked before phase
    8 and may stop the run.  A missing input or an error stops the run unless
    it is to continue; everything is logged.
    """
    for phase in phases or ORDER:
        if phase == 8 and pause and not dry_run and not pause(phase):
            session.log.append({"stage": "pause", "phase": 8, "status": "stopped"})
            break
        for stage in [s for s in stages if s.phase == phase and only in (None, s.name)]:
            for profile in (profiles or ["balanced"]) if stage.per_profile else [None]:
                name = f"{stage.name}_{profile}" if profile else stage.name
                entry = {"stage": name, "phase": phase}
                session.log.append(entry)
                missing = [i for i in stage.inputs if not session.has(i.format(profile=profile))]
                began = time.time()
                if dry_run:
                    entry |= {"status": "planned", "missing": missing}
                    continue
                if resume and session.has(name):
                    entry["status"] = "skipped"
                    continue
                try:
                    if missing:
                        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")
                    args = [session.table(i.format(profile=profile)) for i in stage.inputs]
                    out = stage.run(*args, profile) if profile else stage.run(*args)
                    out.write.mode("overwrite").parquet(session.path(name))
                    entry |= {"status": "done", "took": duration(time.time() - began)}
                    session.complete(name, entry["took"])
                except Exception as e:  # noqa: BLE001  (logged, then raised unless told otherwise)
                    entry |= {"status": "failed", "error": str(e)[:500]}
                    if not continue_on_error:
                        session.save_log()
                        raise
    session.save_log()
    return session.log
