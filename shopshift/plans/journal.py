"""What a run has finished, so that a run that failed can go on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from shopshift.config import MigrationConfig
from shopshift.session import ensure_checkpoint_dir
from shopshift.sources.tables import create_file, delete_path, folder_size, list_names, live_folders, read_text

JOURNAL = "_journal"


def fingerprint(spark: SparkSession, cfg: MigrationConfig, jobs: Sequence[str], tables: Sequence[str], number: int) -> str:
    """What a run works on: its parameters, its number, and the folders (size, files, time) of the tables it reads."""
    found = {t: [(f, folder_size(spark, f)) for f in live_folders(spark, t)] for t in sorted(tables)}
    said = json.dumps([asdict(cfg), list(jobs), number, found], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()[:12]


class Journal:
    """A folder of one small file per finished stage or target of a run (``<base>/_journal/<run id>``)."""

    def __init__(self, spark: SparkSession, base: str, run_id: str) -> None:
        self.spark, self.run_id = spark, run_id
        self.folder = f"{base.rstrip('/')}/{JOURNAL}/{run_id}"

    @classmethod
    def open(cls, spark: SparkSession, base: str, of: str, resume: bool) -> Journal:
        """A new run of fingerprint ``of``; with ``resume`` the last one of that fingerprint that was not published, if any."""
        runs = [n for n in list_names(spark, f"{base.rstrip('/')}/{JOURNAL}") if n.startswith(f"{of}-")] if resume else []
        # of several, the one that has finished most
        run_id = max(runs, key=lambda r: len(list_names(spark, f"{base.rstrip('/')}/{JOURNAL}/{r}")), default=f"{of}-{uuid.uuid4().hex[:8]}")
        return cls(spark, base, run_id)

    def finished(self, kind: str, name: str) -> dict | None:
        """What was noted when it was finished; None if it was not."""
        text = read_text(self.spark, f"{self.folder}/{kind}-{name}.json")
        return json.loads(text) if text else None

    def finish(self, kind: str, name: str, note: dict) -> None:
        create_file(self.spark, f"{self.folder}/{kind}-{name}.json", json.dumps(note) + "\n")


def clean_up(spark: SparkSession, base: str, published: str) -> None:
    """After run ``published``: its stages and journal go, and those of all runs that failed before it, with the folders they wrote."""
    root = f"{base.rstrip('/')}/{JOURNAL}"
    for run_id in list_names(spark, root):
        if run_id != published:
            for name in list_names(spark, f"{root}/{run_id}"):
                note = json.loads(read_text(spark, f"{root}/{run_id}/{name}") or "{}")
                for folder in note.get("wrote", []):
                    delete_path(spark, folder)
        delete_path(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{run_id}")
        delete_path(spark, f"{root}/{run_id}")
