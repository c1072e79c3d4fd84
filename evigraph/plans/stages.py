"""A run of named stages that can be resumed: markers, content hashes and lineage."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import table_hash
from ..sources.shared import get_text, names, put_text, removed

#: Policies towards what is in the folder of a run.
REFUSE, OVERWRITE, RESUME = "refuse", "overwrite", "resume"
_EMPTY = hashlib.sha256(b"").hexdigest()


def digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


class Run:
    """Stages in one folder; each has a table and a marker.

    A marker is written last, with the hash of the stage's rows and a fingerprint of what it was made from: its name, its parameters and the
    content hashes of its inputs. In mode "resume" a complete stage with the same fingerprint is read instead of made; a stage that is
    half written, failed or made from something else is cleared first. "refuse" takes an empty folder only, "overwrite" clears it.
    """

    def __init__(self, spark: SparkSession, folder: str, mode: str = REFUSE):
        if mode not in (REFUSE, OVERWRITE, RESUME):
            raise ValueError(f"unknown mode {mode}")
        self.spark, self.folder, self.done = spark, folder.rstrip("/"), {}
        if mode == REFUSE and names(spark, self.folder):
            raise FileExistsError(f"{self.folder} is not empty; overwrite or resume it")
        if mode == OVERWRITE:
            removed(spark, self.folder)

    def marker(self, stage: str) -> dict | None:
        found = names(self.spark, f"{self.folder}/markers")
        return json.loads(get_text(self.spark, f"{self.folder}/markers/{stage}.json")) if f"{stage}.json" in found else None

    def _mark(self, stage: str, facts: dict) -> dict:
        put_text(self.spark, f"{self.folder}/markers/{stage}.json", json.dumps({"stage": stage} | facts, sort_keys=True))
        return {"stage": stage} | facts

    def clear(self, stage: str) -> None:
        """Delete a stage's marker, then its table: what is half deleted is not complete."""
        removed(self.spark, f"{self.folder}/markers/{stage}.json")
        removed(self.spark, f"{self.folder}/tables/{stage}")

    def stage(self, name: str, make: Callable[..., DataFrame], order: list[str], inputs: dict[str, DataFrame] | None = None, after: list[str] = (), params: dict | None = None) -> DataFrame:
        """The table of a stage: ``make(*inputs, *tables of the stages after which it comes)``, hashed in ``order`` (which should tell its rows
        apart). ``inputs`` are tables from outside; they are hashed too, by all their columns."""
        tables = [self.done[a][0] for a in after]
        given = {k: self._content(df, sorted(df.columns))[0] for k, df in (inputs or {}).items()}
        fingerprint = digest({"stage": name, "params": params or {}, "inputs": given, "after": {a: self.done[a][1]["content_sha256"] for a in after}})
        marker = self.marker(name)
        path = f"{self.folder}/tables/{name}"
        if not marker or marker["status"] != "complete" or marker["fingerprint"] != fingerprint:
            self.clear(name)
            facts = {"fingerprint": fingerprint, "inputs": given, "after": sorted(after)}
            self._mark(name, facts | {"status": "running"})
            began = time.time()
            try:
                make(*(inputs or {}).values(), *tables).write.parquet(path)
                content, rows = self._content(self.spark.read.parquet(path), order)
            except Exception as error:
                self._mark(name, facts | {"status": "failed", "error": str(error).splitlines()[0][:500] if str(error) else type(error).__name__})
                raise
            marker = self._mark(name, facts | {"status": "complete", "content_sha256": content, "n_rows": rows, "seconds": round(time.time() - began, 3)})
        table = self.spark.read.parquet(path)
        self.done[name] = table, marker
        return table

    @staticmethod
    def _content(df: DataFrame, order: list[str]) -> tuple[str, int]:
        found = table_hash(df, order).first()
        return (found.content_sha256, found.n_rows) if found else (_EMPTY, 0)

    def dataset_id(self) -> str:
        """One id for the contents of all stages of this run."""
        return digest({name: marker["content_sha256"] for name, (_, marker) in self.done.items()})

    def lineage(self) -> DataFrame:
        """stage, status, n_rows, content_sha256, fingerprint, what it was made from, and the id of the data set."""
        rows = [
            (m["stage"], m["status"], m["n_rows"], m["content_sha256"], m["fingerprint"], ",".join(sorted([*m["inputs"], *m["after"]])), self.dataset_id())
            for _, m in self.done.values()
        ]
        return self.spark.createDataFrame(rows, "stage string, status string, n_rows long, content_sha256 string, fingerprint string, made_from string, dataset_id string")
