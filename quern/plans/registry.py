"""State of tracked runs: runs, snapshots, checkpoints, prompt versions and artifacts, each a small versioned table."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quern.operators import merge

LAYOUT_VERSION = 1
#: Fixed values.
STATUSES = ("running", "succeeded", "failed", "cancelled")
STAGES = ("source.ingest", "entries.assemble", "definitions.generate", "definitions.review", "audit.export", "distribution.export", "distribution.sqlite_export", "workflow.run")
TABLES = {
    "layout": "version int, applied_at timestamp",
    "runs": "run_id string, stage string, status string, parent_run_id string, config string, stats string, error string, started_at timestamp, finished_at timestamp",
    "snapshots": "snapshot_id string, source_name string, archive_sha256 string, size long, acquisition_mode string, compression string, path string",
    "checkpoints": "run_id string, stage_name string, checkpoint_key string, payload string, updated_at timestamp",
    "prompts": "prompt_version string, prompt_text string, definition_language_code string, definition_language_name string",
    "artifacts": "run_id string, artifact_type string, output_path string, output_sha256 string, entry_count long, metadata string, created_at timestamp",
    "raw": "id long, run_id string, snapshot_id string, source_line long, source_byte_offset long, word string, lang string, lang_code string, pos string, payload string",
    "anomalies": "run_id string, snapshot_id string, source_line long, source_byte_offset long, anomaly_type string, detail string, raw_payload string",
    "reviews": "entry_id string, enrichment_input_hash string, review_prompt_version string, judge_model string, sample_seed string, stratum string, sampling_weight double, verdict string, scores string, issues string, run_id string",
    "enrichments": "enrichment_id string, run_id string, entry_id string, model string, prompt_version string, definition_language_code string, definition_language_name string, input_hash string, status string, request_payload string, response_payload string, raw_response string, error string, retries int, generation_metadata string, created_at timestamp",
}


def now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


def resume_points(runs: DataFrame, checkpoints: DataFrame, stage: str, snapshot_id: str) -> DataFrame:
    """Checkpoints of unfinished runs of a stage over a snapshot, which the run's stats or else its config name; newest first."""
    open_ = runs.filter((F.col("stage") == stage) & F.col("status").isin("running", "failed"))
    snapshot = F.coalesce(F.get_json_object("stats", "$.snapshot_id"), F.get_json_object("config", "$.snapshot_id"))
    own = open_.withColumn("snapshot_id", snapshot).filter(F.col("snapshot_id") == snapshot_id).select("run_id", "snapshot_id", "started_at")
    return checkpoints.join(own, "run_id").orderBy(F.desc("updated_at"), F.desc("started_at"), "run_id", "checkpoint_key")


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.store = merge.Store(spark, self.path)

    def table(self, name: str, schema=None) -> merge.VersionedTable:
        return merge.VersionedTable(self.spark, f"{self.path}/{name}", schema or TABLES[name])

    def _row(self, name: str, **values) -> DataFrame:
        table = self.table(name)
        return self.spark.createDataFrame([tuple(values.get(f) for f in table.schema.fieldNames())], table.schema)

    def init(self) -> bool:
        """Records the layout once; later calls change nothing."""
        layout = self.table("layout")
        if not layout.read().filter(F.col("version") == LAYOUT_VERSION).isEmpty():
            return False
        layout.append(self._row("layout", version=LAYOUT_VERSION, applied_at=now()))
        return True

    def start(self, stage: str, config: dict, parent: str | None = None) -> str:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        run_id = str(uuid.uuid4())
        self.table("runs").append(self._row("runs", run_id=run_id, stage=stage, status="running", parent_run_id=parent, config=json.dumps(config), started_at=now()))
        return run_id

    def _update(self, run_id: str, **values) -> None:
        runs = self.table("runs")
        found = runs.read().filter(F.col("run_id") == run_id).collect()
        if not found:
            raise KeyError(run_id)
        runs.upsert(self._row("runs", **(found[0].asDict() | values)), ["run_id"])

    def complete(self, run_id: str, stats: dict) -> None:
        self._update(run_id, status="succeeded", stats=json.dumps(stats), finished_at=now())

    def fail(self, run_id: str, error: str) -> None:
        self._update(run_id, status="failed", error=error, finished_at=now())

    def cancel(self, run_id: str) -> None:
        self._update(run_id, status="cancelled", finished_at=now())

    def update_config(self, run_id: str, updates: dict) -> None:
        """A shallow merge."""
        config = json.loads(self.table("runs").read().filter(F.col("run_id") == run_id).first()["config"])
        self._update(run_id, config=json.dumps(config | updates))

    def snapshot(self, source_name: str, found) -> str:
        """The id of a snapshot with this content, a new one if there is none."""
        known = self.table("snapshots")
        row = known.read().filter((F.col("source_name") == source_name) & (F.col("archive_sha256") == found.sha256)).first()
        if row:
            return row["snapshot_id"]
        snapshot_id = str(uuid.uuid4())
        known.append(self._row("snapshots", snapshot_id=snapshot_id, source_name=source_name, archive_sha256=found.sha256, size=found.size, acquisition_mode=found.mode, compression=found.compression, path=found.path))
        return snapshot_id

    def checkpointed(self, run_id: str, stage: str, key: str, payload: dict) -> dict[str, list[str]]:
        """A change for a commit: the checkpoint is this now."""
        table, keys = self.table("checkpoints"), ["run_id", "stage_name", "checkpoint_key"]
        row = self._row("checkpoints", run_id=run_id, stage_name=stage, checkpoint_key=key, payload=json.dumps(payload), updated_at=now())
        return table.replacing(merge.upserted(table.read(), row, keys))

    def checkpoints(self, run_id: str, stage: str, key: str, payloads: dict[int, dict]) -> dict[int, dict[str, list[str]]]:
        """As checkpointed(), for commits to come in a row: a change for each number, by one write for all of them."""
        table, keys = self.table("checkpoints"), ["run_id", "stage_name", "checkpoint_key"]
        rows = [(run_id, stage, key, json.dumps(p), now(), n) for n, p in payloads.items()]
        made = self.spark.createDataFrame(rows, StructType([*table.schema.fields, StructField("n", IntegerType())]))
        rest = table.put(merge.deleted(table.read(), made, keys))
        parts = table.put_parts(made.coalesce(1), "n")
        return {n: {table.name: [rest, f"{parts}/n={n}"]} for n in payloads}

    def commit(self, *changes: dict[str, list[str]]) -> None:
        """Changes of several tables, all at once."""
        self.store.commit({k: v for c in changes for k, v in c.items()})

    def checkpoint(self, run_id: str, stage: str, key: str, payload: dict) -> None:
        self.commit(self.checkpointed(run_id, stage, key, payload))

    def resumable(self, stage: str, snapshot_id: str) -> tuple[str, dict] | None:
        """(run_id, payload) of the newest checkpoint of an unfinished run of this snapshot."""
        row = resume_points(self.table("runs").read(), self.table("checkpoints").read(), stage, snapshot_id).first()
        return (row["run_id"], json.loads(row["payload"])) if row else None

    def register_prompt(self, version: str, text: str, code: str, name: str) -> None:
        prompts = self.table("prompts")
        prompts.write(merge.inserted(prompts.read(), self._row("prompts", prompt_version=version, prompt_text=text, definition_language_code=code, definition_language_name=name), ["prompt_version"]))

    def artifact(self, run_id: str, kind: str, path: str, sha256: str | None, n: int, metadata: dict) -> None:
        self.table("artifacts").append(self._row("artifacts", run_id=run_id, artifact_type=kind, output_path=path, output_sha256=sha256, entry_count=n, metadata=json.dumps(metadata), created_at=now()))
