"""Model life cycle on shared storage: save, register, find, load, promote (ML7, ML12, ML13, R1-R3, F4-F6).

A registry is a folder with append-only tables ``runs``, ``versions`` and
``stage_events`` and the saved models. Several writers may register at once: a
version's number is taken by creating the file of that number, which only one
of them can (``claim``); the others take the next. Each row that is added lies in a
folder of its own.

An ensemble is saved as a node table with a manifest: the number of its nodes and
a checksum of them, which doesn't depend on how they lie in files. A version whose
nodes can't be read or don't fit its manifest is damaged (``sound_versions``), and
the versions that count end before it (O5).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import registry as R
from tallyspark.operators.boosting import NODES

MANIFEST = "uri string, n_nodes bigint, checksum decimal(38,0)"


def checksum() -> list[Column]:
    """Number of rows and a sum of row hashes: the same however the rows lie in files."""
    names = [c.split()[0] for c in NODES.split(", ")]
    return [F.count(F.lit(1)).alias("n_nodes"), F.coalesce(F.sum(F.xxhash64(*names).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("checksum")]


class ModelRegistry:
    """Tables and models under ``base`` (a folder that all machines see)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _table(self, name: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.base}/{name}")
        except AnalysisException as ex:
            if "PATH_NOT_FOUND" not in str(ex):
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, name: str, rows: DataFrame) -> None:
        """Rows in a folder of their own: jobs that write into one folder at once would take each other's unfinished files away."""
        rows.write.parquet(f"{self.base}/{name}/{uuid.uuid4().hex}")

    def runs(self) -> DataFrame:
        return self._table("runs", R.RUNS_SCHEMA)

    def versions(self) -> DataFrame:
        return self._table("versions", R.VERSIONS_SCHEMA)

    def stage_events(self) -> DataFrame:
        return self._table("stage_events", R.STAGE_EVENTS_SCHEMA)

    def add_runs(self, runs: list[tuple]) -> None:
        """(run_id, experiment, params, metrics, tags) records."""
        self._append("runs", R.runs_frame(self.spark, runs))

    def register(self, model_name: str, uri: str, run_id: str | None = None) -> int:
        """R2: the next version of a model, stored at ``uri``; returns its number. Other writers may register at the same time."""
        row = R.register_version(self.spark, self.versions(), model_name, uri, run_id).first().asDict()
        while not self.claim(f"{model_name}-{row['version']}"):
            row["version"] += 1            # another writer has that number, in the table or on its way there
        self._append("versions", self.spark.createDataFrame([row], R.VERSIONS_SCHEMA))
        return row["version"]

    def claim(self, name: str) -> bool:
        """Create a file that only one writer can create; False if it is there.

        A mounted folder does that itself; there Hadoop's client would look first and write then, which isn't one step.
        """
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.base}/claims/{name}")
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if files.getScheme() == "file":
            files.mkdirs(target.getParent())
            return jvm.java.io.File(target.toUri().getPath()).createNewFile()
        try:
            files.create(target, False).close()
        except Py4JJavaError as ex:
            if "FileAlreadyExists" not in ex.java_exception.getClass().getName() and not files.exists(target):
                raise
            return False
        return True

    def save_ensemble(self, nodes: DataFrame, model_name: str, run_id: str | None = None) -> int:
        """ML7: save a node table (``boosting.NODES``) with its manifest under a fresh name and register it."""
        uri = f"{self.base}/models/{model_name}-{uuid.uuid4().hex}"
        nodes.write.parquet(uri)
        written = self.spark.read.schema(NODES).parquet(uri)
        self._append("manifests", written.agg(*checksum()).select(F.lit(uri).alias("uri"), "n_nodes", "checksum"))
        return self.register(model_name, uri, run_id)

    def ensembles(self, versions: DataFrame) -> DataFrame:
        """The nodes of versions (model_name, version, uri), in one scan of their folders; files that can't be read give nothing.

        A folder is recognized by the name of its files' parent, which :meth:`save_ensemble` makes unique.
        """
        held = [r["uri"] for r in versions.select("uri").distinct().collect() if self._there(r["uri"])]     # one text a version
        if not held:
            return self.spark.createDataFrame([], "model_name string, version int, " + NODES)
        nodes = (self.spark.read.schema(NODES).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(*held)
                 .withColumn("_folder", F.element_at(F.split(F.input_file_name(), "/"), -2)))
        named = versions.select("model_name", "version", F.element_at(F.split("uri", "/"), -1).alias("_folder"))
        return nodes.join(F.broadcast(named), "_folder").drop("_folder")     # as many rows as there are versions

    def _there(self, uri: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def sound_versions(self, model_name: str) -> DataFrame:
        """(model_name, version, uri, is_sound): whether the saved nodes are those of the manifest; one scan of all versions."""
        versions = R.versions_of(self.versions(), model_name)
        found = self.ensembles(versions).groupBy("model_name", "version").agg(*checksum())
        want = self._table("manifests", MANIFEST).select("uri", F.col("n_nodes").alias("_n"), F.col("checksum").alias("_sum"))
        both = versions.join(found, ["model_name", "version"], "left").join(want, "uri", "left")
        same = (F.col("n_nodes") == F.col("_n")) & (F.col("checksum") == F.col("_sum"))
        return both.select("model_name", "version", "uri", F.coalesce(same, F.lit(False)).alias("is_sound"))

    def live_versions(self, model_name: str) -> DataFrame:
        """(model_name, version, uri) of versions 1, 2, ... up to the first that is missing or damaged."""
        sound = self.sound_versions(model_name).where("is_sound")
        return sound.join(R.gap_free_versions(sound), ["model_name", "version"], "left_semi").drop("is_sound")

    def save(self, model: PipelineModel, model_name: str, run_id: str | None = None) -> int:
        """ML7: save a fitted pipeline under a fresh name and register it."""
        uri = f"{self.base}/models/{model_name}-{uuid.uuid4().hex}"
        model.write().save(uri)
        return self.register(model_name, uri, run_id)

    def promote(self, model_name: str, version: int | None, stage: str = "Production") -> None:
        """Move a version to a stage; nothing happens without a version. Moves at the same time get an order of their own."""
        row = R.promote(self.spark, model_name, version, stage, self.stage_events())
        if row is not None:
            event = row.first().asDict()
            while not self.claim(f"stage-event-{event['seq']}"):
                event["seq"] += 1
            self._append("stage_events", self.spark.createDataFrame([event], R.STAGE_EVENTS_SCHEMA))

    def uri(self, model_name: str, stage: str | None = None, version: int | None = None, run_id: str | None = None) -> str:
        """where the version lies that is in a stage, has a number or comes from a run (the latest of these)."""
        found = R.versions_of(self.versions(), model_name)
        if stage is not None:
            held = R.version_in_stage(R.current_stage(self.stage_events()), stage)
            found = found.join(R.versions_of(held, model_name), ["model_name", "version"], "left_semi")
        if version is not None:
            found = R.version_lookup(found, model_name, version)
        if run_id is not None:
            found = R.versions_of_run(found, run_id)
        row = found.orderBy(found["version"].desc()).first()
        if row is None:
            raise LookupError(f"no version of {model_name} with stage={stage}, version={version}, run_id={run_id}")
        return row["uri"]

    def load(self, model_name: str, **which) -> PipelineModel:
        """The saved pipeline of :meth:`uri`."""
        return PipelineModel.load(self.uri(model_name, **which))
