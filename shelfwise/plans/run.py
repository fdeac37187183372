"""End-to-end run with resumable stages and one published manifest.

``run`` builds features, model metrics, elasticities, recommendations, inventory, replenishment, transfers, the joint
decision and the back-test. Every stage's table is named by a fingerprint of the inputs (names, sizes
and times of the input files) and of all parameters. A table counts as done when Spark's ``_SUCCESS``
is there, so a run that was killed and is started again computes only what is missing, and a run
over changed inputs or parameters never reads stale tables.

The manifest is written last, under another name, and renamed: readers find a whole run or none.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_SCENARIO, Scenario
from shelfwise.plans.pipeline import Pipeline

#: Raise when the rules of a stage change, so that older tables are not taken for its result.
VERSION = 1
INPUTS = ("region", "nation", "customer", "part", "orders", "lineitem")
#: (stage, table of a pipeline, column that is summed for the manifest)
STAGES = (
    ("features", lambda p: p.features, "units_sold"),
    ("model_metrics", lambda p: p._mat(p.model("ridge")[1], "model_metrics"), "value"),
    ("elasticity", lambda p: p.elasticity, "sample_size"),
    ("recommendations", lambda p: p.recommendations, "recommended_price"),
    ("inventory", lambda p: p.inventory_status, "on_hand_inventory"),
    ("replenishment", lambda p: p._mat(p.replenishment, "replenishment"), "recommended_order_quantity"),
    ("transfers", lambda p: p.transfers, "transfer_quantity"),
    ("joint", lambda p: p.joint, "gross_profit_lift"),
    ("backtest", lambda p: p._mat(p.comparison, "backtest"), "total_gross_profit"),
)


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def fingerprint(spark: SparkSession, sf_dir: str, scenario: Scenario) -> str:
    seen = []
    for table in INPUTS:
        fs, at = _files(spark, f"{sf_dir}/{table}.parquet")
        status = fs.getFileStatus(at)
        for f in fs.listStatus(at) if status.isDirectory() else [status]:
            seen.append((table, f.getPath().getName(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps([VERSION, str(sf_dir), sorted(seen), asdict(scenario)], default=str).encode()).hexdigest()[:16]


class ResumablePipeline(Pipeline):
    """A pipeline whose stage tables are found again under their fingerprint."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str, scenario: Scenario = DEFAULT_SCENARIO):
        super().__init__(spark, sf_dir, scenario)
        self.folder, self.key = folder.rstrip("/"), fingerprint(spark, sf_dir, scenario)
        self.computed: list[str] = []

    def table(self, name: str) -> str:
        return f"{self.folder}/tables/{name}-{self.key}"

    def _mat(self, df: DataFrame, name: str) -> DataFrame:
        path = self.table(name)
        fs, done = _files(self.spark, f"{path}/_SUCCESS")
        if not fs.exists(done):
            df.write.mode("overwrite").parquet(path)
            self.computed.append(name)
        return self.spark.read.schema(df.schema).parquet(path)


def run(spark: SparkSession, sf_dir: str, folder: str, scenario: Scenario = DEFAULT_SCENARIO) -> tuple[DataFrame, list[str]]:
    """(manifest, stages computed by this call): a row per stage with its path, rows, total and checksum."""
    p = ResumablePipeline(spark, sf_dir, folder, scenario)
    rows = []
    for stage, build, measure in STAGES:
        df = build(p)
        digest = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).cast("decimal(38,0)")
        n, total, checksum = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col(measure).cast("double")), F.lit(0.0)), F.coalesce(F.sum(digest), F.lit(0)).cast("string")).first()
        rows.append((stage, df.inputFiles()[0].rsplit("/", 1)[0] if n else p.table(stage), n, total, checksum))
    manifest = spark.createDataFrame(rows, "stage string, path string, rows long, total double, checksum string")
    final, draft = f"{p.folder}/manifests/{p.key}", f"{p.folder}/drafts/{p.key}"
    manifest.coalesce(1).write.mode("overwrite").json(draft)
    fs, source = _files(spark, draft)
    _, target = _files(spark, final)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot publish {final}")
    return spark.read.schema(manifest.schema).json(final), p.computed


def published(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the manifests of whole runs, latest first."""
    fs, at = _files(spark, f"{folder.rstrip('/')}/manifests")
    found = sorted(((f.getModificationTime(), f.getPath().toString()) for f in fs.listStatus(at)), reverse=True) if fs.exists(at) else []
    return [path for _, path in found]


def read_stage(spark: SparkSession, manifest: str, stage: str) -> DataFrame:
    """A stage's table of a published run."""
    return spark.read.parquet(spark.read.json(manifest).where(F.col("stage") == stage).first()["path"])
