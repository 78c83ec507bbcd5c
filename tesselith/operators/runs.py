"""One run: its name, its state while it lasts, its log, and what it leaves."""

from __future__ import annotations

import logging
import os
import shutil
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, dumped
from ..sources.sinks import published
from . import report

MANIFEST = ["slide_id", "index", "x", "y", "level", "size", "output", "status", "error"]
LINE = "slide=%s status=%s patches=%d reader=%s heuristic=%s color_correction=%s elapsed=%.2fs error=%s"


def run_id(prefix: str = "run", now: datetime | None = None) -> str:
    return f"{prefix}_{(now or datetime.now(UTC)).strftime('%Y%m%dT%H%M%SZ')}_{os.getpid()}"


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str  # success, partial
    slides: DataFrame
    output_root: str
    log: str
    summary: dict


class Run:
    """State lies in <logs>/.state/<run id> until a run succeeds; a run id is bound to one set of settings."""

    def __init__(self, spark: SparkSession, name: str, config: Config):
        self.spark, self.name, self.config = spark, name, config
        self.state, self.log = os.path.join(config.logging.root, ".state", name), os.path.join(config.logging.root, f"{name}.log")
        os.makedirs(self.state, exist_ok=True)
        sign = os.path.join(self.state, "config.sha256")
        if os.path.exists(sign):
            with open(sign) as f:
                if f.read().strip() != config.signature:
                    raise ValueError(f"run {name!r} is there with other settings")
        published(sign, config.signature.encode() + b"\n")
        self.logger = logging.getLogger(f"tesselith.{name}")
        self.logger.setLevel(getattr(logging, config.logging.level.upper(), logging.INFO))
        self.logger.propagate = False
        if not self.logger.handlers:
            handler = logging.FileHandler(self.log, encoding="utf-8")
            handler.setFormatter(logging.Formatter("%(levelname).1s%(asctime)s %(process)d %(filename)s:%(lineno)d] %(message)s", "%Y%m%d %H:%M:%S"))
            self.logger.addHandler(handler)
        self.logger.info("run %s, settings %s\n%s", name, config.signature, dumped(config).rstrip())

    def stored(self, df: DataFrame, what: str) -> DataFrame:
        """A step's rows, written once to the run's state."""
        path = f"file://{os.path.abspath(self.state)}/{what}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_manifest(self, records: DataFrame) -> None:
        records.select(*MANIFEST).write.mode("overwrite").option("header", True).csv(f"file://{os.path.abspath(self.state)}/manifest")

    def successes(self, slide_id: str) -> set[str]:
        """Outputs of a slide that the manifest calls a success."""
        rows = self.spark.read.option("header", True).csv(f"file://{os.path.abspath(self.state)}/manifest")
        return {r["output"] for r in rows.where((F.col("slide_id") == slide_id) & (F.col("status") == "success")).select("output").collect()}

    def finish(self, results: DataFrame, output_root: str) -> RunResult:
        """Log lines in input order, failures, the summary; the state goes if all is well."""
        results = self.stored(report.with_level(results).orderBy("ordinal"), "results")
        levels, failures = {"error": logging.ERROR, "warning": logging.WARNING}, []
        for r in results.orderBy("ordinal").toLocalIterator():
            self.logger.log(levels.get(r["level"], logging.INFO), LINE, r["slide_id"], r["status"], r["patches"], r["reader"] or "-", r["heuristic"] or "-", r["color_correction"] or "-", r["elapsed"] or 0.0, r["error"] or "-")
            if r["status"] == "failed":
                failures.append(f"{r['slide_id']}\t{r['error'] or 'unknown error'}\n")
        if failures:
            published(os.path.join(self.state, "failures.txt"), "".join(failures).encode())
        total = report.summary(results).first().asDict()
        self.logger.info("summary status=%s slides=%d success=%d failed=%d patches=%d", total["status"], total["slides"], total["success"], total["failed"], total["patches"])
        if total["status"] == "success":
            rows = self.spark.createDataFrame(results.collect(), results.schema) if total["slides"] <= 10_000 else self.kept(results)
            shutil.rmtree(self.state, ignore_errors=True)
            results = rows
        return RunResult(self.name, total["status"], results, output_root, self.log, total)

    def kept(self, results: DataFrame) -> DataFrame:
        """Results of very many slides stay beside the log, as the state goes."""
        path = f"file://{os.path.abspath(self.config.logging.root)}/{self.name}.results"
        results.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(results.schema).parquet(path)

    def abort(self, message: str) -> None:
        self.logger.critical(message, exc_info=True)
