"""Job parameters and the folder layout of the warehouse."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from fairlead.schemas import DIRECTIONS

# Session settings a job profits from; the models are right without them.
SESSION_SETTINGS = {
    # Tasks that write few partitions keep a file open for each instead of sorting first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@dataclass(frozen=True)
class JobConfig:
    """Parameters of one batch run; every root may be any URI Spark can resolve.

    ``file_years`` limits which year files are converted, ``first_year`` and
    ``last_year`` bound (inclusively) the rows the models keep. A run refuses to build without a file of
    every year, direction and code table unless ``allow_missing``. ``force`` converts files again
    that are converted already; without it, ``revised`` does so for those that changed since.
    """

    landing_root: str
    warehouse_root: str
    first_year: int = 2020
    last_year: int = 2024
    directions: tuple[str, ...] = DIRECTIONS
    file_years: tuple[int, ...] | None = None
    code_tables: bool = True
    force: bool = True
    revised: bool = False
    fail_fast: bool = True
    allow_missing: bool = False
    layout: "Layout" = field(init=False)

    def __post_init__(self) -> None:
        unknown = set(self.directions) - set(DIRECTIONS)
        if unknown:
            raise ValueError(f"unknown directions {sorted(unknown)}; expected some of {DIRECTIONS}")
        if self.first_year > self.last_year:
            raise ValueError(f"empty year window {self.first_year}..{self.last_year}")
        object.__setattr__(self, "layout", Layout(self.warehouse_root))


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one warehouse root."""

    root: str

    def raw(self, direction: str) -> str:
        return f"{self.root}/raw/{direction.lower()}"

    def code_table(self, name: str) -> str:
        return f"{self.root}/raw/aux/{name}"

    def core(self, name: str) -> str:
        return f"{self.root}/core/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def ledger(self) -> str:
        return f"{self.root}/raw/ledger"

    def snapshots(self) -> str:
        return f"{self.root}/published"

    def report(self, layer: str) -> str:
        return f"{self.root}/quality/{layer}"


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its scratch tables: below ``spark.checkpoint.dir``, for all executors.

    Only a local session may go without that setting; it gets a temporary folder
    that goes when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="fairlead-")
        # Executors of a local session are its driver; one folder serves the whole session.
        spark.conf.set("spark.checkpoint.dir", shared)
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/fairlead/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach; see ``sinks.release_scratch``."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
