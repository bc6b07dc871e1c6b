"""Session, test-table loading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "beaconry") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Tables:
    """Lazy ``t.orders`` access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._latest: dict[tuple[str, str], datetime] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def latest(self, table: str, column: str) -> datetime:
        """Newest timestamp of a table's column: the default ``as_of``, read once."""
        if (table, column) not in self._latest:
            self._latest[table, column] = latest(getattr(self, table), column)
        return self._latest[table, column]


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A cluster must name one. Only a one-machine session (``local[...]``, as in
    tests) that names none gets a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="beaconry-"))
    return (configured or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared root."""
    return f"{shared_root(spark)}/beaconry/{label}-{uuid.uuid4().hex}"


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Inline relation of a few fixed rows (planned as local data, size known).

    Each value goes in as a named parameter marker, so no quoting is involved.
    """
    args, lines = {}, []
    for i, row in enumerate(rows):
        args.update({f"v{i}_{j}": v for j, v in enumerate(row)})
        lines.append("(" + ", ".join(f":v{i}_{j}" for j in range(len(row))) + ")")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t({columns})", args=args)


def latest(df: DataFrame, column: str) -> datetime:
    """Newest timestamp in ``column``: the default ``as_of`` (one row read)."""
    return df.agg(F.max(column).alias("m")).first()["m"]


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named columns, for reports whose float sums vary in order."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})
