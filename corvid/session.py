"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "corvid",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on and the UI off; used by tests, bench and scripts."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corvid`` importable in Python workers (pandas UDFs, mapInPandas).

    Executors do not share the driver's ``sys.path``; the package is zipped
    once per application and added with ``addPyFile``, which Spark distributes
    to every executor.
    """
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="corvid-py-"), "corvid.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("corvid", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, as executors share no local folder: without it
    this raises. Only a single-machine session (``local[...]``, as in tests)
    gets a folder of its own, registered as the context's checkpoint directory.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corvid-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared scratch root."""
    return f"{scratch_root(spark)}/corvid/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: one
    computation for several consumers, nothing lost with an executor."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
