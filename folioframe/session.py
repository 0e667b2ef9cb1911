"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "folioframe") -> SparkSession:
    """A local session with adaptive execution, as tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        here = Path(__file__).resolve().parent
        where = Path(tempfile.mkdtemp(prefix="folioframe-code-")) / "folioframe.zip"
        with zipfile.ZipFile(where, "w") as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, Path("folioframe") / p.relative_to(here))
        context.addPyFile(str(where))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_run_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This run's own folder inside ``spark.checkpoint.dir``, deleted when the application ends.

    Where that setting is unset, only a local session gets a temporary folder of
    its own; on a cluster, whose machines don't share one, it is an error.
    """
    application = spark.sparkContext.applicationId
    if application not in _run_folders:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="folioframe-")
            spark.conf.set("spark.checkpoint.dir", folder)
        run = f"{folder.rstrip('/')}/folioframe-{application}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(run)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _run_folders[application] = run
    return _run_folders[application]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once into the shared folder and read them from there.

    Used where one result feeds several later jobs; a lost executor costs nothing,
    since the files are not tied to it.
    """
    spark = df.sparkSession
    where = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)
