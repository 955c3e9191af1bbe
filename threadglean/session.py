"""Session settings and the checkpoint folder."""

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed partition also where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_spark(app_name="threadglean", master=None, **conf):
    """A session with the library's settings; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def apply_settings(spark):
    """Put the run-time settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _machine_local(path):
    """Whether a path without a store lies in this machine's temporary folder."""
    scheme, _, rest = path.rpartition("file:")
    plain = rest if scheme == "" else path
    return "://" not in plain.lstrip("/") and ("/" + plain.lstrip("/")).startswith(
        os.path.join(tempfile.gettempdir(), ""))


def checkpoint_folder(spark):
    """The cluster's checkpoint folder; a temporary one only for a local session.

    `spark.checkpoint.dir` names a folder all executors share. Without it a
    cluster run is refused, since a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            if not sc.master.startswith("local") and _machine_local(configured):
                raise RuntimeError(f"{configured} is one machine's own temporary folder")
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="threadglean-ckpt-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return sc.getCheckpointDir()


def share_package(spark):
    """Let Python workers find this package where the driver found it, unless a cluster
    has it installed anyway."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


# Bytes of a batch that a Python worker gets at once, texts being long; Spark's own default.
BATCH_BYTES = 4 * 1024 * 1024
_DEFAULT_BATCH = "67108864b"


def prepare_workers(spark):
    """Let Python workers find this package and get batches of bounded bytes, unless the
    session has set a bound of its own."""
    share_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _DEFAULT_BATCH:
        spark.conf.set(key, str(BATCH_BYTES))
