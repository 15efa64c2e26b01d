"""Session settings and the shared scratch folder.

The library never sets cluster-wide settings behind the caller's back: it
only fills in defaults that are unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are written for.  AQE re-plans joins from measured sizes
# (a broadcast only happens below the threshold, sort-merge beyond it), splits
# skewed shuffle partitions, and coalesces tiny ones.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(master: str | None = None, app_name: str = "entryflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above.

    ``master`` is only used when given (on a cluster the launcher sets it).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set those of ``SCALE_DEFAULTS`` that nobody has set.

    A setting given when the session was built (or by the launcher) is kept;
    a value that is only Spark's own default is replaced.  The plans depend
    on these values for speed, not for results; the time zone is the
    exception, and a zone that somebody set is kept like the rest.
    """
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in SCALE_DEFAULTS.items():
        if k not in given:
            try:
                spark.conf.set(k, v)
            except Exception:  # static or locked settings stay as they are
                pass
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` of the session.  Where it is unset, a
    local master gets a private folder; a cluster, whose executors do not
    share local folders, gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        path = tempfile.mkdtemp(prefix="entryflow-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        _LOCAL_SCRATCH[app] = path
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the scratch root; ``unique`` adds a fresh run folder."""
    pieces = [scratch_root(spark), "entryflow", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    # plain "/" joins keep URIs such as hdfs:// or s3a:// intact
    return "/".join([pieces[0].rstrip("/")] + [p.strip("/") for p in pieces[1:]])
