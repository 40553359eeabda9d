"""Session defaults. Only settings the caller left alone are filled in."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "mercato", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_STAGING: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or the checkpoint folder that the context was
    given. Only a local session without either gets a temporary folder; a cluster without a shared folder is an error,
    because executors would write to disks that others do not see."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = sc.applicationId
        if app not in _OWN_STAGING:
            _OWN_STAGING[app] = tempfile.mkdtemp(prefix="mercato-stage-")
        named = _OWN_STAGING[app]
    return named.rstrip("/")
