"""Session builder with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning does the size-dependent work: it coalesces small shuffle
# partitions, splits the ones a hot key makes too large, and turns a join into a
# broadcast only after the shuffle has measured the side as small.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
}


def build_session(
    app_name: str = "chartlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session.

    ``shuffle_partitions`` is the number adaptive execution starts from, so on a
    cluster it should be a few times the core count; it is coalesced downwards at
    run time and never needs to be small. ``conf`` wins over every default here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
