"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession


def session(app: str = "postings", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the jobs rely on.

    Days are UTC days, so the session zone is UTC. Adaptive execution sizes the
    reduce side from a generous first partition count, splits skewed joins and
    rebalanced writes, and turns joins with a small measured side into
    broadcasts. Plans here have hundreds of column expressions, so call sites are
    not recorded for each. Aggregates that hold a set per group stay hashed up to
    16384 groups per task (some tens of megabytes) before they sort. Whatever the cluster configures (checkpoint folder, memory,
    shuffle partitions) stays as it is unless given in ``settings``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **settings,
    }
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
