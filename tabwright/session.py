"""Session settings that suit wide tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods above 8,000 bytes of bytecode. A fused stage over sixty
# columns is larger than that and would run interpreted. With this limit Spark plans such a
# stage unfused, as many small methods, which is several times faster.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
DEFAULT_LIMIT, JIT_LIMIT = "65535", "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings where the session still has Spark's defaults."""
    if spark.conf.get(HUGE_METHOD, DEFAULT_LIMIT) == DEFAULT_LIMIT:
        spark.conf.set(HUGE_METHOD, JIT_LIMIT)
    return spark
