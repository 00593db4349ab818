"""The one session setting the cleaning jobs depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# Fixed value: HotSpot compiles no method with more bytecode than this.
HOTSPOT_LIMIT = "8000"
UNSET = "-1"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Spark drop whole-stage code that the JVM would only interpret.

    Cleaning dozens of columns at once makes one generated method far beyond what HotSpot
    compiles, and interpreting it takes about twice the time. With the limit at HotSpot's own,
    Spark generates such stages operator by operator, in methods that do get compiled. A
    limit the caller has set stays, be it Spark's own default.
    """
    if spark.conf.get(HUGE_METHOD_LIMIT, UNSET) == UNSET:
        spark.conf.set(HUGE_METHOD_LIMIT, HOTSPOT_LIMIT)
    return spark
