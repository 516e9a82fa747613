from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8") -> SparkSession:
    """A plain session: the library must not lean on settings of its own."""
    spark = SparkSession.builder.master(f"local[{cores}]").appName("tests") \
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false") \
        .config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
