"""Local session for tests and comparisons."""

from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tidewheel-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
