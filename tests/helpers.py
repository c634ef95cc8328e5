"""Small inputs for the tests."""

LOG_COLUMNS = "log_id string, time bigint, topic string, source string, reserved string, " \
    "contents array<struct<key:string,value:string>>, shard int"
GROUP_COLUMNS = "topic string, source string, reserved string, " \
    "logs array<struct<time:bigint,contents:array<struct<key:string,value:string>>>>, shard int"


def logs_frame(spark, rows):
    """Rows of (log_id, time, topic, source, [(key, value), ...]) in shard 0."""
    from logloom.functions.times import utc_date
    from pyspark.sql import functions as F

    data = [(i, t, topic, source, None, contents, 0) for i, t, topic, source, contents in rows]
    return spark.createDataFrame(data, LOG_COLUMNS).withColumn("date", utc_date(F.col("time")))


def groups_frame(spark, rows):
    """Rows of (topic, source, reserved, [(time, [(key, value), ...]), ...]) in shard 0."""
    return spark.createDataFrame([(*r, 0) for r in rows], GROUP_COLUMNS)


def tuples(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


