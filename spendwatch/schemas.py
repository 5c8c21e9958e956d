"""Explicit schemas for every table the library reads or writes."""

from pyspark.sql import types as T

# Nine decimals each, so a product of quantity and price keeps all digits.
MONEY = T.DecimalType(20, 9)

USAGE = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("usage_date", T.DateType()),
    T.StructField("usage_start_time", T.TimestampType()),
    T.StructField("usage_metadata", T.StructType([T.StructField("cluster_id", T.StringType())])),
    T.StructField("sku_name", T.StringType()),
    T.StructField("billing_origin_product", T.StringType()),
    T.StructField("usage_quantity", MONEY),
])

EXECUTOR = T.StructType([T.StructField("node_id", T.StringType())])

INVENTORY = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("snapshot_ts", T.TimestampType()),
    T.StructField("cluster_id", T.StringType()),
    T.StructField("cluster_name", T.StringType()),
    T.StructField("creator_user_name", T.StringType()),
    T.StructField("node_type_id", T.StringType()),
    T.StructField("driver_node_type_id", T.StringType()),
    T.StructField("spark_version", T.StringType()),
    T.StructField("runtime_engine", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("cluster_source", T.StringType()),
    T.StructField("num_workers", T.IntegerType()),
    T.StructField("executors", T.ArrayType(EXECUTOR)),
    T.StructField("autoscale", T.StructType([T.StructField("min_workers", T.IntegerType())])),
])

EXCLUSION_RULES = T.StructType([
    T.StructField("rule_order", T.IntegerType()),
    T.StructField("rule_type", T.StringType()),  # id | name_glob | creator
    T.StructField("pattern", T.StringType()),
])

FLEET_ALIASES = T.StructType([
    T.StructField("alias", T.StringType()),
    T.StructField("base_family", T.StringType()),
])

SEND_LOG = T.StructType([
    T.StructField("sent_at", T.TimestampType()),
    T.StructField("workspace_id", T.LongType()),
    T.StructField("cluster_id", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("recipient", T.StringType()),
    T.StructField("routing", T.StringType()),
    T.StructField("message_ts", T.StringType()),
])

DIRECTORY = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("user_id", T.StringType()),
])

PRICING_RATES = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("cloud", T.StringType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("workload", T.StringType()),
    T.StructField("photon", T.BooleanType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("dbu_per_hour", T.DoubleType()),
    T.StructField("dollars_per_dbu", T.DoubleType()),
    T.StructField("dollars_per_hour", T.DoubleType()),
    T.StructField("refreshed_at", T.TimestampType()),
])

WORKSPACE_BASELINE = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("computed_at", T.TimestampType()),
    T.StructField("lookback_days", T.IntegerType()),
    T.StructField("n_cluster_days", T.LongType()),
    T.StructField("mean_daily_dollars", T.DoubleType()),
    T.StructField("stddev_daily_dollars", T.DoubleType()),
    T.StructField("p50_daily_dollars", T.DoubleType()),
    T.StructField("p90_daily_dollars", T.DoubleType()),
    T.StructField("p95_daily_dollars", T.DoubleType()),
    T.StructField("p99_daily_dollars", T.DoubleType()),
    T.StructField("max_daily_dollars", T.DoubleType()),
    T.StructField("mean_log_daily_dollars", T.DoubleType()),
    T.StructField("stddev_log_daily_dollars", T.DoubleType()),
])

CLUSTER_SCORES = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("snapshot_ts", T.TimestampType()),
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("cluster_id", T.StringType()),
    T.StructField("cluster_name", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("cluster_source", T.StringType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("driver_node_type", T.StringType()),
    T.StructField("num_workers", T.IntegerType()),
    T.StructField("photon", T.BooleanType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("dbu_per_hour", T.DoubleType()),
    T.StructField("dollars_per_hour", T.DoubleType()),
    T.StructField("projected_daily_dollars", T.DoubleType()),
    T.StructField("baseline_mean", T.DoubleType()),
    T.StructField("baseline_stddev", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("signal", T.StringType()),
    T.StructField("reason", T.StringType()),
])

ALERT_COLUMNS = [
    "workspace_id", "snapshot_ts", "cluster_id", "cluster_name", "creator", "node_type",
    "num_workers", "photon", "sku_name", "dbu_per_hour", "dollars_per_hour",
    "projected_daily_dollars", "z_score", "signal", "reason",
]

# Moments of a day's positive cluster-day totals, raw and in log space.
DAY_MOMENTS = T.StructType([
    T.StructField("workspace_id", T.LongType()),
    T.StructField("usage_date", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("raw_sum", T.DecimalType(38, 12)),
    *[T.StructField(c, T.DoubleType()) for c in ("raw_mean", "raw_m2", "log_mean", "log_m2")],
])
