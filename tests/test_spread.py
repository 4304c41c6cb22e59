"""Work is dealt out over tasks where few bytes or few row groups hide it, and a draw is made once."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from dragoman.functions.plan import spread
from dragoman.operators import planning
from dragoman.plans import queries_analysis, views

COUNTS = "class_id int, label string"


def tasks_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_ids_of_one_file_are_spread_after_a_distinct(spark):
    ids = spark.range(2000).coalesce(1).select(F.col("id").alias("request_id")).union(spark.range(5).select("id")).distinct()
    assert tasks_of(ids) == 1 and tasks_of(spread(ids, "request_id")) > 8
    assert sorted(r[0] for r in spread(ids, "request_id").collect()) == list(range(2000))
    null = spark.createDataFrame([(None,), (1,), (1,)], "request_id long")
    assert sorted((r[0] or 0) for r in spread(null, "request_id").collect()) == [0, 1, 1]


def test_requests_are_sampled_by_many_tasks(spark, tmp_path):
    pq.write_table(pa.table({"conv_id": list(range(500)) * 2, "turn": [1] * 500 + [2] * 500}), tmp_path / "conversations.parquet")
    classes = spark.createDataFrame([(k, f"c{k}") for k in range(1, 9)], COUNTS)
    picked = queries_analysis.sampled(spark, str(tmp_path), classes)
    assert tasks_of(picked) > 8 and picked.count() == 500 * 6


def test_views_over_events_of_one_row_group_use_many_tasks(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").toArrow()
    big = pa.concat_tables([events] * 20)
    big = big.set_column(big.schema.get_field_index("event_id"), "event_id", pa.array(range(len(big)), pa.int64()))
    pq.write_table(big, tmp_path / "events.parquet", row_group_size=len(big))
    assert tasks_of(spark.read.parquet(f"{tmp_path}/events.parquet").select("event_id")) == 1
    lines = views.example_lines(spark, str(tmp_path))
    assert tasks_of(lines) > 8 and lines.count() == len(big)


def test_a_slot_draws_once(spark):
    allocated = spark.createDataFrame([(7, 1, 3, "c3", 2)], "request_id long, place int, class_id int, label string, quantity long")
    slots = planning.plan_slots(allocated)
    assert slots._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    key = F.concat_ws(":", F.col("request_id").cast("string"), F.col("class_id").cast("string"), F.col("slot").cast("string"))
    iso, resource = planning.sample_language(F.col("class_id"), key)
    assert slots.count() == 2 and slots.filter((iso != F.col("language_iso")) | (resource != F.col("resource_class"))).count() == 0
