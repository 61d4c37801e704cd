"""Registered query: streaming intake (L1-L3) of the events table."""

from growlytics.session import shared_path
from growlytics.streaming import intake
from growlytics.plans.registry import register


@register("l2_ingest", sql="""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time
FROM events
""")
def l2_ingest(ctx):
    """The events table is written as JSON payloads to a fresh landing
    folder, drained by the streaming intake into a parquet sink (exactly
    once), and the sink is read back."""
    spark = ctx.spark
    landing = shared_path(spark, "landing")
    sink = shared_path(spark, "sink")
    ckpt = shared_path(spark, "stream-checkpoint")
    intake.write_payloads(ctx.binding.events, landing)
    intake.run_available(spark, landing, sink, ckpt)
    return intake.read_sink(spark, sink).drop("ingested_at")

