"""Registered queries: RFM segmentation (H1-H3)."""

from growlytics.operators import segments
from growlytics.plans.oracle import RFM, r6
from growlytics.plans.registry import register


@register("h1_rfm", extra=RFM, sql=f"""
SELECT user_id, current_plan, recency, frequency, {r6('monetary')} AS monetary FROM rfm
""")
def h1_rfm(ctx):
    wh = ctx.wh
    return segments.rfm_features(wh.dim_users, wh.user_days, ctx.p)


@register("h2_segment", extra=RFM, sql=f"""
SELECT user_id, current_plan, recency, frequency, {r6('monetary')} AS monetary, segment FROM seg
""")
def h2_segment(ctx):
    wh = ctx.wh
    rfm = segments.rfm_features(wh.dim_users, wh.user_days, ctx.p)
    return segments.assign_segments(rfm, ctx.p)


@register("h3_summary", extra=RFM, sql=f"""
SELECT segment, count(user_id) AS user_count, {r6('avg(recency)')} AS avg_recency,
       {r6('avg(frequency)')} AS avg_frequency, {r6('avg(CAST(monetary AS DOUBLE))')} AS avg_monetary
FROM seg GROUP BY segment ORDER BY user_count DESC, segment
""")
def h3_summary(ctx):
    return segments.rfm_segments(ctx.wh, ctx.p)

