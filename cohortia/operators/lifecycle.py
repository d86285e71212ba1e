"""Weekly user lifecycle: new / retained / gone (C14).

One aggregation keyed by user keeps the sorted set of active Mondays (bounded
by the number of weeks in the data); comparing each week with its neighbours
in that list decides its status (O(weeks) per user) and a partial aggregation
counts users per (week, status).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.timefn import as_date, date_lit, monday


def user_lifecycle_weekly(activity: DataFrame, as_of, strict_new: bool = False,
                          approx_rsd: float | None = None) -> DataFrame:
    """(this_week, previous_week, num_users, status).

    For every user and active week w: ``retained`` if w−7 is active, else
    ``new`` (the reference's rule, quirk D8).  With ``strict_new`` a user whose
    first week is earlier than w−7 is ``resurrected`` and only a first week is
    ``new``.  For every active week w whose next week is not active: a ``gone``
    row (w+7, w) counted negative, except when w+7 is the Monday after
    ``as_of``'s week (that week has not happened yet).

    Counts are exact (each user contributes one row per week and status); with
    ``approx_rsd`` they use HyperLogLog++ (``approx_count_distinct``), the
    analogue of the reference's approximate ``uniq`` (A7).
    """
    weeks = (activity.groupBy("user_id")
             .agg(F.array_sort(F.collect_set(monday("time"))).alias("weeks")))
    next_monday = F.date_add(F.trunc(date_lit(as_date(as_of)), "week"), 7)

    # neighbours in the sorted week list decide every status in O(weeks) per user
    n = F.size("weeks")
    per_week = F.transform("weeks", lambda w, i: F.struct(
        w.alias("week"),
        F.when(i > 0, F.element_at("weeks", i)).alias("prev"),          # element_at is 1-based
        F.when(i < n - 1, F.element_at("weeks", i + 2)).alias("next"),
        (i == 0).alias("first")))
    cur = weeks.select("user_id", F.explode(per_week).alias("x")).select("user_id", "x.*")
    was_active = F.coalesce(F.col("prev") == F.date_sub("week", 7), F.lit(False))
    if strict_new:
        status = (F.when(was_active, F.lit("retained"))
                  .when(F.col("first"), F.lit("new"))
                  .otherwise(F.lit("resurrected")))
    else:
        status = F.when(was_active, F.lit("retained")).otherwise(F.lit("new"))
    stay = cur.select("user_id", F.col("week").alias("this_week"),
                      F.date_sub("week", 7).alias("previous_week"), status.alias("status"))
    stays_next = F.coalesce(F.col("next") == F.date_add("week", 7), F.lit(False))
    gone = (cur.where(~stays_next)
            .select("user_id", F.date_add("week", 7).alias("this_week"),
                    F.col("week").alias("previous_week"), F.lit("gone").alias("status"))
            .where(F.col("this_week") != next_monday))

    n = (F.approx_count_distinct("user_id", approx_rsd) if approx_rsd is not None
         else F.count(F.lit(1)))
    counts = (stay.unionByName(gone)
              .groupBy("this_week", "previous_week", "status")
              .agg(n.alias("n")))
    return counts.select("this_week", "previous_week",
                         F.when(F.col("status") == "gone", -F.col("n")).otherwise(F.col("n"))
                          .alias("num_users"),
                         "status")
