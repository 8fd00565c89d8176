"""A source feed and a serving copy of it with the usual faults, the same text for both engines.

The copy lacks the last two days and the errors it refused, carries purchases with a fee of one,
lost the user of cheap sign-ups, and holds refunds the source knows nothing about.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .registry import table

SOURCE = """
SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(12, 2)) AS amount, props FROM {events}
"""

TARGET = """
SELECT event_id, ts,
       CASE WHEN event_type = 'signup' AND amount < 5 THEN NULL ELSE user_id END AS user_id,
       event_type,
       CAST(CASE WHEN event_type = 'purchase' THEN amount + 1 ELSE amount END AS DECIMAL(12, 2)) AS amount
FROM {src}
WHERE CAST(ts AS DATE) < DATE '2024-01-29' AND NOT (event_type = 'error' AND amount > 30)
UNION ALL
SELECT -1 - event_id AS event_id, ts, user_id, event_type, amount FROM {src}
WHERE event_type = 'purchase' AND amount > 60
"""

# Lines as an order system keeps them: returned lines are gone, quantities are the largest seen.
LINES = """
SELECT l_orderkey, l_linenumber, max(l_shipdate) AS shipped, max(l_quantity) AS quantity
FROM {lineitem} WHERE l_returnflag <> 'R' GROUP BY l_orderkey, l_linenumber
"""

AS_OF = datetime(2024, 1, 15, 12)

CTES = f"WITH src AS ({SOURCE.format(events='events')}), tgt AS ({TARGET.format(src='src')})"


def source(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SOURCE, events=table(spark, sf, "events"))


def target(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(TARGET, src=source(spark, sf))


def served_lines(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LINES, lineitem=table(spark, sf, "lineitem"))
