"""Log volume over time."""

from __future__ import annotations

from datetime import timedelta

from logframe import bytes_over_time, count_over_time, rate
from workload.registry import query
from workload.relations import ev_logs
from workload.scans import ev_sql

HOUR = 3_600_000_000_000


def _steps(start: str, end: str, step_ns: int) -> str:
    """The instants of the grid, in nanoseconds."""
    first, last = (f"epoch_us(TIMESTAMP '{t}') * 1000" for t in (start, end))
    return f"SELECT {first} + i * {step_ns} AS t FROM range(0, ({last} - {first}) // {step_ns} + 1) g(i)"


@query(
    "count_over_time",
    ev_sql(f"""
    , grid AS ({_steps('2024-01-05', '2024-01-20', 6 * HOUR)}),
    picked AS (SELECT labels_key, ts_ns FROM ev_logs WHERE job = 'api'
      AND ts_ns > (SELECT min(t) FROM grid) - {25 * HOUR} AND ts_ns <= (SELECT max(t) FROM grid))
    SELECT t AS ts_ns, k.labels_key, count(p.ts_ns) AS value
    FROM grid CROSS JOIN (SELECT DISTINCT labels_key FROM picked) k
    LEFT JOIN picked p ON p.labels_key = k.labels_key AND p.ts_ns > t - {25 * HOUR} AND p.ts_ns <= t
    GROUP BY t, k.labels_key
    """),
)
def counted(spark, sf_dir):
    """Entries of the last 25 hours, every 6 hours, per label set."""
    found = count_over_time(
        ev_logs(spark, sf_dir), [("job", "=", "api")],
        step=timedelta(hours=6), range=timedelta(hours=25), start="2024-01-05", end="2024-01-20",
    )
    return found.select("ts_ns", "labels_key", "value")


@query(
    "rate_by_label",
    ev_sql(f"""
    , grid AS ({_steps('2024-01-10', '2024-01-12', 2 * HOUR)}),
    picked AS (SELECT level, ts_ns FROM ev_logs WHERE job <> '' AND line LIKE '%user=1%'),
    known AS (SELECT DISTINCT level FROM picked WHERE ts_ns > (SELECT min(t) FROM grid) - {HOUR} AND ts_ns <= (SELECT max(t) FROM grid)
      AND EXISTS (SELECT 1 FROM grid WHERE ts_ns > t - {HOUR} AND ts_ns <= t))
    SELECT t AS ts_ns, k.level, count(p.ts_ns) / 3600.0::DOUBLE AS value
    FROM grid CROSS JOIN known k LEFT JOIN picked p ON p.level = k.level AND p.ts_ns > t - {HOUR} AND p.ts_ns <= t
    GROUP BY t, k.level
    """),
)
def rates(spark, sf_dir):
    """Entries a second per level, over the last hour of every second hour: the range is below the step."""
    found = rate(
        ev_logs(spark, sf_dir), '{job=~".+"} |= "user=1"',
        step=timedelta(hours=2), range=timedelta(hours=1), by=["level"], start="2024-01-10", end="2024-01-12",
    )
    return found.select("ts_ns", "level", "value")


@query(
    "bytes_over_time",
    ev_sql(f"""
    , grid AS ({_steps('2024-01-05', '2024-01-06', HOUR)})
    SELECT t AS ts_ns, job, pod, CAST(sum(strlen(line)) AS BIGINT) AS value
    FROM grid JOIN ev_logs ON level <> 'info' AND ts_ns > t - {3 * HOUR} AND ts_ns <= t
    GROUP BY t, job, pod
    """),
)
def volumes(spark, sf_dir):
    """Bytes per job and pod over three hours, only where there are any."""
    found = bytes_over_time(
        ev_logs(spark, sf_dir), [("level", "=~", ".+"), ("level", "!=", "info")],
        step=timedelta(hours=1), range=timedelta(hours=3), by=["job", "pod"], start="2024-01-05", end="2024-01-06", fill=False,
    )
    return found.select("ts_ns", "job", "pod", "value")
