"""The nightly job: refresh customers.total_bookings and write every view for ``as_of``.

Views are written to ``{out}/{view}/as_of=YYYY-MM-DD`` (overwrite of that date only, so a
re-run of the same night is idempotent and earlier nights stay readable).  The customers table is
published: the next night's refresh starts from it.  The writes are
independent jobs and are submitted together; each one's row count is gathered by an
``Observation`` while it writes.

    python -m slotwise.plans.nightly --tables <root> --out <root> --as-of 2025-07-09
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Observation
from pyspark.sql import functions as F

from slotwise.operators import refresh
from slotwise.plans.views import VIEW_BUILDERS
from slotwise.sources.sinks import write_table

log = logging.getLogger(__name__)


def run_nightly(t, as_of: dt.date, out: str, workers: int = 4) -> dict:
    start = time.monotonic()
    stamp = as_of.isoformat()

    def write_view(name: str) -> tuple[str, int]:
        obs = Observation(name)
        df = VIEW_BUILDERS[name](t, as_of).observe(obs, F.count(F.lit(1)).alias("rows"))
        write_table(df, f"{out}/{name}/as_of={stamp}")
        return name, obs.get["rows"]

    with ThreadPoolExecutor(max_workers=workers) as pool:
        counts = dict(pool.map(write_view, list(VIEW_BUILDERS)))
    ref = refresh.publish_refresh(t, out, as_of)
    result = {"as_of": stamp, "views": counts, "refresh": ref,
              "duration_ms": int((time.monotonic() - start) * 1000)}
    log.info("Nightly refresh complete: %s", result)
    return result


def data_calendar(t, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Whole years around everything booked, with a year before for early reminders."""
    least, most = F.least("scheduled_at", "created_at"), F.greatest("scheduled_at", "created_at")
    first, last = t.appointments.agg(F.year(F.min(least)), F.year(F.max(most))).first()
    years = [y for y in (first, last, as_of.year) if y is not None]
    return dt.date(min(years) - 1, 1, 1), dt.date(max(years) + 1, 12, 31)


def main(argv: list[str] | None = None) -> None:
    from slotwise.session import get_session
    from slotwise.sources.tables import Tables

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--tables", required=True, help="root folder of the domain parquet tables")
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--input-bytes", type=int, default=0,
                   help="approximate input volume; sizes shuffle partitions and scan splits")
    p.add_argument("--cores", type=int, default=0, help="total executor cores (with --input-bytes)")
    p.add_argument("--cal-start", type=dt.date.fromisoformat, help="calendar range; by default it follows the bookings")
    p.add_argument("--cal-end", type=dt.date.fromisoformat)
    a = p.parse_args(argv)
    from slotwise.session import recommended_conf

    extra = recommended_conf(a.input_bytes, a.cores or 8) if a.input_bytes else None
    spark = get_session(extra=extra)
    t = Tables.from_parquet(spark, a.tables)
    start, end = data_calendar(t, a.as_of)
    t = t.with_calendar(a.cal_start or start, a.cal_end or end)
    if (a.cal_start or start) > dt.date(start.year + 1, 1, 1) or (a.cal_end or end) < dt.date(end.year - 1, 12, 31):
        log.warning("The calendar given does not cover all bookings (%s to %s)", start, end)
    print(run_nightly(t, a.as_of, a.out))


if __name__ == "__main__":
    main()
