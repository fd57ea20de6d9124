"""Command line of the three programs, for ``spark-submit`` or ``python -m``."""

from __future__ import annotations

import argparse
import datetime as dt

from tallywatch.plans.grains import GRAINS, Maps, run_grain
from tallywatch.session import build_session
from tallywatch.sources.maps import read_zip_fix, read_zip_state
from tallywatch.sources.postings import read_postings


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--grain", choices=sorted(GRAINS), required=True)
    args.add_argument("--postings", required=True, help="Parquet folder of raw postings")
    args.add_argument("--ledger", required=True, help="folder of the history ledger")
    args.add_argument("--batch-id", required=True, help="the same id twice counts once")
    args.add_argument("--seen", help="folder of the posting keys counted so far; a posting then counts once over all batches")
    args.add_argument("--counters", action="store_true", help="print gaps and repairs of this batch")
    args.add_argument("--out", required=True, help="folder for the result files")
    args.add_argument("--zip-fix", help="short postal codes, CSV or Parquet (state grain)")
    args.add_argument("--zip-state", help="state of each postal code, CSV or Parquet (state grain)")
    args.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    given = args.parse_args(argv)
    if given.grain == "state" and not (given.zip_fix and given.zip_state):
        args.error("the state grain needs --zip-fix and --zip-state")

    spark = build_session(f"tallywatch-{given.grain}")
    maps = Maps(
        read_zip_fix(spark, given.zip_fix) if given.zip_fix else None,
        read_zip_state(spark, given.zip_state) if given.zip_state else None,
    )
    run = run_grain(spark, given.grain, read_postings(spark, given.postings), given.ledger, given.batch_id,
                    given.out, given.run_date, maps, seen_path=given.seen,
                    with_counters=given.counters)
    run.summary.show(truncate=False)
    for part, counts in run.counters.items():
        print(f"{part}: " + ", ".join(f"{name} {n}" for name, n in counts.items()))
    print(f"alerts of the latest day: {run.today_path or 'none'}")


if __name__ == "__main__":
    main()
