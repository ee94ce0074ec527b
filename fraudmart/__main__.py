r"""Command line: load the bank reference tables, then every pending day.

    python -m fraudmart --warehouse hdfs:///bank/dwh --incoming hdfs:///bank/in \
        [--seed hdfs:///bank/in/seed_dump.sql] [--mode observed] [--fact-buckets]

(on a cluster: ``spark-submit --py-files fraudmart.zip fraudmart/__main__.py ...``)

Days are the complete ``transactions_/terminals_/passport_blacklist_DDMMYYYY``
file sets under ``--incoming`` that the ingest ledger has not seen, oldest
first. A day's writes are idempotent (insert-new loads, per-day report
overwrite, new table versions) and its ledger rows are written last, so a rerun
after a failure redoes exactly the unfinished day.
"""

from __future__ import annotations

import argparse
import json

from fraudmart.operators.enrich import DOCUMENTED, OBSERVED
from fraudmart.plans.pipeline import bootstrap_dims, run_pending
from fraudmart.session import get_spark
from fraudmart.sources.tables import Warehouse


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="fraudmart", description=__doc__.splitlines()[0])
    ap.add_argument("--warehouse", required=True, help="root folder of the warehouse tables")
    ap.add_argument("--incoming", required=True, help="folder with the daily files")
    ap.add_argument("--seed", help="INSERT dump with the bank's cards, accounts and clients")
    ap.add_argument("--mode", choices=[DOCUMENTED, OBSERVED], default=DOCUMENTED)
    ap.add_argument("--archive", help="folder that loaded files are moved to, as <name>.backup")
    ap.add_argument("--fact-buckets", action="store_true",
                    help="keep the fact bucketed by trans_id (bucket count = shuffle partitions)")
    args = ap.parse_args(argv)

    spark = get_spark(app="fraudmart")
    wh = Warehouse(spark, args.warehouse, fact_buckets=args.fact_buckets or None)
    out: dict = {}
    if args.seed:
        out["dimensions"] = bootstrap_dims(spark, wh, args.seed, args.mode)
    out["days"] = [d.isoformat() for d in run_pending(spark, wh, args.incoming, args.mode, archive=args.archive)]
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
