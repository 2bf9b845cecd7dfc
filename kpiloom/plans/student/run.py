"""Nightly job: build, write and assemble every team table.

    python -m kpiloom.plans.student.run --root <parquet warehouse> \
        --sink <folder> [--as-of YYYY-MM-DD]

``--root`` holds one Parquet folder per logical table (``contact_template``,
``contact_at_template``, ``class_template``, …).  ``--sink`` is a fixed folder
on shared storage: readers find the tables there, and the next run the monthly
snapshot.  ``--as-of``
replaces the reference's ``CURRENT_DATE()`` and defaults to today.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt

from pyspark.sql import SparkSession

from kpiloom.plans.student.params import StudentParams
from kpiloom.plans.student.teams import student_nightly_job
from kpiloom.session import DEFAULT_CONF, cluster_conf
from kpiloom.sources.catalog import ParquetCatalog


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--root", required=True)
    ap.add_argument("--sink", required=True)
    ap.add_argument("--as-of")
    ap.add_argument("--shuffle-gb", type=float, help="largest exchange expected; sizes partitions with --cores")
    ap.add_argument("--cores", type=int, default=0, help="cores of the cluster")
    ap.add_argument("--support-grain", choices=["site", "cohort"], default="site")
    args = ap.parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName("kpiloom-nightly")
        sized = cluster_conf(int(args.shuffle_gb * (1 << 30)), 1, args.cores) if args.shuffle_gb else {}
        for k, v in {**DEFAULT_CONF, **sized}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    params = dataclasses.replace(StudentParams(), as_of=as_of, support_grain=args.support_grain)
    student_nightly_job(ParquetCatalog(spark, args.root, suffix=""), params, args.sink)
    return args.sink


if __name__ == "__main__":
    print(main())
