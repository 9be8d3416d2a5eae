"""Run queries in a plain session like the driver's: no checkpoint dir, a
non-UTC time zone, no settings of ours.  ``python tests/driver_session_check.py [names...]``"""

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from oracle_compare import compare, duck_connection  # noqa: E402


def main(names):
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "America/Sao_Paulo").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    assert e.entry(spark).count() > 0
    sf = "/root/testdata/sf0.01"
    con = duck_connection(sf)
    failed = [msg for n in (names or sorted(e.oracle_sql()))
              for ok, msg in [compare(spark, n, sf, e.queries()[n], e.oracle_sql()[n], con)] if not ok]
    print("\n".join(failed) or "all ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
