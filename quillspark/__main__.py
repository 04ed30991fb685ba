"""``python -m quillspark SETTINGS.json``: run the job that a settings file describes and print its scores."""

from __future__ import annotations

import sys

from quillspark.plans.settings import run_settings
from quillspark.session import build_session


def main(args: list[str]) -> int:
    if len(args) != 1:
        print(__doc__, file=sys.stderr)
        return 2
    spark = build_session()
    result = run_settings(spark, args[0])
    if result.scores is not None:
        for row in result.scores.orderBy("split", "metric").collect():  # 18 numbers a split
            print(f"{row['split']} {row['metric']}: {row['value']}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
