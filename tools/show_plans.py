"""Print the physical plans of registered queries (``explain('simple')``).

    python tools/show_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mobility.plans.registry import BY_NAME  # noqa: E402
from mobility.session import local_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session("plans")
    for name in args:
        print(f"### {name}\n\n```")
        BY_NAME[name].build(spark, sf_dir).explain("simple")
        print("```\n")


if __name__ == "__main__":
    main()
