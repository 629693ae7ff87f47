"""Command line: the weekly refresh over collected CSV files, and the
questions over a published star.

  python -m pitchstar refresh --collected DIR --root DIR [--name league] [--as-of DATE]
  python -m pitchstar ask --root DIR [--name league] top_scorers SEASON COMPETITION [N]

``--root`` is the shared folder that holds the version store ``<name>``
(see ``sources.versions``). On a cluster, launch with spark-submit
so the master and spark.checkpoint.dir come from the cluster config.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from .plans import questions as K
from .plans.publish import RAW_TABLES, refresh
from .session import get_session
from .sources.raw import path_exists, read_raw, rejects
from .sources.versions import Versions

QUESTIONS = {
    "top_scorers": (K.top_scorers, [str, str, int]),
    "league_table": (K.league_table, [str, str]),
    "team_results": (K.team_results, [str, str, str]),
    "most_goals": (K.most_goals, [str, int]),
    "team_record": (K.team_record, [str, str]),
    "upcoming": (K.upcoming, [str]),
    "highest_scoring": (K.highest_scoring, [int]),
    "division_results": (K.division_results, [str]),
    "card_count": (K.card_count, [str, str]),
    "team_journey": (K.team_journey, [str]),
    "goal_share": (K.goal_share, [str]),
}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pitchstar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--collected", required=True, help="folder with matches/, match_events/, standings/ CSV")
    r.add_argument("--root", required=True)
    r.add_argument("--name", default="league")
    r.add_argument("--as-of", default=None, help="date for the future-results check (default today)")
    q = sub.add_parser("ask")
    q.add_argument("--root", required=True)
    q.add_argument("--name", default="league")
    q.add_argument("question", choices=sorted(QUESTIONS))
    q.add_argument("args", nargs="*")
    a = ap.parse_args(argv)

    spark = get_session()
    store = Versions(spark, f"{a.root}/{a.name}")
    if a.cmd == "refresh":
        batches = {t: read_raw(spark, f"{a.collected}/{t}", t, sequence=True) for t in RAW_TABLES
                   if path_exists(spark, f"{a.collected}/{t}")}
        stamp = dt.datetime.now().strftime("%Y%m%d_%H%M")
        published, summary, diff = refresh(store, batches, stamp, a.as_of)
        for t in batches:
            rejects(spark, f"{a.collected}/{t}", t).groupBy("column_name").count().show(truncate=False)
        summary.filter("failures > 0").orderBy("severity", "model", "column_name").show(200, False)
        diff.show(truncate=False)
        print("published" if published else "NOT published: error checks failed")
        return 0 if published else 1
    fn, types = QUESTIONS[a.question]
    star = store.tables()
    vals = [t(v) for t, v in zip(types, a.args)]
    fn(star, *vals).show(100, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
