"""Build, check and publish.

Flow: start a draft of the published version, merge the run's rows into the
parts of the raw tables that they touch, write the models whose raw tables
changed (downstream models read the stored upstream tables: lineage is cut at
each layer and a lost executor only recomputes one layer), run the checks over
the stored tables, and publish the draft, by renaming one pointer, only when no
error-severity check failed. See ``sources.versions``.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.upsert import batch_order
from ..schemas import RAW, UPSERT_KEYS
from ..session import release
from ..sources.raw import attach_table, create_database, diff_counts, materialize
from ..sources.versions import Draft, Versions
from .models import Star, counted_team_matches, fct_team_matches, repeated_ids, repeated_scores

log = logging.getLogger(__name__)

RAW_TABLES = ["standings", "matches", "match_events"]


# Storage layout of the facts: the columns the questions filter on, so
# those filters prune files (season filters arrive as a semi-join from
# dim_seasons, which dynamic partition pruning turns into a file filter).
PARTITIONING = {
    "fct_matches": ["season_id"],
    "fct_team_matches": ["season_id"],
    "fct_standings": ["season_id"],
    "fct_match_events": ["competition_name"],
}


class StoredStar(Star):
    """A Star whose every model is written to ``db`` when first needed and
    then read back from there."""

    def __init__(self, raw: dict[str, DataFrame], db: str,
                 partitioning: dict | None = None):
        super().__init__(raw)
        self.db = db
        self.partitioning = PARTITIONING if partitioning is None else partitioning

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._m:
            df = getattr(self, "_" + name)()
            self._m[name] = materialize(df, self.db, name, self.partitioning.get(name))
        return self._m[name]

    def counted(self, name: str) -> DataFrame:
        return self[name].withColumn("_n", F.lit(1).cast("bigint"))


# Models in dependency waves: every model reads only models of earlier waves.
WAVES = [
    ["stg_standings", "stg_matches", "stg_match_events"],
    ["int_matches", "dim_seasons", "dim_phases", "dim_teams", "dim_players"],
    ["int_team_matches", "fct_matches", "fct_team_matches", "fct_match_events", "fct_standings"],
]


def build_star_tables(raw: dict[str, DataFrame], db: str, threads: int = 4) -> StoredStar:
    """Write all 13 models to ``db``, wave by wave; the models of one wave
    are independent, so up to ``threads`` of their jobs run at once (Spark
    accepts jobs from several threads of one session), like a warehouse
    building independent models concurrently."""
    star = StoredStar(raw, db)
    for wave in WAVES:
        if threads <= 1:
            for name in wave:
                star[name]
            continue
        with ThreadPoolExecutor(max_workers=threads) as pool:
            list(pool.map(lambda n: star[n], wave))
    return star


#: Raw tables that a model is made from, directly or through other models.
READS = {
    "stg_standings": {"standings"}, "stg_matches": {"matches"}, "stg_match_events": {"match_events"},
    "int_matches": {"matches"}, "int_team_matches": {"matches"},
    "dim_seasons": {"standings", "matches"}, "dim_phases": {"standings"}, "dim_teams": {"standings"},
    "dim_players": {"match_events"},
    "fct_matches": {"standings", "matches"}, "fct_team_matches": {"standings", "matches"},
    "fct_match_events": {"standings", "matches", "match_events"}, "fct_standings": {"standings", "matches"},
}


class DraftStar(Star):
    """A Star in a version: models whose raw tables the run left alone keep the
    folder of the base version, the others are written to the run's own. Rows of
    fct_team_matches whose id repeats are written once, and the scores that they fan
    out to (D11) beside them; a table without repeated ids, as any that the checks
    let pass, is whole in its folder."""

    def __init__(self, draft: Draft):
        super().__init__({t: draft.table(t) for t in RAW_TABLES})
        self.draft = draft
        self.same = {t for t in RAW_TABLES if draft.unchanged(t)}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._m:
            if name in self.draft.entries and READS[name] <= self.same:
                self._m[name] = self.draft.table(name)
            elif name == "fct_team_matches":
                self._m[name] = self._write_team_matches(name)
            else:
                df = getattr(self, "_" + name)()
                self._m[name] = self.draft.write(name, df, PARTITIONING.get(name)).select(*df.columns)
        return self._m[name]

    def _write_team_matches(self, name: str) -> DataFrame:
        int_m = self["int_matches"]
        rows = fct_team_matches(int_m, self["dim_seasons"], self["dim_phases"], self["dim_teams"], fan_out=False)
        out, ids = self.draft.write(name, rows, PARTITIONING.get(name)), repeated_ids(int_m)
        if not ids.isEmpty():
            out = self.draft.fan_out(name, "match_id", ids, repeated_scores(int_m, ids))
        return out.select(*rows.columns)

    def counted(self, name: str) -> DataFrame:
        df = self[name]
        fan = self.draft.entries[name].get("fan")
        if fan is None:
            return df.withColumn("_n", F.lit(1).cast("bigint"))
        return counted_team_matches(self.draft.bare(name), self.draft.fan_times(fan))


def build_models(star: DraftStar, threads: int = 1) -> None:
    """Write all models, wave by wave, up to ``threads`` of a wave at once; shuffles
    of a wave, or of a single model, leave the disk before the next."""
    for wave in WAVES:
        for names in [[n] for n in wave] if threads <= 1 else [wave]:
            with ThreadPoolExecutor(max_workers=max(threads, 1)) as pool:
                list(pool.map(lambda n: star[n], names))
            release(star.draft.spark)


# A13
def prepare(store: Versions, stamp: str) -> Draft:
    """The working copy: a draft that names production's folders. Nothing is
    copied; production as it stands is the backup, under its version."""
    if store.current() is None:
        log.info("%s holds no version yet: nothing to start from", store.root)
    draft = store.begin(stamp)
    for t in RAW_TABLES:
        draft.entries.setdefault(t, {"schema": RAW[t].jsonValue(), "parts": {}})
    return draft


# A14
def promote(store: Versions, draft: Draft, summary: DataFrame, tables: list[str] = RAW_TABLES) -> tuple[bool, DataFrame]:
    """Publish the draft only if the checks passed. Returns (published,
    before/after counts of production), the counts as the versions hold them."""
    before, ok = store.rows(draft.base), C.passed(summary)
    if ok:
        store.publish(draft)
    else:
        log.warning("checks failed: production %s left untouched", store.root)
    counts = lambda rows: store.spark.createDataFrame(
        [(t, rows.get(t, 0)) for t in tables], "table_name string, row_count bigint")
    return ok, diff_counts(counts(before), counts(store.rows(store.current())))


def attach_tables(spark: SparkSession, db: str, location: str) -> list[str]:
    """Register every table folder under a database's location that the
    session's catalog does not know yet (e.g. written by an earlier run when
    the catalog is not persistent), as an external Parquet table with its
    recorded schema and partitions."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    added = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")) \
                and not spark.catalog.tableExists(f"{db}.{name}"):
            attach_table(spark, db, name, st.getPath().toString())
            added.append(name)
    return added


def ensure_databases(spark: SparkSession, root: str, prefix: str) -> dict[str, str]:
    """raw / pre databases under ``root``; tables left there by earlier runs
    are attached. (Production is a version store, not a database.)"""
    dbs = {}
    for k in ("raw", "pre"):
        loc = f"{root}/{prefix}_{k}.db"
        dbs[k] = create_database(spark, f"{prefix}_{k}", loc)
        attach_tables(spark, dbs[k], loc)
    return dbs


def refresh(store: Versions, batches: dict[str, DataFrame], stamp: str, as_of=None,
            threads: int = 4) -> tuple[bool, DataFrame, DataFrame]:
    """The weekly flow as plain calls, in order:

    1. prepare: a draft of the current version (A13);
    2. merge this run's collected rows into the parts they touch (A6);
    3. build the models whose raw tables changed, as tables of the draft;
    4. run every check (Q1-Q7) over the draft's models;
    5. publish the draft as a whole, by one rename, only if no error-severity
       check failed (Q8, A14).

    ``batches`` maps a raw table name to this run's rows; rows that carry their
    place in the input (``read_raw(.., sequence=True)``) are merged in that
    order. Returns (published, check summary, before/after counts of the raw
    tables in production).
    """
    draft = prepare(store, stamp)
    for t, new in batches.items():
        draft.merge(t, new, UPSERT_KEYS[t], batch_order(new), by="season")
        release(store.spark)
    star = DraftStar(draft)
    build_models(star, threads)
    summary = draft.write("check_summary", C.run_checks(star, as_of))
    published, diff = promote(store, draft, summary)
    return published, summary, diff
