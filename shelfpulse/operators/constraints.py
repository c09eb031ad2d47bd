"""Table rules, checked as data: every broken rule comes back as a row.

Each table is read once: one grouping over several sets of columns counts its keys, what it refers to and its nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.operators.quality import OUTCOME_KEY
from shelfpulse.schemas import STATUSES

REQUIRED = {
    "runs": ("id", "merchant", "method", "started_at", "ok", "products_seen", "variants_seen"),
    "field_outcomes": ("run_id", "merchant", "field", "status", "count"),
    "observations": ("id", "run_id", "merchant", "product_ext_id", "variant_ext_id", "observed_at"),
}


KEYS = {"runs": ("id",), "field_outcomes": OUTCOME_KEY, "observations": ("run_id", "id")}
# A run id that a table refers to, and one that there is.
REFERS, KNOWN = "run", "known"


def _counted(df: DataFrame, table: str) -> DataFrame:
    """(table_name, rule, key, n_rows) of what breaks a rule in `df`, and of the run ids it holds or refers to."""
    key = KEYS[table]
    present = [c for c in REQUIRED[table] if c in df.columns]
    sets: dict[str, Sequence[str]] = {"unique": key, "nulls": ()}
    if table != "runs":
        sets[REFERS] = ("run_id",)
    if "status" in key:
        sets["status"] = ("status",)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present]
    counted = df.groupingSets([list(columns) for columns in sets.values()], *key).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), *nulls)

    def at(name: str) -> Column:
        absent = sum(1 << place for place, c in enumerate(reversed(key)) if c not in sets[name])
        return F.col("level") == absent

    def row(when: Column, rule: str, told: Column, rows: Column) -> Column:
        return F.when(when, F.struct(F.lit(rule).alias("rule"), told.cast("string").alias("key"), rows.cast("bigint").alias("n_rows")))

    n, joined = F.col("n"), F.concat_ws("|", *key)
    found = [row(at("unique") & (n > 1), "unique", joined, n)]
    found += [row(at("nulls") & (F.col(f"null_{c}") > 0), "required", F.lit(c), F.col(f"null_{c}")) for c in present]
    if REFERS in sets:
        found.append(row(at(REFERS), REFERS, F.col("run_id"), n))
    else:
        found.append(row(at("unique"), KNOWN, F.col("id"), n))
    if "status" in sets:
        found.append(row(at("status") & ~F.col("status").isin(*STATUSES), "status", F.col("status"), n))
    return counted.select(F.lit(table).alias("table_name"), F.explode(F.array_compact(F.array(*found))).alias("found")).select(
        "table_name", "found.*")


def violations(runs: DataFrame, outcomes: DataFrame, observations: DataFrame) -> DataFrame:
    """What every rule finds in the three tables. Run ids that are held and referred to meet in one grouping."""
    rows = _counted(runs, "runs").unionByName(_counted(outcomes, "field_outcomes")).unionByName(
        _counted(observations, "observations"))
    of_runs = F.col("rule").isin(REFERS, KNOWN)
    whose = F.when(of_runs, REFERS).otherwise(F.concat_ws("|", "table_name", "rule"))
    known = F.max((F.col("rule") == KNOWN) & F.col("key").isNotNull())
    entry = F.struct("table_name", "rule", "n_rows")  # a key has one row for each of three tables at most
    met = rows.groupBy(whose.alias("whose"), "key").agg(known.alias("is_known"), F.collect_list(entry).alias("entries"))
    broken = met.where(~((F.col("whose") == REFERS) & F.col("is_known"))).select("key", F.explode("entries").alias("entry"))
    return broken.where(F.col("entry.rule") != KNOWN).select("entry.table_name", "entry.rule", "key", "entry.n_rows")
