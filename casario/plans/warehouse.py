"""Build the warehouse as tables.

Silver and the enriched table are partitioned by month and bucketed by identity.  Months are
replaced one at a time, and the cross-month dedup reads the buckets without a shuffle.  Loading a
month touches only the identities in it: their rows are decided anew, and only the months in which
one comes or goes are written again.  Every layer is written before the next one reads it, so a
lost executor costs one layer's tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casario.operators import keep_first, not_null, plausible, union_by_name, unique
from casario.plans.layers import (
    BY_LOCALIZACAO,
    BY_TIPO,
    bronze,
    dedup_month,
    enriched,
    has_identity,
    mart_localizacao,
    mart_stats,
    mart_tipo,
    obt,
    silver,
    stamped,
    typed,
    with_change,
)
from casario.schema import SILVER
from casario.sources import replace_partition, save_table


@dataclass(frozen=True)
class Names:
    """Table names; the database of each layer is the prefix plus the layer's name."""

    db: str = "main"
    bronze: str = "listings"
    silver: str = "listings"
    obt: str = "obt"
    mart_tipo: str = "mart_tipo"
    mart_localizacao: str = "mart_localizacao"

    @property
    def silver_db(self) -> str:
        return f"{self.db}_silver"

    @property
    def gold_db(self) -> str:
        return f"{self.db}_gold"


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def bronze_view(raw: DataFrame, names: Names = Names()) -> DataFrame:
    """Register bronze as a view."""
    view = f"{names.db}_bronze_{names.bronze}"
    stamped(bronze(raw)).createOrReplaceTempView(view)
    return raw.sparkSession.table(view)


def bucketed_silver(listings: DataFrame, buckets: int) -> DataFrame:
    """Silver with its rows dealt out by identity, as the buckets are: one shuffle.

    The identity alone also brings the rows of an identity and a month together.  Listings
    without an identity would all meet in one task that way, so they go a way of their own,
    on which each task keeps one row a month before anything is shuffled.  They are told apart
    by their raw columns, so each row is cleaned and hashed once.
    """
    named = dedup_month(typed(listings.where(has_identity())).repartition(buckets, "id"))
    nameless = dedup_month(typed(listings.where(~has_identity())))
    return plausible(named.unionByName(nameless)).select(*SILVER.fieldNames())


def build_warehouse(
    raw: DataFrame, names: Names = Names(), buckets: int | None = None, dim: DataFrame | None = None
) -> dict[str, int]:
    """Build every layer from raw listings of any number of months; rows per table.

    `buckets` should leave each bucket of silver at about what one task can sort in memory
    (a few hundred MB); the default, the session's shuffle partitions, suits tables that are
    shuffled with that number anyway.
    """
    spark = raw.sparkSession
    n = _buckets(spark, buckets)
    cleaned = bucketed_silver(bronze_view(raw, names), n)
    rows = {
        "silver": save_table(
            stamped(cleaned), names.silver_db, names.silver, ["date_ref"], (n, "id")
        )
    }
    return rows | build_gold(spark, names, dim, n)


def load_month(
    raw: DataFrame,
    date_ref: str,
    names: Names = Names(),
    buckets: int | None = None,
    dim: DataFrame | None = None,
) -> dict[str, int]:
    """Add or replace one month, and bring gold up to date; rows written per table.

    Within a month the identity alone is the key, so the dedup's shuffle already has
    the layout of the buckets when their number is that of the shuffle partitions.  `dim` must be
    the dimension that gold was built with; to change it, build gold again.
    """
    spark = raw.sparkSession
    n = _buckets(spark, buckets)
    month = silver(bronze(raw).where(F.col("date_ref") == date_ref), keys=("id",))
    if n != int(spark.conf.get("spark.sql.shuffle.partitions")):
        month = month.repartition(n, "id")
    if spark.catalog.tableExists(f"{names.silver_db}.{names.silver}"):
        written = replace_partition(
            stamped(month), names.silver_db, names.silver, "date_ref", date_ref
        )
    else:
        written = save_table(
            stamped(month), names.silver_db, names.silver, ["date_ref"], (n, "id")
        )
    made = [f"{names.gold_db}.{name}" for name in (names.obt, names.mart_tipo, names.mart_localizacao)]
    if all(map(spark.catalog.tableExists, made)):
        return {"silver": written} | update_gold(spark, date_ref, names, dim)
    return {"silver": written} | build_gold(spark, names, dim, n)


def build_gold(
    spark: SparkSession, names: Names = Names(), dim: DataFrame | None = None, buckets: int | None = None
) -> dict[str, int]:
    """Rebuild the enriched table and the marts from the silver table."""
    listings = spark.table(f"{names.silver_db}.{names.silver}")
    layout = ["date_ref"], (_buckets(spark, buckets), "id")
    rows = {"obt": save_table(stamped(obt(listings, dim)), names.gold_db, names.obt, *layout)}
    gold = spark.table(f"{names.gold_db}.{names.obt}")
    for name, build in ((names.mart_tipo, mart_tipo), (names.mart_localizacao, mart_localizacao)):
        rows[name] = save_table(stamped(build(gold)), names.gold_db, name)
    return rows


def _with_identity(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join by identity, in which NULL is one.  The buckets serve all others."""
    named, nameless = F.col("id").isNotNull(), F.col("id").isNull()
    one = ids.select(F.col("id").alias("_id"))
    return rows.where(named).join(ids.select("id").where(named), "id", how).unionByName(
        rows.where(nameless).join(one.where("_id is null"), F.col("id").eqNullSafe(F.col("_id")), how)
    )


def decided(spark: SparkSession, date_ref: str, names: Names = Names(), dim: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that enter the enriched table after a month of silver was replaced, and the
    (id, date_ref) that leave it from other months.

    Identities of the month compete with their row in gold, of which three columns are read; those
    whose row in gold is of this month also with their other months in silver, which are only
    read if there are such.
    """
    listings, gold = spark.table(f"{names.silver_db}.{names.silver}"), spark.table(f"{names.gold_db}.{names.obt}")
    here = F.col("date_ref").eqNullSafe(F.lit(date_ref))
    month = listings.where(here).select(*SILVER.fieldNames())
    standing = _with_identity(gold.where(~here).select("id", "preco", "date_ref"), month, "left_semi")
    rivals = [month.withColumn("stands", F.lit(False)), standing.withColumn("stands", F.lit(True))]
    was_here = gold.where(here).select("id")
    if not was_here.isEmpty():
        others = _with_identity(listings.where(~here).select(*SILVER.fieldNames()), was_here, "left_semi")
        rivals.append(others.withColumn("stands", F.lit(False)))
    # An identity has one row a month at most, so price and month decide.
    best = keep_first(union_by_name(rivals), ["id"], [F.col("preco").desc(), F.col("date_ref").asc_nulls_last()])
    entering = enriched(best.where(~F.col("stands")).drop("stands"), dim)
    return entering, _with_identity(standing.select("id", "date_ref"), entering, "left_semi")


def update_gold(
    spark: SparkSession, date_ref: str, names: Names = Names(), dim: DataFrame | None = None
) -> dict[str, int]:
    """Bring gold up to date after a month of silver was replaced.

    Months in which no row comes or goes keep their files.  The marts compute the statistics of
    the others anew, and the change from month to month over their own rows.  After a failure the
    same call can be repeated.
    """
    entering, leaving = decided(spark, date_ref, names, dim)
    coming, staged = f"{names.obt}__coming", f"{names.obt}__staged"
    save_table(stamped(entering), names.gold_db, coming)
    entering = spark.table(f"{names.gold_db}.{coming}")
    moved = entering.select("date_ref").unionByName(leaving.select("date_ref")).distinct()
    months = sorted({date_ref, *(row.date_ref for row in moved.collect())})
    gold = spark.table(f"{names.gold_db}.{names.obt}")
    rest = gold.where(F.col("date_ref").isin(months) & (F.col("date_ref") != date_ref))
    fresh = _with_identity(rest, entering, "left_anti").unionByName(entering)
    save_table(fresh, names.gold_db, staged, ["date_ref"])
    rows = {"obt": 0}
    for month in months:
        of_month = spark.table(f"{names.gold_db}.{staged}").where(F.col("date_ref") == month)
        rows["obt"] += replace_partition(of_month, names.gold_db, names.obt, "date_ref", month)
    gold = spark.table(f"{names.gold_db}.{names.obt}").where(F.col("date_ref").isin(months))
    for name, (by, lag_by) in ((names.mart_tipo, BY_TIPO), (names.mart_localizacao, BY_LOCALIZACAO)):
        stats = mart_stats(gold, by)
        kept = spark.table(f"{names.gold_db}.{name}").where(~F.col("date_ref").isin(months))
        whole = with_change(kept.select(*stats.columns).unionByName(stats), lag_by)
        rows[name] = save_table(stamped(whole), names.gold_db, name)
    for name in (coming, staged):
        spark.sql(f"DROP TABLE {names.gold_db}.{name}")
    return rows


def check_warehouse(spark: SparkSession, names: Names = Names()) -> DataFrame:
    """Violations of the identity checks: per month in silver, overall in gold."""
    listings = spark.table(f"{names.silver_db}.{names.silver}")
    gold = spark.table(f"{names.gold_db}.{names.obt}")
    checks = [
        ("silver", "unique", unique(listings, "date_ref", "id")),
        ("silver", "not_null", not_null(listings, "id")),
        ("gold", "unique", unique(gold, "id")),
        ("gold", "not_null", not_null(gold, "id")),
    ]
    counted = [
        found.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(layer).alias("layer"), F.lit(check).alias("check"), "violations"
        )
        for layer, check, found in checks
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result
