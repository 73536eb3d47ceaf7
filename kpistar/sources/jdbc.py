"""Remote relations of the legacy reports read over JDBC.

The legacy reports pull programme clubs and online payments from a second
database.  On Spark that is a JDBC source with the remote query text and an
explicit result schema; the tenant predicate is part of the query so the
remote side filters before sending rows, and ``partition_column`` splits the
read over executors.  ``kpistar.sources.remote`` runs the same queries through a
driver of Python in Spark tasks.  Without a reachable
database the same relations come from ``kpistar.sources.legacy.LegacyDomain``; ``LegacyDomain.from_tables`` takes
the results of ``read_query`` as ``remote_programs`` and ``remote_paid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpistar.config import TENANT_BRAND_IDS

PROGRAM_SCHEMA = ("status string, id int, name_prog string, brand_id int, brand string, salon_id int")
PAYMENT_SCHEMA = "brand_id int, master_id int, seminar_id int, ykassa int"


def read_query(spark: SparkSession, url: str, query: str, schema: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Run ``query`` remotely and cast the result to ``schema`` (a column-definition list)."""
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        # partitioned reads need a table expression, not the ``query`` option
        reader = (reader.option("dbtable", f"({query}) AS remote_q")
                  .option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.to(spark.createDataFrame([], schema).schema)


def programs_query(brand_id: int | None) -> str:
    """Programme records x clubs with the brand's name, of one brand (filtered remotely) or of all, records without a club included."""
    names = " ".join(f"WHEN {i} THEN '{name}'" for name, i in sorted(TENANT_BRAND_IDS.items(), key=lambda x: x[1]))
    kind, where = ("LEFT JOIN", "") if brand_id is None else ("JOIN", f" WHERE c.brand_id = {int(brand_id)}")
    return ("SELECT r.status AS status, c.id AS id, c.name AS name_prog, c.brand_id AS brand_id, "
            f"CASE c.brand_id {names} END AS brand, r.salon_id AS salon_id "
            f"FROM special_program_club_records r {kind} special_program_clubs c ON r.club_id = c.id{where}")


def payments_query(brand_id: int | None = None) -> str:
    """Distinct online-payment flags per (brand, master, seminar), of one brand or of all."""
    where = "" if brand_id is None else f" WHERE brand_id = {int(brand_id)}"
    return ("SELECT DISTINCT brand_id, master_id, seminar_id, "
            f"CASE WHEN price IS NOT NULL THEN 1 END AS ykassa FROM payments{where}")
