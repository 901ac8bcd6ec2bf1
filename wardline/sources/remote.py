"""Tables of other database servers over JDBC.

Credentials come from the session configuration, never from code:
``spark.wardline.remote.<server>.{url,user,password,driver}``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.clock import Clock

# Query timeouts in seconds per remote system (fixed values).
TIMEOUTS = {"pharmacy": 60, "clearinghouse": 120}


@dataclass(frozen=True)
class Split:
    """How a remote read is cut into parallel range queries."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def remote_options(
    spark: SparkSession,
    server: str,
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """JDBC options for a remote table, or for a pass-through query run there.

    JDBC does not take a ``query`` together with a partition column, so a split query
    is read as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    prefix = f"spark.wardline.remote.{server}"
    options = {"url": spark.conf.get(f"{prefix}.url"), "fetchsize": str(fetch_size)}
    for name in ("user", "password", "driver"):
        value = spark.conf.get(f"{prefix}.{name}", None)
        if value is not None:
            options[name] = value
    if server in TIMEOUTS:
        options["queryTimeout"] = str(TIMEOUTS[server])
    if split is None:
        options["dbtable" if table else "query"] = table or query
        return options
    options["dbtable"] = table or f"({query}) remote_rows"
    options["partitionColumn"] = split.column
    options["lowerBound"], options["upperBound"] = str(split.lower), str(split.upper)
    options["numPartitions"] = str(split.parts)
    return options


def read_remote(spark: SparkSession, server: str, **kwargs) -> DataFrame:
    """A remote table or query as a DataFrame; simple filters are pushed to the server."""
    return spark.read.format("jdbc").options(**remote_options(spark, server, **kwargs)).load()


# Pass-through queries the remote systems are asked (fixed values).
LOW_STOCK = "SELECT DrugCode, DrugName, StockQuantity, ExpirationDate FROM DrugInventory WHERE StockQuantity < {limit}"
STUDIES = "SELECT AccessionNumber, StudyDate, Modality, StudyDescription FROM STUDIES WHERE PatientID = '{mrn}'"


def low_stock_query(limit: int = 10) -> str:
    return LOW_STOCK.format(limit=int(limit))


def studies_query(mrn: str) -> str:
    """The studies of one patient; quotes in the record number are doubled."""
    return STUDIES.format(mrn=mrn.replace("'", "''"))


def recent_results(results: DataFrame, mrn: str, clock: Clock, days: int = 7) -> DataFrame:
    """One patient's results of the last days; both filters are pushed to the remote server."""
    return results.filter((F.col("PatientMRN") == mrn) & (F.col("ResultDate") >= clock.days(-days)))
