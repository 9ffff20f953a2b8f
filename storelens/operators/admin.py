"""Administrative reports: reachability matrix and account plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reachability_matrix(probes: DataFrame, destinations: list[str]) -> DataFrame:
    """One row per server and port, one column per destination, and OTHER as a map of the rest.

    The newest probe of a pair counts; a pair that was never probed stays NULL. Without a PORT
    column there is a row per server. OTHER is NULL where all destinations are listed.
    """
    keys = ["SERVER", "PORT"] if "PORT" in probes.columns else ["SERVER"]
    newest = probes.groupBy(*keys, "DESTINATION").agg(F.max_by("REACHABLE", "PROBE_ID").alias("REACHABLE"))
    listed = F.col("DESTINATION").isin(destinations)
    columns = [F.max(F.when(F.col("DESTINATION") == d, F.col("REACHABLE"))).alias(d) for d in destinations]
    rest = F.collect_list(F.when(~listed, F.struct("DESTINATION", "REACHABLE")))
    return newest.groupBy(*keys).agg(
        *columns, F.when(F.size(rest) > 0, F.map_from_entries(F.array_sort(rest))).alias("OTHER")
    )


def account_plan(employees: DataFrame, accounts: DataFrame, domain: str | None = None) -> DataFrame:
    """Accounts to create for employees whose user name is not in the directory.

    The user name is the first initial and the surname; names compare without case. Of
    employees that share a user name, the one with the lowest number gets the account. A domain such as
    `example.com` is appended to the path.
    """
    place = [F.lit("OU="), F.col("LOC")]
    if domain is not None:
        place.append(F.lit("".join(f",DC={part}" for part in domain.split("."))))
    named = employees.select(
        F.concat(F.substring("FIRST_NAME", 1, 1), F.col("LAST_NAME")).alias("USER_NAME"),
        F.concat(*place).alias("OU_PATH"),
        F.lit(True).alias("IS_ENABLED"),
        F.col("FIRST_NAME").alias("GIVEN_NAME"),
        F.col("LAST_NAME").alias("SURNAME"),
        "DEPARTMENT",
        "EMPLOYEE_ID",
        F.col("PHONE").alias("OFFICE_PHONE"),
    )
    account = F.struct(*named.columns)
    wanted = named.groupBy(F.lower("USER_NAME").alias("NAME_KEY")).agg(
        F.min_by(account, "EMPLOYEE_ID").alias("ACCOUNT")
    )
    taken = accounts.select(F.lower("USER_NAME").alias("NAME_KEY"))
    return wanted.join(taken, "NAME_KEY", "left_anti").select("ACCOUNT.*")
