"""Advances: online receipts split by the lender that holds the client's portfolio."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.advances import classify_advance, match_accounts, split_advances
from ..operators.flags import flag_advances
from ..schemas import ADVANCES
from ..session import written
from ..sources.sinks import publish_tables
from ..sources.tables import conform_all


def advances(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every advance with its client's accounts, what is left, and the remark."""
    return classify_advance(match_accounts(tables["ONLINE"], tables["AC ARP"], tables["AC FS"]))


def run_advances(spark: SparkSession, found: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Publishes the tables that have rows, each row with its marks."""
    classified = written(advances(conform_all(found, ADVANCES, extra=())))
    reports = {name: flag_advances(table) for name, table in split_advances(classified).items()}
    return publish_tables(spark, reports, folder)
