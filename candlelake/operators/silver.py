"""Silver layer: closed, valid candles, the newest version of each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlelake.operators.quality import apply_silver_quality_rules
from candlelake.operators.scan import latest_by_key
from candlelake.schema import SILVER_COLUMNS, project

CANDLE_KEY = ("symbol", "interval", "open_time")
VERSION_ORDER = ("ingested_at", "event_id")


def build_silver(bronze: DataFrame, reject_nan: bool = False) -> DataFrame:
    """Newest version per candle by ingestion time, then event id.

    Versions equal in both are told apart by their content, so a recomputed task picks the same one.
    """
    clean = project(apply_silver_quality_rules(bronze, reject_nan), SILVER_COLUMNS)
    rest = [name for name in SILVER_COLUMNS if name not in (*CANDLE_KEY, *VERSION_ORDER)]
    return latest_by_key(clean, CANDLE_KEY, [*VERSION_ORDER, *rest])
