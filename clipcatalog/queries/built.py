"""Staged frames shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.plans import views
from clipcatalog.queries.registry import Inputs


def tie() -> list:
    """Order of answers of one item and time."""
    return [F.col("record_hash").asc_nulls_last()]


def recipes(t: Inputs) -> DataFrame:
    return views.stage_recipes(t.fx("silver_fx"), tie())


def evidence(t: Inputs) -> DataFrame:
    return views.stage_evidence(t.fx("evidence_fx"))


def quality(t: Inputs) -> DataFrame:
    return views.score_recipes(recipes(t), views.evidence_by_item(evidence(t)))


def gold(t: Inputs) -> DataFrame:
    return views.catalog(quality(t))


def api(t: Inputs) -> DataFrame:
    return views.api_catalog(gold(t))
