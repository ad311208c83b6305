"""The work list: discovered answer links that are not held yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.functions.text import composed_key
from askmill.operators.dedup import keep_first
from askmill.operators.filters import drop_null_keys
from askmill.operators.joins import union_by_name, without_keys


def pending_answers(
    links: DataFrame,
    held_snapshot: DataFrame | None = None,
    held_table: DataFrame | None = None,
) -> DataFrame:
    """Links once per (question, answer), null ids dropped, minus the answers already held.

    ``links`` has ``qId`` and ``aid``; the held frames have ``question_id`` and
    ``answer_id`` and may repeat them. The result has the added column ``qaId``. The
    deduplication, the held keys and the anti-join share one partitioning by the id pair;
    both held frames go through one anti-join.
    """
    unique = drop_null_keys(keep_first(links, ["qId", "aid"]), ["qId", "aid"])
    held = [h.select("question_id", "answer_id") for h in (held_snapshot, held_table) if h is not None]
    pending = unique
    if held:
        keys = {"qId": "question_id", "aid": "answer_id"}
        pending = without_keys(unique, union_by_name(*held), keys)
    return pending.withColumn("qaId", composed_key(F.col("qId"), F.col("aid")))
