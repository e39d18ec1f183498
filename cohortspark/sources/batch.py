"""An ordered batch of SQL stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cohortspark.sources.tables import load_part, save_table


class Stage(NamedTuple):
    """One statement. ``write`` stages become a table, ``view`` and ``query`` stay lazy.

    ``load`` stages add to the table ``name``, under the column and value of ``part``: what an earlier
    run of the stage added is replaced. The result is the whole table.
    """

    name: str
    sql: str
    action: str = "view"
    part: tuple[str, str | int] | None = None


def run_batch(
    spark: SparkSession, stages: Sequence[Stage], params: Mapping[str, Any] | None = None
) -> dict[str, DataFrame]:
    """Run the stages in order and return their results by name.

    Parameters are bound by name (``:since``, ``IDENTIFIER(:schema || '.t')``),
    never pasted into the text. A later stage reads an earlier one by its name.
    """
    results: dict[str, DataFrame] = {}
    for stage in stages:
        frame = spark.sql(stage.sql, args=dict(params or {}))
        if stage.action == "write":
            frame = save_table(frame, stage.name)
        elif stage.action == "load" and stage.part:
            frame = load_part(frame, stage.name, *stage.part)
        elif stage.action == "view":
            frame.createOrReplaceTempView(stage.name)
        elif stage.action != "query":
            raise ValueError(f"unknown action {stage.action!r} of stage {stage.name}")
        results[stage.name] = frame
    return results
