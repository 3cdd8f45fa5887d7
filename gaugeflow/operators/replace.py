"""Replace a station's archive: delete its (station, parameter) rows, append new."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow.operators.aggregate import distinct_parameters


def replace_rows(current: DataFrame, new: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """``current`` without the (STATION_NUMBER, Parameter) pairs present in
    ``new``, plus all of ``new``.

    Only parameters that the new archive holds are replaced; a station's
    other parameters stay. The pair set is distinct (partial aggregation
    first); Spark broadcasts it when its measured size is under the
    broadcast threshold and shuffles both sides otherwise. ``pairs`` are the
    pairs of ``new`` where the caller has them.
    """
    pairs = distinct_parameters(new) if pairs is None else pairs
    kept = current.join(pairs, ["STATION_NUMBER", "Parameter"], "left_anti")
    return kept.select(*current.columns).unionByName(new.select(*current.columns))
