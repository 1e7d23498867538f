"""Resampling and scoring on Structured Streaming input."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.scalars import angle_of
from tidemark.functions.times import DAY, width_micros
from tidemark.operators.hmm import causal_path, emissions
from tidemark.plans.scoring import score_states, score_vectors
from tidemark.sources.model_store import StoredModels


def stream_resample(
    df: DataFrame,
    station: str,
    timestamp: str,
    numeric: Sequence[str],
    directional: Sequence[str],
    width: str,
    lateness: str,
) -> DataFrame:
    """Means and circular means per station and bin, emitted once a bin can no longer change.

    The event time must be a zoned timestamp. Streaming bins start at the epoch, which agrees with
    the batch grid for widths that divide a day; others are refused.
    """
    micros = width_micros(width)
    if DAY % micros:
        raise ValueError("a streaming bin width must divide a day")
    sums = [F.avg(c).alias(c) for c in numeric]
    for c in directional:
        sums += [F.avg(F.sin(F.radians(c))).alias(f"{c}__sin"), F.avg(F.cos(F.radians(c))).alias(f"{c}__cos")]
    binned = (
        df.where(F.col(station).isNotNull())
        .withWatermark(timestamp, lateness)
        .groupBy(station, F.window(timestamp, f"{micros} microseconds").alias("_w"))
        .agg(*sums)
    )
    return binned.select(
        station,
        F.col("_w.start").alias(timestamp),
        *numeric,
        *[angle_of(F.col(f"{c}__sin"), F.col(f"{c}__cos")).alias(c) for c in directional],
    )


def stream_score(windows: DataFrame, models: StoredModels, output: str, checkpoint: str) -> DataStreamWriter:
    """Score a stream of window rows into ``output``: its columns, the states and, if embedded, the error.

    Each window gets the state in which the best path up to it ends (``score_windows(causal=True)`` gives the same), so
    the borders of micro-batches do not matter: the decoder's scores of every station are kept from batch to batch. Windows of a station must
    arrive by ascending ``end_idx``, in any number of batches; one that comes after a later one has no state.
    """
    scaled, vector = score_vectors(windows, models)
    parameters, kept = models.hmm, scaled.columns
    schema = T.StructType([*scaled.schema.fields, T.StructField("micro_state", T.IntegerType())])

    def decode(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, scores = state.get if state.exists else (None, None)
        rows = pd.concat(list(parts)).sort_values("end_idx", ignore_index=True)
        late = rows["end_idx"] <= last if last is not None else rows["end_idx"].isna()
        found = pd.array([None] * len(rows), dtype="Int32")
        if (~late).any():
            x = np.stack(rows.loc[~late, vector].to_numpy())
            path, scores = causal_path(emissions(x, parameters), None if scores is None else np.asarray(scores), parameters)
            found[(~late).to_numpy()] = path
            state.update((int(rows["end_idx"].max()), [float(v) for v in scores]))
        yield rows[kept].assign(micro_state=found)

    decoded = scaled.groupBy("station").applyInPandasWithState(
        decode, schema, "last long, scores array<double>", "append", GroupStateTimeout.NoTimeout
    )
    scored, added = score_states(decoded, models)
    return (
        scored.select(*windows.columns, *added).writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
