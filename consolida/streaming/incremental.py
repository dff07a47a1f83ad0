"""Version numbers over a stream of operations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

NUMBERED = "target string, operation_id string, version int, propagated boolean"


def _number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    version, bad = state.get if state.exists else (0, False)
    rows = pd.concat(list(batches)).sort_values(["ts", "operation_id"])
    out = []
    for op, error, clears in zip(rows["operation_id"], rows["error"], rows["clears"], strict=True):
        version += 1
        blocked = bool(bad and not clears)
        out.append((key[0], op, version, blocked))
        bad = bool(error or blocked)
    state.update((version, bad))
    yield pd.DataFrame(out, columns=["target", "operation_id", "version", "propagated"])


def numbered(ops: DataFrame) -> DataFrame:
    """Versions and propagation of a stream of (target, operation_id, ts, error, clears), with state per target.

    Operations of a micro-batch are taken in the order of ``ts``; a later batch goes on from the state.
    """
    return ops.groupBy("target").applyInPandasWithState(_number, NUMBERED, "version int, bad boolean", "append", GroupStateTimeout.NoTimeout)
