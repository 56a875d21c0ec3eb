"""Rows sorted by key inside a partition, handed out so that no key is torn apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd


def starts_of(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Positions at which the values of the keys change, and the length."""
    if not len(frame):
        return np.zeros(1, dtype=np.int64)
    change = np.zeros(len(frame), dtype=bool)
    change[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), len(frame))


def whole_runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames that end where a key ends. Memory: one batch and one key."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = starts_of(batch, keys)[-2]
        if last == 0 and held and all(held[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys):
            held.append(batch)  # the key goes on through this batch
            continue
        if held or last:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
        held = [batch.iloc[last:]]
    if held:
        yield pd.concat(held, ignore_index=True)
