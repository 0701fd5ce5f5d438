"""Sorted rows in batches, cut at the borders of their keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def key_borders(keys: pd.Series | pd.DataFrame) -> np.ndarray:
    """True where a row's key differs from that of the row before; nulls are equal. The first row is a border."""
    by = keys.to_frame() if isinstance(keys, pd.Series) else keys
    before = by.shift()
    border = ((by != before) & ~(by.isna() & before.isna())).any(axis=1).to_numpy()
    border[:1] = True
    return border


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The same rows in batches that hold whole keys: the last key of a batch waits for the next one."""
    held: list[pd.DataFrame] = []
    for rows in batches:
        if not len(rows):
            continue
        border = key_borders(rows[key])
        if held:
            last = held[-1][key].iloc[-1]
            border[0] = not (last == rows[key].iloc[0] or (pd.isna(last) and pd.isna(rows[key].iloc[0])))
        starts = np.flatnonzero(border)
        if len(starts):
            cut = int(starts[-1])
            done = [*held, rows.iloc[:cut]] if cut else held
            if done:
                yield pd.concat(done, ignore_index=True)
            held = [rows.iloc[cut:]]
        else:
            held.append(rows)
    if held:
        yield pd.concat(held, ignore_index=True)
