"""Row-shaped operators: words, unpivot, tags, routing, union, membership, partition-wise maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import WORD_DELIMITERS, word_array


def split_words(
    df: DataFrame,
    text: str,
    name: str = "word",
    pattern: str = WORD_DELIMITERS,
    lowercase: bool = True,
    drop_empty: bool = True,
) -> DataFrame:
    """One row per word of a text column, other columns kept."""
    rest = [c for c in df.columns if c != text]
    words = df.select(*rest, F.explode(word_array(F.col(text), pattern, lowercase)).alias(name))
    return words.where(F.length(name) > 0) if drop_empty else words


def one_to_many(df: DataFrame, kept: Sequence[str], values: Sequence[Column], name: str) -> DataFrame:
    """One row becomes one row per given value expression."""
    return df.select(*kept, F.explode(F.array(*values)).alias(name))


def tag_rows(df: DataFrame, rules: Mapping[str, Column], name: str = "tags") -> DataFrame:
    """Add the list of tags whose rule holds; a row may carry several or none."""
    tags = [F.when(rule, F.lit(tag)) for tag, rule in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*tags)))


def with_tag(df: DataFrame, tag: str, name: str = "tags") -> DataFrame:
    """The rows of one tagged sub-stream."""
    return df.where(F.array_contains(name, tag))


def explode_tags(df: DataFrame, tags: str = "tags", name: str = "tag") -> DataFrame:
    """One row per row and tag."""
    return df.withColumn(name, F.explode(tags)).drop(tags)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs, duplicates kept; works on batches and on streams."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def map_both(left: DataFrame, left_map: Sequence[Column], right: DataFrame, right_map: Sequence[Column]) -> DataFrame:
    """Two inputs of different types, each mapped by its own expressions into one output."""
    return left.select(*left_map).unionByName(right.select(*right_map))


def keep_members(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return df.join(members.select(*keys), list(keys), "left_semi")


def map_partitions(
    df: DataFrame,
    set_up: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """A pandas function over Arrow batches, with one ``set_up`` call per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transform = set_up()
        for batch in batches:
            yield transform(batch)

    return df.mapInPandas(run, schema)
