"""Table functions and aggregates for SQL, by name: lateral over the rows of a query, or grouped.

    json_leaves(doc)             path and value of every leaf of a JSON text but nulls; none if it can't be read
    json_under(doc, name)        path and value of the leaves under a name, at any depth
    page_blocks(html)            position, tag, text and link_chars of the blocks of a page
    page_sources(html)           position, url and label of the sources that a record page lists
    paragraphs(doc, most)        position and text of the pieces of a text, of so many characters at most
    nearest_rank(value, share)   the smallest value that at least a share of the values don't exceed
    longest_run(flag, at)        the most true flags on end, by at

Table functions give a row for each match; null arguments give none. Aggregates leave out nulls, can't stand beside built-in ones and hold a group's values in
one task: for groups that are large, operators.scan has percentiles() and running_sums().
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from sedimenta.operators import extract, record_pages


def _leaves(doc: str | None) -> Iterator[tuple[str, str]]:
    try:
        value = json.loads(doc) if doc is not None else None
    except ValueError:
        return
    if value is not None:
        for path, v in extract.walk(value):
            yield path, v if isinstance(v, str) else json.dumps(v)


class JsonLeaves:
    def eval(self, doc: str):
        yield from _leaves(doc)


class JsonUnder:
    def eval(self, doc: str, name: str):
        for path, value in _leaves(doc):
            last = path.split(".")[-1].split("[")[0]
            if last == name:
                yield path, value


class PageBlocks:
    def eval(self, html: str):
        if html is not None:
            for k, b in enumerate(extract.blocks_of(html), 1):
                yield k, b.tag, b.text, b.link_chars


class PageSources:
    def eval(self, html: str):
        if html is not None:
            for k, s in enumerate(record_pages.parse(html).get("sources") or [], 1):
                yield k, s["url"], s["name"]


class Paragraphs:
    def eval(self, doc: str, most: int):
        for k, part in enumerate([p[i : i + most] for p in (doc or "").split("\n\n") for i in range(0, max(1, len(p)), most)], 1):
            if part:
                yield k, part


def nearest_rank(value: pd.Series, share: pd.Series) -> float:
    known = np.sort(value.dropna().to_numpy(dtype=np.float64))
    if not len(known):
        return None
    return float(known[max(0, int(np.ceil(share.iloc[0] * len(known))) - 1)])


def longest_run(flag: pd.Series, at: pd.Series) -> int:
    best = run = 0
    for hit in flag.iloc[np.argsort(at.to_numpy(), kind="stable")].fillna(False):
        run = run + 1 if hit else 0
        best = max(best, run)
    return best


#: Table functions by name, with what they give.
TABLES = {
    "json_leaves": (JsonLeaves, "path string, value string"),
    "json_under": (JsonUnder, "path string, value string"),
    "page_blocks": (PageBlocks, "position int, tag string, text string, link_chars int"),
    "page_sources": (PageSources, "position int, url string, label string"),
    "paragraphs": (Paragraphs, "position int, text string"),
}
AGGREGATES = {"nearest_rank": (nearest_rank, "double"), "longest_run": (longest_run, "bigint")}


def register(spark: SparkSession) -> None:
    for name, (function, kind) in TABLES.items():
        spark.udtf.register(name, udtf(function, returnType=kind, useArrow=True))
    for name, (function, kind) in AGGREGATES.items():
        spark.udf.register(name, pandas_udf(function, kind))
