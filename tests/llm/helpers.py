"""Tables and plain reference computations for the tests of the training-data operators."""

from __future__ import annotations

import os
import zlib
from collections import Counter

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def docs(spark, texts, **more):
    """A documents table with these texts, ids from 0."""
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def crc(value, modulus):
    return zlib.crc32(str(value).encode()) % modulus


def bag(df, columns=None):
    columns = columns or sorted(df.columns)
    return Counter(map(str, (tuple(row) for row in df.select(*columns).collect())))


def groups(items, linked):
    """The smallest item reachable from each, by union of all linked pairs."""
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for b in items[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in items}
