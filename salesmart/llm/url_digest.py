"""URL rules in a sorted array of digests, probed by binary search.

The rules are one file: sorted 64-bit XXH64 keys, then the offsets of the full strings and the
strings. Each executor gets the file from the driver and maps it into memory, so its Python
workers share one copy and a set of many millions of rules is paged in as it is probed. A batch
of urls becomes one array of digests, one for each host suffix and each prefix of the path as
long as some rule's path; all are searched for at once, and each hit is confirmed against the
stored string, so colliding digests decide nothing.

A rule (action, host, path) fits its host and all subdomains where the url's path starts with the
rule's. The longest rule that fits (host and path together; then the longer host) decides; a url
that none fits gets `default`.

Defined cases: a null url, an empty one and one without `://` have an empty host and path, which
no rule fits; repeated rows are judged each; rules given twice count once, conflicting ones are
refused. Columns named like a result are replaced.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, text_column

ACTIONS = ("allow", "block")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(ord("A"), ord("Z") + 1)})

FIELDS = [
    T.StructField("host", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()),
]

Rule = tuple[str, str, str]


def write_rules(rules: list[Rule], path: str) -> tuple[list[int], int]:
    """Write the rules' file; the lengths of their paths and the most labels of a host."""
    actions: dict[str, str] = {}
    for action, host, prefix in rules:
        if action not in ACTIONS or not prefix.startswith("/"):
            raise ValueError(f"not a rule: {action} {host}{prefix}")
        if actions.setdefault(host.translate(LOWER) + prefix, action) != action:
            raise ValueError(f"both allowed and blocked: {host}{prefix}")
    stored = sorted((digest(key), f"{ACTIONS.index(action)}{key}".encode()) for key, action in actions.items())
    strings = [value for _, value in stored]
    with open(path, "wb") as file:
        file.write(np.array([len(stored)], np.int64).tobytes())
        file.write(np.array([key for key, _ in stored], np.uint64).tobytes())
        file.write(np.cumsum([0, *map(len, strings)]).astype(np.int64).tobytes())
        file.write(b"".join(strings))
    return sorted({len(prefix) for _, _, prefix in rules}), max((host.count(".") + 1 for _, host, _ in rules), default=0)


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


class Rules:
    """The rules' file, mapped into memory."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, np.int64, 1)[0])
        self.keys = np.memmap(path, np.uint64, "r", 8, (n,)) if n else np.empty(0, np.uint64)
        self.offsets = np.memmap(path, np.int64, "r", 8 * (n + 1), (n + 1,))
        self.start = 8 * (2 * n + 2)
        self.bytes = np.memmap(path, np.uint8, "r")

    def find(self, keys: list[str]) -> dict[int, str]:
        """By place in `keys`, the action of each key that is a rule."""
        probes = np.fromiter(map(digest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.keys, probes)
        found = {}
        hit = np.flatnonzero(at < len(self.keys))
        for i in hit[self.keys[at[hit]] == probes[hit]]:
            j = at[i]
            while j < len(self.keys) and self.keys[j] == probes[i]:
                value = bytes(self.bytes[self.start + self.offsets[j] : self.start + self.offsets[j + 1]]).decode()
                if value[1:] == keys[i]:
                    found[int(i)] = ACTIONS[int(value[0])]
                j += 1
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host, lower-cased in ASCII, and path of a url; both empty without `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find(c, end) for c in "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(LOWER), rest[end:stop]


def suffixes(host: str, most: int) -> list[str]:
    """The host and those of its parent domains that have `most` labels at most."""
    labels = host.rsplit(".", most)[-most:] if host and most else []
    return [".".join(labels[i:]) for i in range(len(labels))]


def judged(urls: DataFrame, rules: list[Rule], *, url: str = "url", default: str = "allow", without: list[str] | None = None) -> DataFrame:
    """urls with host, path, the deciding rule (host and path, else null) and the verdict."""
    folder = os.path.realpath(tempfile.mkdtemp(prefix="rules-"))
    name = os.path.basename(folder)
    lengths, most = write_rules(rules, f"{folder}/{name}")
    urls.sparkSession.sparkContext.addFile(f"{folder}/{name}")
    own: list[Rules] = []

    def make(values: list) -> dict[str, list]:
        if not own:
            own.append(Rules(SparkFiles.get(name)))
        parts = [split_url(v) for v in values]
        keys, of = [], []
        for i, (host, path) in enumerate(parts):
            prefixes = [path[:n] for n in lengths if n <= len(path)]
            for suffix in suffixes(host, most):
                for prefix in prefixes:
                    keys.append(suffix + prefix)
                    of.append((i, len(suffix)))
        best: dict[int, tuple[tuple[int, int], str, str]] = {}
        for j, action in own[0].find(keys).items():
            i, host_length = of[j]
            rank = (len(keys[j]), host_length)
            if i not in best or rank > best[i][0]:
                best[i] = (rank, keys[j], action)
        chosen = [best.get(i) for i in range(len(values))]
        return {
            "host": [host for host, _ in parts],
            "path": [path for _, path in parts],
            "rule": [c[1] if c else None for c in chosen],
            "verdict": [c[2] if c else default for c in chosen],
        }

    return add_columns(text_column(urls, url), url, make, FIELDS, without=without or [])
