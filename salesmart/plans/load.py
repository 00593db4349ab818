"""Raw text to daily snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from salesmart.schemas import ENTITIES, JOIN_KEYS, data_columns
from salesmart.session import prepare
from salesmart.sources.published import Load
from salesmart.sources.raw import check_columns, file_headers, headers_differ, scan_by_header, scan_raw, schema_from_header
from salesmart.sources.snapshots import write_snapshot


def load_entity(
    spark: SparkSession, entity: str, raw_path: str | Sequence[str], stage_path: str, run_date: dt.date
) -> Load:
    """Load one entity's raw files as the snapshot of the day before the run.

    A file's header says where its columns are. All declared columns must be there; others are
    left out with a warning. The files are scanned as if all headers were alike, which the scan
    checks; only if it finds another are the headers of all files gathered and each file read by
    its own. Nothing is published before all files are read. Running it again for the same day
    replaces that day, by nothing if the files hold no rows.
    """
    spark = prepare(spark)
    declared = data_columns(ENTITIES[entity])
    keys = JOIN_KEYS[entity]
    found = schema_from_header(spark, raw_path)
    try:
        check_columns(found, declared, str(raw_path))
        return write_snapshot(scan_raw(spark, raw_path, found).select(*declared), stage_path, run_date, keys)
    except Exception as error:  # a failed job's error has no narrower class that all sessions share
        if not isinstance(error, ValueError) and not headers_differ(error):
            raise
        headers = file_headers(spark, raw_path)
        if len(headers) < 2:
            raise
        return write_snapshot(scan_by_header(spark, raw_path, declared, headers), stage_path, run_date, keys)


def load_entities(
    spark: SparkSession,
    raw_dir: str,
    stage_dir: str,
    run_date: dt.date,
    entities: Iterable[str] = ENTITIES,
) -> None:
    for entity in entities:
        load_entity(spark, entity, f"{raw_dir}/{entity}", f"{stage_dir}/{entity}", run_date)
