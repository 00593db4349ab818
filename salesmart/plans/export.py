"""Snapshots to cleaned gold files, entity by entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from salesmart.operators.conform import conform_counting, parsed_columns, reject_rows
from salesmart.schemas import ENTITIES
from salesmart.session import prepare
from salesmart.sources.gold import write_gold
from salesmart.sources.published import Load
from salesmart.sources.snapshots import LATEST, scan_staged


@dataclass(frozen=True)
class Export:
    """A published gold table, and for each number or date column how many values were none."""

    load: Load
    rejects: Mapping[str, int]


def export_entity(
    spark: SparkSession,
    entity: str,
    stage_path: str,
    gold_path: str,
    run_date: dt.date,
    dt_foto: str = LATEST,
    iso_dates: bool = False,
    rejects_path: str | None = None,
    compression: str | None = None,
) -> Export:
    """Clean one entity and write it as gold.

    Values that are no number or date come out as NULL. They are counted while the rows are
    written, in the same scan. With `rejects_path` the rows that have any are written there as
    they arrived, with the names of the columns; that takes a second scan, of which there is none
    where the first has found nothing. Files are plain text, or compressed as asked.
    """
    schema = ENTITIES[entity]
    staged = scan_staged(prepare(spark), stage_path, schema, dt_foto)
    cleaned, seen = conform_counting(staged, schema, run_date, iso_dates)
    load = write_gold(cleaned, gold_path, compression=compression)
    rejects = dict(seen.get) if parsed_columns(schema) else {}
    if rejects_path is not None:
        bad = reject_rows(staged, schema, iso_dates)
        some = bad if any(rejects.values()) else bad.limit(0)
        write_gold(some, rejects_path, keep_blanks=True, compression=compression)
    return Export(load, rejects)


def export_entities(
    spark: SparkSession,
    stage_dir: str,
    gold_dir: str,
    run_date: dt.date,
    entities: Iterable[str] = ENTITIES,
    dt_foto: str = LATEST,
    iso_dates: bool = False,
    rejects_dir: str | None = None,
    compression: str | None = None,
) -> dict[str, Export]:
    return {
        entity: export_entity(
            spark,
            entity,
            f"{stage_dir}/{entity}",
            f"{gold_dir}/{entity}",
            run_date,
            dt_foto,
            iso_dates,
            f"{rejects_dir}/{entity}" if rejects_dir else None,
            compression,
        )
        for entity in entities
    }
