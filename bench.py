"""Time the headline operators and print one JSON line.

The stand-in entities are loaded once as the snapshots of a day, outside the timing, so that the operators are
timed and not the making of their input. Planning, with the counting and measuring jobs that it
runs, and the run itself are timed apart; `queries` has their sum.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import joins, stage, star
from salesmart.operators.conform import conform_entity
from salesmart.operators.skew import SALTED
from salesmart.plans.star import scan_entities, ways_to_join
from salesmart.schemas import ENTITIES, JOIN_KEYS
from salesmart.session import prepare
from salesmart.sources.gold import write_gold
from salesmart.sources.snapshots import write_snapshot
from verification.standins import Standins

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

Tables = dict[str, DataFrame]

HEADLINE: dict[str, Callable[[Tables], DataFrame]] = {
    "stage_join": lambda t: joins.stage_join(**t, how=ways_to_join(t)),
    "conform_stage": lambda t: stage.conformed_stage(**t, how=ways_to_join(t)),
    "keys_wide": lambda t: stage.wide_stage(**t, how=ways_to_join(t)),
    "keys_narrow": lambda t: stage.narrow_stage(**t, how=ways_to_join(t)),
    "dim_tempo": lambda t: star.dim_tempo(t["vendas"]),
    "dim_clientes": lambda t: star.dim_clientes(t["vendas"], t["clientes"], how=ways_to_join(t)),
    "dim_localidade": lambda t: star.dim_localidade(t["vendas"], t["clientes"], t["endereco"], how=ways_to_join(t)),
    "dim_cliente_division": lambda t: star.dim_cliente_division(
        t["vendas"], t["clientes"], t["divisao"], how=ways_to_join(t)
    ),
    "dim_clientes_wide": lambda t: star.dim_clientes_wide(**t, how=ways_to_join(t)),
    "dim_row_count": lambda t: star.dim_row_count(**t),
    "ft_vendas": lambda t: star.ft_vendas(t["vendas"]),
    "export_vendas": lambda t: conform_entity(t["vendas"], ENTITIES["vendas"], dt.date(2024, 1, 2)),
    "keys_wide_salted": lambda t: stage.wide_stage(**t, how=ways_to_join(t, SALTED)),
}


def written(spark: SparkSession, folder: str) -> Tables:
    """The stand-in entities loaded as a day, the sales in as many files as there are cores."""
    for name, df in Standins(spark, SF_DIR).all.items():
        files = df.repartition(int(CPUS)) if name == "vendas" else df
        write_snapshot(files, f"{folder}/{name}", dt.date(2024, 1, 2), JOIN_KEYS[name])
    return scan_entities(spark, folder)


def timed(name: str, tables: Tables, folder: str) -> tuple[float, float]:
    """Seconds to plan an operator, and to work out all its rows, which are then thrown away;
    an export is written out."""
    start = time.perf_counter()
    df = HEADLINE[name](tables)
    planned = time.perf_counter()
    if name.startswith("export"):
        write_gold(df, f"{folder}/gold")
    else:
        df.write.format("noop").mode("overwrite").save()
    return planned - start, time.perf_counter() - planned


def main() -> None:
    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("salesmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.files.maxPartitionBytes", "8m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    build, run = {}, {}
    with tempfile.TemporaryDirectory(prefix="salesmart-bench-") as folder:
        tables = written(spark, folder)
        for name in HEADLINE:
            times = [timed(name, tables, folder) for _ in range(RUNS)]
            build[name] = round(statistics.median(t[0] for t in times), 3)
            run[name] = round(statistics.median(t[1] for t in times), 3)
        spark.stop()
    queries = {name: round(build[name] + run[name], 3) for name in HEADLINE}
    result = {
        "metric": "sum of median operator times",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "build": build,
        "run": run,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "runs": RUNS,
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
