"""Incremental load of arriving sales files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.plans.sales_load import load_sales, marked_processed, unreadable_lines
from tillspark.schemas import SALES_EXTRACT
from tillspark.sources.extracts import CORRUPT, SALES_FILES, CorruptExtractError, as_sales_raw, count_corrupt, read_files, stream_files
from tillspark.sources.warehouse import Warehouse


def load_arrivals(
    warehouse: Warehouse,
    folder: str,
    checkpoint: str,
    as_of: dt.date,
    stream_name: str,
    pattern: str = SALES_FILES,
    reject_invalid: bool = False,
) -> None:
    """Load all files that arrived since the last call, each exactly once, and return.

    The checkpoint remembers the files.  A micro-batch that is replayed after a
    failure writes the same batch folder again, and lines loaded by earlier
    batches are left out.  A new checkpoint needs a new ``stream_name``.

    Columns are found by name.  Lines that do not fit the schema stop the
    batch before anything of it is loaded; ``reject_invalid`` logs them as
    rejects, with their text, and loads the others.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        files = sorted(r["path"] for r in batch.collect())
        lines, more = read_files(warehouse.spark, files, SALES_EXTRACT), None
        if reject_invalid:
            # Written once, so that good and corrupt lines come from the same read.
            lines = warehouse.staged(f"Arrivals-{stream_name}", lines)
            corrupt = lines.filter(F.col(CORRUPT).isNotNull())
            staged = warehouse.replace("SalesRaw", as_sales_raw(lines.filter(F.col(CORRUPT).isNull())))
            more = None if corrupt.isEmpty() else unreadable_lines(corrupt, CORRUPT, as_of)
        else:
            # Counted while staging is written, which is published only without any.
            counted, unreadable = count_corrupt(lines)

            def check() -> None:
                if unreadable():
                    example = lines.filter(F.col(CORRUPT).isNotNull()).first()[CORRUPT]
                    raise CorruptExtractError(f"{unreadable()} lines do not fit the schema, for example {example}")

            staged = warehouse.replace("SalesRaw", as_sales_raw(counted), check)
        load_sales(warehouse, staged, as_of, f"{stream_name}-{epoch:08d}", reject_invalid, more)
        warehouse.replace("SalesRaw", marked_processed(staged, as_of))

    query = (
        stream_files(warehouse.spark, folder, pattern)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
