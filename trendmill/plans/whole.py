"""Feeds, silver, gold and enrichment in one call, with a row for each step."""

import time

from pyspark.sql import functions as F

from trendmill.plans import refresh
from trendmill.sources import catalog

#: Columns of a run's log, as ``plans.analytics.run_report`` and ``run_totals`` read them.
RUN_LOG = "step string, status string, result string, duration double"
_LONGEST = 500


def whole_run(spark, feeds, root, database, batch, now, first, last, enrich=None):
    """Runs all steps on what is new and returns their log: ``step``, ``status``, ``result``, ``duration``.

    ``feeds`` has the bronze rows of each source, or a function that gives them. Tables lie below ``root``; gold
    tables for the closed range of days and enriched signals can be read by their names in ``database``
    afterwards. ``enrich`` names further arguments of ``refresh_enriched`` (scorer, model, clock,
    batches). ``result`` is the number of rows, or the error of a step that FAILED. A feed that fails holds
    nothing else up, it is only read by a later run. What reads a table whose refresh failed is SKIPPED.
    Every step may be repeated, so a run that broke off is run again under the same ``batch``.
    """
    path = lambda name: f"{root.rstrip('/')}/{name}"
    log, failed = [], set()

    def step(name, function, needs=None):
        if needs in failed:
            failed.add(name)
            log.append((name, "SKIPPED", f"{needs} has no new state", 0.0))
            return
        begun = time.monotonic()
        try:
            status, result = "SUCCESS", str(function())
        except Exception as error:  # noqa: BLE001, the log says what happened and the others go on
            failed.add(name)
            status, result = "FAILED", f"{type(error).__name__}: {error}"[:_LONGEST]
        log.append((name, status, result, time.monotonic() - begun))

    def landed(source, rows):
        return refresh.ingest(
            spark, source, rows() if callable(rows) else rows, path(f"bronze/{source}"), path("checks"),
            path("checkpoints"), batch, now,
        )

    def silver():
        paths = {source: path(f"bronze/{source}") for source in refresh.BRONZE}
        found = refresh.refresh_silver(spark, paths, path("silver"), path("marks"), path("quality"), now)
        return sum(found.values())

    def gold():
        catalog.create_databases(spark, [database])
        tables = refresh.refresh_gold(spark, path("silver"), path("gold"), first, last, now)
        for name, rows in tables.items():
            # A table without a day yet has no files that Spark could take its columns from.
            if rows.take(1):
                catalog.publish(spark, f"{database}.{name}", path(f"gold/{name}"))
        return tables["source_summary"].agg(F.coalesce(F.sum("signal_count"), F.lit(0))).first()[0]

    def enriched():
        catalog.create_databases(spark, [database])
        refresh.refresh_enriched(spark, path("silver"), path("answers"), path("enriched"), **enrich)
        return catalog.publish(spark, f"{database}.enriched_signals", path("enriched")).count()

    for source, rows in feeds.items():
        step(f"ingest {source}", lambda source=source, rows=rows: landed(source, rows))
    step("silver", silver)
    step("gold", gold, needs="silver")
    if enrich is not None:
        step("enrichment", enriched, needs="silver")
    return spark.createDataFrame(log, RUN_LOG)
