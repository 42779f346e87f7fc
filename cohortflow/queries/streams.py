"""Streaming forms over the events, run to the end of what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from cohortflow.queries import planning
from cohortflow.queries.lab_tables import text
from cohortflow.queries.planning import FOLDERS, ROOT
from cohortflow.queries.registry import query, table
from cohortflow.session import scratch_path
from cohortflow.streaming import discovery, restriction


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # A pattern, because a stream source takes a folder of files but no single file by name.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def event_arrivals(spark, sf_dir, drain: Callable) -> None:
    """Let the events arrive in three goes: the last ones first, then the rest, then all once more.

    After each go ``drain`` is given the stream of all files and the number of the go, and runs it to the end of what is there.
    """
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "arrivals")
    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    for number, part in enumerate((events.filter(late), events.filter(~late), events)):
        part.write.mode("append").parquet(path)
        drain(spark.readStream.schema(events.schema).parquet(path), number)


def feed(stream, write: Callable, path: str) -> None:
    """Give each batch of a stream to ``write`` until all that has arrived is done."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/state")
    writer.trigger(availableNow=True).start().awaitTermination()


def drain(stream, label):
    """Run a stream over all that has arrived and read what it wrote."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query(
    "stream_runs",
    """SELECT DISTINCT t.code AS analysis_type, cast(user_id AS varchar) AS run_id
       FROM events JOIN (VALUES ('click', 'TF'), ('click', 'TM'), ('view', 'SG'),
            ('purchase', 'RP'), ('error', 'BL'), ('signup', 'YC')) t(kind, code) ON event_type = kind
       WHERE value >= 5""",
)
def stream_runs(spark, sf_dir):
    name = F.concat(text("event_id"), F.when(F.col("value") < 5, ".bam.bai").otherwise(".bam"))
    folder = planning.case("event_type", FOLDERS)
    path = scratch_path(spark, "runs")

    def drain(stream, number):
        listing = stream.select(
            F.concat_ws("/", F.lit(ROOT), folder, text("user_id"), name).alias("path"),
            F.col("ts").alias("modificationTime"),
        )
        runs = discovery.runs_once(discovery.arrivals_from_files(listing, ROOT))
        discovery.report_runs(runs, f"{path}/rows", f"{path}/state").awaitTermination()

    event_arrivals(spark, sf_dir, drain)
    found = spark.read.schema("folder string, run_id string").parquet(f"{path}/rows")
    return discovery.with_types(found).select("analysis_type", "run_id")


@query(
    "stream_scrub",
    """SELECT event_id, 'U' || user_id AS sample FROM events
       WHERE user_id NOT IN (SELECT o_custkey FROM orders
                             WHERE o_orderstatus = 'P' AND o_totalprice > 400000)""",
)
def stream_scrub(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 400000")
    marked = orders.select(F.concat(F.lit("U"), text("o_custkey"), F.lit(".A1")).alias("id"))
    samples = event_stream(spark, sf_dir).select(
        "event_id", F.concat(F.lit("U"), text("user_id")).alias("sample")
    )
    return drain(restriction.scrub_stream(samples, marked, "sample"), "scrubbed")


@query(
    "stream_scrub_late",
    """SELECT event_id, 'U' || user_id AS sample FROM events
       WHERE NOT (user_id % 3 = 0) AND NOT (user_id % 3 = 1 AND ts < TIMESTAMP '2024-01-20')
       UNION ALL
       SELECT event_id, 'U' || user_id FROM events WHERE NOT (user_id % 3 IN (0, 1))""",
)
def stream_scrub_late(spark, sf_dir):
    """Marks that come between the goes: a third of the users before the first, another before the second."""
    path = scratch_path(spark, "scrubbed-late")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    listed = F.concat(F.lit("U"), text("user_id"), F.lit("_ss.A0101")).alias("id")

    def mark(rest):
        users.filter(F.col("user_id") % 3 == rest).select(listed).write.mode("append").parquet(f"{path}/marks")

    mark(0)
    scrubbed = restriction.scrub_batches(lambda: spark.read.parquet(f"{path}/marks"), "sample", f"{path}/rows")

    def drain(stream, number):
        if number == 1:
            mark(1)
        samples = stream.select("event_id", F.concat(F.lit("U"), text("user_id")).alias("sample"))
        feed(samples, scrubbed, path)

    event_arrivals(spark, sf_dir, drain)
    return spark.read.parquet(f"{path}/rows").select("event_id", "sample")
