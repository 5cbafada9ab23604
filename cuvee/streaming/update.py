"""The update run: new observations become a version of the store, checked before it is published, exports included.

One batch is one change of all tables (``versions``): observations and exports by release, releases, unmapped labels,
failures and findings. Readers see the last version or the new one, whole; a run that dies between any two steps publishes
nothing, and a replayed batch is recognised by its stream's name and number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import report, store, versions
from ..schemas import EXCEPTION, FAILURE, OBSERVATION, OBSERVATION_KEY, RELEASE, UNMAPPED, conform

#: Findings of a version's observations and releases.
Check = Callable[[DataFrame, DataFrame], DataFrame]


def load(
    spark: SparkSession, folder: str, observations: DataFrame, releases: DataFrame, unmapped: DataFrame | None = None, failures: DataFrame | None = None,
    check: Check | None = None, refuse: bool = False, applied: tuple[str, int] | None = None, on_step: Callable[[str], None] | None = None,
    beside: dict[str, DataFrame] | None = None,
) -> int | None:
    """Publishes a version of the store at ``folder`` with ``releases`` registered, their observations and unmapped labels
    replaced, and each touched month's winner chosen anew; its number, or None for a batch that it holds already.

    Rows equal in key are taken in order of their ``loaded_at`` if there is such a column, else by their content.
    ``failures`` (release_id, problem) are releases that could not be read: they are recorded, nothing of them is loaded,
    and what an earlier run loaded of them stays; a release that loads is no failure any more. ``check`` sees the version
    before it is published; its findings become the table qa_exceptions. With ``refuse``, a finding of severity fail raises
    ``versions.Unchecked`` and publishes nothing. ``beside`` are further tables of the store, replaced by release. The inputs are read more than once: tables, not long plans."""
    failed = (conform(failures, FAILURE) if failures is not None else spark.createDataFrame([], FAILURE)).where("release_id IS NOT NULL")
    told = observations.withColumn("_at", F.col("loaded_at") if "loaded_at" in observations.columns else F.lit(0))
    new = told.select(*[c.alias(f.name) for c, f in zip(_conformed(told), OBSERVATION, strict=True)], "_at").join(failed, "release_id", "left_anti")
    content = F.xxhash64(*[F.col(c) for c in OBSERVATION.names if c not in ("parsed_at", "fetched_at")])
    known = conform(releases, RELEASE).join(failed, "release_id", "left_anti").withColumn("_order", F.col("version"))

    def work(change: versions.Change) -> None:
        touched = known.select("release_id").union(new.select("release_id")).distinct()
        mine = versions.parts_of(touched, "release_id")
        rows = store.last_by_key(new.withColumn("_order", F.struct("_at", content)), list(OBSERVATION_KEY), "_order").select(OBSERVATION.names)
        change.replace("observations", rows, "release_id", mine)
        old = change.read("releases", RELEASE)
        all_ = store.upsert(old, known, ["release_id"], "_order")
        before = old.join(touched, "release_id", "left_semi").select("report_month")
        month = before.union(known.select("report_month")).distinct().withColumnRenamed("report_month", "_month")
        here = F.col("report_month").eqNullSafe(F.col("_month"))
        rivals = all_.join(F.broadcast(month), here, "left_semi")
        parts = versions.parts_of(rivals, "release_id")
        winners = store.latest_winner(rivals, change.read("observations", OBSERVATION, parts))
        change.replace("releases", all_.join(F.broadcast(month), here, "left_anti").unionByName(winners))
        if unmapped is not None:
            change.replace("unmapped", conform(unmapped, UNMAPPED).join(failed, "release_id", "left_anti"), "release_id", mine)
        for name, d in (beside or {}).items():
            change.replace(name, d.join(failed, "release_id", "left_anti"), "release_id", mine)
        change.replace("failures", failed.distinct(), "release_id", sorted({*mine, *versions.parts_of(failed, "release_id")}))
        found = None
        if check is not None:
            change.on_step("check")
            found = change.replace("qa_exceptions", report.exceptions(check(change.read("observations"), change.read("releases"))))
            if refuse and (bad := found.where("severity = 'fail'").first()):
                raise versions.Unchecked(f"{bad['check_name']} of {bad['release_id']}: {bad['detail']}")
        _export(change, parts)

    return versions.transact(spark, folder, work, applied, on_step=on_step)


def _conformed(d: DataFrame) -> list:
    """The columns of an observation, as ``conform`` makes them."""
    return [F.coalesce(F.when(~F.isnan(c), c), F.lit(None)) if f.dataType.simpleString() == "double" else c for c, f in ((F.col(f.name).cast(f.dataType) if f.name in d.columns else F.lit(None).cast(f.dataType), f) for f in OBSERVATION)]


def _export(change: versions.Change, parts: list[str]) -> None:
    """The named exports as tables of the same version: those that are tables as they are, the others by release (``parts``),
    where a release of a touched month may have become or ceased to be its month's winner."""
    frames = report.exports(change.read("observations", OBSERVATION, parts), change.read("releases", RELEASE), change.read("qa_exceptions", EXCEPTION))
    won = versions.parts_of(change.read("releases", RELEASE).where("is_latest AND release_id IS NOT NULL"), "release_id")
    # an observation's row is exported as it lies, with its whole release
    lent = change.lend("exports/observations", "observations", sorted({*won} & {*parts}), parts)
    for name in report.BALANCES if lent else ("observations", *report.BALANCES):
        change.replace(f"exports/{name}", frames[name].select(OBSERVATION.names), "release_id", parts)
    for name, of in (("observations_all_versions", "observations"), ("releases", "releases"), ("qa_exceptions", "qa_exceptions")):
        change.alias(f"exports/{name}", of)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that keeps its progress at ``checkpoint``; a new checkpoint is a new stream."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def run(spark: SparkSession, landing: str, folder: str, checkpoint: str, check: Check | None = None, refuse: bool = False) -> int:
    """Loads files that are new in ``landing`` (Parquet of observation rows with version and release_datetime); their
    number of batches. A batch that fails leaves the checkpoint where it was and is run again next time."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OBSERVATION) + ", version int, release_datetime timestamp, format_era string"
    done: list[int] = []

    def one(batch: DataFrame, number: int) -> None:
        releases = batch.groupBy("release_id").agg(*[F.max(c).alias(c) for c in ("report_month", "version", "release_datetime", "format_era")])
        load(spark, folder, batch.withColumn("loaded_at", F.col("release_datetime")), releases, check=check, refuse=refuse, applied=(stream_id(spark, checkpoint), number))
        done.append(number)

    stream = spark.readStream.schema(schema).parquet(landing)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)
