"""Structured Streaming versions of four batch behaviours (ST1-ST4).

Sources are file streams over the driver tables; sinks are append-only
Parquet written by ``foreachBatch`` under the session's shared
checkpoint folder, partitioned by batch id so a retried batch overwrites
its own output (exactly-once with the streaming checkpoint). Runs use
``trigger(availableNow=True)``: process what is there, then stop.

* ST1 latest position per flight, ST2 baggage state -- latest event per key
  by (event time, id), kept by ``KeyedState``: a batch is folded to a row a
  key and batches are folded into a snapshot, so the stream holds no state
  between batches. A row that arrives late counts in the number of events
  and never replaces a newer state.
* ST3 engine telemetry -- hourly tumbling windows; each batch appends its
  sums and counts per window and engine, readers add them up, so no row is
  too late for its window and no state is held between batches.
* ST4 rule quarantine -- the §2.13 rule set applied to each micro-batch.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.rules import Rule, apply_rules
from contrail.session import scratch_path
from contrail.sources.fixtures import Fixtures
from contrail.sources.schemas import DRIVER_SCHEMAS, struct
from contrail.streaming.keyed import KeyedState, latest_row


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """File stream over one driver table (directory source, file glob)."""
    return (spark.readStream.schema(struct(DRIVER_SCHEMAS[name]))
            .option("pathGlobFilter", f"{name}*.parquet").option("maxFilesPerTrigger", 1)
            .parquet(sf_dir.rstrip("/") + "/"))


def _run(stream: DataFrame, mode: str, handler, name: str, base: str | None = None) -> str:
    """Run to completion (availableNow). ``base`` names a stable folder so a
    restarted job resumes from its checkpoint; by default each run gets a
    fresh folder under the shared checkpoint directory."""
    spark = stream.sparkSession
    base = base or scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex}")
    q = (stream.writeStream.outputMode(mode).foreachBatch(lambda df, bid: handler(df, bid, base + "/out"))
         .option("checkpointLocation", base + "/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = 0
    for p in q.recentProgress:
        for op in (p.get("stateOperators") or []) if isinstance(p, dict) else (p.stateOperators or []):
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            dropped += n or 0
    LAST_METRICS[name] = {"rows_dropped_by_watermark": dropped, "batches": len(q.recentProgress)}
    return base + "/out"


# per stream name: late rows dropped and batches run in the last availableNow run
LAST_METRICS: dict[str, dict] = {}


def _append_batch(df: DataFrame, bid: int, path: str) -> None:
    # idempotent per batch: a retried batch rewrites only its own partition
    df.withColumn("batch_id", F.lit(bid)).write.mode("overwrite") \
      .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


# ---- ST1 -----------------------------------------------------------------------
_POSITION = latest_row(["vuelo_id"], ["timestamp_utc", "posicion_id"], ["latitud", "longitud", "altitud_pies", "velocidad_nudos"])


def _keyed(rows: DataFrame, fold, name: str, base: str | None) -> DataFrame:
    out = _run(rows, "append", lambda df, bid, path: KeyedState(df.sparkSession, path, fold).absorb(df, bid), name, base)
    state = KeyedState(rows.sparkSession, out, fold).read()
    return rows.sparkSession.createDataFrame([], fold(rows).schema) if state is None else state


def latest_position_stream(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    pos = Fixtures.positions_from(stream_table(spark, sf_dir, "events"))
    rows = pos.select("vuelo_id", "timestamp_utc", "posicion_id", "latitud", "longitud", "altitud_pies", "velocidad_nudos")
    return _keyed(rows, _POSITION, "latest_position", base)


# ---- ST2 -----------------------------------------------------------------------
_BAG = latest_row(["tag_id"], ["timestamp_utc", "baggage_id"], ["evento"], ["eventos"])


def baggage_state_stream(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    bag = Fixtures.baggage_from(stream_table(spark, sf_dir, "events"))
    rows = bag.select("tag_id", "timestamp_utc", "baggage_id", "evento", F.lit(1).cast("long").alias("eventos"))
    return _keyed(rows, _BAG, "baggage_state", base)


# ---- ST3 -----------------------------------------------------------------------
def engine_health_stream(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    ev = stream_table(spark, sf_dir, "events")
    s = Fixtures.sensors_from(ev).withColumn("ts", F.col("timestamp_utc").cast("timestamp"))
    exact = {c: s.schema[c].dataType for c in ("egt_c", "vibration")}

    def parts(df: DataFrame) -> DataFrame:
        sums = [x for c in exact for x in (F.sum(c).alias(c), F.count(c).alias(f"n_{c}"))]
        return (df.groupBy(F.window("ts", "1 hour"), "engine_id").agg(F.count("*").alias("lecturas"), *sums)
                .select(F.col("window.start").cast("timestamp_ntz").alias("ventana_inicio"),
                        F.col("window.end").cast("timestamp_ntz").alias("ventana_fin"), "engine_id", "lecturas",
                        *[x for c in exact for x in (c, f"n_{c}")]))

    out = _run(s, "append", lambda df, bid, path: _append_batch(parts(df), bid, path), "engine_health", base)
    try:
        log = spark.read.parquet(out)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log = spark.createDataFrame([], parts(s).schema)  # no batch produced output
    # each batch's sums and counts are merged, so a row counts in its window however late it came
    mean = lambda c: F.col(c) / F.col(f"n_{c}").cast("decimal(20,0)")
    agg = (log.groupBy("ventana_inicio", "ventana_fin", "engine_id")
           .agg(F.sum("lecturas").alias("lecturas"), *[F.sum(x).alias(x) for c in exact for x in (c, f"n_{c}")])
           .withColumns({n: F.when(F.col(f"n_{c}") > 0, mean(c)).cast(f"decimal({exact[c].precision + 4},{exact[c].scale + 4})")
                         for n, c in (("egt", "egt_c"), ("vib", "vibration"))}))
    return agg.select("ventana_inicio", "ventana_fin", "engine_id", "lecturas",
                      F.round("egt", 4).cast("double").alias("temperatura_promedio"),
                      F.round("vib", 4).cast("double").alias("vibracion_promedio"),
                      # egt/vib are averages of decimals: exact, rounded half up
                      F.when((F.col("vib") > 5) | (F.col("egt") > 900), "REQUIERE_INSPECCION")
                       .otherwise("OPERACION_NORMAL").alias("estado_predictivo"))


# ---- ST4 -----------------------------------------------------------------------
def rule_quarantine_stream(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    li = stream_table(spark, sf_dir, "lineitem")
    r = Fixtures.rule_inputs_from(li).select("registro_id", "load_factor_pct")
    rules = [Rule("M9", (F.col("load_factor_pct") < 0) | (F.col("load_factor_pct") > 100),
                  "LOAD FACTOR INVALIDO: fuera de 0-100")]

    def handle(df: DataFrame, bid: int, path: str) -> None:
        acc, rej, _ = apply_rules(df, rules)
        out = (acc.withColumn("resultado", F.lit("ACCEPTED")).withColumn("regla", F.lit(None).cast("string"))
               .unionByName(rej.drop("mensaje").withColumn("resultado", F.lit("REJECTED"))))
        _append_batch(out, bid, path)

    out = _run(r, "append", handle, "rule_quarantine", base)
    return spark.read.parquet(out).drop("batch_id")
