"""Performance and energy reports over all machines at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import kpis
from millrace.operators import affinity as aff
from millrace.operators import clustering, metrics
from millrace.operators.density import DensityClustering
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.scaling import Scaler
from millrace.operators.state import energy_per_unit_asof, latest_of, latest_state
from millrace.plans.anomalies import peak_ratio
from millrace.session import written

PERFORMANCE = ["time_per_unit", "defect_pct", "affinity"]
ENERGY = ["energy_per_unit", "power_kw", "temperature_c"]
PROFILE_PERFORMANCE = ["time_per_unit", "defect_rate"]
PROFILE_ENERGY = ["power_kw", "temperature_c", "vibration_mm_s"]
HOURLY = ["hour", "temperature_c", "vibration_mm_s"]
TIERS = ["high", "average", "low"]
MIN_SAMPLES = 10


def performance_state(mes: DataFrame, affinity: DataFrame) -> DataFrame:
    """Per machine: ratios of its latest production row and the affinity with that row's operator."""
    row = F.struct("ts", "operator_id", "units_produced", "defective_units", "production_time_min")
    latest = mes.groupBy("machine_id").agg(F.max_by(row, F.struct("ts", "event_id")).alias("r"))
    rows = latest.select("machine_id", "r.*").withColumns({
        "time_per_unit": kpis.time_per_unit(), "defect_pct": kpis.defect_pct(),
    })
    return aff.lookup(rows, affinity).select("machine_id", "ts", "operator_id", *PERFORMANCE)


def latest_energy_per_unit(rows: DataFrame) -> DataFrame:
    """Per machine: its last power reading over the units last known at that time, if above zero."""
    return energy_per_unit_asof(rows).groupBy("machine_id").agg(latest_of("energy_per_unit"))


def energy_state(rows: DataFrame) -> DataFrame:
    """Per machine: energy per unit, power and temperature as last known."""
    latest = latest_state(rows, ("power_kw", "temperature_c")).select("machine_id", "power_kw", "temperature_c")
    return latest.join(latest_energy_per_unit(rows), "machine_id").select("machine_id", *ENERGY)


def performance_cluster(state: DataFrame, centres: clustering.Centres) -> DataFrame:
    placed = clustering.assign(state.na.drop(subset=PERFORMANCE), PERFORMANCE, centres)
    centre = clustering.centre_column(centres, F.col("cluster"))
    return placed.select(
        "machine_id", "cluster", *[F.get(centre, F.lit(i)).alias(f"centre_{c}") for i, c in enumerate(PERFORMANCE)]
    )


def energy_cluster(state: DataFrame, scaler: Scaler, model: DensityClustering) -> DataFrame:
    """Each machine's energy features, the cluster of the history they fall in, and whether in none."""
    labels = model.near_core(scaler.transform(state), "machine_id")
    return state.join(labels, "machine_id").select(
        "machine_id", *ENERGY, (F.col("label") == -1).alias("is_anomaly"), F.col("label").alias("energy_cluster")
    )


def optimal_pairings(mes: DataFrame, affinity: DataFrame) -> DataFrame:
    return aff.ranked(aff.lookup(aff.operators_of(mes).select(*aff.PAIR), affinity))


def energy_efficiency(rows: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Energy per unit (last), peak over mean power and 1 / energy per unit."""
    joined = latest_energy_per_unit(rows).where("energy_per_unit is not null").join(peak_ratio(rows, missing_as_zero), "machine_id")
    score = F.try_divide(F.lit(1.0), F.col("energy_per_unit"))
    return joined.select("machine_id", "energy_per_unit", "peak_ratio", score.alias("efficiency_score"))


def performance_analysis(mes: DataFrame, affinity: DataFrame, centres: clustering.Centres) -> DataFrame:
    """Tier, centre, three best operators and the gap to the next tier of each machine.

    ``centres`` come in tier order (best first).
    """
    state = performance_state(mes, affinity).na.drop(subset=PERFORMANCE)
    placed = clustering.assign(state, PERFORMANCE, centres)
    own = clustering.centre_column(centres, F.col("cluster"))
    better = clustering.centre_column(centres, F.when(F.col("cluster") > 0, F.col("cluster") - 1))
    names = F.array(*[F.lit(t) for t in TIERS[: len(centres)]])
    top = aff.ranked(aff.lookup(aff.operators_of(mes).select(*aff.PAIR), affinity), top=3)
    entry = F.concat(F.col("operator_id").cast("string"), F.lit(":"), F.round("affinity", 4).cast("string"))
    top = top.groupBy("machine_id").agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("text")))).alias("t"))
    top = top.select("machine_id", F.array_join(F.transform("t", lambda e: e["text"]), ",").alias("top_operators"))
    return placed.join(top, "machine_id", "left").select(
        "machine_id", F.get(names, F.col("cluster")).alias("tier"), *PERFORMANCE,
        F.get(own, F.lit(0)).alias("centre_time_per_unit"), F.get(own, F.lit(1)).alias("centre_defect_pct"),
        "top_operators", F.get(names, F.when(F.col("cluster") > 0, F.col("cluster") - 1)).alias("target_tier"),
        (F.get(own, F.lit(0)) - F.get(better, F.lit(0))).alias("time_gap"),
        (F.get(own, F.lit(1)) - F.get(better, F.lit(1))).alias("defect_gap"),
    )


def future_hours(rows: DataFrame, anchor: str, hours: int) -> DataFrame:
    """Each row once per hour ahead of ``anchor``: ``hours_ahead``, ``forecast_ts``, ``hour``."""
    ahead = rows.withColumn("hours_ahead", F.explode(F.sequence(F.lit(1), F.lit(hours))))
    at = F.lit(anchor).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hours_ahead"))
    return ahead.withColumn("forecast_ts", at).withColumn("hour", F.hour("forecast_ts"))


def performance_trend(mes: DataFrame, affinity: DataFrame, centres: clustering.Centres, anchor: str, hours: int = 24) -> DataFrame:
    """Expected time per unit and defect rate of each operator and machine for each hour ahead."""
    state = performance_state(mes, affinity).select("machine_id", "time_per_unit", "defect_pct")
    pairs = affinity.join(state, "machine_id").na.drop(subset=PERFORMANCE)
    placed = clustering.assign(pairs, PERFORMANCE, centres)
    centre = clustering.centre_column(centres, F.col("cluster"))
    return future_hours(placed, anchor, hours).select(
        "machine_id", "operator_id", "hours_ahead", "forecast_ts", "hour", "cluster",
        F.get(centre, F.lit(0)).alias("predicted_time_per_unit"), F.get(centre, F.lit(1)).alias("predicted_defect_pct"),
    )


def hourly_history(aligned: DataFrame) -> DataFrame:
    """Aligned sensor and power rows with the hour of day; rows with a missing value drop."""
    rows = aligned.withColumn("hour", F.hour("ts").cast("double"))
    return rows.select("machine_id", *HOURLY, "power_kw").na.drop()


def machine_scales(history: DataFrame) -> DataFrame:
    return clustering.keyed_scaler(history, "machine_id", HOURLY).where(F.col("samples") >= MIN_SAMPLES)


def scaled_history(history: DataFrame) -> DataFrame:
    """History with each machine's own scaling as ``x``; machines with under ten rows drop."""
    joined = history.join(written(machine_scales(history), "scales"), "machine_id")
    return joined.select("machine_id", "power_kw", clustering.standardised(HOURLY).alias("x"))


def energy_forecast(
    history: DataFrame, latest: DataFrame, centres: DataFrame, points: DataFrame, anchor: str, hours: int = 24
) -> DataFrame:
    """Median power and its 10-90 % band per machine and hour ahead, by the cluster the hour falls in.

    ``centres`` holds one array of centres per machine (in the machine's own scale) and ``points``
    the scaled history; the latest temperature and vibration stand for the future ones.
    """
    placed = points.join(centres, "machine_id").select(
        "machine_id", "power_kw", clustering.closest(F.col("x"), F.col("centres")).alias("cluster")
    )
    stats = exact_quantiles(placed, ["machine_id", "cluster"], "power_kw", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    scaler = machine_scales(history)
    now = latest.select(
        "machine_id", F.coalesce("temperature_c", F.lit(25.0)).alias("temperature_c"),
        F.coalesce("vibration_mm_s", F.lit(0.0)).alias("vibration_mm_s"),
    )
    ahead = future_hours(now.join(scaler, "machine_id").join(centres, "machine_id"), anchor, hours)
    ahead = ahead.withColumn("cluster", clustering.closest(clustering.standardised(HOURLY), F.col("centres")))
    found = ahead.join(stats, ["machine_id", "cluster"], "left")
    return found.select(
        "machine_id", "hours_ahead", "forecast_ts", "cluster", "samples",
        F.coalesce("p50", F.lit(0.0)).alias("predicted_kw"), F.coalesce("p10", F.lit(0.0)).alias("lower_kw"),
        F.coalesce("p90", F.lit(0.0)).alias("upper_kw"),
    )


def cluster_quality(rows: DataFrame, features: Sequence[str], linear: bool = False) -> DataFrame:
    """One row: silhouette, Davies-Bouldin, Calinski-Harabasz and the noise share of labelled rows.

    ``linear`` takes the silhouette under squared distance, whose cost grows with the rows only.
    """
    outline = (metrics.silhouette_squared if linear else metrics.silhouette)(rows, features)
    parts = [
        outline.toDF("silhouette"), metrics.davies_bouldin(rows, features).select("davies_bouldin"),
        metrics.calinski_harabasz(rows, features).select("calinski_harabasz"), metrics.noise_share(rows),
    ]
    # Each part is one row; scalar subqueries put them side by side.
    return parts[0].select(
        "silhouette", *[p.scalar().alias(p.columns[0]) for p in parts[1:]]
    )


# Metric names and wording of the trends.
def drift(training: DataFrame, current: DataFrame, energy: bool = False) -> DataFrame:
    """Rows (metric, value, training value, change, trend, interpretation) of two quality rows."""
    both = current.select(
        *[F.col(c).alias(c) for c in current.columns],
        *[training.select(c).scalar().alias(f"t_{c}") for c in ("silhouette", "davies_bouldin", "noise_share")],
    )

    def line(name: str, c: str, text: Column, rising: str, falling: str) -> Column:
        value, old = F.col(c), F.col(f"t_{c}")
        return F.struct(
            F.lit(name).alias("metric"), value.alias("value"), old.alias("training_value"), F.abs(value - old).alias("change"),
            metrics.trend(value, old, rising, falling).alias("trend"), text.alias("interpretation"),
        )

    lines = [line("Cluster Separation", "silhouette", metrics.interpret_silhouette(F.col("silhouette")), "improving", "declining")]
    if energy:
        lines.append(line("Anomaly Rate", "noise_share", metrics.interpret_noise(F.col("noise_share")), "increasing", "decreasing"))
    else:
        text = metrics.interpret_davies_bouldin(F.col("davies_bouldin"))
        lines.append(line("Cluster Compactness", "davies_bouldin", text, "declining", "improving"))
    return both.select(F.inline(F.array(*lines)))


def health(quality: DataFrame, energy: bool = False) -> DataFrame:
    noise = F.col("noise_share") if energy else None
    score = metrics.health_score(F.col("silhouette"), F.col("davies_bouldin"), noise)
    return quality.select(score.alias("health_score"), metrics.health_grade(score).alias("health_status"))
