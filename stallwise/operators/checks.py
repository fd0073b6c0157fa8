"""Quality checks over whole tables, the alerts they raise and the health score.

Each check reads every row and ends in one row per table or one row in all: partial sums in the map tasks, no
sampling and no caps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality
from stallwise.operators import dedup, ingest
from stallwise.plans.views import average_of_parts, days_before, exact_avg, part_sums, since


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _any_data(n: Column, status: Column) -> Column:
    return F.when(n == 0, "NO_DATA").otherwise(status)


def data_quality(scores: DataFrame) -> DataFrame:
    high = F.count_if(F.col("overall_score") >= schemas.MIN_OVERALL_SCORE)
    n = F.count("*")
    rate = (n - high) / F.nullif(n, F.lit(0))
    return scores.agg(
        _any_data(n, F.when(rate <= schemas.LOW_QUALITY_RATE_LIMIT, "PASS").otherwise("FAIL")).alias("status"),
        n.alias("total_records"), high.alias("high_quality_records"), (n - high).alias("low_quality_records"),
        rate.alias("low_quality_rate"),
        exact_avg("overall_score").alias("avg_overall_score"),
        exact_avg("completeness_score").alias("avg_completeness_score"),
        exact_avg("accuracy_score").alias("avg_accuracy_score"),
        exact_avg("consistency_score").alias("avg_consistency_score"),
    )


def profiles(
    tables: dict[str, DataFrame], as_of: Column, hours: int = schemas.STALE_HOURS, whole: bool = False
) -> DataFrame:
    """One row per table with the counts behind the checks: one pass over each table.

    With `whole` also what the quality and duplicate checks need: score figures and the number of distinct signatures.
    Rows are then scored on the way and reduced to a few numbers each before they are grouped by signature.
    """
    threshold = as_of - F.make_dt_interval(hours=F.lit(hours))

    def one(name: str, df: DataFrame) -> DataFrame:
        def filled(field) -> Column:
            held = F.col(field.name).isNotNull()
            held = held & (F.col(field.name) != "") if field.dataType.simpleString() == "string" else held
            return F.coalesce(held, F.lit(False)).cast("int")

        fields = df.schema.fields
        # A bit per expected site, so the set stays small whatever the column holds.
        site_bits = reduce(lambda a, b: a + b, [F.when(F.col("site") == s, 1 << i).otherwise(0) for i, s in enumerate(schemas.SITES)])
        rows = df.withColumns({
            "_filled": reduce(lambda a, b: a + b, [filled(f) for f in fields]),
            "_recent": F.coalesce(F.col("scraped_at") > threshold, F.lit(False)).cast("int"), "_sites": site_bits,
        })
        figures = [
            F.lit(name).alias("table"), F.count("*").alias("records"), F.lit(len(fields)).alias("fields"),
            F.coalesce(F.sum("_filled"), F.lit(0)).alias("filled"), F.coalesce(F.sum("_recent"), F.lit(0)).alias("recent"),
            F.filter(F.array(*[
                F.when(F.coalesce(F.bit_or("_sites"), F.lit(0)).bitwiseAND(F.lit(1 << i)) > 0, F.lit(s)) for i, s in enumerate(schemas.SITES)
            ]), lambda s: s.isNotNull()).alias("sites"),
        ]
        if whole:
            rows = rows.withColumn("_signature", dedup.signature_hash(name, as_of))
            rows = quality.with_scores(ingest.parse_json_columns(rows, name), name, as_of)
            rows = rows.select("_filled", "_recent", "_sites", "_signature", "overall_score")
            figures += [
                F.count_if(F.col("overall_score") >= schemas.MIN_OVERALL_SCORE).alias("high"), *part_sums("overall_score", "overall"),
                F.count_distinct("_signature").alias("distinct_rows"),
            ]
        return rows.agg(*figures)

    return _union([one(name, df) for name, df in tables.items()])


def _rate(part: str, whole: Column) -> Column:
    return F.col(part) / F.nullif(whole, F.lit(0))


def _completeness() -> tuple[Column, Column]:
    """(figure, status) of a table; whole counts, so the mean is exact."""
    mean = _rate("filled", F.col("records") * F.col("fields"))
    return mean, _any_data(F.col("records"), F.when(mean >= schemas.MIN_TABLE_COMPLETENESS, "PASS").otherwise("FAIL"))


def _freshness() -> tuple[Column, Column]:
    rate = _rate("recent", F.col("records"))
    return rate, _any_data(F.col("records"), F.when(rate > 0.5, "PASS").otherwise("STALE"))


def _coverage() -> tuple[Column, Column]:
    """Expected sites that a table lacks; an empty table counts as covered."""
    expected = F.array(*[F.lit(s) for s in schemas.SITES])
    missing = F.when(F.col("records") == 0, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_except(expected, "sites")))
    return F.array_join(missing, ","), F.when(F.size(missing) == 0, "PASS").otherwise("PARTIAL")


def _duplication() -> tuple[Column, Column]:
    rate = (F.col("records") - F.col("distinct_rows")) / F.nullif(F.col("records"), F.lit(0))
    return rate, _any_data(F.col("records"), F.when(rate > schemas.DUPLICATE_RATE_LIMIT, "FAIL").otherwise("PASS"))


def completeness(profile: DataFrame) -> DataFrame:
    """Share of fields that are neither NULL nor '' per table."""
    mean, status = _completeness()
    return profile.select("table", mean.alias("avg_completeness"), F.col("records").alias("records_checked"), status.alias("status"))


def freshness(profile: DataFrame) -> DataFrame:
    rate, status = _freshness()
    return profile.select(
        "table", rate.alias("freshness_rate"), F.col("recent").alias("recent_records"), F.col("records").alias("total_checked"), status.alias("status")
    )


def site_coverage(profile: DataFrame) -> DataFrame:
    missing, status = _coverage()
    return profile.select("table", "records", missing.alias("missing_sites"), status.alias("status"))


def duplicate_rate(tables: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table"), F.count("*").alias("records"),
            F.countDistinct(dedup.signature_hash(name, as_of)).alias("distinct_rows"),
        )

    return _duplicates(_union([one(name, df) for name, df in tables.items()]))


def _duplicates(profile: DataFrame) -> DataFrame:
    rate, status = _duplication()
    return profile.select(
        "table", "records", (F.col("records") - F.col("distinct_rows")).alias("duplicates"), rate.alias("duplicate_rate"), status.alias("status"),
        F.coalesce(rate <= schemas.DUPLICATE_RATE_TARGET, F.lit(True)).alias("within_target"),
    )


def missing_sites(df: DataFrame) -> DataFrame:
    """Expected sites without any row."""
    expected = df.sparkSession.createDataFrame([(s,) for s in schemas.SITES], "site string")
    return expected.join(df.select("site").distinct(), "site", "left_anti")


def processing_health(jobs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = jobs.filter(since(jobs, "created_at", days_before(as_of, days)))
    done, failed = (F.count_if(F.col("status") == s) for s in ("completed", "failed"))
    finished = F.nullif(done + failed, F.lit(0))
    failure_share = F.coalesce(failed / finished, F.lit(0.0))
    return recent.agg(
        F.when(failure_share > schemas.JOB_FAILURE_LIMIT, "FAIL").otherwise("PASS").alias("status"),
        (done / finished).alias("job_success_rate"),
        F.count_if(F.col("status") == "running").alias("active_jobs"),
        F.count_if(F.col("status") == "pending").alias("queue_size"),
    )


def job_status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("site", "status").agg(F.count("*").alias("jobs"))


def run_checks(profile: DataFrame, jobs: DataFrame, jobs_as_of: Column) -> DataFrame:
    """All checks as rows (check, status, measure): the measure is the figure that decides the status.

    `profile` is that of `profiles(..., whole=True)`: a row per table, from which every check is read at once.
    """
    def all_pass(ok: list[str], status: Column, bad: str) -> Column:
        return F.when(F.bool_and(status.isin(ok)), "PASS").otherwise(bad)

    def check(name: str, status: Column, measure: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), status.alias("status"), measure.cast("double").alias("measure"))

    complete, complete_status = _completeness()
    fresh, fresh_status = _freshness()
    copies, copies_status = _duplication()
    _, covered = _coverage()
    n, high = F.sum("records"), F.sum("high")
    low_rate = (n - high) / F.nullif(n, F.lit(0))
    partial = F.count_if(covered == "PARTIAL")
    found = profile.agg(F.array(
        check("data_quality", _any_data(n, F.when(low_rate <= schemas.LOW_QUALITY_RATE_LIMIT, "PASS").otherwise("FAIL")), low_rate),
        check("completeness", all_pass(["PASS", "NO_DATA"], complete_status, "FAIL"), F.min(complete)),
        check("freshness", F.when(F.bool_or(fresh_status == "PASS"), "PASS").otherwise("STALE"), F.max(fresh)),
        check("duplicates", all_pass(["PASS", "NO_DATA"], copies_status, "FAIL"), F.max(copies)),
        check("site_coverage", all_pass(["PASS"], covered, "PARTIAL"), partial),
    ).alias("checks"))
    health = processing_health(jobs, jobs_as_of).select(
        F.lit("processing_health").alias("check"), "status", F.col("job_success_rate").alias("measure")
    )
    return found.select(F.explode("checks").alias("c")).select("c.*").unionByName(health)


def average_quality(profile: DataFrame) -> Column:
    """The mean overall score over all tables of a whole profile, 0 without rows."""
    return profile.agg(F.coalesce(average_of_parts("overall"), F.lit(0.0))).scalar()


def quality_alerts(checks: DataFrame) -> DataFrame:
    """Alerts (type, severity, message) for the checks that did not pass."""
    check, status = F.col("check"), F.col("status")
    percent = (F.floor(F.col("measure") * 1000 + 0.5) / 10).cast("string")
    rules = [
        ((check == "data_quality") & (status == "FAIL"), "LOW_DATA_QUALITY", "HIGH",
         F.concat(F.lit("Low quality rate: "), percent, F.lit("%"))),
        ((check == "freshness") & (status == "STALE"), "STALE_DATA", "MEDIUM", F.lit("Data appears to be stale")),
        ((check == "site_coverage") & (status == "PARTIAL"), "INCOMPLETE_SITE_COVERAGE", "MEDIUM",
         F.lit("Not all sites are being scraped")),
    ]
    raised = F.coalesce(*[
        F.when(hit, F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), message.alias("message")))
        for hit, kind, severity, message in rules
    ])
    return checks.select(raised.alias("alert")).filter("alert is not null").select("alert.*")


def overall_status(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.when(F.count("*") == 0, "PASS")
        .when(F.bool_or(F.col("severity") == "HIGH"), "ALERT").otherwise("WARNING").alias("overall_status"),
        F.count("*").alias("alerts"),
    )


def health_metrics(checks: DataFrame, average: Column) -> DataFrame:
    """Mean points of the checks beside the average quality score."""
    points = (
        F.when(F.col("status") == "PASS", 1.0).when(F.col("status").isin("FAIL", "STALE", "PARTIAL"), 0.5)
        .otherwise(0.0)
    )
    return checks.agg(
        F.avg(points).alias("overall_health_score"), F.count("*").alias("checks")
    ).withColumn("avg_quality_score", average)


def report_rows(checks: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per check, then one per alert: (check_type, status, details)."""
    shown = (F.floor(F.col("measure") * 10000 + 0.5) / 10000).cast("string")
    return checks.select(
        F.col("check").alias("check_type"), "status", F.coalesce(shown, F.lit("")).alias("details")
    ).unionByName(
        alerts.select(
            F.concat(F.lit("ALERT_"), "type").alias("check_type"), F.col("severity").alias("status"),
            F.col("message").alias("details"),
        )
    )
