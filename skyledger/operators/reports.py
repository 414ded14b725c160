"""Post-flight reports: foreign aircraft, counts per reporter, reporter roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import predicates as P
from skyledger.functions import temporal as t


def count_reports(reports: DataFrame, roles: bool = True) -> DataFrame:
    """Reports per aircraft, month and reporter, combined before the shuffle.

    ``last`` is the latest (date, class): the reporter's role follows from it. Reports are
    counted per class first, with the latest date of each, which hashes; only these few
    rows are compared as (date, class). They are placed by the final key before that, as at most one
    row per class shares it: so they are sorted once, and not on both sides of a shuffle.
    Without ``roles`` there is no ``last``, and one aggregate that hashes gives the counts.
    """
    keys = ["registration", "month", "reporteur_uid"]
    if not roles:
        return reports.groupBy(
            F.col("aircraftregistration").alias("registration"),
            t.calendar_month(F.col("reportingdate")).alias("month"),
            P.reporter_key(F.col("reporteurid")).alias("reporteur_uid"),
        ).agg(
            F.count("*").alias("reps"),
            F.count_if(P.is_marep(F.col("reporteurclass"))).alias("mareps"),
            F.count_if(P.is_pirep(F.col("reporteurclass"))).alias("pireps"),
        )
    per_class = (
        reports.groupBy(
            F.col("aircraftregistration").alias("registration"),
            t.calendar_month(F.col("reportingdate")).alias("month"),
            "reporteurid",
            "reporteurclass",
        )
        .agg(F.count("*").alias("n"), F.max("reportingdate").alias("reportingdate"))
        .withColumn("reporteur_uid", P.reporter_key(F.col("reporteurid")))
        .drop("reporteurid")
        .repartition(*keys)
    )
    of_class = lambda is_class: F.sum(F.when(is_class(F.col("reporteurclass")), F.col("n")).otherwise(0))
    return per_class.groupBy(*keys).agg(
        F.sum("n").alias("reps"),
        of_class(P.is_marep).alias("mareps"),
        of_class(P.is_pirep).alias("pireps"),
        F.max(F.struct("reportingdate", "reporteurclass")).alias("last"),
    )


def count_reports_by_date(reports: DataFrame) -> DataFrame:
    """The counts of ``count_reports`` with the latest date of pilot, maintenance and unclassed reports each.

    One aggregate that hashes, before and after its shuffle: classes are text and would be sorted. With
    ``other_classes`` reporters' roles follow from it.
    """
    group, date = F.col("reporteurclass"), F.col("reportingdate")
    return reports.groupBy(
        F.col("aircraftregistration").alias("registration"),
        t.calendar_month(date).alias("month"),
        P.reporter_key(F.col("reporteurid")).alias("reporteur_uid"),
    ).agg(
        F.count("*").alias("reps"),
        F.count_if(P.is_marep(group)).alias("mareps"),
        F.count_if(P.is_pirep(group)).alias("pireps"),
        F.count_if(group.isNull()).alias("unclassed"),
        F.max(F.when(P.is_marep(group), date)).alias("last_marep"),
        F.max(F.when(P.is_pirep(group), date)).alias("last_pirep"),
        F.max(F.when(group.isNull(), date)).alias("last_unclassed"),
    )


def other_classes(reports: DataFrame) -> DataFrame:
    """The latest date per aircraft, reporter and class, of reports of all other classes."""
    group = F.col("reporteurclass")
    return (
        reports.where(group.isNotNull() & ~P.is_marep(group) & ~P.is_pirep(group))
        .groupBy(
            F.col("aircraftregistration").alias("registration"),
            P.reporter_key(F.col("reporteurid")).alias("reporteur_uid"),
            "reporteurclass",
        )
        .agg(F.max("reportingdate").alias("reportingdate"))
    )


def _known(aircrafts: DataFrame) -> DataFrame:
    return aircrafts.where("registration is not null").select("registration")


def of_known_aircraft(counts: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Counts on aircraft of the lookup. The join sees counts, not reports, so
    a hot aircraft brings at most one row per month and reporter."""
    return counts.join(_known(aircrafts), "registration", "left_semi")


def of_foreign_aircraft(df: DataFrame, aircrafts: DataFrame, registration: str = "registration") -> DataFrame:
    """Rows on aircraft outside the lookup, a missing registration included.

    Rows without a registration are foreign by definition; they are spread by their content,
    so that they do not meet in one task of a shuffled join.
    """
    known = aircrafts.where("registration is not null").select(F.col("registration").alias("_known"))
    missing = F.col(registration).isNull()
    spread = F.xxhash64(*[c for c in df.columns if c != registration]).cast("string")
    same = (missing == F.lit(False)) & (F.coalesce(F.col(registration), spread) == F.col("_known"))
    return df.join(known, same, "left_anti")


def _latest_by_class(kept: DataFrame, others: DataFrame) -> DataFrame:
    """One row per reporter and class, from counts by date and the other classes."""
    classes = {"marep": P.MAREP, "pirep": P.PIREP, "unclassed": None}
    counted = {"marep": "mareps", "pirep": "pireps", "unclassed": "unclassed"}
    seen = lambda n: F.when(
        F.col(counted[n]) > 0,
        F.struct(F.lit(classes[n]).cast("string").alias("reporteurclass"), F.col(f"last_{n}").alias("reportingdate")),
    )
    per_reporter = kept.groupBy("reporteur_uid").agg(
        *[F.sum(counted[n]).alias(counted[n]) for n in classes], *[F.max(f"last_{n}").alias(f"last_{n}") for n in classes]
    )
    of_others = others.groupBy("reporteur_uid", "reporteurclass").agg(F.max("reportingdate").alias("reportingdate"))
    return per_reporter.select("reporteur_uid", F.inline(F.array_compact(F.array(*map(seen, classes))))).unionByName(of_others)


def reporter_roles(kept: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Role of a reporter: class of the last report, the greater class on a tie.

    The latest date of each class hashes; only one row per reporter and class is compared.
    ``others`` go with counts by date.
    """
    if others is not None:
        per_class = _latest_by_class(kept, others)
    else:
        per_class = kept.groupBy("reporteur_uid", F.col("last.reporteurclass").alias("reporteurclass")).agg(
            F.max("last.reportingdate").alias("reportingdate")
        )
    last = F.max(F.struct("reportingdate", "reporteurclass"))
    return per_class.groupBy("reporteur_uid").agg(last["reporteurclass"].alias("role"))


def reporters(personnel: DataFrame, kept: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Personnel file merged with the reporters seen in kept reports."""
    listed = personnel.select(_trimmed(F.col("reporteurid")).alias("reporteur_uid"), "airport")
    return (
        listed.dropDuplicates()
        .join(reporter_roles(kept, others), "reporteur_uid", "full_outer")
        .select("reporteur_uid", "airport", "role")
    )


def _trimmed(text: Column) -> Column:
    """Without blanks of any kind around it."""
    return F.regexp_replace(text.cast("string"), r"(?U)^\s+|\s+$", "")
