"""Board lifespans: dated events, April-Fools pairs, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def decimal_year(text: Column) -> Column:
    """YYYY-MM[-DD] as a year with a fraction of 365.25 days."""
    whole = F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)
    day = F.try_to_date(whole, "yyyy-MM-dd")
    return F.year(day) + F.datediff(day, F.make_date(F.year(day), F.lit(1), F.lit(1))) / 365.25


def slugs(events: DataFrame) -> DataFrame:
    """The distinct board names of letters and digits, without slashes."""
    bare = F.regexp_replace("slug", "/", "")
    return events.select(bare.alias("slug")).filter(F.col("slug").rlike("^[a-z0-9]+$")).distinct()


def fools_pairs(events: DataFrame) -> DataFrame:
    """Boards made on 1 or 2 April and removed within seven days: slug, the two dates; the first removal counts."""
    full = events.filter(F.length("date") == 10).withColumn("day", F.try_to_date("date", "yyyy-MM-dd"))
    made = full.filter((F.col("type") == "created") & (F.month("day") == 4) & F.dayofmonth("day").isin(1, 2)).select("slug", F.col("day").alias("made"))
    gone = full.filter(F.col("type") == "removed").select("slug", F.col("day").alias("gone"))
    pairs = made.join(gone, "slug").filter((F.datediff("gone", "made") > 0) & (F.datediff("gone", "made") <= 7))
    return pairs.groupBy("slug", "made").agg(F.min("gone").alias("gone"))


def events_with_fools(events: DataFrame) -> DataFrame:
    """All dated events but those of pairs, and one mark for each year that has pairs."""
    pairs = fools_pairs(events)
    marks = pairs.groupBy(F.year("made").alias("y")).agg(F.count("*").alias("n"), F.min("made").alias("day"))
    marks = marks.select(F.lit("fools").alias("type"), F.concat(F.col("n").cast("string"), F.lit(" boards")).alias("slug"), F.date_format("day", "yyyy-MM-dd").alias("date"))
    used = pairs.select("slug", F.explode(F.array("made", "gone")).alias("day")).select("slug", F.date_format("day", "yyyy-MM-dd").alias("date"))
    rest = events.filter(F.col("date").isNotNull()).join(used, ["slug", "date"], "left_anti").select("type", "slug", "date")
    return rest.unionByName(marks).withColumn("at", F.round(decimal_year(F.col("date")), 6))


def gaps(events: DataFrame, least: float, until: float) -> DataFrame:
    """Stretches of over `least` years without an event, up to `until`."""
    at = events.filter(F.col("date").isNotNull()).select(F.round(decimal_year(F.col("date")), 6).alias("at")).distinct()
    ends = at.unionByName(events.sparkSession.range(1).select(F.lit(float(until)).alias("at")))
    # a board's history is a short list; the window sees one row for each event date
    before = F.lag("at").over(Window.orderBy("at"))
    return ends.withColumn("since", before).filter(F.col("at") - F.col("since") > least).select("since", F.col("at").alias("upto"))
