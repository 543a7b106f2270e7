"""The ten-question incident report and the response-speed labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import CENTS, FAST_LIMIT, NORMAL_LIMIT, exact_total, mean, response_speed
from millrace.plans.registry import query
from millrace.plans.sqltext import half_up_mean, largest
from millrace.sources.tables import Tables


@dataclass(frozen=True)
class Incidents:
    """An incident table and the names of its columns.

    ``number`` identifies a row and completes every order. Where delays have no more than
    two decimals, ``exact`` takes averages over exact numbers, free of the order of rows.
    """

    rows: DataFrame
    number: str
    kind: str
    delay: str
    exact: bool = False

    def _mean_delay(self) -> Column:
        if self.exact:
            return mean(exact_total(self.rows, self.delay, CENTS), F.count(self.delay))
        return F.round(F.avg(self.delay), 2)

    def _of(self, *kinds: str) -> DataFrame:
        return self.rows.filter(F.col(self.kind).isin(*kinds))

    def kinds(self) -> DataFrame:
        """1. How many kinds of incident are there?"""
        return self.rows.agg(F.count_distinct(self.kind).alias("n_types"))

    def of_kind(self, kind: str, columns: list[str], n: int = 10, ordered: bool = True, **where: object) -> DataFrame:
        """2 and 7. ``n`` incidents of one kind, with further equalities in ``where``: the first, or any if not ``ordered``."""
        found = self._of(kind)
        for column, value in where.items():
            found = found.filter(F.col(column) == value)
        found = found.select(self.number, *columns)
        return (found.orderBy(self.number) if ordered else found).limit(n)

    def per_group(self, group: str) -> DataFrame:
        """3. How many incidents has each group?"""
        return self.rows.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group)

    def busiest(self, group: str, n: int = 10) -> DataFrame:
        """4. Which groups have most incidents?"""
        return self.per_group(group).limit(n)

    def slowest(self, group: str, n: int = 10) -> DataFrame:
        """5. Which groups have the highest average delay?"""
        averages = self.rows.groupBy(group).agg(self._mean_delay().alias("avg_delay"))
        return averages.orderBy(F.desc("avg_delay"), group).limit(n)

    def worst(self, over: float, columns: list[str], n: int = 15) -> DataFrame:
        """6. Which incidents above a delay are the worst?"""
        late = self.rows.filter(F.col(self.delay) > over)
        return late.select(self.number, *columns, self.delay).orderBy(F.desc(self.delay), self.number).limit(n)

    def speeds(self, columns: list[str], fast: float, normal: float, n: int = 20, ordered: bool = True) -> DataFrame:
        """8. How fast was the response, for the first ``n`` incidents, or for any if not ``ordered``?"""
        speed = response_speed(self.delay, fast, normal).alias("speed")
        found = self.rows.select(self.number, *columns, self.delay, speed)
        return (found.orderBy(self.number) if ordered else found).limit(n)

    def kinds_per_group(self, group: str, *kinds: str) -> DataFrame:
        """9. How do chosen kinds split over the groups?"""
        counts = self._of(*kinds).groupBy(group, self.kind).agg(F.count("*").alias("n"))
        return counts.orderBy(F.asc(group), F.desc("n"), F.asc(self.kind))

    def delays_of(self, kind: str, group: str) -> DataFrame:
        """10. Which groups are slowest for one kind?"""
        return (
            self._of(kind)
            .groupBy(group)
            .agg(
                F.count("*").alias("n"),
                self._mean_delay().alias("avg_delay"),
                F.round(F.max(self.delay), 2).alias("max_delay"),
            )
            .orderBy(F.desc("avg_delay"), group)
        )

    def labelled(self, kind: str, columns: list[str], fast: float = FAST_LIMIT, normal: float = NORMAL_LIMIT) -> DataFrame:
        """Every incident of one kind with its response speed; no shuffle."""
        return (
            self.rows.filter(F.col(self.kind) == kind)
            .select(self.number, self.kind, *columns, self.delay)
            .withColumn("speed", response_speed(self.delay, fast, normal))
        )


def of_events(t: Tables) -> Incidents:
    return Incidents(t.events, number="event_id", kind="event_type", delay="value", exact=True)


def _as_doubles(df: DataFrame, **names: str) -> DataFrame:
    """Exact results as doubles under new names, the form the comparison expects."""
    for old, new in names.items():
        df = df.withColumn(old, F.col(old).cast("double")).withColumnRenamed(old, new)
    return df


@query("SELECT COUNT(DISTINCT event_type) AS n_types FROM events")
def fire_q1(t: Tables) -> DataFrame:
    return of_events(t).kinds()


@query("SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 10")
def fire_q2(t: Tables) -> DataFrame:
    return of_events(t).of_kind("error", ["ts", "user_id", "value"])


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def fire_q3(t: Tables) -> DataFrame:
    return of_events(t).per_group("event_type")


@query("SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
def fire_q4(t: Tables) -> DataFrame:
    return of_events(t).busiest("user_id")


@query(f"""
    SELECT user_id, {half_up_mean('value')} AS avg_value FROM events
    GROUP BY user_id ORDER BY avg_value DESC, user_id LIMIT 10
""")
def fire_q5(t: Tables) -> DataFrame:
    return _as_doubles(of_events(t).slowest("user_id"), avg_delay="avg_value")


@query("""
    SELECT event_id, event_type, user_id, value FROM events WHERE value > 100
    ORDER BY value DESC, event_id LIMIT 15
""")
def fire_q6(t: Tables) -> DataFrame:
    return of_events(t).worst(100, ["event_type", "user_id"])


@query("""
    SELECT event_id, ts, value FROM events WHERE event_type = 'purchase' AND user_id = 12
    ORDER BY event_id LIMIT 10
""")
def fire_q7(t: Tables) -> DataFrame:
    return of_events(t).of_kind("purchase", ["ts", "value"], user_id=12)


@query("""
    SELECT event_id, event_type, value,
           CASE WHEN value <= 20 THEN 'Fast' WHEN value <= 60 THEN 'Normal' ELSE 'Slow' END AS speed
    FROM events ORDER BY event_id LIMIT 20
""")
def fire_q8(t: Tables) -> DataFrame:
    return of_events(t).speeds(["event_type"], 20, 60)


@query("""
    SELECT user_id, event_type, COUNT(*) AS n FROM events
    WHERE event_type IN ('error', 'purchase') GROUP BY user_id, event_type
""")
def fire_q9(t: Tables) -> DataFrame:
    return of_events(t).kinds_per_group("user_id", "error", "purchase")


@query(f"""
    SELECT user_id, COUNT(*) AS n, {half_up_mean('value')} AS avg_value, {largest('value')} AS max_value
    FROM events WHERE event_type = 'error' GROUP BY user_id
""")
def fire_q10(t: Tables) -> DataFrame:
    return _as_doubles(of_events(t).delays_of("error", "user_id"), avg_delay="avg_value", max_delay="max_value")


@query("""
    SELECT event_id, event_type, user_id, value,
           CASE WHEN value <= 20 THEN 'Fast' WHEN value <= 60 THEN 'Normal' ELSE 'Slow' END AS speed
    FROM events WHERE event_type = 'error'
""")
def job_speed_label(t: Tables) -> DataFrame:
    return of_events(t).labelled("error", ["user_id"], 20, 60)
