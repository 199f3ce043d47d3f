"""Test inputs: messy records from a seed, and a few adversarial ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["first_name", "last_name", "email", "phone", "job_title", "company", "date"]
_FIRST = ["Alice", "Bob", "Carol", "David", "Eve", "Frank", "Grace"]
_LAST = ["Smith", "Jones", "Brown", "Miller", "Davis"]
_MAIL = ["gmail.com", "yahoo.com", "hotmail.com", "corp.net"]
_JOBS = ["Engineer", "Manager", "CEO", "Consultant", "Director"]
_NOISE = ["🔥", " ", "\t", "\n", "...", "N/A", "null"]


def _draw(seed: int, key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(key), F.col("id")), F.lit(n)).cast("int")


def _pick(seed: int, key: str, options: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), _draw(seed, key, len(options)) + 1)


def _mess(seed: int, key: str, c: Column, percent: int = 30) -> Column:
    """Noise on ``percent`` of the values."""
    how, noise = _draw(seed, key + "-how", 5), _pick(seed, key + "-noise", _NOISE)
    spared = _draw(seed, key + "-spared", 100) >= percent
    return F.when(spared, c).when(how == 0, F.concat(noise, c)).when(how == 1, F.concat(c, noise)).when(how == 2, F.upper(c)).when(how == 3, F.lower(c)).otherwise(F.concat(c, F.lit(" " + _NOISE[0])))


def messy_records(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``n`` records, shuffled, and five more that repeat some where n is over ten; the same for the same seed, at any parallelism."""
    ids = spark.range(n)
    if n > 10:
        ids = ids.unionByName(spark.range(5).select(F.pmod(F.xxhash64(F.lit(seed), F.lit("again"), F.col("id")), F.lit(n)).alias("id")))
    first, last = _pick(seed, "first", _FIRST), _pick(seed, "last", _LAST)
    has_mail, has_phone = _draw(seed, "mail?", 10) < 8, _draw(seed, "phone?", 10) < 8
    mail = F.concat(first, F.lit("."), last, F.lit("@"), _pick(seed, "at", _MAIL))
    digits = F.lpad((F.lit(2_000_000_000) + F.pmod(F.xxhash64(F.lit(seed), F.lit("digits"), F.col("id")), F.lit(7_999_999_999))).cast("string"), 10, "0")
    shown = F.when(_draw(seed, "form", 2) == 0, digits).otherwise(F.concat(F.lit("("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 4)))
    day = _draw(seed, "day", 100)
    return ids.orderBy(F.xxhash64(F.lit(seed), F.lit("order"), F.col("id"))).select(
        first.alias("first_name"),
        last.alias("last_name"),
        F.when(has_mail | ~has_phone, _mess(seed, "mail", mail, 40)).alias("email"),
        F.when(has_phone, _mess(seed, "phone", shown, 40)).alias("phone"),
        _mess(seed, "job", _pick(seed, "job", _JOBS)).alias("job_title"),
        F.lit("Acme Corp").alias("company"),
        F.when(day < 20, "01/01/23").when(day < 28, "Jan 1st, 2023").otherwise("2023-01-01").alias("date"),
    )


def adversarial_records(spark: SparkSession) -> DataFrame:
    rows = [
        ("Tom", "Reed", "tom@corp.net", "Call 555 123 4567 after 5pm", "Manager", "Acme Corp", "2023-01-01"),
        ("Bob", "Stone", "bob [at] example dot com", "5551234567", "Engineer", "Acme Corp", "2023-01-01"),
        ('Robert "Rob" (CEO)', "Marsh", "rob@corp.net", "5551234567", "Founder & Visionary", "Acme Corp", "2023-01-01"),
        ("Dana", "Wells", "dana@corp.net", "5551234567", "Director", "Acme Corp", "Second of January, 2024"),
        ("Lee", "Moss", None, "5551234567", None, None, None),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
