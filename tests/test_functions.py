"""Golden cases of the text functions and normalisers, one job for each table."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.functions import missing as M
from tidewright.functions import normalize as N
from tidewright.functions import text as T
from tidewright.operators import infer


def run(spark, cases, f):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r["r"] for r in df.select("i", f(F.col("x")).alias("r")).orderBy("i").collect()]


def check(spark, table, f):
    got = run(spark, list(table), f)
    assert [(g["value"], g["status"]) for g in got] == list(table.values())


def test_email(spark):
    check(spark, {" Test@Example.com ": ("test@example.com", "VALID"), "not_an_email": ("not_an_email", "INVALID"), None: (None, "MISSING"), "": (None, "MISSING"), "Bob.Doe@yahoo.com 🔥": ("bob.doe@yahoo.com", "VALID"), "a @ b . c": ("a@b.c", "VALID")}, N.email)


def test_phone(spark):
    P = "Not Provided"
    check(spark, {"1234567890": ("123-456-7890", "VALID"), "11234567890": ("123-456-7890", "VALID"), "123": (P, "INVALID"), "🔥5551234567": ("555-123-4567", "VALID"), "555-0199": ("555-0199", "VALID"), "(555) 123-4567 ext. 9": ("555-123-4567 x9", "VALID"), "none here": (P, "MISSING"), "'5551234567": ("555-123-4567", "VALID"), None: (P, "MISSING")}, N.phone)


def test_name(spark):
    check(spark, {"  john doe  ": ("John Doe", "VALID"), "": (None, "MISSING"), "Alice 🔥": ("Alice", "VALID"), "Dr. JANE": ("Jane", "VALID"), "Drake": ("Ake", "VALID"), "alice (Al)": ("Alice", "VALID"), "Sarah (CEO)": ("Sarah (CEO)", "INVALID"), "J0hn": ("J0hn", "INVALID"), "o'brien mc-donald": ("O'Brien Mc-Donald", "VALID"), "x": ("x", "INVALID")}, N.name)
    check(spark, {"Li": ("Li", "INVALID"), "M.": ("M.", "INVALID"), "smith": ("Smith", "VALID")}, lambda c: N.name(c, "last_name"))
    assert run(spark, ["Drake", "Dr Who"], lambda c: N.name(c, greedy=False)["value"]) == ["Drake", "Who"]


def test_job_title(spark):
    check(spark, {"Director 🔥": ("Director", "VALID"), "CEO🔥": ("CEO", "VALID"), "head of hr": ("Head of HR", "VALID"), "r&d director": ("R&D Director", "VALID"), "saas lead": ("SaaS Lead", "VALID")}, N.job_title)


def test_currency(spark):
    assert run(spark, ["$1.5K", "€2M", "-3", "'$40", "1,500", "3B", "none", None], N.currency) == [1500.0, 2e6, -3.0, 40.0, 1.0, 3e9, None, None]
    assert run(spark, ["1,500"], lambda c: N.currency(c, thousands_cut=False)) == [1500.0]


def test_date(spark):
    check(spark, {"2023-01-01": ("2023-01-01", "VALID"), "01/31/2024": ("2024-01-31", "VALID"), "13/02/2024": ("2024-02-13", "VALID"), "Jan 1, 2023": ("2023-01-01", "VALID"), "01/01/23": ("2023-01-01", "VALID"), "Second of January, 2024": ("Second of January, 2024", "INVALID"), "2023-02-30": ("2023-02-30", "INVALID"), None: (None, "MISSING")}, N.date)


def test_missing_and_sanitize(spark):
    assert run(spark, [None, " ", "N/A", "'n/a", "-", "?", "x", "'", "NaN"], M.is_missing) == [True, True, True, True, True, True, False, False, True]
    assert run(spark, [" a 🔥", "'=x", None], lambda c: M.sanitize(c, "company")) == ["a", "=x", "Not Provided"]
    assert run(spark, [None], lambda c: M.sanitize(c, "salary")) == [None]
    assert (M.category("language"), M.category("email"), M.category("note")) == ("numeric", "placeholder", "other")


def test_text(spark):
    assert run(spark, ["  a  b\n", None], T.clean_whitespace) == ["a b", ""]
    assert run(spark, ["漢字x"], T.strip_emojis) == ["x"]
    assert run(spark, ["漢字x🔥"], lambda c: T.strip_emojis(c, cjk=False)) == ["漢字x"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_emails_are_idempotent(spark, cases):
    cases = [c.replace("\x00", "") for c in cases if not any(0xD800 <= ord(x) < 0xE000 for x in c)]
    once = run(spark, cases, lambda c: N.email(c)["value"])
    valid = [o for o, s in zip(once, run(spark, cases, lambda c: N.email(c)["status"])) if s == "VALID"]
    if valid:
        assert run(spark, valid, lambda c: N.email(c)["value"]) == valid


@pytest.mark.parametrize("samples, kind", [(["a@b.co", "c@d.org"], "email"), (["$12", "3.5K"], "currency"), (["2023-01-01", "Jan 5, 2024"], "date"), (["(555) 123-4567", "555-123-4567"], "phone"), (["x"], None), ([], None)])
def test_content_type(samples, kind):
    assert infer.content_type(samples) == kind


def test_headers():
    assert infer.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    assert infer.bad_header(["Unnamed: 0", "", "x"]) and not infer.bad_header(["a", "b"])
    assert infer.header_row([[None, "", "x"], ["a", "b", None]]) == 1
