"""Dedup, routing, rules, repair, merge, files: behaviour on small inputs."""

import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from tidewright.config import Config
from tidewright.operators import dedup, infer, ledger, merge, rules, security, semantic
from tidewright.operators.clean import LINE, clean
from tidewright.plans import pipeline, report
from tidewright.streaming.records import clean_stream as records_stream
from tidewright.sources import docx, generators, sinks, tables

ROWS = [("a@b.com", "Ann", "Lee Roy", "2023-01-01", "5551234567"), ("A@B.com", "ann", "lee roy", "2024-01-01", "5559999999"), ("c@d.com", "Carl", "Moss", "2023-01-01", None)]
TYPES = {"email": "email", "first_name": "first_name", "last_name": "last_name", "join_date": "date", "phone": "phone"}


def table(spark, rows=ROWS):
    return tables.with_lines(spark.createDataFrame(rows, "email string, first_name string, last_name string, join_date string, phone string"))


def test_duplicates_and_survivorship(spark):
    done = dedup.enrich(dedup.mark(clean(table(spark), TYPES)))
    got = {r[LINE]: r for r in done.collect()}
    assert [got[i]["is_duplicate"] for i in (1, 2, 3)] == [False, True, False]
    assert got[2]["duplicate_of"] == got[1]["row_id"]
    assert got[1]["clean"]["phone"] == "555-999-9999"  # the newer one's
    assert got[1]["clean"]["join_date"] == "2023-01-01"


@pytest.mark.parametrize("strategy, n", [("email_only", 1), ("phone_only", 0), ("composite", 1), ("all_fields", 0), ("disabled", 0)])
def test_strategies(spark, strategy, n):
    cfg = Config(strategy=strategy)
    assert dedup.mark(clean(table(spark), TYPES, cfg), cfg).where("is_duplicate").count() == n


def test_routes_and_conservation(spark):
    done = pipeline.records(table(spark), types=TYPES)
    merge.verify(done.select("row_id"), done.where("status = 'CLEAN'"), done.where("status = 'REJECTED'"))
    assert report.health(done).first()["total"] == 3
    with pytest.raises(merge.VerificationError):
        merge.verify(done.select("row_id"), done.where("status = 'CLEAN'"), done.limit(0))


def test_empty_table(spark):
    done = pipeline.records(table(spark).limit(0), types=TYPES)
    h = report.health(done).first()
    assert (h["total"], h["clean_ratio"], h["warn"]) == (0, None, False)


def test_repair_narrows_failures(spark):
    class Fixer:
        def resolve(self, prompts):
            if any("boom" in p for p in prompts):
                raise RuntimeError("boom")
            return ['{"first": "Zoe", "note": "x"}' for _ in prompts]

    rows = [("bad", "J0hn", "boom", "2023-01-01", None), ("bad2", "J0e", "Stone", "2023-01-01", None)]
    done = {r[LINE]: r for r in pipeline.records(table(spark, rows), types=TYPES, resolver=Fixer()).collect()}
    assert (done[1]["status"], done[1]["failure_reason"], done[1]["repair_event"]) == ("REJECTED", "UNKNOWN", "ROW_ERROR")
    assert done[2]["status"] == "CLEAN" and done[2]["clean"]["first_name"] == "Zoe" and done[2]["extras"] == {"note": "x"}


def test_a_model_that_does_not_load_rejects_what_it_was_asked(spark):
    class Unloadable:
        def load(self):
            raise OSError("no weights")

        def resolve(self, prompts):
            return ["{}"] * len(prompts)

    rows = [("bad", "J0hn", "Stone", "2023-01-01", None), ("a@b.com", "Ann", "Lee Roy", "2023-01-01", "5551234567")]
    done = {r[LINE]: r for r in pipeline.records(table(spark, rows), types=TYPES, resolver=Unloadable()).collect()}
    assert (done[1]["status"], done[1]["failure_reason"]) == ("REJECTED", "MODEL_CRASH")
    assert done[2]["status"] == "CLEAN"


def test_batches_shrink_and_grow_back():
    sizes = []

    class Fussy:
        def resolve(self, prompts):
            sizes.append(len(prompts))
            if "bad" in prompts:
                raise RuntimeError
            if "big" in prompts and len(prompts) == 1:
                raise MemoryError
            return prompts

    asked = ["a", "b", "bad", "c", "big", "d", "e", "f", "g"]
    got = list(semantic._answers(Fussy(), asked[:4] + asked[5:], 4))
    assert got == [(p, None) if p != "bad" else (None, "UNKNOWN") for p in asked[:4] + asked[5:]]
    assert sizes == [4, 2, 4, 2, 1, 1, 2, 2]  # a row that fails by itself gives no reason to grow
    assert list(semantic._answers(Fussy(), ["big"], 4)) == [(None, "MODEL_CRASH")]
    assert list(semantic._answers(Fussy(), [], 4)) == []


def test_events_of_survivorship_and_repair(spark):
    rows = [("a@b.com", "Ann", "Lee", "2023-01-01", None), ("a@b.com", "Ann", "Lee", "2024-01-01", "5551234567"), ("a@b.com", "Ann", "Lee", "2024-02-01", "5559999999"), ("a@b.com", "Ann", "Lee", None, None)]
    cfg = Config(placeholder_overwrites=False)
    rows = [(e, f, n, d, p if p else "-") for e, f, n, d, p in rows]
    done = dedup.enrich(dedup.mark(clean(table(spark, rows), TYPES, cfg), cfg), cfg)
    got = {r[LINE]: r["gave"] for r in done.collect()}
    # a placeholder is a value, so that no gap is open; the newer two say a phone and an email
    assert got[1] is None and [tuple(got[i]) for i in (2, 3, 4)] == [(0, 2), (0, 2), (0, 0)]
    held = done.withColumns({"failure_reason": F.lit(None).cast("string"), "repair_event": F.when(F.col(LINE) == 1, "JSON_PARSE_ERROR"), "confidence_score": F.lit(0.5)})
    events = [(r["row_id"], r["action"]) for r in ledger.audit(held).collect()]
    keeper = done.where(f"{LINE} = 1").first()["row_id"]
    assert [a for i, a in events if i == keeper and a.startswith("ROW_U")] == ["ROW_UPDATED_FROM_NEWER"] * 2
    assert (keeper, "JSON_PARSE_ERROR") in events and len(events) == 4 + 3 + 2 + 1
    assert ledger.phases(spark, "r", 0).where("action = 'SKIP'").count() == 1


def test_gaps_are_filled_once(spark):
    df = clean(table(spark, [("a@b.com", "Ann", "Lee", "2023-01-01", "5551234567")] * 3), TYPES)
    emptied = df.withColumn("clean", F.col("clean").withField("phone", F.when(F.col(LINE) > 1, F.col("clean.phone"))))
    got = {r[LINE]: r for r in dedup.enrich(dedup.mark(emptied)).collect()}
    assert got[1]["clean"]["phone"] == "555-123-4567"
    assert [tuple(got[i]["gave"]) for i in (2, 3)] == [(1, 0), (0, 0)]


def test_keys_that_repair_adds_reach_the_outputs(spark):
    class Adds:
        def resolve(self, prompts):
            return ['{"first": "Zoe", "note": "x"}' for _ in prompts]

    done = pipeline.records(table(spark, [("bad2", "J0e", "Stone", "2023-01-01", None)]), types=TYPES, resolver=Adds())
    final, _ = pipeline.outputs(done)
    assert [r["note"] for r in final.collect()] == ["x"]


def test_a_hot_key_has_one_keeper(spark):
    rows = [(f"n/a", "Ann", "Lee Roy", f"2023-01-{1 + i % 28:02d}", None) for i in range(200)]
    done = dedup.enrich(dedup.mark(clean(table(spark, rows), TYPES)))
    got = done.groupBy("is_duplicate").count().collect()
    assert {r["is_duplicate"]: r["count"] for r in got} == {False: 1, True: 199}
    assert done.select("duplicate_of").distinct().count() == 2


def test_reply_forms(spark):
    cases = {'{"a": 1}': "OBJECT", "NOT JSON": "INVALID_FORMAT", "null": "INVALID_FORMAT", "[]": "INVALID_FORMAT", '```json\n{"a": 1}\n```': "OBJECT", "```json\n{bad}\n``` {}": "INVALID_FORMAT"}
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    assert {r["x"]: r["v"] for r in df.select("x", semantic.verdict(F.col("x")).alias("v")).collect()} == cases


def test_rules(spark):
    found = rules.parse('# c\ncolumn[email] == Valid\nColumn[last_name] == "moss" OR "Lee Roy"')
    assert rules.apply(table(spark), found).count() == 3
    with pytest.raises(ValueError, match="line 2"):
        rules.parse("\nnonsense")
    with pytest.raises(ValueError):
        rules.parse("Column[name] == Valid")
    with pytest.raises(ValueError):
        rules.apply(table(spark), rules.parse("Column[nope] == True"))


def test_flatten_order():
    assert merge.ordered(["zeta", "email", "raw_b", "id", "row_id", "employee_id", "first_name", "raw_a"]) == ["row_id", "id", "employee_id", "first_name", "email", "zeta", "raw_a", "raw_b"]


def test_csv_header_repair_and_round_trip(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(',,\n,"",\nName,E Mail,Name\nAnn,a@b.co,"x ""y"", z"\nBob,N/A,\n', encoding="utf-8")
    df = tables.read_csv(spark, str(p))
    assert df.columns == ["name", "e_mail", "name_1", LINE]
    rows = [tuple(r) for r in df.orderBy(LINE).collect()]
    assert rows == [("Ann", "a@b.co", 'x "y", z', 1), ("Bob", None, None, 2)]
    out = sinks.write_csv(df, str(tmp_path / "out.csv"))
    assert [tuple(r) for r in tables.read_csv(spark, out).orderBy(LINE).collect()] == rows
    with pytest.raises(tables.InputError):
        tables.read_table(spark, str(tmp_path / "none.csv"))


def test_sqlite(spark, tmp_path):
    p = str(tmp_path / "t.db")
    with sqlite3.connect(p) as db:
        db.execute('CREATE TABLE people ("First Name" text, n int)')
        db.executemany("INSERT INTO people VALUES (?, ?)", [(f"p{i}", i if i % 3 else None) for i in range(50)])
    df = tables.read_table(spark, p)
    assert df.columns == ["first_name", "n", LINE] and df.count() == 50 and df.where("n is null").count() == 17
    with sqlite3.connect(p) as db:
        db.execute("CREATE TABLE other (x text PRIMARY KEY) WITHOUT ROWID")
        db.executemany("INSERT INTO other VALUES (?)", [("b",), ("a",)])
    assert [tuple(r) for r in tables.read_sqlite(spark, p, "other").orderBy(LINE).collect()] == [("a", 1), ("b", 2)]
    with pytest.raises(tables.InputError, match="several"):
        tables.read_sqlite(spark, p)


_DOC = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Hello </w:t></w:r><w:r><w:t>world</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'


def test_docx(spark, tmp_path):
    p = tmp_path / "a.docx"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("word/document.xml", _DOC)
    blocks = docx.read_docx(spark, str(tmp_path))
    assert [(r["id"], r["type"], r["text"]) for r in blocks.orderBy("id").collect()] == [(0, "paragraph", "Hello world"), (1, "table_cell", "cell")]
    files = spark.read.format("binaryFile").load(str(p))
    made = docx.clean_documents(files, lambda ps: ['[{"id": 0, "cleaned": "Hi"}]' for _ in ps]).first()["content"]
    assert [b[2] for b in docx.blocks_of(bytes(made))] == ["Hi", "cell"]
    assert security.verdicts(files).first()["verdict"] == "OK"
    out = tmp_path / "out"
    docx.clean_folder(spark, str(tmp_path), str(out), lambda ps: ['[{"id": 1, "cleaned": "Ho"}]' for _ in ps])
    assert [f.name for f in out.iterdir()] == ["a.docx"]
    assert [b[2] for b in docx.blocks_of((out / "a.docx").read_bytes())] == ["Hello world", "Ho"]
    with pytest.raises(ValueError, match="2 files named a.docx"):
        sinks.write_files(files.unionByName(files), str(out))


def test_macros_are_found(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m.docx", "w") as z:
        z.writestr("word/document.xml", _DOC)
        z.writestr("word/vbaProject.bin", b"x")
    files = spark.read.format("binaryFile").load(str(tmp_path / "m.docx"))
    assert security.verdicts(files).first()["verdict"] == "MACRO_DETECTED"


def test_types_come_from_the_first_values_of_each_column(spark):
    rows = spark.createDataFrame([(f"u{i}@b.co" if i < 12 else "x", "  " if i < 5 else "2023-01-01 10:00", None) for i in range(40)], "a string, b string, c string")
    assert infer.column_types(tables.with_lines(rows)) == {"a": "email", "b": "date"}
    assert infer.column_types(tables.with_lines(rows.limit(0))) == {}


def test_a_rejected_file_is_in_the_ledger(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes(b"a\n=cmd|x\n")
    with pytest.raises(pipeline.RejectedFile):
        pipeline.run(spark, str(p), Config(run_id="g"), out_dir=str(tmp_path / "out"))
    assert tables.read_csv(spark, str(tmp_path / "out" / "rejection_cache_g.csv")).first()["type"] == "FILE_REJECTED_SECURITY"


def test_white_space_survives_a_csv_file(spark, tmp_path):
    df = tables.with_lines(spark.createDataFrame([("  a ", " N/A "), ("b", "N/A")], "x string, y string"))
    back = tables.read_csv(spark, sinks.write_csv(df, str(tmp_path / "w.csv")))
    assert [tuple(r) for r in back.orderBy(LINE).collect()] == [("  a ", " N/A ", 1), ("b", None, 2)]


def test_a_stream_is_cleaned_like_a_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    table(spark).write.parquet(src)
    batch = spark.read.parquet(src)
    query = records_stream(spark.readStream.schema(batch.schema).parquet(src), TYPES).writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    query.awaitTermination(60)
    same = lambda df: sorted((r[LINE], str(r["clean"])) for r in df.collect())
    assert same(spark.table("cleaned")) == same(clean(batch, TYPES))


def test_file_gate(spark):
    rows = [("/a.csv", b"a,b\n1,2\n"), ("/b.csv", b"x\x00"), ("/c.exe", b"a"), ("/d.txt", b"a"), ("/e.csv", b"MZ\x00"), ("/f.csv", b"=cmd|x"), ("/g.db", b"nope"), ("/h.docx", b"PK\x03\x04zz"), ("/i.csv", "é".encode() * 4095 + b"ab" + "é".encode() * 9 + b"\xff"), ("/j.csv", b"x\xffy")]
    files = spark.createDataFrame([(p, len(c), bytearray(c)) for p, c in rows], "path string, length long, content binary")
    got = {r["path"]: r["verdict"].split(":")[0] for r in security.verdicts(files).collect()}
    assert got == {"/a.csv": "OK", "/b.csv": "INVALID_FILE_SIGNATURE", "/c.exe": "HAZARDOUS_FILE_DETECTED", "/d.txt": "UNSUPPORTED_FILE_TYPE", "/e.csv": "INVALID_FILE_SIGNATURE", "/f.csv": "DANGEROUS_PATTERN_DETECTED", "/g.db": "INVALID_FILE_SIGNATURE", "/h.docx": "INVALID_DOCX", "/i.csv": "OK", "/j.csv": "INVALID_FILE_SIGNATURE"}


def test_generated_run(spark, tmp_path):
    path = sinks.write_csv(tables.with_lines(generators.messy_records(spark, 50, seed=999)), str(tmp_path / "in.csv"))
    result = pipeline.run(spark, path, Config(run_id="t"), out_dir=str(tmp_path / "out"))
    assert result.done.count() == 55
    assert tables.latest_run(spark, str(tmp_path / "out")) == "t"
    seen = report.analyze(spark, str(tmp_path / "out"), "t")
    assert seen["rejected"] and report.analyze(spark, str(tmp_path), "none") is None
    assert seen["rows"] == result.final.count() and seen["columns"][0] == "row_id"
