from datetime import datetime as D

from pyspark.sql import functions as F

from juriflow.functions import consistent as C
from juriflow.operators import references, snapshots


def test_consistent_form(spark):
    cases = {"\u0410rt. 3": "Art. 3", "l\u2019e\u0301tat": "l'état", "２５％": "25%", "a\u200bb\u00a0c": "ab c", "ﬁn Ⅳ": "fin IV", "chef\u2011lieu": "chef-lieu", "λόγος": "λόγος", "Δt α": "Δt α", "налог": "налог", "½ — œ €": "½ — œ €", "": "", "A": "A"}
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string")
    assert [r[0] for r in df.select(C.consistent_form(F.col("t"))).collect()] == [*cases.values(), None]
    assert df.select(C.same_but_spacing(F.lit("a b\n c\u2003d"))).first()[0] == "abcd"


def test_orphans(spark):
    t = [D(2024, m, 1) for m in range(1, 13)]
    ref = "chunk_id string, loaded_at timestamp, refs array<struct<code:string,articles:array<string>,is_range:boolean,assumed:boolean>>, extra int"
    chunks = spark.createDataFrame([("a", t[5], [(" CGI ", ["1 er", "2", "9", "3", "4bis", None, ""], False, False), (None, ["8"], False, False)], 1), ("b", t[0], [("cgi", ["2"], False, False)], 1), ("b", t[0], [("cgi", ["2"], False, False)], 1), ("c", None, [("cgi", ["1", "99999999999999999999"], False, False)], 1), ("d", t[1], None, 1)], ref)
    arts = spark.createDataFrame([("cgi", "premier", "x", t[0], None), ("CGI", "2", None, t[2], None), ("cgi", "3", "x", t[0], t[4]), ("cgi", "3", "x", t[0], t[4]), ("cgi", "4 Bis", "x", t[1], t[2]), ("cgi", "4bis", "x", t[3], None), (None, "7", "x", t[0], None)], "code string, article string, title string, loaded_at timestamp, removed_at timestamp")
    units = spark.createDataFrame([("d", 0, [("fn 2", "x"), ("FN0003", None), (None, "y"), ("note", "z")], t[3])], "doc_id string, unit_ix int, footnotes array<struct<id:string,text:string>>, loaded_at timestamp")
    defs = spark.createDataFrame([("d", 1, 2, "x", t[0], None), ("e", 1, 3, "x", t[0], None)], "doc_id string, page int, num int, text string, loaded_at timestamp, withdrawn_at timestamp")
    got = sorted((r.rec_id, r.ref_key, r.status, r.ym or "") for r in references.orphans(chunks, units, arts, defs).collect())
    assert got == [("a", "cgi:3", "deleted", "2024-06"), ("a", "cgi:9", "missing", "2024-06"), ("b", "cgi:2", "late", "2024-01"), ("c", "cgi:99999999999999999999", "missing", ""), ("d#0", "fn3", "missing", "2024-04")]
    assert references.orphans(chunks.limit(0), units.limit(0), arts, defs).count() == 0
    assert {r.status for r in references.orphans(chunks, units, arts.limit(0), defs.limit(0)).collect()} == {"missing"}


def test_runs_are_split_at_blocks(spark):
    keys = spark.createDataFrame([(p, n) for p in "ab" for n in [1, 2, 3, 7, 8, 12]], "p string, num long")
    runs = references.key_runs(keys, ["p"], block=5)
    assert sorted((r.run_start, r.run_end) for r in runs.filter("p = 'a'").collect()) == [(1, 3), (7, 8), (12, 12)]
    asked = spark.createDataFrame([("a", n) for n in range(15)], "p string, num long")
    assert sorted(r.num for r in references.match_runs(asked, runs, ["p"], block=5).filter("known").collect()) == [1, 2, 3, 7, 8, 12]


def test_snapshots(spark):
    t0, t1 = D(2024, 1, 1), D(2024, 1, 2)
    rows = [(1, "d", "1 er", "abc", t0), (1, "d", "1er", "abd", t1), (2, "d", "premier", "ab d\n", t0), (4, "d", "1", "abD", t0), (1, "d", "2", None, t0), (2, "d", "2", "x", t0), (4, "d", None, "x", t0), (4, "d", "2", "\u0445", None), (1, "d", "3", "y", t0), (4, "d", "3", "y", t0), (4, "d", "3", "y", t0), (7, None, "9", "z", t0)]
    df = spark.createDataFrame(rows, "snap_no int, doc_id string, unit_key string, text string, loaded_at timestamp")
    got = sorted((r.snap_from, r.snap_to, r.unit_key, r.what) for r in snapshots.unit_changes(df).collect())
    assert got == [(1, 2, "2", "changed"), (1, 2, "3", "removed"), (2, 4, "1", "changed"), (2, 4, "3", "added"), (4, 7, "1", "removed"), (4, 7, "2", "removed"), (4, 7, "3", "removed")]
    assert snapshots.unit_changes(df.limit(0)).count() == 0
