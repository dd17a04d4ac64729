import pytest
from pyspark.sql import functions as F

from juriflow.operators import chunks, layout, ocr, ordered, pack, qa, rawmd, reflow, units
from juriflow.plans import pipeline
from juriflow.queries import reference

MD = """<!--pg:1-->
# LIVRE PREMIER : IMPÔTS

## TITRE I : X

<!--art:1-->
**Art. 1 :** Le texte[^fn1] selon l'article 17 du présent code.

[^fn1]: Loi N°2022-022 du 27 décembre 2022 portant Loi de Finances

**I - Sous-titre**

<!--art:2-->
**Art. 2 :** Suite.
<!--pg:2-->
et fin.

# LIVRE DEUX : Y

perdu"""


def lines(spark, text, doc="d"):
    return spark.createDataFrame([(doc, i, t) for i, t in enumerate(text.split("\n"))], "doc_id string, seq long, text string")


def meta(spark, kind="code", doc="d"):
    return spark.createDataFrame([(doc, None, kind, "CGI", 2023, None, None, [1])], "doc_id string, source_doc_id string, doc_type string, code string, version_year int, published string, source_url string, pdf_pages array<int>")


def test_running_in_buckets(spark):
    rows = [("a", i, i % 7 if i % 3 else None) for i in range(0, 60, 2)] + [("b", 5, None), (None, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id string, seq long, v int")
    got = {r.seq: (r.l, r.s) for r in ordered.running(df, "seq", {"l": F.col("v")}, {"s": F.col("v")}, bucket=8).filter("doc_id = 'a'").collect()}
    last, total = None, 0
    for _, i, v in rows[:30]:
        last, total = (last, total) if v is None else (v, total + v)
        assert got[i] == (last, total)
    assert ordered.running(df.limit(0), "seq", {"l": F.col("v")}, {"s": F.col("v")}).count() == 0


@pytest.mark.parametrize("bucket", [ordered.BUCKET, 3])
def test_units_of_a_code(spark, bucket, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET", bucket)
    docs = pipeline.documents_of(meta(spark))
    got = units.units(lines(spark, MD), docs).orderBy("unit_ix").collect()
    assert [(u.kind, u.key, u.page_start, u.page_end) for u in got] == [("article", "1", 1, 1), ("article", "2", 1, 2)]
    assert [[h.v for h in u.hier] for u in got] == [["LIVRE PREMIER : IMPÔTS", "TITRE I : X"], ["LIVRE PREMIER : IMPÔTS", "TITRE I : X", "I - Sous-titre"]]
    assert got[0].text == "Art. 1 : Le texte selon l'article 17 du présent code."
    assert [(n.id, n.text[:8]) for n in got[0].footnotes] == [("fn1", "Loi N°20")]
    assert [r.text for r in units.outside_lines(lines(spark, MD), docs).collect()] == ["perdu"]


def test_chunks(spark):
    found, u, outside = pipeline.chunk(lines(spark, MD), meta(spark), spark.createDataFrame([("d", 1, 12)], "doc_id string, pdf_page int, printed_page int"), spark.createDataFrame([("d", 2, 9, "Loi N°1 du 1 mai 2020")], "doc_id string, page int, num int, text string"))
    a, b = found.orderBy("chunk_id").collect()
    assert (a.chunk_id, b.chunk_id) == ("d::art1::0", "d::art2::0")
    assert a.context == "CGI 2023 | LIVRE PREMIER : IMPÔTS > TITRE I : X | Art. 1"
    assert [(r.code, r.articles, r.range, r.assumed) for r in a.refs] == [("CGI", ["17"], False, True)]
    assert (a.printed_page_start, b.printed_page_end, a.amended_by[0].law, len(a.page_notes), [n.page for n in b.page_notes]) == (12, None, "Loi N°2022-022", 0, [2])
    s = chunks.chunk_stats(found, u, outside).first()
    assert (s.n_units, s.n_chunks, s.text_outside_units_chars, s.with_refs) == (2, 2, 5, 1)


def test_merge_of_small_sections(spark):
    md = "# A\nintro courte\n**Un**\n" + "x" * 300 + "\n**Deux**\nfin"
    docs = pipeline.documents_of(meta(spark, "generic"))
    got = units.merge_small_units(units.units(lines(spark, md), docs)).collect()
    assert len(got) == 1 and got[0].title == "Un" and got[0].text.startswith("intro courte") and got[0].text.endswith("fin")


@pytest.mark.parametrize("text", ["a " * 4000, "Phrase un. Phrase Deux. " * 300, "x" * 9000, "court", "| a | b |\n| --- | --- |\n" + "| 1 | 2 |\n" * 900, "mot\n" * 3000, "p1\n\n" + "y" * 2990 + "\n\nz"])
def test_split_bounds_and_text(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    parts = df.select(pack.split_text(F.col("t"))).first()[0]
    assert all(len(p) <= 3750 for p in parts) and sum(len(p) > 3000 for p in parts) <= 1
    if not text.startswith("|"):
        assert "".join("".join(parts).split()) == "".join(text.split())
    df.createOrReplaceTempView("texts")
    pack.register(spark, "texts", text="t")
    assert [r.part_text for r in spark.sql("SELECT part_text FROM text_parts ORDER BY part").collect()] == parts


def test_reflow(spark):
    raw = "<!--pg:1-->\nLe contribuable est exemp-\ntions de la taxe\n:\n<!--pg:2-->\nsur les sels.\n• un ;\n• deux ;\nde 0 A 10 5%\nPlus de 10 7%\n| a | b |\n| --- | --- |\n\n<!--art:3-->\n**Art. 3 :** Fin"
    got = [r.text for r in reflow.reflow(lines(spark, raw), spark.createDataFrame([("d", 80.0)], "doc_id string, p95 double")).orderBy("seq").collect()]
    assert got == ["<!--pg:1-->", "Le contribuable est exemptions de la taxe : <!--pg:2--> sur les sels.", "", "- un ;", "- deux ;", "", "| Tranche (FCFA) | Taux |", "| --- | --- |", "| de 0 à 10 | 5% |", "| plus de 10 | 7% |", "", "| a | b |", "| --- | --- |", "", "<!--art:3-->", "**Art. 3 :** Fin"]


def page(rows):
    """(page, text, size, y0, bold) as lines of a document of 600 points a page."""
    return [("d", p, i, t, 50.0, float(y), 300.0, float(y) + size, float(size), b, 14.0, 600.0) for i, (p, t, size, y, b) in enumerate(rows)]


LINE = "doc_id string, page int, ix long, text string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean, gap_before double, page_h double"


def test_extraction(spark):
    rows = []
    for p in range(1, 5):
        rows += [(p, "CODE GÉNÉRAL", 11, 10, False), (p, str(100 + p), 11, 30, False)]
        rows += [(p, f"Art. {p} : Le texte{{{{fn:{p}}}}} de la page", 11, 100, False), (p, "petite remarque", 7, 500, False), (p, f"{{{{fn:{p}}}}} Loi N°{p} du 1 mai 2020", 7, 520, False)]
    rows.insert(2, (1, "LIVRE PREMIER : IMPÔTS AU PROFIT DE", 11, 60, True))
    rows.insert(3, (1, "L'ETAT", 11, 74, True))
    df = spark.createDataFrame(page(rows), LINE)
    docs = spark.createDataFrame([("d", "code")], "doc_id string, doc_type string")
    got = pipeline.extract(df, docs)
    raw = [r.text for r in got.raw.orderBy("seq").collect()]
    assert "# LIVRE PREMIER : IMPÔTS AU PROFIT DE L'ETAT" in raw
    assert "**Art. 2 :** Le texte[^fn2] de la page" in raw and "[^fn2]: Loi N°2 du 1 mai 2020" in raw
    assert not any("CODE GÉNÉRAL" in t for t in raw) and sum(t == "petite remarque" for t in raw) == 4
    # a note stays with the article that cites it
    assert raw.index("<!--art:2-->") < raw.index("[^fn2]: Loi N°2 du 1 mai 2020") < raw.index("<!--art:3-->")
    assert sorted((r.page, r.printed_page, r.reclaimed) for r in got.pages.collect()) == [(p, 100 + p, 1) for p in range(1, 5)]
    assert got.orphans.count() == 0


def test_notes_are_taken_once_and_looked_for_nearby(spark):
    body = spark.createDataFrame([("d", 1, 1, "a{{fn:1}}"), ("d", 2, 2, "b{{fn:1}} {{fn:7}}"), ("d", 9, 3, "c{{fn:1}}")], "doc_id string, page int, ix long, text string")
    defs = spark.createDataFrame([("d", 2, 1, "deux"), ("d", 5, 1, "cinq"), ("d", 3, 4, "perdu")], "doc_id string, page int, num int, text string")
    links = rawmd.note_links(body, defs)
    assert [(r.ix, r.num, r.def_page, r.fid) for r in links.orderBy("ix", "pos").collect()] == [(1, 1, 2, "fn1"), (2, 1, 5, "fn2"), (2, 7, None, None), (3, 1, None, None)]
    assert [r.text for r in rawmd.orphan_notes(defs, links).collect()] == ["perdu"]
    assert [r.text for r in rawmd.resolved(body, links).orderBy("ix").collect()] == ["a[^fn1]", "b[^fn2] ", "c"]


def test_spans_to_lines(spark):
    s = [("d", 1, 595.0, 800.0, 0, 0, "Loi", 11.0, False, False, 50.0, 100.0, 70.0, 111.0), ("d", 1, 595.0, 800.0, 0, 1, "du 1", 11.0, False, False, 75.0, 100.0, 95.0, 111.0), ("d", 1, 595.0, 800.0, 1, 0, "er", 6.0, False, True, 95.0, 99.0, 100.0, 106.0), ("d", 1, 595.0, 800.0, 2, 0, "12", 5.5, False, True, 100.0, 99.0, 106.0, 105.0), ("d", 1, 595.0, 800.0, 3, 0, None, 5.5, None, None, None, None, None, None)]
    df = spark.createDataFrame(s, "doc_id string, page int, page_w double, page_h double, raw_line int, span_ix int, text string, size double, bold boolean, sup boolean, x0 double, y0 double, x1 double, y1 double")
    assert [(r.text, r.size) for r in layout.page_lines(df.unionByName(df)).collect()] == [("Loi du 1er{{fn:12}}", 11.0)]


def test_qa_and_ocr(spark):
    md = lines(spark, "<!--art:1-->\nabc\n<!--art:4-->\n<!--art:2-->\nx\n<!--art:2-->")
    m = qa.article_marks(md)
    assert [r.missing for r in qa.missing_numbers(m).collect()] == [3]
    assert sorted((r.prev_id, r.id) for r in qa.order_violations(m).collect()) == [("2", "2"), ("4", "2")]
    assert [(r.id, r.n) for r in qa.duplicate_articles(m).collect()] == [("2", 2)]
    pages = spark.createDataFrame([("d", 1, "# Titre\nlogo: armes\n[icon: x] taux de 18 %\n| 1 | 2 |"), ("d", 2, None)], "doc_id string, page int, markdown string")
    r = ocr.page_report(pages).first()
    assert (r.n_pages, r.empty_pages, r.dropped_lines, r.headings, r.table_rows) == (2, 1, 1, 1, 1)
    assert [(f.page, f.text) for f in ocr.figure_lines(pages).collect()] == [(1, "[icon: x] taux de 18 %")]


def test_contexts_of_all_units(spark, tmp_path):
    hier = [("livre", "LIVRE I")]
    u = [("d", 0, "article", "1", None, hier, "court"), ("d", 0, "article", "1", None, hier, "court"), ("r__x", 0, "rescrit", "7", "TVA", None, "mot\n" * 1500), ("lois_de_x__1", 0, "section", None, "Objet", hier, None)]
    spark.createDataFrame(u, "doc_id string, unit_ix int, kind string, unit_key string, title string, hier array<struct<k:string,v:string>>, text string").write.parquet(f"{tmp_path}/units.parquet")
    m = [("d", "code", "LPF", 2020, 1), ("d", "code", "CGI", 2023, 2), ("r__x", "rescrits", None, None, 1), ("lois_de_x__1", None, None, None, 1)]
    spark.createDataFrame(m, "doc_id string, doc_type string, code string, version_year int, loaded_at int").write.parquet(f"{tmp_path}/documents_meta.parquet")
    got = sorted((r.doc_id, r.part, r.n_parts, r.context) for r in reference.all_unit_contexts(spark, str(tmp_path)).collect())
    assert got == [
        ("d", 0, 1, "CGI 2023 | LIVRE I | Art. 1"), ("lois_de_x__1", 0, 1, "Lois De X | LIVRE I | Objet"),
        ("r__x", 0, 2, "Rescrits fiscaux | R7 : TVA (partie 1/2)"), ("r__x", 1, 2, "Rescrits fiscaux | R7 : TVA (partie 2/2)"),
    ]


def test_empty_tables(spark):
    none = lines(spark, "x").limit(0)
    assert reflow.reflow(none).count() == 0
    assert pipeline.chunk(none, meta(spark))[0].count() == 0
