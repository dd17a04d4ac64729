import json
from pathlib import Path

from juriflow import cli
from juriflow.operators import chunks, inspect, layout, ocr, qa
from juriflow.streaming.incremental import stream_documents

LINE = "doc_id string, page int, seq long, text string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean, gap_before double, page_h double"
TABLE = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>"


def page(doc, rows):
    return [(doc, p, i, t, x, float(y), x + 200, float(y) + size, float(size), b, gap, 600.0) for i, (p, t, size, y, b, x, gap) in enumerate(rows)]


def both_codes():
    rows = []
    for p in range(1, 7):
        rows += [(p, "RECUEIL DES TEXTES", 11, 10, False, 50.0, 0.0), (p, str(10 + p), 11, 580, False, 300.0, 0.0)]
        rows += [(p, f"Art. {p if p < 4 else p - 3} : Le redevable dépose une déclaration dans le délai fixé par la loi{{{{fn:{p}}}}}", 11, 100, False, 50.0, 14.0)]
        rows += [(p, "et la porte au bureau qui la reçoit avant la fin du mois", 11, 114, False, 50.0, 14.0), (p, f"{{{{fn:{p}}}}} Loi N°{p} du 1 mai 2020", 7, 520, False, 50.0, 14.0)]
    return page("deux_codes", rows)


def booklet():
    rows = [(1, "GRAND TITRE", 20, 60, True, 50.0, 0.0), (1, "SUR DEUX LIGNES", 20, 90, True, 50.0, 30.0), (1, "Le texte du cahier explique la mesure à tous les lecteurs du service", 11, 120, False, 50.0, 14.0)]
    rows += [(1, "a b 1 2", 11, 205, False, 60.0, 14.0), (1, "Objet de la mesure", 11, 300, True, 50.0, 30.0), (1, "La mesure vise les entreprises nouvelles de la région et leurs salariés", 11, 320, False, 50.0, 14.0)]
    return page("cahier", rows)


MANIFEST = """
docs:
  - doc_id: deux_codes
    doc_type: code
    version_year: 2023
    subdocs: [{code: CGI, first_page: 1}, {code: LPF, first_page: 4}]
  - doc_id: cahier
    doc_type: generic
    layout: {skip_pages: [9], gap_factor: 1.6}
"""


def records(path, name):
    return [json.loads(line) for f in sorted(Path(path, name).glob("*.json")) for line in f.read_text(encoding="utf-8").splitlines()]


def text_of(path, name, doc):
    return next(Path(path, name, f"doc_id={doc}").glob("*.txt")).read_text(encoding="utf-8")


def test_stages_one_after_the_other(spark, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    spark.createDataFrame(both_codes() + booklet(), LINE).write.parquet(f"{data}/doc_lines.parquet")
    good = ("cahier", 1, 50.0, 200.0, 400.0, 230.0, [["a", "b|c"], ["1", "2"], ["3", None]])
    bad = ("cahier", 1, 50.0, 300.0, 400.0, 330.0, [["seul"]])
    spark.createDataFrame([good, bad], TABLE).write.parquet(f"{data}/pdf_tables.parquet")
    listed = tmp_path / "docs.yaml"
    listed.write_text(MANIFEST, encoding="utf-8")
    cli.main(["extract", "--data", data, "--out", out, "--manifest", str(listed)], spark)
    code = text_of(out, "raw", "deux_codes__LPF")
    # parts are documents of their own; notes stay with the article that cites them, running lines and page numbers go
    assert "code: LPF" in code and "source_doc_id: deux_codes" in code and "<!--art:1-->" in code and "[^fn1]: Loi N°4 du 1 mai 2020" in code and "RECUEIL" not in code
    book = text_of(out, "raw", "cahier")
    # a good table replaces the lines inside it, a bad one does not
    assert "# GRAND TITRE SUR DEUX LIGNES" in book and "| a | b\\|c |" in book and "a b 1 2" not in book and "**Objet de la mesure**" in book
    report = {r["doc_id"]: r for r in records(out, "extract_report")}
    assert report["deux_codes__CGI"]["n_articles"] == 3 and report["deux_codes__CGI"]["dropped_lines"] == {"page_number": 3, "running_header_footer": 3}
    assert [m["text"] for m in report["cahier"]["multiline_headings"]] == ["GRAND TITRE SUR DEUX LIGNES … (2 lignes)"]
    cli.main(["clean", "--data", out, "--out", out], spark)
    clean = text_of(out, "clean", "deux_codes__CGI")
    assert clean.startswith("---\n") and "loi[^fn1] et la porte au bureau" in clean
    cli.main(["chunk", "--data", out, "--out", out, "--max-chars", "400"], spark)
    found = [c for c in records(out, "chunks") if c["doc_id"] == "deux_codes__LPF"]
    assert [(c["article"], c["page_start"], c["printed_page_start"], len(c["amended_by"])) for c in sorted(found, key=lambda c: c["article"])] == [("1", 4, 14, 1), ("2", 5, 15, 1), ("3", 6, 16, 1)]
    assert {s["doc_id"]: s["n_chunks"] for s in records(out, "stats")}["deux_codes__CGI"] == 3
    cli.main(["inspect", "--data", data, "--out", out, "--manifest", str(listed), "--doc", "deux_codes", "--dump", "1"], spark)
    seen = text_of(out, "inspect", "deux_codes")
    assert "6 articles, first 1, last 3" in seen and "recueil des textes (6)" in seen and "Articles found more than once" in seen


def test_ocr_stage(spark, tmp_path):
    data, out = str(tmp_path), str(tmp_path / "out")
    spark.createDataFrame([("scan", bytearray(b"x"), 3)], "doc_id string, content binary, n_pages int").write.parquet(f"{data}/files.parquet")
    # executors need the module too
    (tmp_path / "fake_service.py").write_text("def pages(name, content, options):\n    return [f'# {name}\\n\\nLogo: armes\\n\\ntaux de 18 %', None]\n", encoding="utf-8")
    spark.sparkContext.addPyFile(str(tmp_path / "fake_service.py"))
    args = ["ocr", "--data", data, "--out", out, "--provider", "fake_service:pages", "--env", str(tmp_path / "none")]
    cli.main([*args, "--first", "1"], spark)
    assert not Path(out, "ocr_pages").exists() and Path(out, "trial", "raw").exists()
    cli.main(args, spark)
    raw = text_of(out, "raw", "scan")
    assert "structured_markdown: true" in raw and "<!--pg:2-->" in raw and "armes" not in raw
    assert "taux de 18 %" in text_of(out, "figures", "scan") and [(r["cached"], r["expected"]) for r in records(out, "page_counts")] == [(2, 3)]
    # cached documents are not parsed again: no provider is needed
    cli.main(["ocr", "--data", data, "--out", out, "--env", str(tmp_path / "none")], spark)


def test_provider_and_settings(tmp_path, monkeypatch):
    import pytest

    with pytest.raises(RuntimeError):
        ocr.HostedProvider().parse("a", b"", "fast", ("fr",))
    monkeypatch.delenv("K_ONE", raising=False)
    monkeypatch.setenv("K_TWO", "kept")
    with pytest.raises(RuntimeError):
        ocr.HostedProvider(lambda n, c, o: [], "K_ONE").parse("a", b"", "fast", ("fr",))
    (tmp_path / "e").write_text("# note\nK_ONE = \"v 1\"\nK_TWO=other\n\nnothing\n", encoding="utf-8")
    assert ocr.load_env(str(tmp_path / "e")) == {"K_ONE": "v 1"}
    assert ocr.HostedProvider(lambda n, c, o: [o["key"], None], "K_ONE").parse("a", b"", "fast", ("fr",)) == ["v 1", ""]


def test_quality_flags(spark):
    md = [(0, "<!--art:1-->"), (1, "renvoi[^fn1] et [^fn2]"), (2, "[^fn2]: note"), (3, "[^fn9]: sans appel"), (4, "12"), (5, "x" * 2501), (6, "<!--art:3-->"), (7, "<!--art:3-->")]
    rows = [("d", i, t) for i, t in md] + [("ok", 0, "<!--art:1-->"), ("ok", 1, "[^fn9]: sans appel"), ("ok", 2, "\ue000")]
    got = {(r.doc_id, r.flag) for r in qa.flags(spark.createDataFrame(rows, "doc_id string, seq long, text string")).collect()}
    assert got == {("d", f) for f in ("missing_numbers", "duplicate_articles", "order_violations", "refs_without_def", "digit_only_paragraphs", "very_long_paragraphs")}


def test_labels_and_inspection(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("loi-finances_2023a__x",)], "doc_id string")
    assert df.select(chunks.title_case(F.replace(F.element_at(F.split("doc_id", "__"), 1), F.lit("_"), F.lit(" ")))).first()[0] == "Loi-Finances 2023A"
    rows = [("s", 1, 0, "x" * 900, 10.0, 100.0, 20.0, 111.0, 11.0, False, 14.0, 600.0), ("s", 30, 1, "y", 300.0, 100.0, 310.0, 111.0, 11.0, False, 50.0, 600.0), ("s", 30, 2, "petit", 300.0, 120.0, 310.0, 128.0, 8.0, False, 30.0, 600.0)]
    lines = layout.as_lines(spark.createDataFrame(rows, LINE))
    stats = layout.doc_stats(lines, layout.settings(lines))
    r = inspect.text_per_page(lines).first()
    # 30 pages with 906 characters in all: the pages without text count
    assert (r.pages, r.min_chars, r.scan, r.skip) == (30, 0, True, True)
    assert tuple(inspect.large_gaps(lines, stats).first())[1:] == (2, 1)
    widths = spark.createDataFrame([("s", 30, 700.0)], "doc_id string, page int, page_w double")
    assert [inspect.two_columns(lines, stats, w).first()["right"] for w in (None, widths)] == [1, 0]


def test_stream_of_documents(spark, tmp_path):
    from juriflow.plans import pipeline

    source, out = str(tmp_path / "in"), str(tmp_path / "got")
    schema = "doc_id string, seq long, text string"
    spark.createDataFrame([("a", 0, "mot cou-"), ("a", 1, "pé")], schema).write.parquet(source)
    for _ in range(2):
        stream_documents(spark, source, schema, lambda d: pipeline.clean(d), out, str(tmp_path / "cp")).awaitTermination()
        spark.createDataFrame([("b", 0, "suite")], schema).write.mode("append").parquet(source)
    got = sorted((r.doc_id, r.text) for r in spark.read.parquet(out).collect())
    assert got == [("a", "mot coupé"), ("b", "suite")]
