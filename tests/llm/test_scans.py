from juriflow.llm import scans

SCHEMA = "doc_id string, page int, seq long, text string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean, gap_before double, page_h double, loaded_at timestamp"
BODY = [
    "et le redevable acquitte la taxe sur les sels auprès du bureau de cet",
    "endroit pour un montant de 3I6 francs et le redevable acquitte la contri-",
    "bution sur les sels et au chef-",
    "lieu du canton. Le redevablc acquitte la taxe sur les sels de",
    "1977",
    "1978",
    "fin de la page et le redevable acquitte la taxe",
]


def book(pages=6):
    rows, seq = [], 0
    for p in range(1, pages + 1):
        texts = [("BULLETIN FISCAL DE X" if p % 3 else "BULLFTIN FISCAL DE X", 150.0, 40.0)]
        varied = [t if t.isdigit() else t.replace(" ", f" {'abcdefg'[p] * 4} ", 1) for t in BODY]
        texts += [(t, 250.0 if t.isdigit() else 60.0, 100.0 + 20 * i) for i, t in enumerate(varied)]
        texts += [("Direction des impôts de X", 200.0, 770.0), (f"- {40 + p} -", 290.0, 800.0)]
        for t, x, y in texts:
            geometry = (x, y, x + 200, y + 10) if seq % 7 else (None,) * 4
            rows.append(("s", p, seq, t, *geometry, 10.0, None, None, 842.0, None))
            seq += 1
    return rows


def test_faults_and_paragraphs(spark):
    clean = [("b", 1, i, "Le redevable acquitte la contribution et la taxe au chef-lieu du canton de cet endroit", 60.0, 100.0, 300.0, 110.0, 10.0, False, 0.0, 842.0, None) for i in range(300)]
    lines = spark.createDataFrame(book() + clean + book()[:5], SCHEMA)
    meta = spark.createDataFrame([("s", "scan"), ("s", "scan"), ("b", None), (None, "scan")], "doc_id string, ocr string")
    units = spark.createDataFrame([("s", 0, "\n".join(r[3] for r in book(1))), ("s", 1, None), ("b", 0, "3I6")], "doc_id string, unit_ix int, text string")
    got = scans.noise(lines, units, meta).collect()
    by = {}
    for r in got:
        by.setdefault((r.src, r.fault), set()).add((r.pos, r.line_no))
    n = len(BODY) + 3
    assert by["doc_lines", "header"] == {(p * n + k, 0) for p in range(6) for k in (0, n - 2)}
    assert by["doc_lines", "page_number"] == {(p * n + n - 1, 0) for p in range(6)}
    assert by["doc_lines", "hyphen"] == {(p * n + 2, 0) for p in range(6)}
    assert by["doc_lines", "misread"] == {(p * n + k, 0) for p in range(6) for k in (2, 4)}
    assert by["units", "header"] == {(0, 1), (0, 9)} and by["units", "page_number"] == {(0, 10)} and by["units", "hyphen"] == {(0, 3)} and by["units", "misread"] == {(0, 3), (0, 5)}
    text = " ".join(r.text for r in scans.paragraphs(lines, meta).orderBy("para_no").collect())
    assert "la contribution" in text and "316 francs" in text and "redevable acquitte la taxe sur les sels de" in text and "redevablc" not in text and "BULLETIN" not in text


def test_paragraphs_of_units_and_notes(spark, monkeypatch):
    page = [("BULLETIN FISCAL", "header"), ("Art. 1 : la contri-", "body"), ("(1) Loi N°1-O14 du 1 mai 2010, por-", "note"), ("tant réforme", "note"), ("(2) Loi N°2", "note"), ("- 41 -", "page_number")]
    more = [("bution de 3I6 francs.", "body"), ("- 42 -", "page_number")]
    seq = iter(range(99))
    blocks = [("doc_lines", "s", k, 0, [(next(seq), t, label) for t, label in p]) for k, p in ((1, page), (2, more))]
    # the labels are given: here only what is made of them is tested
    labels = spark.createDataFrame(blocks, "src string, doc_id string, ord bigint, variant bigint, lines array<struct<seq:bigint,text:string,label:string>>")
    monkeypatch.setattr(scans, "line_blocks", lambda lines, documents: labels)
    rows = [("s", b[2], q, t, 60.0, 100.0, 200.0, 110.0, 10.0, None, None, 842.0, None) for b in blocks for q, t, _ in b[4]]
    lines, meta = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("s", "scan")], "doc_id string, ocr string")
    unit = "\n".join(t for t, _ in page + more)
    units = spark.createDataFrame([("s", 0, unit), ("s", 0, unit), ("s", 1, "finit en contri-"), ("s", 2, None), ("b", 0, "x")], "doc_id string, unit_ix int, text string")
    got = sorted((r.src, -1 if r.unit_ix is None else r.unit_ix, r.kind, r.para_no, r.text) for r in scans.paragraphs(lines, meta, units).collect())
    want = [("body", 1, "Art. 1 : la contribution de 316 francs."), ("note", 1, "(1) Loi N°1-014 du 1 mai 2010, portant réforme"), ("note", 2, "(2) Loi N°2")]
    assert got == [("doc_lines", -1, *w) for w in want] + [("units", 0, *w) for w in want] + [("units", 1, "body", 1, "finit en contri-")]


def test_empty(spark):
    lines = spark.createDataFrame(book(), SCHEMA)
    meta = spark.createDataFrame([("s", None)], "doc_id string, ocr string")
    units = spark.createDataFrame([], "doc_id string, unit_ix int, text string")
    assert scans.noise(lines, units, meta).count() == 0
