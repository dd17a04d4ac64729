import pytest
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions import text as T


def values(spark, rows, *cols):
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*cols).collect()]


def test_articles(spark):
    lines = ["Art. premier : Il est institué", "Art.50 : x", "Art. 84: y", "Article 12 bis. - z", "Articles 3-1 : q", "art. 5 : no", "Art. 2023 : no", None, ""]
    got = values(spark, lines, P.article_start(F.col("t"))["id"])
    assert got == ["1", "50", "84", "12bis", "3-1", None, None, None, None]


def test_headings(spark):
    lines = ["LIVRE PREMIER : IMPÔTS", "Première partie : Droits", "TITRE II", "Chapitre IX - TAXES", "Section 1 : Définition", "Paragraphe 2 - Revenus", "Section sans numéro", "Le titre premier", None]
    got = values(spark, lines, P.heading(F.col("t"))["level"])
    assert got == [1, 2, 3, 4, 5, 6, None, None, None]
    assert values(spark, ["DEUXIÈME PARTIE : X"], P.heading_label(P.heading(F.col("t"))["kind"], P.heading(F.col("t"))["num"])) == ["DEUXIÈME PARTIE"]


def test_sort_key_is_legal_order(spark):
    ids = ["171quater", "171", "172", "171ter", "171bis", "x"]
    df = spark.createDataFrame([(i,) for i in ids], "t string").orderBy(P.article_sort_key(F.col("t")))
    assert [r.t for r in df.collect()] == ["171", "171bis", "171ter", "171quater", "172", "x"]


def test_references(spark):
    text = "selon les articles 14 à 68 du CGI, l'article 17 du présent code et art. 92-k"
    got = values(spark, [text, "", None], P.references(F.col("t")))
    assert [(r.nums, r.is_range, r.target) for r in got[0]] == [(["14", "68"], True, "CGI"), (["17"], False, "self"), (["92-k"], False, None)]
    assert got[1] == [] and got[2] is None


def test_brackets(spark):
    got = values(spark, ["de 900 001 A 3 000 000 3%", "Plus de 20 000 000 35%", "de 0 A 900 000 exonéré", "de 5 à table"], P.bracket(F.col("t")))
    assert [tuple(g) if g else None for g in got] == [("900 001", "3 000 000", "3%"), ("20 000 000", None, "35%"), ("0", "900 000", "exonéré"), None]


@pytest.mark.parametrize(("line", "yes"), [("- revenus", True), ("1) un", True), ("1 - un", True), ("2° deux", True), ("a) lettre", True), ("ii) deux", True), ("le texte", False), ("2023 fut", False)])
def test_list_start(spark, line, yes):
    assert values(spark, [line], F.col("t").rlike(P.LIST_START)) == [yes]


def test_notes(spark):
    n = values(spark, ["Loi N°2022-022 du 27 décembre 2022 portant Loi de Finances, Exercice 2023", "sans loi", None], P.note(F.col("t")))
    assert (n[0].law, n[0].date, n[0].exercice) == ("Loi N°2022-022", "27 décembre 2022", 2023)
    assert (n[1].law, n[1].exercice, n[2]) == (None, None, None)


@pytest.mark.parametrize(("acc", "line", "want"), [("voir ci-", "dessous la", "voir ci-dessous la"), ("les exemp-", "tions sont", "les exemptions sont"), ("N°2022-", "022 du", "N°2022-022 du"), ("les Etats-", "Unis", "les Etats-Unis"), ("eux-", "mêmes.", "eux-mêmes."), ("un mot", "puis", "un mot puis")])
def test_hyphens(spark, acc, line, want):
    df = spark.createDataFrame([(acc, line)], "a string, b string")
    assert df.select(T.join_pair(F.col("a"), F.col("b"))).first()[0] == want


def test_text_functions(spark):
    assert values(spark, ["l\u2019e\u0301tat\u00a0ﬁnal\u200b  x ", None, ""], T.normalize_chars(F.col("t"))) == ["l'état final x", None, ""]
    assert values(spark, ["le 1 er janvier , ( x ) cidessous euxmêmes"], T.fix_text(F.col("t"))) == ["le 1er janvier, (x) ci-dessous eux-mêmes"]
    assert values(spark, ["<!--pg:3-->**Art. 1 :** texte[^fn1]\n\n\n\nfin"], T.clean_text(F.col("t"))) == ["Art. 1 : texte\n\nfin"]
    assert values(spark, ["• un", "**gras**", "- deux"], T.normalize_bullet(F.col("t"))) == ["- un", "**gras**", "- deux"]


def test_page_mark_inside_a_paragraph(spark):
    items = [("t", "le mot exemp-"), ("pg", "<!--pg:2-->"), ("t", "tion suit"), ("pg", "<!--pg:3-->")]
    df = spark.createDataFrame([(items,)], "i array<struct<kind:string,text:string>>")
    assert df.select(T.join_items(F.col("i"))).first()[0] == "le mot exemption <!--pg:2--> suit"
