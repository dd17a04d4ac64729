import random

from pyspark.sql import functions as F

from juriflow.llm import boilerplate, characters, mixing, packing, tokens

LINES = "doc_id string, page int, seq long, text string, fixed string"


def test_repair_by_script_and_vocabulary(spark):
    cases = {"lа tаxe": "la taxe", "а": "a", "λόγος": "λόγος", "Δt": "Δt", "νille": "ville", "νxqz": "νxqz", "ｒｕｓｓｅ налог": "russe налог", "": "", "plain": "plain", "été": "été"}
    rows = spark.createDataFrame([(k, 1) for k in [*cases, None, "Δt"]], "text string, fixed int")
    vocab = spark.createDataFrame([("ville", 9)], "word string, n long")
    got = characters.repair(rows, vocab)
    assert got.count() == len(cases) + 2
    found = {r.text: r.fixed for r in got.collect()}
    assert found == {**cases, None: None}
    assert characters.repair(rows.limit(0), vocab).count() == 0
    # without a vocabulary a weak look-alike stays
    blind = {r.text: r.fixed for r in characters.repair(rows, vocab.limit(0)).collect()}
    assert blind == found | {"νille": "νille"}
    tokens = spark.createDataFrame([(t,) for t in ("νille", "lа", "λόγος", "νxqz", "lа")], "token string")
    basis = {r.token: (r.script, r.basis) for r in characters.token_repairs(tokens, vocab).collect()}
    assert basis == {"νille": ("Latin", "vocabulary"), "lа": ("Latin", "script"), "λόγος": ("Greek", "foreign"), "νxqz": ("Latin", "none")}


def test_texts_differ_but_for_spaces(spark):
    rows = spark.createDataFrame([("d", 1, 1, "a  b", ""), ("d", 1, 2, "a b", ""), ("d", 1, 3, None, ""), ("d", 1, 4, "½ part", "")], LINES)
    assert [r.seq for r in characters.differing(rows.drop("fixed"), characters.vocabulary(rows)).collect()] == [2]


def test_boilerplate(spark):
    rows = []
    for i in range(20):
        rows += [(f"d{i}", 1, 0, f"Haut de page {i} !", None), (f"d{i}", 1, 1, "Mentions lеgales" if i % 2 else "MENTIONS  LEGALES", None), (f"d{i}", 1, 2, f"corps {'abcdefghijklmnopqrstuvwxyz'[i]}", None)]
        rows += [(f"d{i}", 1, 3, "rare", None)] * (3 if i < 3 else 0) + [(f"d{i}", 1, 4, "12", None), (f"d{i}", 1, 5, None, None)]
    rows += [("x", 1, 0, "Haut de page 3", None)] + rows[:6]
    df = spark.createDataFrame(rows, LINES)
    docs = spark.createDataFrame([(f"d{i}", "site") for i in range(20)] + [("x", "other"), (None, "site"), ("d0", "site")], "doc_id string, source string")
    got = boilerplate.boilerplate_lines(df, docs).collect()
    assert sorted((r.doc_id, r.seq) for r in got) == sorted((f"d{i}", s) for i in range(20) for s in (0, 1))
    # the two lines follow each other everywhere, so they are one block
    assert len({r.block for r in got}) == 1
    report = boilerplate.block_report(boilerplate.boilerplate_lines(df, docs)).collect()
    assert [(r.lines, r.least_support, r.occurrences, r.rows, r.documents) for r in report] == [(2, 20, 20, 40, 20)]
    # apart in the documents, the same lines are two blocks: the edges decide
    apart = boilerplate.boilerplate_lines(df.filter("seq <> 0").unionByName(df.filter("seq = 0").withColumn("seq", F.col("seq") + 50)), docs)
    assert sorted((r.lines, r.occurrences) for r in boilerplate.block_report(apart).collect()) == [(1, 20), (1, 20)]
    kept = boilerplate.without_boilerplate(df, docs)
    assert kept.count() == len([r for r in rows if not (r[0] != "x" and r[2] in (0, 1))])
    assert boilerplate.boilerplate_lines(df.limit(0), docs).count() == 0


def test_plan_packs_everything_tightly():
    r = random.Random(1)
    for cap in (50, 512):
        hist = {r.randint(1, cap): r.randint(1, 40) for _ in range(60)}
        rows = packing.plan(hist, cap)
        bins: dict[int, int] = {}
        used = dict.fromkeys(hist, 0)
        for size, first, per, times, start in rows:
            assert first == used[size]
            used[size] += per * times
            for b in range(start, start + times):
                bins[b] = bins.get(b, 0) + size * per
        assert used == hist and max(bins.values()) <= cap
        total = sum(s * n for s, n in hist.items())
        assert len(bins) <= 1.1 * total / cap + 2


def test_fullest_against_brute_force():
    r = random.Random(2)
    for _ in range(200):
        left = {r.randint(1, 20): r.randint(1, 3) for _ in range(5)}
        room = r.randint(1, 60)
        sums = {0}
        for s, n in left.items():
            sums = {a + s * k for a in sums for k in range(n + 1) if a + s * k <= room}
        got = packing.fullest(sorted(left, reverse=True), left, room)
        assert sum(got) == max(sums) and all(got.count(s) <= left[s] for s in got)


def test_pack(spark):
    sizes = [0, None, 5, 5, 5, 12, 25, 10, 3, 3, 3, 1]
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)] + [(2, 5, "again")], "doc_id long, n int, bin string")
    got = packing.pack(df, {1: 10, 2: 100}, "doc_id", F.col("n"), shard_rows=2).collect()
    for spec, cap in ((1, 10), (2, 100)):
        rows = [r for r in got if r.spec_id == spec]
        bins: dict[int, int] = {}
        for r in rows:
            if r.size:
                bins[r.bin] = bins.get(r.bin, 0) + r.size
            else:
                assert r.bin is None
        assert max(bins.values()) <= cap and sum(bins.values()) == sum(s or 0 for s in sizes) + 5
        assert sorted(bins) == list(range(len(bins)))
    assert sorted(r.size for r in got if r.spec_id == 1 and r.doc_id == 6) == [5, 10, 10]
    assert packing.pack(df.limit(0), {1: 10}, "doc_id", F.col("n")).count() == 0


def test_mix(spark):
    r = random.Random(3)
    docs = [(i, "big" if i % 3 else "small", r.randint(50, 150)) for i in range(600)] + [(900, None, 10), (901, "big", 0), (902, "big", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([(1, "big", 0.5, 1), (1, "small", 0.5, 4), (2, "small", 0.7, 1), (2, "none", 0.3, 4)], "mix_id int, source string, target_share double, max_repeats int")
    got = mixing.mix(df, targets)
    rows = got.collect()
    assert len({(x.mix_id, x.doc_id, x.use) for x in rows}) == len(rows)
    report = {(x.mix_id, x.source): x for x in mixing.shares(got, targets).collect()}
    assert abs(report[1, "big"].reached_share - 0.5) < 0.01 and report[1, "big"].most_uses == 1 and report[1, "small"].most_uses <= 4
    assert report[2, "none"].tokens == 0 and report[2, "small"].reached_share == 1.0
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(df.repartition(7), targets).collect()))
    assert mixing.mix(df.limit(0), targets).count() == 0
    assert sum(x.tokens for x in mixing.mix(df, targets, budget=5000).filter("mix_id = 1").collect()) <= 5000


def test_token_counts_are_exact():
    import base64

    import tiktoken

    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    count = tokens.counter(tokens.VOCABULARY)
    r = random.Random(4)
    for _ in range(500):
        text = "".join(r.choice(["l'", "acompte", " ", "\n", "12", ",", "é", " ", "'s", "  ", "\t", "😀", "sur"]) for _ in range(r.randint(0, 40)))
        assert count(text) == len(encode(text)), repr(text)
    assert count(None) == 0
