import random

import pytest
from pyspark.sql import functions as F

from juriflow.llm import repeats

SCHEMA = "doc_id long, text string, lang string, h long"


def brute(texts: dict, span: int):
    where: dict = {}
    for d, t in texts.items():
        for i in range(len(t or "") - span + 1):
            where.setdefault(t[i : i + span], set()).add((d, i))
    pairs, covered = set(), {d: set() for d in texts}
    for places in where.values():
        docs = {d for d, _ in places}
        if len(docs) > 1:
            pairs |= {(a, b) for a in docs for b in docs if a < b}
            for d, i in places:
                covered[d] |= set(range(i, i + span))
    return pairs, {d: len(c) for d, c in covered.items()}


def corpus(seed: int, letters: str = "abcdefgh éà€😀"):
    r = random.Random(seed)
    noise = lambda n: "".join(r.choice(letters) for _ in range(n))
    passages = [noise(r.choice([190, 199, 200, 201, 230, 420])) for _ in range(12)]
    texts = {i: noise(r.choice([0, 5, 60, 250])) + r.choice(passages) + noise(r.choice([0, 3, 90])) + r.choice([*passages, ""]) for i in range(60)}
    texts |= {100: texts[3], 101: texts[3], 102: None, 103: "", 104: "x", 105: "ab" * 300, 106: "ab" * 260, 107: texts[5][:200], 108: noise(30000) + texts[7]}
    return texts


@pytest.mark.parametrize(("seed", "held"), [(1, repeats.HELD), (2, 2), (3, repeats.HELD)])
def test_pairs_and_shares_against_brute_force(spark, seed, held):
    texts = corpus(seed, "ab" if seed == 3 else "abcdefgh éà€😀")
    df = spark.createDataFrame([(d, t, None, d) for d, t in texts.items()], SCHEMA).repartition(3)
    pairs, covered = brute(texts, repeats.SPAN)
    assert {tuple(r) for r in repeats.sharing_pairs(df, held=held).collect()} == pairs
    got = {r.doc_id: r for r in repeats.shared_share(df, held=held).collect()}
    assert set(got) == set(texts)
    assert {d: got[d].shared_chars for d in texts} == covered


def test_empty_and_null(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repeats.sharing_pairs(none).count() == 0
    assert repeats.shared_share(none).count() == 0
    odd = spark.createDataFrame([(None, "z" * 500, "fr", 1), (1, None, None, 1)], SCHEMA)
    assert repeats.sharing_pairs(odd).count() == 0
    assert [(r.doc_id, r.share) for r in repeats.shared_share(odd).collect()] == [(1, 0.0)]


def test_long_text_in_blocks():
    a = repeats.Anchors()
    text = "".join(random.Random(5).choice("abcdefghij") for _ in range(5000))
    whole = dict(zip(*(x.tolist() for x in a.find(text)), strict=True))
    old, repeats._BLOCK = repeats._BLOCK, 1024
    try:
        cut = dict(zip(*(x.tolist() for x in a.find(text)), strict=True))
    finally:
        repeats._BLOCK = old
    starts = sorted(cut)
    assert set(whole) & set(cut) and all(whole.get(p, cut[p]) == cut[p] for p in cut)
    assert max(b - c for b, c in zip(starts[1:], starts, strict=False)) <= 101


def test_a_hot_passage(spark):
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, short = noise(300), noise(199)
    texts = {i: noise(150) + passage + noise(60) for i in range(300)} | {1000 + i: noise(90) + short + noise(90) for i in range(300)} | {5000: passage[40:260], 5001: noise(30) + passage[:205]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    members = repeats.span_members(df, held=40)
    # one span holds every document that has the passage, and the rows are far fewer than the pairs
    assert members.groupBy("span").agg(F.count_distinct("doc_id").alias("n")).agg(F.max("n")).first()[0] >= 300
    want = brute(texts, repeats.SPAN)[0]
    assert {r.doc_id for r in members.select("doc_id").distinct().collect()} == {i for pair in want for i in pair}
    assert members.count() < len(want) / 2
    assert {tuple(p) for p in repeats.sharing_pairs(df, held=40).collect()} == want
