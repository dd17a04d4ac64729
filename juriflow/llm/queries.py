"""Queries of the problems tagged llm, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from juriflow.functions.consistent import CYRILLIC_DOUBLES, DOUBLES, GREEK_DOUBLES, JOINED, SINGLE
from juriflow.llm import boilerplate, characters, mixing, packing, repeats, scans
from juriflow.llm.tokens import VOCABULARY, token_count
from juriflow.session import stored, table


def p1_found(spark, d):
    found = characters.inconsistent_texts(table(spark, d, "doc_lines"), table(spark, d, "spans"), table(spark, d, "documents_meta"))
    return found.select("src", "doc_id", "page", "pos", "span_ix").distinct()


def p1_repaired(spark, d):
    return characters.inconsistent_texts(table(spark, d, "doc_lines"), table(spark, d, "spans"), table(spark, d, "documents_meta"))


def p1_tokens(spark, d):
    return characters.repaired_tokens(table(spark, d, "doc_lines"), table(spark, d, "spans"), table(spark, d, "documents_meta"))


def p2_found(spark, d):
    documents = characters.born_digital(table(spark, d, "documents_meta"))
    return boilerplate.boilerplate_lines(table(spark, d, "doc_lines"), documents).select("doc_id", "seq").distinct()


def p2_kept(spark, d):
    documents = characters.born_digital(table(spark, d, "documents_meta"))
    return boilerplate.without_boilerplate(table(spark, d, "doc_lines").select("doc_id", "page", "seq", "text"), documents)


def p2_blocks(spark, d):
    documents = characters.born_digital(table(spark, d, "documents_meta"))
    return boilerplate.block_report(boilerplate.boilerplate_lines(table(spark, d, "doc_lines"), documents)).drop("block")


def p4_found(spark, d):
    return scans.noise(table(spark, d, "doc_lines"), table(spark, d, "units"), table(spark, d, "documents_meta"))


def p4_paragraphs(spark, d):
    return scans.paragraphs(table(spark, d, "doc_lines"), table(spark, d, "documents_meta"), table(spark, d, "units"))


def p6_packed(spark, d, vocabulary=VOCABULARY):
    # a fixed list of three kinds of containers
    capacities = {r.spec_id: r.capacity_tokens for r in table(spark, d, "pack_specs").select("spec_id", "capacity_tokens").dropna().collect()}
    return packing.pack(table(spark, d, "documents"), capacities, "doc_id", token_count(F.col("text"), vocabulary))


def p6_fill(spark, d):
    return packing.fill(p6_packed(spark, d))


def p6_checks(spark, d):
    """What must hold of the packing, per spec: every document is there once, nothing is lost, no bin is over its capacity, nothing is split that fits."""
    p = stored(p6_packed(spark, d))
    doc = p.groupBy("spec_id", "capacity", "doc_id").agg(F.sum("size").alias("_all"), F.count(F.lit(1)).alias("_n"), F.count_distinct("piece").alias("_k"), F.max("piece").alias("_m"))
    size = token_sizes(spark, d)
    doc = doc.join(size, "doc_id", "full")
    whole = doc.groupBy("spec_id", "capacity").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(~F.col("_all").eqNullSafe(F.col("tokens"))).alias("wrong_size"), F.count_if((F.col("_n") != F.col("_k")) | (F.col("_m") != F.col("_n") - 1)).alias("wrong_pieces"),
        F.count_if((F.col("_all") <= F.col("capacity")) & (F.col("_n") > 1)).alias("split_in_vain"),
    )
    bins = p.filter("bin IS NOT NULL").groupBy("spec_id", "capacity", "bin").agg(F.sum("size").alias("_s"))
    bins = bins.groupBy("spec_id").agg(F.count_if(F.col("_s") > F.col("capacity")).alias("over_capacity"), (F.sum("_s") >= 0.95 * F.sum("capacity")).alias("tight"), (F.max("bin") + 1 == F.count(F.lit(1))).alias("numbered"))
    return whole.join(bins, "spec_id")


def token_sizes(spark, d, vocabulary=VOCABULARY):
    return stored(table(spark, d, "documents").select("doc_id", token_count(F.col("text"), vocabulary).alias("tokens")))


def p7_checks(spark, d):
    """What must hold of each mix and source: the share that its sources with documents give it is reached within 2 % of all tokens, or within one document where that is more, and no document is used too often."""
    targets = table(spark, d, "mix_targets")
    mixed = stored(p7_mixed(spark, d))
    shares = stored(mixing.shares(mixed, targets))
    step = mixed.groupBy("mix_id").agg(F.greatest(F.lit(0.02), F.max("tokens") / F.sum("tokens")).alias("_step"))
    there = table(spark, d, "documents").filter("source IS NOT NULL AND text <> ''").select("source").distinct().withColumn("_there", F.lit(True))
    t = targets.join(there, "source", "left").withColumn("_share", F.when(F.col("_there"), F.col("target_share")).otherwise(0.0))
    whole = t.groupBy("mix_id").agg(F.sum("_share").alias("_whole"))
    t = t.join(whole, "mix_id").join(step, "mix_id", "left").join(shares.select("mix_id", "source", "reached_share", "most_uses"), ["mix_id", "source"], "left")
    wanted = F.col("_share") / F.col("_whole")
    return t.select("mix_id", "source", F.round(wanted, 6).alias("wanted"), (F.abs(F.col("reached_share") - wanted) <= F.coalesce("_step", F.lit(0.02))).alias("reached"), (F.col("most_uses") <= F.col("max_repeats")).alias("within_repeats"))


def sized(spark, d, vocabulary=VOCABULARY):
    return table(spark, d, "documents").filter("source IS NOT NULL").select("doc_id", "source", token_count(F.col("text"), vocabulary).alias("tokens"))


def p7_mixed(spark, d):
    return mixing.mix(sized(spark, d), table(spark, d, "mix_targets"))


def p7_shares(spark, d):
    return mixing.shares(p7_mixed(spark, d), table(spark, d, "mix_targets"))


def p8_found(spark, d):
    return repeats.sharing_pairs(table(spark, d, "documents"))


def p8_members(spark, d):
    return repeats.span_members(table(spark, d, "documents"))


def p8_shares(spark, d):
    return repeats.shared_share(table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found, "p1_repaired": p1_repaired, "p1_tokens": p1_tokens, "p2_found": p2_found, "p2_kept": p2_kept, "p2_blocks": p2_blocks, "p4_found": p4_found, "p4_paragraphs": p4_paragraphs,
    "p6_packed": p6_packed, "p6_fill": p6_fill, "p6_checks": p6_checks, "p7_mixed": p7_mixed, "p7_shares": p7_shares, "p7_checks": p7_checks, "p8_found": p8_found, "p8_shares": p8_shares, "p8_members": p8_members,
}


def _tr(c: str, m: dict[str, str]) -> str:
    kept, gone = [k for k, v in m.items() if v], [k for k, v in m.items() if not v]
    q = lambda s: s.replace("'", "''")
    return f"translate({c}, '{q(''.join(kept + gone))}', '{q(''.join(m[k] for k in kept))}')"


def _form(c: str) -> str:
    """The consistent form in SQL: word by word for the look-alikes."""
    spaces = {k: v for k, v in SINGLE.items() if v == " " or k == "\t"}
    rest = {k: v for k, v in SINGLE.items() if k not in spaces}
    out = f"regexp_replace({c}, '[\\t\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', ' ', 'g')"
    out = _tr(out, rest)
    for glyph, letters in JOINED.items():
        out = f"replace({out}, '{glyph}', '{letters}')"
    other = "[" + "".join(sorted(set("αβγδεζηθικλμνξπρςστυφχψωΓΔΘΛΞΠΣΦΨΩбвгдєжзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ") - set(CYRILLIC_DOUBLES) - set(GREEK_DOUBLES))) + "]"
    words = f"regexp_extract_all({out}, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+')"
    fixed = f"list_aggregate(list_transform({words}, lambda w: CASE WHEN regexp_matches(w, '\\p{{Latin}}') OR NOT regexp_matches(w, '{other}') THEN {_tr('w', DOUBLES)} ELSE w END), 'string_agg', '')"
    return f"nfc_normalize(CASE WHEN {c} = '' THEN '' ELSE {fixed} END)"


_BORN = "born AS (SELECT DISTINCT doc_id, source FROM documents_meta WHERE ocr IS NULL)"
_P1 = f"""
WITH {_BORN}, t AS (
 SELECT 'doc_lines' AS src, doc_id, page, seq AS pos, CAST(0 AS INTEGER) AS span_ix, text FROM doc_lines
 UNION ALL SELECT 'spans', doc_id, page, CAST(raw_line AS BIGINT), span_ix, text FROM spans),
f AS (SELECT t.*, {_form('text')} AS fixed FROM t WHERE doc_id IN (SELECT doc_id FROM born) AND regexp_matches(text, '[^\\x20-\\x7EÀ-ÿ]')),
found AS (SELECT * FROM f WHERE regexp_replace(text, ' +', ' ', 'g') <> regexp_replace(fixed, ' +', ' ', 'g'))
"""
_P2 = f"""
WITH {_BORN}, k AS (SELECT source, doc_id, page, seq, regexp_replace(regexp_replace(regexp_replace(lower({_form('text')}), '\\s+', '', 'g'), '[0-9]+([.,][0-9]+)*', '0', 'g'), '\\p{{P}}+$', '') AS key
 FROM doc_lines JOIN born USING (doc_id)),
need AS (SELECT source, greatest(4, ceil(0.2 * count(*))) AS need FROM born GROUP BY ALL),
node AS (SELECT source, key FROM k JOIN need USING (source) WHERE regexp_matches(key, '\\p{{L}}') GROUP BY source, key, need HAVING count(DISTINCT doc_id) >= need),
found AS (SELECT DISTINCT doc_id, seq FROM k JOIN node USING (source, key))
"""

_P2_BLOCKS = """, hit AS (SELECT DISTINCT source, doc_id, seq, key FROM k JOIN node USING (source, key)),
edge AS (SELECT a.source, b.key AS pk, a.key AS key FROM hit a JOIN hit b ON a.doc_id = b.doc_id AND a.source = b.source AND a.seq = b.seq + 1 JOIN need ON need.source = a.source GROUP BY ALL HAVING count(DISTINCT a.doc_id) >= any_value(need)),
link AS (SELECT source, pk AS x, key AS y FROM edge UNION SELECT source, key, pk FROM edge UNION SELECT source, key, key FROM node),
reach AS (SELECT source, x, y FROM reach0), blk AS (SELECT source, x AS key, min(y) AS block FROM reach GROUP BY ALL),
p AS (SELECT hit.*, block FROM hit JOIN blk USING (source, key)),
sup AS (SELECT source, block, key, count(DISTINCT doc_id) AS support FROM p GROUP BY ALL),
o AS (SELECT source, block, count(*) AS occurrences FROM p WHERE NOT EXISTS (FROM p q WHERE q.source = p.source AND q.block = p.block AND q.doc_id = p.doc_id AND q.seq = p.seq - 1) GROUP BY ALL)
SELECT p.source, count(DISTINCT key) AS lines, min(support) AS least_support, max(support) AS most_support, count(*) AS rows, any_value(occurrences) AS occurrences, count(DISTINCT doc_id) AS documents
FROM p JOIN sup USING (source, block, key) JOIN o USING (source, block) GROUP BY p.source, p.block"""

#: Every window of 200 code points by its hash, and those that several documents have.
_P8 = """WITH d AS (SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL AND length(text) >= 200),
w AS (SELECT doc_id, pos, hash(substr(text, pos, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS pos FROM d)),
g AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)), hit AS (SELECT doc_id, pos, h FROM w WHERE h IN (FROM g))"""

ORACLE = {
    "p8_found": _P8 + ", o AS (SELECT DISTINCT doc_id, h FROM hit) SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM o a JOIN o b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p8_shares": _P8 + """, c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first, count(*) OVER (PARTITION BY text) AS copies FROM d),
 s AS (SELECT doc_id, CAST(sum(least(200, coalesce(nx - pos, 200))) AS BIGINT) AS chars FROM (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS nx FROM (SELECT DISTINCT doc_id, pos FROM hit)) GROUP BY doc_id),
 r AS (SELECT DISTINCT doc_id, coalesce(length(text), 0) AS n_chars FROM documents WHERE doc_id IS NOT NULL)
 SELECT r.doc_id, coalesce(c.first, r.doc_id) AS first, coalesce(copies, 1) AS copies, n_chars, coalesce(chars, 0) AS shared_chars, CASE WHEN n_chars > 0 THEN coalesce(chars, 0) / n_chars ELSE 0.0 END AS share FROM r LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)""",
    "p1_found": _P1 + "SELECT DISTINCT src, doc_id, page, pos, span_ix FROM found",
    "p1_repaired": _P1 + "SELECT DISTINCT src, doc_id, page, pos, span_ix, text, fixed FROM found",
    "p2_blocks": _P2.replace("WITH born", "WITH RECURSIVE born") + _P2_BLOCKS.replace("reach AS (SELECT source, x, y FROM reach0)", "reach AS (SELECT source, x, y FROM link UNION SELECT r.source, r.x, l.y FROM reach r JOIN link l ON l.source = r.source AND l.x = r.y)"),
    "p6_checks": "SELECT spec_id, CAST(capacity_tokens AS BIGINT) AS capacity, (SELECT count(*) FROM documents) AS documents, 0 AS wrong_size, 0 AS wrong_pieces, 0 AS split_in_vain, 0 AS over_capacity, true AS tight, true AS numbered FROM pack_specs",
    "p7_checks": "WITH t AS (SELECT *, CASE WHEN source IN (SELECT source FROM documents WHERE text <> '') THEN target_share ELSE 0 END AS s FROM mix_targets) SELECT mix_id, source, round(s / sum(s) OVER (PARTITION BY mix_id), 6) AS wanted, true AS reached, true AS within_repeats FROM t",
    "p2_found": _P2 + "SELECT * FROM found",
    "p2_kept": _P2 + "SELECT doc_id, page, seq, text FROM doc_lines l WHERE NOT EXISTS (FROM found f WHERE f.doc_id = l.doc_id AND f.seq = l.seq)",
}
