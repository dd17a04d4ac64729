"""Queries of the general problems: orphan references (p3) and snapshot changes (p5)."""

from __future__ import annotations

from juriflow.functions.consistent import DOUBLES, JOINED, SINGLE
from juriflow.operators import references, snapshots
from juriflow.session import table


def p3_found(spark, d):
    return references.orphans(*(table(spark, d, t) for t in ("chunks", "units", "code_articles", "footnote_defs")))


def p3_orphan_counts(spark, d):
    return references.orphan_counts(p3_found(spark, d))


def p5_found(spark, d):
    return snapshots.unit_changes(table(spark, d, "unit_snapshots"))


QUERIES = {"p3_found": p3_found, "p3_orphan_counts": p3_orphan_counts, "p5_found": p5_found}

_P3 = r"""
WITH a AS (SELECT lower(trim(code)) AS code, lower(regexp_replace(article, '\s', '', 'g')) AS art0, loaded_at, removed_at FROM code_articles),
a1 AS (SELECT code, CASE WHEN art0 IN ('1er', 'premier') THEN '1' ELSE art0 END AS art, loaded_at, removed_at FROM a),
r AS (SELECT chunk_id, loaded_at AS t, unnest(refs) AS x FROM chunks),
r1 AS (SELECT chunk_id, t, lower(trim(x.code)) AS code, lower(regexp_replace(unnest(x.articles), '\s', '', 'g')) AS art0 FROM r),
r2 AS (SELECT DISTINCT chunk_id AS rec_id, t, code, CASE WHEN art0 IN ('1er', 'premier') THEN '1' ELSE art0 END AS art FROM r1 WHERE code <> '' AND art0 <> ''),
q1 AS (SELECT 'chunks' AS src, rec_id, r2.code || ':' || r2.art AS ref_key, t, count(a1.code) AS n, count_if(a1.loaded_at <= t) AS past,
  count_if(a1.loaded_at <= t AND (a1.removed_at IS NULL OR a1.removed_at > t)) AS ok FROM r2 LEFT JOIN a1 ON a1.code = r2.code AND a1.art = r2.art GROUP BY ALL),
f AS (SELECT doc_id, doc_id || '#' || unit_ix AS rec_id, loaded_at AS t, unnest(footnotes) AS x FROM units),
f1 AS (SELECT DISTINCT doc_id, rec_id, t, try_cast(regexp_extract(x.id, '[0-9]+') AS BIGINT) AS num FROM f),
q2 AS (SELECT 'units' AS src, rec_id, 'fn' || f1.num AS ref_key, t, count(d.doc_id) AS n, count_if(d.loaded_at <= t) AS past,
  count_if(d.loaded_at <= t AND (d.withdrawn_at IS NULL OR d.withdrawn_at > t)) AS ok FROM f1 LEFT JOIN footnote_defs d ON d.doc_id = f1.doc_id AND d.num = f1.num WHERE f1.num IS NOT NULL GROUP BY ALL),
found AS (SELECT DISTINCT src, rec_id, ref_key, CASE WHEN n = 0 THEN 'missing' WHEN past > 0 THEN 'deleted' ELSE 'late' END AS status, strftime(t, '%Y-%m') AS ym
  FROM (FROM q1 UNION ALL FROM q2) WHERE coalesce(ok, 0) = 0)
"""



def sql_fold(c: str) -> str:
    """The consistent form without white space, in SQL; look-alikes are replaced in every word, which compares alike."""
    singles = {**{k: v for k, v in SINGLE.items() if v != " " and k != "'"}, **DOUBLES}
    kept = [k for k, v in singles.items() if v]
    gone = [k for k, v in singles.items() if not v]
    out = f"regexp_replace({c}, '[\\s\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', '', 'g')"
    out = f"translate({out}, '{''.join(kept + gone)}', '{''.join(singles[k] for k in kept).replace(chr(39), chr(39) * 2)}')"
    for glyph, letters in JOINED.items():
        out = f"replace({out}, '{glyph}', '{letters}')"
    return f"nfc_normalize({out})"


_P5 = rf"""
WITH k AS (SELECT snap_no, doc_id, lower(regexp_replace(unit_key, '\s', '', 'g')) AS k0, text, loaded_at FROM unit_snapshots),
u AS (SELECT snap_no, doc_id, CASE WHEN k0 IN ('1er', 'premier') THEN '1' ELSE k0 END AS unit_key, loaded_at, {sql_fold("text")} AS v FROM k WHERE k0 <> '' AND doc_id IS NOT NULL),
one AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY snap_no, doc_id, unit_key ORDER BY loaded_at DESC NULLS LAST, v DESC NULLS LAST) = 1),
s AS (SELECT snap_no AS snap_from, lead(snap_no) OVER (ORDER BY snap_no) AS snap_to FROM (SELECT DISTINCT snap_no FROM unit_snapshots WHERE snap_no IS NOT NULL)),
a AS (SELECT s.*, one.doc_id, one.unit_key, one.v FROM s JOIN one ON one.snap_no = s.snap_from WHERE s.snap_to IS NOT NULL),
b AS (SELECT s.*, one.doc_id, one.unit_key, one.v FROM s JOIN one ON one.snap_no = s.snap_to)
SELECT snap_from, snap_to, doc_id, unit_key, CASE WHEN ia AND ib THEN 'changed' WHEN ia IS NULL THEN 'added' ELSE 'removed' END AS what
FROM (SELECT *, true AS ia FROM a) a FULL JOIN (SELECT *, true AS ib FROM b) b USING (snap_from, snap_to, doc_id, unit_key)
WHERE ia IS NULL OR ib IS NULL OR a.v IS DISTINCT FROM b.v
"""

ORACLE = {
    "p3_found": _P3 + "SELECT * FROM found",
    "p3_orphan_counts": _P3 + "SELECT src, ym, status, count(*) AS n FROM found GROUP BY ALL",
    "p5_found": _P5,
}
