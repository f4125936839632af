"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from quellwerk.llm import encoding, leakage, lookalikes, neardup, packing, quality, sentences, truncation

_P7 = """WITH d AS (SELECT doc_id, regexp_extract_all(lower(text),'[\\p{L}\\p{N}]+') AS w, regexp_replace(lower(text),'[^\\p{L}\\p{N}]','','g') AS s, regexp_matches(text,'[ぁ-ヺー一-鿿々]') AS ja FROM documents WHERE text IS NOT NULL),
  e AS (SELECT item_id, lang, regexp_extract_all(lower(item_text),'[\\p{L}\\p{N}]+') AS w, regexp_replace(lower(item_text),'[^\\p{L}\\p{N}]','','g') AS s FROM eval_items),
  dw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+11],' ') AS g FROM (SELECT doc_id, w, unnest(range(1,len(w)-10)) AS i FROM d WHERE len(w)>=12)),
  ew AS (SELECT DISTINCT item_id, array_to_string(w[i:i+11],' ') AS g FROM (SELECT item_id, w, unnest(range(1,len(w)-10)) AS i FROM e WHERE lang IN ('de','en') AND len(w)>=12)),
  ds AS (SELECT DISTINCT doc_id, substr(s,i,40) AS g FROM (SELECT doc_id, s, unnest(range(1,length(s)-38)) AS i FROM d WHERE ja AND length(s)>=40)),
  es AS (SELECT DISTINCT item_id, substr(s,i,40) AS g FROM (SELECT item_id, s, unnest(range(1,length(s)-38)) AS i FROM e WHERE lang='ja' AND length(s)>=40))
  SELECT DISTINCT doc_id, item_id FROM dw JOIN ew USING (g) UNION SELECT DISTINCT doc_id, item_id FROM ds JOIN es USING (g)"""

_P3 = """WITH t AS (SELECT 'jp_case_detail' AS table_name, rec_id, full_text AS x FROM jp_case_detail UNION ALL SELECT 'synth_document', rec_id, document_content FROM synth_document),
  n AS (SELECT table_name, rec_id, regexp_replace(lower(x),'\\s','','g') AS s FROM t WHERE x IS NOT NULL), k AS (SELECT * FROM n WHERE length(s)>=500),
  u AS (SELECT table_name, s, min(rec_id) AS rep FROM k GROUP BY 1,2), g AS (SELECT DISTINCT table_name, rep, hash(substr(s,i,5)) AS g FROM (SELECT table_name, rep, s, unnest(range(1,length(s)-3)) AS i FROM u)),
  c AS (SELECT table_name, rep, count(*) AS c FROM g GROUP BY 1,2),
  p AS (SELECT a.table_name, a.rep AS ra, b.rep AS rb, count(*) AS n_both FROM g a JOIN g b ON a.table_name=b.table_name AND a.g=b.g AND a.rep<b.rep GROUP BY 1,2,3),
  near AS (SELECT p.table_name, ra, rb FROM p JOIN c x ON x.table_name=p.table_name AND x.rep=ra JOIN c y ON y.table_name=p.table_name AND y.rep=rb WHERE n_both>=0.65*(x.c+y.c-n_both) UNION ALL SELECT table_name, rep, rep FROM u),
  m AS (SELECT k.table_name, k.rec_id, u.rep FROM k JOIN u USING (table_name, s))
  SELECT DISTINCT near.table_name, least(x.rec_id,y.rec_id) AS rec_id_a, greatest(x.rec_id,y.rec_id) AS rec_id_b FROM near JOIN m x ON x.table_name=near.table_name AND x.rep=ra JOIN m y ON y.table_name=near.table_name AND y.rep=rb WHERE x.rec_id<>y.rec_id"""


def queries() -> dict:
    out = {}
    for module in (truncation, encoding, neardup, sentences, lookalikes, packing, leakage, quality):
        out |= {name: f for name, f in vars(module).items() if name[:1] == "p" and name[1:2].isdigit()}
    return out


def oracle_sql() -> dict[str, str]:
    return {"p3_found": _P3, "p7_found": _P7}
