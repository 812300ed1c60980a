"""DuckDB SQL text of the oracle: the same computations written as plain SQL
over the pre-registered tables, built from the same fixed values and
expression renderers as the Spark side."""

from __future__ import annotations

from ..functions import analyze as A
from ..functions import porter
from ..functions.scoring import idf_sql, norm_sql
from ..sources.tables import TITLE_SQL

TOK = A.TOKEN_RE.replace("'", "''")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def field_values_sql() -> str:
    """(doc_id, field, v) of title, content, venue, year."""
    return (f"SELECT doc_id, 'title' AS field, {TITLE_SQL} AS v FROM documents "
            "UNION ALL SELECT doc_id, 'content' AS field, text AS v FROM documents "
            "UNION ALL SELECT doc_id, 'venue' AS field, source AS v FROM documents "
            "UNION ALL SELECT doc_id, 'year' AS field, lang AS v FROM documents")


def raw_tokens_sql() -> str:
    """(doc_id, field, pos, tok) of documents + authors (continuing positions)."""
    docs = (f"SELECT doc_id, field, unnest(_t) AS tok, CAST(generate_subscripts(_t, 1) - 1 AS INT) AS pos "
            f"FROM (SELECT doc_id, field, CASE WHEN field = 'year' THEN [v] "
            f"ELSE regexp_extract_all(v, '{TOK}') END AS _t FROM ({field_values_sql()}) _fv WHERE v IS NOT NULL) _d")
    auth = (f"SELECT doc_id, 'authors' AS field, unnest(_t) AS tok, "
            f"CAST(generate_subscripts(_t, 1) - 1 + _off AS INT) AS pos FROM ("
            f"SELECT conv_id AS doc_id, regexp_extract_all(text, '{TOK}') AS _t, "
            f"coalesce(sum(len(regexp_extract_all(text, '{TOK}'))) OVER (PARTITION BY conv_id ORDER BY turn "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _off FROM conversations) _a")
    return f"{docs} UNION ALL {auth}"


def analyzed_sql(src: str, title_an: A.Analyzer, untokenized=("year",)) -> str:
    """Per-field analyzer dispatch over rows with ``field`` and ``tok``."""
    raw = ", ".join(lit(f) for f in untokenized) if untokenized else "''"
    t_lc = "lower(tok)" if title_an.lowercase else "tok"
    base = (f"SELECT *, CASE WHEN field IN ({raw}) THEN tok WHEN field = 'title' THEN {t_lc} "
            f"ELSE lower(tok) END AS term FROM ({src}) _b")
    if title_an.stemming:
        titles = porter.stem_sql(f"SELECT * EXCLUDE (term), term AS _raw FROM ({base}) _t WHERE field = 'title'",
                                 "_raw", "term")
        titles = f"SELECT * EXCLUDE (_raw) FROM ({titles}) _t2"
        base = f"{titles} UNION ALL BY NAME SELECT * FROM ({base}) _o WHERE field <> 'title'"
    t_stop = f"term NOT IN ({A.sql_list(title_an.stop_list)})" if title_an.stopwords else "TRUE"
    s_stop = f"term NOT IN ({A.sql_list(A.STANDARD.stop_list)})"
    return (f"SELECT * FROM ({base}) _c WHERE field IN ({raw}) OR "
            f"(field = 'title' AND {t_stop}) OR (field NOT IN ('title', {raw}) AND {s_stop})")


def postings_sql(title_an: A.Analyzer = A.DEFAULT_TITLE) -> str:
    tok = analyzed_sql(raw_tokens_sql(), title_an)
    return (f"SELECT field, term, doc_id, CAST(count(*) AS INT) AS tf, "
            f"CAST(sum(count(*)) OVER (PARTITION BY doc_id, field) AS INT) AS flen, "
            f"list(pos ORDER BY pos) AS positions FROM ({tok}) _k GROUP BY field, term, doc_id")


def term_stats_sql(title_an: A.Analyzer = A.DEFAULT_TITLE) -> str:
    return f"SELECT field, term, count(*) AS df FROM ({postings_sql(title_an)}) _p GROUP BY field, term"


N_DOCS = "(SELECT count(*) FROM documents)"


def with_idf(n_docs: str = N_DOCS) -> str:
    return idf_sql("df", n_docs)


def norm(field: str, flen: str, mode: str = "lossy") -> str:
    return norm_sql(field, flen, mode)


# ------------------------------------------------------------------ search

def leaves_sql(units: str, title_an: A.Analyzer = A.DEFAULT_TITLE, extra: bool = False) -> str:
    """Clause leaves of ``units(qid, u, field, text)`` (see operators.query) and,
    with ``extra``, those of a table ``xl``."""
    u2 = (f"SELECT qid, u, field, regexp_extract_all(text, '\"([^\"]*)\"', 1) AS phrases, "
          f"trim(regexp_replace(text, '\"[^\"]*\"', '', 'g')) AS rest FROM ({units}) _u")
    pb = (f"SELECT qid, u, field, unnest(phrases) AS ptext, generate_subscripts(phrases, 1) - 1 AS b "
          f"FROM ({u2}) _p")
    pt_raw = (f"SELECT qid, u, field, b, unnest(_t) AS tok, CAST(generate_subscripts(_t, 1) - 1 AS INT) AS pos "
              f"FROM (SELECT *, regexp_extract_all(ptext, '{TOK}') AS _t FROM ({pb}) _x) _y")
    pt = analyzed_sql(pt_raw, title_an, untokenized=())
    p_terms = (f"SELECT qid, u, field, b, row_number() OVER (PARTITION BY qid, u, b ORDER BY pos) - 1 AS c, "
               f"'term' AS kind, term, NULL AS pterms, 1.0 AS boost, 'P' AS grp FROM ({pt}) _a")
    p_phr = (f"SELECT qid, u, field, b, count(*) AS c, CASE WHEN count(*) = 1 THEN 'term' ELSE 'phrase' END AS kind, "
             f"CASE WHEN count(*) = 1 THEN min(term) END AS term, "
             f"CASE WHEN count(*) > 1 THEN list({{'term': term, 'qpos': pos}} ORDER BY pos) END AS pterms, "
             f"5.0 AS boost, 'P' AS grp FROM ({pt}) _b GROUP BY qid, u, field, b")
    kb = (f"SELECT * FROM (SELECT qid, u, field, unnest(_w) AS word, generate_subscripts(_w, 1) - 1 AS b "
          f"FROM (SELECT *, regexp_split_to_array(rest, '\\s+') AS _w FROM ({u2}) _r WHERE rest <> '') _s) _k "
          f"WHERE word <> ''")
    kt_raw = (f"SELECT qid, u, field, b, unnest(_t) AS tok, CAST(generate_subscripts(_t, 1) - 1 AS INT) AS pos "
              f"FROM (SELECT *, regexp_extract_all(word, '{TOK}') AS _t FROM ({kb}) _x) _y")
    kt = analyzed_sql(kt_raw, title_an, untokenized=())
    kw = (f"SELECT qid, u, field, b, row_number() OVER (PARTITION BY qid, u, b ORDER BY pos) - 1 AS c, "
          f"'term' AS kind, term, NULL AS pterms, 1.0 AS boost, 'P' AS grp FROM ({kt}) _c")
    kw = kw.replace("'P' AS grp", "'K' AS grp")
    lv = (f"SELECT *, CAST(u AS VARCHAR) || ':' || grp AS ga, NOT (grp = 'K' AND u = 0) AS must, "
          f"grp = 'P' AS b_all FROM (SELECT * FROM p_terms UNION ALL BY NAME SELECT * FROM p_phr "
          f"UNION ALL BY NAME SELECT * FROM kw) _l")
    if extra:
        lv += " UNION ALL BY NAME SELECT * FROM xl"
    p_terms = p_terms.replace(f"FROM ({pt}) _a", "FROM pt")
    p_phr = p_phr.replace(f"FROM ({pt}) _b", "FROM pt")
    pb = pb.replace(f"FROM ({u2}) _p", "FROM u2")
    kb = kb.replace(f"FROM ({u2}) _r", "FROM u2")
    pt_raw = pt_raw.replace(f"FROM ({pb}) _x", "FROM pb")
    kt_raw = kt_raw.replace(f"FROM ({kb}) _x", "FROM kb")
    pt = analyzed_sql(pt_raw, title_an, untokenized=())
    kt = analyzed_sql(kt_raw, title_an, untokenized=())
    kw = kw.replace(f"FROM ({kt}) _c", "FROM kt") if f"FROM ({kt}) _c" in kw else \
        (f"SELECT qid, u, field, b, row_number() OVER (PARTITION BY qid, u, b ORDER BY pos) - 1 AS c, "
         f"'term' AS kind, term, NULL AS pterms, 1.0 AS boost, 'K' AS grp FROM kt")
    return (f"WITH u2 AS ({u2}), pb AS ({pb}), pt AS ({pt}), kb AS ({kb}), kt AS ({kt}), "
            f"p_terms AS ({p_terms}), p_phr AS ({p_phr}), kw AS ({kw}), lvb AS ({lv}) "
            f"SELECT l.*, nc.n_c, nb.n_b, na.n_a, na.n_must FROM lvb l "
            f"JOIN (SELECT qid, ga, b, count(*) AS n_c FROM lvb GROUP BY qid, ga, b) nc USING (qid, ga, b) "
            f"JOIN (SELECT qid, ga, count(DISTINCT b) AS n_b FROM lvb GROUP BY qid, ga) nb USING (qid, ga) "
            f"JOIN (SELECT qid, count(DISTINCT ga) AS n_a, count(DISTINCT CASE WHEN must THEN ga END) AS n_must "
            f"FROM lvb GROUP BY qid) na USING (qid)")


def scored_sql(units: str, title_an: A.Analyzer = A.DEFAULT_TITLE, norm_mode: str = "lossy") -> str:
    """All matching ``(qid, doc_id, score)``."""
    return f"WITH {_search_ctes(units, title_an, norm_mode)} SELECT qid, doc_id, score FROM scored"


def sloppy_sql(pairs: str, keys: str, slop: int) -> str:
    """Sloppy frequency per ``keys`` of ``pairs(keys, _nt, k, x)``: shifted
    positions x of the phrase's terms k."""
    on = " AND ".join(f"o.{k} = a.{k}" for k in keys.split(", "))
    a = ", ".join(f"a.{k}" for k in keys.split(", "))
    d = (f"SELECT {a}, a._nt, a.x AS a, o.k, min(abs(o.x - a.x)) AS d FROM {pairs} a JOIN {pairs} o ON a.k = 0 AND o.k > 0 "
         f"AND {on} AND abs(o.x - a.x) <= {slop} GROUP BY {a}, a._nt, a.x, o.k")
    each = f"SELECT {keys}, a, count(*) AS n, sum(d) AS dsum, any_value(_nt) AS _nt FROM ({d}) _d GROUP BY {keys}, a"
    return f"SELECT {keys}, sum(1.0 / (1.0 + dsum)) AS freq FROM ({each}) _e WHERE n = _nt - 1 AND dsum <= {slop} GROUP BY {keys}"


def _search_ctes(units: str, title_an: A.Analyzer, norm_mode: str, extra: str = "", slop: int = 0) -> str:
    """``extra``: tables ``xl`` (leaves, kind ``term`` or ``multi``) and ``xt``
    (``qid, ga, b, term`` of the multi ones)."""
    lv = leaves_sql(units, title_an, bool(extra))
    xidf = lambda t: f"CASE WHEN lv0.kind = 'multi' THEN 1.0 ELSE {t} END" if extra else t
    pkeys = "qid, doc_id, ga, b, c"
    exact = (f"SELECT {pkeys}, count(*) AS freq FROM (SELECT {pkeys}, anchor, count(*) AS k, any_value(_nt) AS _nt FROM pa "
             f"GROUP BY {pkeys}, anchor) _x WHERE k = _nt GROUP BY {pkeys}")
    freq = sloppy_sql("(SELECT *, anchor AS x FROM pa)", pkeys, slop) if slop else exact
    nrm = norm_sql("p.field", "p.flen", norm_mode)
    keys = "qid, ga, b, c"
    return (
        f"post AS ({postings_sql(title_an)}), ts AS (SELECT field, term, count(*) AS df FROM post GROUP BY field, term), "
        f"{extra}{', ' if extra else ''}lv0 AS ({lv}), "
        f"lt AS (SELECT {keys}, field, CASE WHEN kind = 'phrase' THEN [x.term FOR x IN pterms] ELSE [term] END AS _ts "
        f"FROM lv0), "
        f"li AS (SELECT {keys}, sum({idf_sql('coalesce(ts.df, 0)', N_DOCS)}) AS idf FROM "
        f"(SELECT {keys}, field, unnest(_ts) AS term FROM lt) e LEFT JOIN ts USING (field, term) GROUP BY {keys}), "
        f"lv AS (SELECT lv0.*, {xidf('li.idf')} AS idf, q.qnorm FROM lv0 JOIN li USING ({keys}) JOIN "
        f"(SELECT qid, 1.0 / sqrt(sum(power({xidf('li.idf')} * lv0.boost, 2))) AS qnorm FROM lv0 JOIN li USING ({keys}) "
        f"GROUP BY qid) q USING (qid)), "
        f"tm AS (SELECT l.qid, p.doc_id, l.ga, l.must, l.b, l.b_all, l.c, l.n_a, l.n_must, l.n_b, l.n_c, l.qnorm, "
        f"sqrt(CAST(p.tf AS DOUBLE)) * l.idf * l.idf * l.boost * {nrm} AS s "
        f"FROM lv l JOIN post p ON l.kind = 'term' AND p.field = l.field AND p.term = l.term), "
        f"pe AS (SELECT l.*, unnest(l.pterms) AS _pt, unnest(range(len(l.pterms))) AS k, len(l.pterms) AS _nt FROM lv l "
        f"WHERE l.kind = 'phrase'), "
        f"pj AS (SELECT e.qid, e.ga, e.must, e.b, e.b_all, e.c, e.n_a, e.n_must, e.n_b, e.n_c, e.qnorm, e.idf, "
        f"e.boost, e._nt, e.k, p.field, p.flen, p.doc_id, e._pt.qpos AS qpos, p.positions "
        f"FROM pe e JOIN post p ON p.field = e.field AND p.term = e._pt.term), "
        f"pa AS (SELECT * EXCLUDE (positions), unnest(positions) - qpos AS anchor FROM pj), "
        f"pf AS (SELECT f.*, i.* EXCLUDE ({pkeys}) FROM ({freq}) f JOIN (SELECT {pkeys}, any_value(must) AS must, "
        f"any_value(b_all) AS b_all, any_value(n_a) AS n_a, any_value(n_must) AS n_must, any_value(n_b) AS n_b, "
        f"any_value(n_c) AS n_c, any_value(qnorm) AS qnorm, any_value(idf) AS idf, any_value(boost) AS boost, "
        f"any_value(field) AS field, any_value(flen) AS flen FROM pj GROUP BY {pkeys}) i USING ({pkeys})), "
        f"pm AS (SELECT qid, doc_id, ga, must, b, b_all, c, n_a, n_must, n_b, n_c, qnorm, "
        f"sqrt(CAST(freq AS DOUBLE)) * idf * idf * boost * {norm_sql('field', 'flen', norm_mode)} AS s FROM pf), "
        + ("mm AS (SELECT DISTINCT l.qid, p.doc_id, l.ga, l.must, l.b, l.b_all, l.c, l.n_a, l.n_must, l.n_b, l.n_c, l.qnorm, "
           "CAST(l.boost AS DOUBLE) AS s FROM lv l JOIN xt ON l.kind = 'multi' AND xt.qid = l.qid AND xt.ga = l.ga AND xt.b = l.b "
           "JOIN post p ON p.field = l.field AND p.term = xt.term), " if extra else "") +
        f"m AS (SELECT * FROM tm UNION ALL SELECT * FROM pm{' UNION ALL SELECT * FROM mm' if extra else ''}), "
        f"cl AS (SELECT qid, doc_id, ga, b, sum(s) * count(*) / any_value(n_c) AS s, any_value(must) AS must, "
        f"any_value(b_all) AS b_all, any_value(n_b) AS n_b, any_value(n_a) AS n_a, any_value(n_must) AS n_must, "
        f"any_value(qnorm) AS qnorm FROM m GROUP BY qid, doc_id, ga, b), "
        f"bl AS (SELECT qid, doc_id, ga, sum(s) * count(*) / any_value(n_b) AS s, any_value(must) AS must, "
        f"any_value(n_a) AS n_a, any_value(n_must) AS n_must, any_value(qnorm) AS qnorm FROM cl "
        f"GROUP BY qid, doc_id, ga HAVING NOT any_value(b_all) OR count(*) = any_value(n_b)), "
        f"scored AS (SELECT qid, doc_id, sum(s) * count(*) / any_value(n_a) * any_value(qnorm) AS score FROM bl "
        f"GROUP BY qid, doc_id HAVING sum(CAST(must AS INT)) = any_value(n_must))")


def topk_sql(units: str, n: int = 10, title_an: A.Analyzer = A.DEFAULT_TITLE, norm_mode: str = "lossy", extra: str = "",
             slop: int = 0) -> str:
    lim = f"WHERE rank <= {n}" if n else ""
    return (f"WITH {_search_ctes(units, title_an, norm_mode, extra, slop)} SELECT qid, rank, doc_id, round(score, 4) AS score FROM "
            f"(SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, doc_id) "
            f"AS rank FROM scored) r {lim}")


def total_hits_sql(units: str, queries: str, title_an: A.Analyzer = A.DEFAULT_TITLE) -> str:
    return (f"WITH {_search_ctes(units, title_an, 'lossy')} SELECT q.qid, CAST(coalesce(h.n, 0) AS BIGINT) AS total_hits "
            f"FROM ({queries}) q LEFT JOIN (SELECT qid, count(*) AS n FROM scored GROUP BY qid) h USING (qid)")
