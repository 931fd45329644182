"""Building blocks of the DuckDB twins: the same definitions, written again in SQL."""

from __future__ import annotations

from matchloom.functions import text as T


def rx(pattern: str) -> str:
    """Unicode word boundaries and word characters for an engine whose ``\\b`` and ``\\w`` are ASCII."""
    word = r"[\pL\pN_]"
    out = pattern.replace(r"\w", word)
    parts = out.split("|") if "(" not in out else [out]
    done = []
    for p in parts:
        if p.startswith(r"\b"):
            p = r"(?:^|[^\pL\pN_])" + p[2:]
        if p.endswith(r"\b"):
            p = p[:-2] + r"(?:$|[^\pL\pN_])"
        done.append(p)
    return "|".join(done).replace("'", "''")


def norm(x: str) -> str:
    num = r"(\d+(?:\.\d+)?)"
    t = f"strip_accents(lower(coalesce({x}, '')))"
    steps = [(r"[^\x00-\x7F]", ""), (",", "."), (rf"\b{T.WITHOUT_MARK}\s*", "sem "),
             (rf"\b\d+\s*x\s*{num}\b", r"\1"), (rf"\b{T.COUNT_MARK}\s*\d+\b", " ")]
    steps += [(rf"\b{w}\b", " ") for w in T.PACK_WORDS]
    steps += [(rf"{num}\s*({T.LITRES})\b", r"\1l"), (rf"{num}\s*{T.MILLILITRES}\b", r"\1ml"),
              (rf"{num}\s*({T.KILOGRAMS})\b", r"\1kg"), (rf"{num}\s*({T.GRAMS})\b", r"\1g"),
              (rf"\b{T.LONE_CAN}\b", "lata"), (r"[^a-z0-9. ]", " "),
              (r"\.{2,}", " "), (r"\.([^0-9])", r" \1"), (r"([^0-9])\.", r"\1 ")]
    for pattern, out in steps:
        t = f"regexp_replace({t}, '{pattern}', '{out}', 'g')"
    stop = ", ".join(f"'{w}'" for w in T.STOPWORDS)
    return (f"array_to_string(list_filter(string_split({t}, ' '), "
            f"lambda w: w <> '' AND w NOT IN ({stop})), ' ')")


def base_name(x: str) -> str:
    measure = T.NAME_MEASURE[:-2] + r"($|[^\pL\pN_])"
    t = f"regexp_replace(lower({x}), '{measure}', ' \\2', 'g')"
    t = rf"regexp_replace({t}, '\d+', ' ', 'g')"
    return rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"


def token_count(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '\S+'))"


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


PRODUCTS = "SELECT p_partkey AS doc_id, p_name || ' ' || p_size || ' GR' AS name, p_brand AS brand FROM part"

ORDERS = """SELECT p_partkey AS query_id, p_partkey AS gold_id,
 CASE p_type WHEN 'ECONOMY' THEN upper(p_name || ' ' || p_size) || ' GR C/12 UNID'
  WHEN 'SMALL' THEN p_name || ' ' || p_size || 'g'
  WHEN 'MEDIUM' THEN upper(p_name) || ' CX 12X' || p_size || ' GR'
  WHEN 'LARGE' THEN p_name || ' ' || p_brand || ' ' || p_size || ' gramas'
  WHEN 'PROMO' THEN 'fardo de ' || p_name || ' da ' || p_brand || ' com ' || p_size || ' gr cada und'
  ELSE p_name || ' marca ' || p_brand || ' sortido' END AS text,
 CASE WHEN p_size <= 25 THEN 'val' ELSE 'test' END AS split FROM part"""

ARTICLES = "SELECT doc_id, text AS name, source AS brand FROM documents"

PASSAGES = "SELECT item_id AS query_id, text FROM benchmark"

REQUESTS_SEEN = f"""SELECT 'o' || query_id AS query_id, text FROM ({ORDERS})
 UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations WHERE role = 'user'"""


def catalog_norm(catalog: str, use_brand: bool) -> str:
    if not use_brand:
        return f"SELECT doc_id, {norm('name')} AS norm FROM ({catalog})"
    return (f"SELECT doc_id, CASE WHEN b <> '' AND NOT contains(n, b) THEN n || ' ' || b ELSE n END AS norm "
            f"FROM (SELECT doc_id, {norm('name')} AS n, {norm('brand')} AS b FROM ({catalog}))")


def terms(rel: str, key: str, analyzer: str) -> str:
    """(key, term, tf) of a relation with columns key and norm."""
    words = f"SELECT {key}, string_split(norm, ' ') AS w FROM {rel} WHERE norm <> ''"
    if analyzer == "word":
        src = f"SELECT {key}, unnest(w) AS term FROM ({words})"
    elif analyzer == "word12":
        src = (f"SELECT {key}, unnest(w) AS term FROM ({words}) UNION ALL SELECT {key}, "
               f"unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM ({words})")
    else:
        one = f"SELECT {key}, ' ' || unnest(w) || ' ' AS p FROM ({words})"
        src = " UNION ALL ".join(
            f"SELECT {key}, unnest(list_transform(range(1, length(p) - {n} + 2), "
            f"lambda i: substring(p, i, {n}))) AS term FROM ({one}) WHERE length(p) >= {n}" for n in (3, 4, 5))
    return f"SELECT {key}, term, count(*) AS tf FROM ({src}) GROUP BY ALL"


def vocabulary(analyzer: str, weighting: str, catalog: str) -> str:
    """(term, df, idf) of a catalog (doc_id, norm), without any scores."""
    value = ("ln((1 + n) / (1 + df)) + 1" if weighting == "tfidf"
             else "CASE WHEN r < 0 THEN 0.25 * avg(r) OVER () ELSE r END")
    return f"""WITH cat AS MATERIALIZED ({catalog}), n AS (SELECT count(*)::DOUBLE AS n FROM cat),
 dfs AS (SELECT term, count(*)::DOUBLE AS df FROM ({terms('cat', 'doc_id', analyzer)}) GROUP BY term),
 raw AS (SELECT term, df, n, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM dfs, n)
 SELECT term, df::BIGINT AS df, round({value}, 6) AS idf FROM raw"""


def scored(analyzer: str, weighting: str, catalog: str, queries: str) -> str:
    """CTEs up to ``s(query_id, doc_id, score)``. catalog: doc_id, norm. queries: query_id, norm."""
    head = f"""WITH cat AS MATERIALIZED ({catalog}), qs AS MATERIALIZED ({queries}),
 dt AS MATERIALIZED ({terms('cat', 'doc_id', analyzer)}), qt AS MATERIALIZED ({terms('qs', 'query_id', analyzer)}),
 n AS (SELECT count(*)::DOUBLE AS n FROM cat), dfs AS (SELECT term, count(*)::DOUBLE AS df FROM dt GROUP BY term),"""
    if weighting == "tfidf":
        return head + """
 idf AS MATERIALIZED (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM dfs, n),
 dw AS (SELECT doc_id, term, tf * idf AS w FROM dt JOIN idf USING (term)),
 dn AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM dw GROUP BY doc_id),
 qw AS (SELECT query_id, term, tf * idf AS w FROM qt JOIN idf USING (term)),
 qn AS (SELECT query_id, sqrt(sum(w * w)) AS len FROM qw GROUP BY query_id),
 s AS MATERIALIZED (SELECT query_id, doc_id, dot / dn.len / qn.len AS score FROM
  (SELECT query_id, doc_id, sum(qw.w * dw.w) AS dot FROM qw JOIN dw USING (term) GROUP BY ALL)
  JOIN dn USING (doc_id) JOIN qn USING (query_id))"""
    return head + """
 raw AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM dfs, n),
 idf AS MATERIALIZED (SELECT term, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw),
 dl AS (SELECT doc_id, sum(tf)::DOUBLE AS len FROM dt GROUP BY doc_id),
 av AS (SELECT sum(len) / max(n) AS avgdl FROM dl, n),
 dw AS (SELECT doc_id, term, idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * len / avgdl)) AS w
  FROM dt JOIN idf USING (term) JOIN dl USING (doc_id), av),
 s AS MATERIALIZED (SELECT query_id, doc_id, sum(qt.tf * dw.w) AS score FROM qt JOIN dw USING (term) GROUP BY ALL)"""


def ranked(k: int, pad: bool = False) -> str:
    """CTE ``r(query_id, rank, doc_id, score)`` after :func:`scored`."""
    src = "SELECT query_id, doc_id, score FROM s"
    if pad:
        src += (" UNION ALL SELECT q.query_id, c.doc_id, 0.0 FROM qs q, cat c "
                "WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.query_id = q.query_id AND s.doc_id = c.doc_id)")
    return f""", r AS MATERIALIZED (SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM (
 SELECT query_id, doc_id, round(score, 9) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM ({src}))
 WHERE rank <= {k})"""


def search(analyzer: str, weighting: str, catalog: str, queries: str, k: int = 5, pad: bool = False) -> str:
    return scored(analyzer, weighting, catalog, queries) + ranked(k, pad)


PRODUCT_TEXTS = catalog_norm(PRODUCTS, False)
PRODUCT_BRAND_TEXTS = catalog_norm(PRODUCTS, True)
ARTICLE_TEXTS = catalog_norm(ARTICLES, False)
ORDER_TEXTS = f"SELECT query_id, {norm('text')} AS norm FROM ({ORDERS})"
PASSAGE_TEXTS = f"SELECT query_id, {norm('text')} AS norm FROM ({PASSAGES})"
