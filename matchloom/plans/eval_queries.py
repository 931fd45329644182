"""Registered queries: evaluation, comparison, reranking tables and no-match detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import text as T
from matchloom.operators import compare, evaluate as E, nomatch as N, profile as P, rerank as RR
from matchloom.operators.grid import Configuration, GridIndex, grid_ranks
from matchloom.operators.storage import written
from matchloom.plans import roles as R, shared, sql as S

C = F.col
#: What is known of each system besides its ranks: published seconds for an index and 250 queries, US dollars for these, effort, kind
#: of index, whether it needs vectors (fixed values).
SYSTEM_NOTES = [("tfidf_char", 1.3, 0.0, "low", "character n-grams", False), ("tfidf_word", 0.16, 0.0, "low", "words", False),
                ("bm25", 4.6, 0.0, "low", "words and lengths", False)]
FEW_SHOT = 'Example: "STEEL BOLT 14 GR CX 12X14 GR", first candidate of another size -> {"ranking": [2, 1, 3]}'


# ------------------------------------------------------------------ evaluation
def _gold(spark, sf):
    return R.orders(spark, sf).select("query_id", "gold_id", "split")


def gold_ranks(spark, sf):
    return E.gold_ranks(_gold(spark, sf), shared.order_ranking(spark, sf, "word", "bm25", True), "split")


def metrics_overall(spark, sf):
    return E.metrics(gold_ranks(spark, sf))


def predictions_wide(spark, sf):
    tops = shared.order_ranking(spark, sf, "word", "bm25", True)
    ranks = E.gold_ranks(_gold(spark, sf), tops)
    return E.wide_predictions(ranks, tops, R.products(spark, sf), R.orders(spark, sf))


def _grid(spark, sf):
    """Metrics of every configuration on both splits: one index and one ranking for the whole grid, read from the tables
    each time. What stays is a written table of one row per configuration and split."""
    families = F.create_map(*[F.lit(x) for name, how in shared.GRID.items() for x in (name, how[0])])
    index = GridIndex.fit_all({"name": shared.product_texts(spark, sf, False), "name+brand": shared.product_texts(spark, sf, True)},
                              [Configuration(name, "name+brand" if brand else "name", analyzer, weighting) for name, (_, analyzer, weighting, brand) in shared.GRID.items()])
    ranked = index.search(shared.order_texts(spark, sf), pad=True)
    scores = E.metrics(grid_ranks(index, _gold(spark, sf), ranked, "split").withColumn("family", families[C("config")]), "family", "config", "split")
    table, _ = written(scores, "grid-metrics")
    index.release()
    return table


def leaderboard(spark, sf):
    return _grid(spark, sf).filter("split = 'val'").drop("split").orderBy(F.desc("p_at_1"), "config")


def best_configs(spark, sf):
    return _best(_grid(spark, sf))


def _best(grid):
    return E.best_configs(grid.filter("split = 'val'")).select("family", "config", "p_at_1")


def frozen_eval(spark, sf):
    """Configurations chosen on one split, measured once on the other."""
    grid = _grid(spark, sf)
    return grid.filter("split = 'test'").drop("split").join(_best(grid).select("family", "config"), ["family", "config"], "left_semi")


# ------------------------------------------------------------------ comparison
def system_compare(spark, sf):
    """Stored ranks of all systems, joined with the table of what is known about them besides."""
    notes = spark.createDataFrame(SYSTEM_NOTES, "system string, seconds double, cost double, complexity string, index_kind string, vectors boolean")
    return E.metrics(shared.system_ranks(spark, sf), "system").join(notes, "system", "left")


def query_segments(spark, sf):
    return R.orders(spark, sf).select("query_id", F.explode(compare.segments(C("text"))).alias("segment"))


def segment_scores(spark, sf):
    return compare.segment_scores(shared.system_ranks(spark, sf), R.orders(spark, sf), list(shared.SYSTEMS))


def error_counts(spark, sf):
    return compare.error_counts(shared.system_ranks(spark, sf))


def error_overlap(spark, sf):
    return compare.error_overlap(shared.system_ranks(spark, sf))


def exclusive_errors(spark, sf):
    return compare.exclusive_errors(shared.system_ranks(spark, sf))


def repaired_errors(spark, sf):
    weak, strong = "tfidf_char", "bm25"
    return compare.repaired(shared.system_ranks(spark, sf, weak, strong), shared.system_tops(spark, sf, weak), weak, strong)


def error_list(spark, sf):
    return compare.error_list(shared.system_ranks(spark, sf))


def distributor_hits(spark, sf):
    return compare.distributor_hits(shared.system_ranks(spark, sf, "tfidf_char"), R.orders(spark, sf), 6)


# ------------------------------------------------------------------ reranking
def _candidates(spark, sf):
    return RR.number_candidates(shared.order_ranking(spark, sf, "char35", "tfidf", False, RR.CANDIDATES))


def _ranking_json(q):
    """Stand-in for an outside answer, a function of the query number: a permutation, or odd cases."""
    order = F.array_sort(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda n: F.struct(
        F.pmod(q * 7 + n * 3, F.lit(11)).alias("o"), n.cast("string").alias("n"))))
    five = F.transform(F.slice(order, 1, 5), lambda x: x["n"])
    odd = F.concat(F.lit("["), five[0], F.lit(", "), five[0], F.lit(', 11, "3", null, 0, '), five[1], F.lit("]"))
    return (F.when(q % 7 == 3, "[]").when(q % 11 == 5, odd)
            .otherwise(F.concat(F.lit("["), F.array_join(five, ", "), F.lit("]"))))


def _answers(spark, sf):
    q = C("query_id")
    text = F.when(q % 13 == 6, "no answer").otherwise(F.concat(F.lit('{"ranking": '), _ranking_json(q), F.lit("}")))
    return R.orders(spark, sf).select("query_id", text.alias("answer"))


def _batch_answers(spark, sf, again=False):
    """``again``: every fifth order is answered a second time, with its candidates 2 and 1."""
    item = F.concat(F.lit('{"pedido": '), C("query_id").cast("string"), F.lit(', "ranking": '),
                    _ranking_json(C("query_id")), F.lit("}"))
    if again:
        item = F.when(C("query_id") % 5 == 0, F.concat(item, F.lit(',\n{"pedido": '), C("query_id").cast("string"), F.lit(', "ranking": [2, 1]}'))).otherwise(item)
    lines = R.orders(spark, sf).select(RR.batch_no(C("query_id")).alias("batch"), "query_id", item.alias("item"))
    listed = F.array_sort(F.collect_list(F.struct("query_id", "item")))
    return lines.groupBy("batch").agg(F.concat(
        F.lit('Here it is:\n```json\n{"resultados": [\n'),
        F.array_join(F.transform(listed, lambda x: x["item"]), ",\n"), F.lit("\n]}\n```")).alias("answer"))


def requests(spark, sf):
    return RR.requests(R.orders(spark, sf), _candidates(spark, sf), R.products(spark, sf))


def requests_few_shot(spark, sf):
    return RR.requests(R.orders(spark, sf), _candidates(spark, sf), R.products(spark, sf),
                       FEW_SHOT)


def _ledger(spark, sf):
    """Answers given so far: user turns count as queries already answered, one entry per turn."""
    return R.table(spark, sf, "conversations").select(
        C("conv_id").alias("query_id"), C("turn").alias("seq"),
        F.array(F.length("text") % 10 + 1, F.length("text") % 7 + 1).cast("array<int>").alias("ranking"))


def resume_pending(spark, sf):
    return RR.pending(R.orders(spark, sf), _ledger(spark, sf)).select("query_id", "text")


def ledger_latest(spark, sf):
    return RR.latest_answers(_ledger(spark, sf)).select("query_id", F.array_join("ranking", ",").alias("ranking"))


def ledger_flatten(spark, sf):
    entries = _ledger(spark, sf).groupBy(RR.batch_no(C("query_id")).alias("batch"), "seq").agg(
        F.map_from_entries(F.collect_list(F.struct(C("query_id").cast("string"), "ranking"))).alias("rankings"))
    return RR.flatten_batches(entries).select("query_id", "seq", F.array_join("ranking", ",").alias("ranking"))


def batch_requests(spark, sf):
    return RR.batch_requests(R.orders(spark, sf), _ledger(spark, sf), _candidates(spark, sf), R.products(spark, sf),
                             "Rank the candidates of every order.", "Answer with JSON only.")


def parse_answers(spark, sf):
    return RR.parse_answers(_answers(spark, sf)).select("query_id", F.array_join("ranking", ",").alias("ranking"))


def parse_free_text(spark, sf):
    return RR.parse_batch_answers(_batch_answers(spark, sf)).select(
        "batch", "query_id", F.array_join("ranking", ",").alias("ranking"))


def fallbacks(spark, sf):
    done = RR.with_fallback(R.orders(spark, sf), RR.parse_answers(_answers(spark, sf)))
    return done.agg(F.count(F.lit(1)).alias("queries"), F.count_if("fallback").alias("fallbacks"))


def _reranked(spark, sf):
    done = RR.with_fallback(R.orders(spark, sf), RR.parse_answers(_answers(spark, sf)))
    return RR.rerank(done, _candidates(spark, sf))


def reranked(spark, sf):
    return _reranked(spark, sf)


def batch_reranked(spark, sf):
    """Free-text batch answers, some with a query answered twice, to ranked lists."""
    done = RR.with_fallback(R.orders(spark, sf), RR.parse_batch_answers(_batch_answers(spark, sf, again=True)).drop("batch"))
    return RR.rerank(done, _candidates(spark, sf))


def rerank_metrics(spark, sf):
    return E.metrics(E.gold_ranks(_gold(spark, sf), _reranked(spark, sf), "split"), "split")


# ------------------------------------------------------------------ no match
def _vocabulary(spark, sf):
    return P.vocabulary(R.products(spark, sf), ["name", "brand"], T.TOKENS_LOWER)


def vocabulary_union(spark, sf):
    return P.vocabulary(R.articles(spark, sf), ["name", "brand"], T.TOKENS_LOWER)


def oov_terms(spark, sf):
    return N.unknown_terms(R.requests_seen(spark, sf), _vocabulary(spark, sf)).select(
        "query_id", F.array_join("terms", " ").alias("terms"))


def nomatch_candidates(spark, sf):
    return N.no_match_candidates(R.requests_seen(spark, sf), _vocabulary(spark, sf)).select(
        "query_id", F.array_join("terms", " ").alias("terms"))


def _sampled(spark, sf):
    return P.seeded_sample(N.no_match_candidates(R.requests_seen(spark, sf), _vocabulary(spark, sf)),
                           "query_id", "42", N.SAMPLE)


def nomatch_sample(spark, sf):
    return _sampled(spark, sf).select("query_id", "text")


def _unmatched_ranking(spark, sf):
    def build():
        index = shared.product_index(spark, sf, "char35", "tfidf", False)
        return index.search(R.normalised(_sampled(spark, sf), "text", "query_id"), RR.CANDIDATES, pad=True).persist()
    return shared._once(spark, (sf, "unmatched"), build)


def _labelled_tops(spark, sf):
    """First score of labelled orders per split."""
    tops = shared.order_ranking(spark, sf, "char35", "tfidf", False).filter("rank = 1")
    return tops.join(_gold(spark, sf), "query_id").select(C("query_id").cast("string").alias("query_id"), C("split").alias("grp"), "score")


def _tops(spark, sf):
    """First score of labelled orders per split, and of the sampled texts without a match."""
    other = _unmatched_ranking(spark, sf).filter("rank = 1").select("query_id", F.lit("no match").alias("grp"), "score")
    return _labelled_tops(spark, sf).unionByName(other)


def score_distribution(spark, sf):
    out = N.score_distribution(_tops(spark, sf))
    return out.select("grp", "n", *[F.round(c, 6).alias(c) for c in ("least", "greatest", "median", "p5")])


def _flagged(spark, sf):
    tops = _tops(spark, sf)
    return N.flag_below(tops, N.threshold(tops.filter("grp = 'val'")))


def score_threshold(spark, sf):
    return N.threshold(_labelled_tops(spark, sf).filter("grp = 'val'")).select(F.round("score_limit", 6).alias("score_limit"))


def nomatch_rates(spark, sf):
    """The limit is fitted on one split; the other split gives its honest false-alarm rate."""
    return N.detection_rates(_flagged(spark, sf))


def nomatch_examples(spark, sf):
    first = _unmatched_ranking(spark, sf).filter("rank = 1")
    return (first.join(R.products(spark, sf).select("doc_id", "name"), "doc_id")
            .select("query_id", "name", F.round("score", 6).alias("score")).orderBy("query_id").limit(4))


def _control(spark, sf):
    return P.seeded_sample(R.orders(spark, sf), "query_id", "7", N.SAMPLE)


def _abstention_rows(spark, sf):
    """Stand-in answers: about half of the unmatched texts abstain, few of the control orders do."""
    unmatched = _sampled(spark, sf).select("query_id", F.length("text").alias("m"), F.lit("no match").alias("grp"))
    control = _control(spark, sf).select(C("query_id").cast("string").alias("query_id"),
                                         (C("query_id") % 10 + 1).cast("int").alias("m"), F.lit("control").alias("grp"))
    empty = F.array().cast("array<int>")
    answers = unmatched.unionByName(control).select("query_id", "grp", F.when(
        F.when(C("grp") == "no match", C("m") % 2 == 0).otherwise(C("m") == 10), empty)
        .otherwise(F.array((C("m") % 3 + 1).cast("int"))).alias("ranking"))
    candidates = (_candidates(spark, sf).withColumn("query_id", C("query_id").cast("string"))
                  .unionByName(RR.number_candidates(_unmatched_ranking(spark, sf))))
    gold = _gold(spark, sf).withColumn("query_id", C("query_id").cast("string"))
    return N.abstentions(answers, candidates, gold)


def abstention(spark, sf):
    return N.abstention_summary(_abstention_rows(spark, sf))


def abstention_picks(spark, sf):
    rows = _abstention_rows(spark, sf).filter("grp = 'no match' AND NOT abstained")
    return rows.select("query_id", "doc_id").orderBy("query_id").limit(6)


def keyword_lookup(spark, sf):
    return N.keyword_rows(R.products(spark, sf), [("anvil", "anvils"), ("red", "red products"), ("rod 1", "small rods")])


def keyword_table(spark, sf):
    """Articles that hold one of the catalog's brands or product types as a word of their text; the keys come from a table."""
    parts = R.table(spark, sf, "part")
    keys = parts.select(F.lower(F.substring_index("p_name", " ", 1)).alias("key"), F.lit("first word").alias("title")).unionByName(
        R.table(spark, sf, "nation").select(F.lower("n_name").alias("key"), F.lit("nation").alias("title"))).unionByName(
        R.table(spark, sf, "benchmark").select(F.lower(F.substring("text", 1, 12)).alias("key"), F.lit("benchmark").alias("title"))).unionByName(
        parts.select(F.lower(F.substring("p_type", 1, 2)).alias("key"), F.lit("short").alias("title"))).distinct()
    rows = N.keyword_join(R.products(spark, sf), keys).select("doc_id", "key", "title").unionByName(
        N.keyword_join(R.articles(spark, sf), keys.filter("title <> 'short'")).select("doc_id", "key", "title"))
    return rows.groupBy("key", "title").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first"), F.sum("doc_id").alias("ids"))


def combined_flags(spark, sf):
    """Low score and abstention of every query in one row."""
    return N.combined_flags(_flagged(spark, sf), _abstention_rows(spark, sf))


def unsure_queries(spark, sf):
    return N.unsure(shared.order_ranking(spark, sf, "char35", "tfidf", False), 0.02).select(
        "query_id", F.round("first", 6).alias("first"), F.round("second", 6).alias("second"))


# ------------------------------------------------------------------ SQL twins
_METRICS = """count(*) AS n, round(avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END), 6) AS p_at_1,
 round(avg(CASE WHEN rank BETWEEN 1 AND 5 THEN 1.0 / rank ELSE 0.0 END), 6) AS mrr_at_5,
 round(avg(CASE WHEN rank BETWEEN 1 AND 5 THEN 1.0 ELSE 0.0 END), 6) AS r_at_5"""


def _texts(brand):
    return S.PRODUCT_BRAND_TEXTS if brand else S.PRODUCT_TEXTS


def _tops_sql(how, k=5):
    analyzer, weighting, brand = how
    return f"({S.search(analyzer, weighting, _texts(brand), S.ORDER_TEXTS, k, True)} SELECT * FROM r)"


def _ranks_sql(how, label=""):
    return (f"SELECT {label} o.query_id, o.gold_id, o.split, coalesce(t.rank, 0)::INTEGER AS rank FROM ({S.ORDERS}) o "
            f"LEFT JOIN {_tops_sql(how)} t ON t.query_id = o.query_id AND t.doc_id = o.gold_id")


_BM25 = shared.SYSTEMS["bm25"]
_SYS = "sr AS MATERIALIZED (" + " UNION ALL ".join(
    _ranks_sql(how, f"'{name}' AS system,") for name, how in shared.SYSTEMS.items()) + ")"
_GRID = "gr AS MATERIALIZED (" + " UNION ALL ".join(
    _ranks_sql((a, w, b), f"'{fam}' AS family, '{cfg}' AS config,") for cfg, (fam, a, w, b) in shared.GRID.items()) + ")"
_BEST = f"""lb AS (SELECT family, config, {_METRICS} FROM gr WHERE split = 'val' GROUP BY family, config),
 best AS (SELECT family, config, p_at_1 FROM (SELECT *, row_number() OVER (PARTITION BY family
  ORDER BY p_at_1 DESC, config) AS place FROM lb) WHERE place = 1)"""
_CANDS = _tops_sql(("char35", "tfidf", False), 10)

_SEGMENTS = f"""SELECT query_id, CASE WHEN len(s) = 0 THEN ['common'] ELSE s END AS s FROM (SELECT query_id,
 list_filter([CASE WHEN upper(text) = text THEN 'upper' END,
  CASE WHEN regexp_matches(text, '{T.SEGMENT_PACK}', 'i') THEN 'packaging' END,
  CASE WHEN regexp_matches(text, '{T.SEGMENT_MEASURE}', 'i') THEN 'measure' END,
  CASE WHEN {S.token_count('text')} <= 4 THEN 'short' END, CASE WHEN {S.token_count('text')} >= 10 THEN 'long' END],
  lambda x: x IS NOT NULL) AS s FROM ({S.ORDERS}))"""

_FIVE = ("list_transform(list_sort(list_transform(range(1, 11), lambda n: [(query_id * 7 + n * 3) % 11, n]))[1:5], "
         "lambda x: x[2])")
_JSON = f"""CASE WHEN query_id % 7 = 3 THEN '[]'
 WHEN query_id % 11 = 5 THEN '[' || f[1] || ', ' || f[1] || ', 11, "3", null, 0, ' || f[2] || ']'
 ELSE '[' || array_to_string(f, ', ') || ']' END"""
_ANSWERS = (f"SELECT query_id, CASE WHEN query_id % 13 = 6 THEN NULL ELSE {_JSON} END AS a FROM "
            f"(SELECT query_id, {_FIVE} AS f FROM ({S.ORDERS}))")
_CLEAN = """SELECT query_id, list(n ORDER BY pos) AS ranking FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS at_place
 FROM (SELECT query_id, n, min(pos) AS pos FROM (SELECT query_id, unnest(range(1, len(p) + 1)) AS pos,
 try_cast(unnest(p) AS INTEGER) AS n FROM (SELECT query_id, list_transform(string_split(a, ','),
 lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS p FROM ans)) WHERE n BETWEEN 1 AND 10 GROUP BY ALL)) WHERE at_place <= 5 GROUP BY query_id"""
_PARSED = f"""ans AS ({_ANSWERS}), cl AS ({_CLEAN}),
 pa AS (SELECT o.query_id, coalesce(cl.ranking, []) AS ranking FROM ({S.ORDERS}) o LEFT JOIN cl USING (query_id))"""
_RANKED_LISTS = f""", cands AS MATERIALIZED (SELECT * FROM {_CANDS}),
 w AS (SELECT c.query_id, c.doc_id, coalesce(list_position(CASE WHEN len(p.ranking) = 0 THEN [1, 2, 3, 4, 5] ELSE p.ranking END, c.rank),
  100 + c.rank) AS pos FROM cands c JOIN pa p USING (query_id)),
 rr AS (SELECT query_id, rank::INTEGER AS rank, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS rank FROM w)
  WHERE rank <= 5)"""
_RERANK = _PARSED + _RANKED_LISTS

_LEDGER = """SELECT conv_id AS query_id, turn AS seq, (length(text) % 10 + 1) || ',' || (length(text) % 7 + 1) AS ranking
 FROM conversations"""


def _blocks(indent=""):
    return (f"(SELECT c.query_id, string_agg('{indent}' || c.rank || '. ' || p.name || ' (marca: ' || p.brand || ')', "
            f"chr(10) ORDER BY c.rank) AS lines FROM {_CANDS} c JOIN ({S.PRODUCTS}) p USING (doc_id) GROUP BY c.query_id)")


def _requests_sql(lead):
    return (f"""SELECT o.query_id, {lead} || 'Pedido: "' || o.text || '"' || chr(10) || 'Candidatos:' || chr(10) || b.lines
 AS request FROM ({S.ORDERS}) o JOIN {_blocks()} b USING (query_id)""")


def _vocab_sql(src):
    return " UNION ".join(f"SELECT unnest(regexp_extract_all(lower({c}), '{T.TOKENS_LOWER}')) AS token FROM ({src})"
                          for c in ("name", "brand"))


_OOV = f"""v AS ({_vocab_sql(S.PRODUCTS)}), tk AS (SELECT query_id, text, regexp_extract_all(lower(text), '{T.TOKENS_LOWER}') AS t
 FROM ({S.REQUESTS_SEEN})), un AS (SELECT query_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos FROM tk),
 oov AS (SELECT query_id, string_agg(token, ' ' ORDER BY pos) AS terms FROM un WHERE length(token) >= 5
  AND token NOT IN (SELECT token FROM v) GROUP BY query_id),
 nm AS (SELECT query_id, text, terms FROM (SELECT min(query_id) AS query_id, text FROM tk WHERE len(t) >= 3 GROUP BY text)
  JOIN oov USING (query_id)),
 sam AS MATERIALIZED (SELECT query_id, text, terms FROM nm ORDER BY md5(query_id || ':42'), query_id LIMIT 25)"""
_UNMATCHED = (f"um AS MATERIALIZED ({S.search('char35', 'tfidf', S.PRODUCT_TEXTS, 'SELECT query_id, ' + S.norm('text') + ' AS norm FROM sam', 10, True)}"
              " SELECT * FROM r)")
_TOPS = f"""{_OOV}, {_UNMATCHED}, tops AS MATERIALIZED (SELECT t.query_id::VARCHAR AS query_id, o.split AS grp, t.score
 FROM {_tops_sql(('char35', 'tfidf', False))} t JOIN ({S.ORDERS}) o USING (query_id) WHERE t.rank = 1
 UNION ALL SELECT query_id, 'no match', score FROM um WHERE rank = 1),
 lim AS (SELECT quantile_cont(score, 0.05) AS score_limit FROM tops WHERE grp = 'val')"""
_ABST = f"""{_OOV}, {_UNMATCHED}, cands AS MATERIALIZED (SELECT query_id::VARCHAR AS query_id, rank, doc_id FROM {_CANDS}
 UNION ALL SELECT query_id, rank, doc_id FROM um),
 ctl AS (SELECT query_id, text FROM ({S.ORDERS}) ORDER BY md5(query_id || ':7'), query_id LIMIT 25),
 an AS (SELECT query_id, 'no match' AS grp, length(text) AS m FROM sam
  UNION ALL SELECT query_id::VARCHAR, 'control', query_id % 10 + 1 FROM ctl),
 ab AS (SELECT query_id, grp, CASE WHEN grp = 'no match' THEN m % 2 = 0 ELSE m = 10 END AS abstained, m % 3 + 1 AS pick FROM an),
 pq AS (SELECT ab.*, CASE WHEN NOT abstained THEN c.doc_id END AS doc_id,
  coalesce(NOT abstained AND c.doc_id = o.gold_id, FALSE) AS hit FROM ab
  LEFT JOIN cands c ON c.query_id = ab.query_id AND c.rank = ab.pick
  LEFT JOIN ({S.ORDERS}) o ON o.query_id::VARCHAR = ab.query_id)"""

_WIDE = ", ".join(
    f"max(CASE WHEN t.rank = {r} THEN t.doc_id END) AS pred{r}_id, max(CASE WHEN t.rank = {r} THEN p.name END) AS pred{r}_name, "
    f"max(CASE WHEN t.rank = {r} THEN round(t.score, 4) END) AS pred{r}_score" for r in range(1, 6))

QUERIES: dict = {
    "gold_ranks": (gold_ranks, _ranks_sql(_BM25)),
    "metrics_overall": (metrics_overall, f"SELECT {_METRICS} FROM ({_ranks_sql(_BM25)})"),
    "predictions_wide": (predictions_wide, f"""WITH t AS MATERIALIZED (SELECT * FROM {_tops_sql(_BM25)}), p AS ({S.PRODUCTS}), o AS ({S.ORDERS})
 SELECT o.query_id, o.gold_id, g.name AS gold_name, o.text AS query,
 coalesce(max(CASE WHEN t.doc_id = o.gold_id THEN t.rank END), 0)::INTEGER AS gold_rank, {_WIDE}
 FROM o JOIN p g ON g.doc_id = o.gold_id JOIN t ON t.query_id = o.query_id JOIN p ON p.doc_id = t.doc_id
 GROUP BY o.query_id, o.gold_id, g.name, o.text"""),
    "leaderboard": (leaderboard, f"WITH {_GRID} SELECT family, config, {_METRICS} FROM gr WHERE split = 'val' GROUP BY family, config"),
    "best_configs": (best_configs, f"WITH {_GRID}, {_BEST} SELECT * FROM best"),
    "frozen_eval": (frozen_eval, f"""WITH {_GRID}, {_BEST} SELECT family, config, {_METRICS} FROM gr
 WHERE split = 'test' AND config IN (SELECT config FROM best) GROUP BY family, config"""),
    "system_compare": (system_compare, f"""WITH {_SYS}, notes(system, seconds, cost, complexity, index_kind, vectors) AS (VALUES {', '.join(map(str, SYSTEM_NOTES))}),
 m AS (SELECT system, {_METRICS} FROM sr GROUP BY system) SELECT m.*, seconds::DOUBLE AS seconds, cost::DOUBLE AS cost, complexity, index_kind, vectors FROM m LEFT JOIN notes USING (system)"""),
    "query_segments": (query_segments, f"SELECT query_id, unnest(s) AS segment FROM ({_SEGMENTS})"),
    "segment_scores": (segment_scores, f"""WITH {_SYS}, sg AS (SELECT query_id, unnest(s) AS segment FROM ({_SEGMENTS}))
 SELECT segment, count(DISTINCT query_id) AS n, """ + ", ".join(
        f"round(avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) FILTER (WHERE system = '{s}'), 3) AS {s}" for s in shared.SYSTEMS)
        + " FROM sg JOIN sr USING (query_id) GROUP BY segment"),
    "error_counts": (error_counts, f"WITH {_SYS} SELECT system, count(*) FILTER (WHERE rank <> 1) AS errors, count(*) AS queries FROM sr GROUP BY system"),
    "error_overlap": (error_overlap, f"""WITH {_SYS}, w AS (SELECT query_id, count(*) FILTER (WHERE rank <> 1) AS wrong FROM sr GROUP BY query_id)
 SELECT count(*) AS queries, count(*) FILTER (WHERE wrong >= 1) AS wrong_in_one, count(*) FILTER (WHERE wrong = 3) AS wrong_in_all,
 round(avg(CASE WHEN wrong < 3 THEN 1.0 ELSE 0.0 END), 6) AS best_of_all FROM w"""),
    "exclusive_errors": (exclusive_errors, f"""WITH {_SYS} SELECT query_id, min(system) AS system FROM sr WHERE rank <> 1
 GROUP BY query_id HAVING count(*) = 1"""),
    "repaired_errors": (repaired_errors, f"""WITH {_SYS}, t AS (SELECT query_id, doc_id FROM {_tops_sql(shared.SYSTEMS['tfidf_char'])} WHERE rank = 1)
 SELECT b.query_id, b.gold_id, t.doc_id AS wrong_id FROM sr b LEFT JOIN t USING (query_id) WHERE b.system = 'bm25' AND b.rank = 1
 AND b.query_id IN (SELECT query_id FROM sr WHERE system = 'tfidf_char' AND rank <> 1)"""),
    "error_list": (error_list, f"WITH {_SYS} SELECT system, split, query_id, gold_id, rank FROM sr WHERE rank <> 1"),
    "distributor_hits": (distributor_hits, f"""SELECT o.query_id, o.text, o.gold_id FROM ({_ranks_sql(shared.SYSTEMS['tfidf_char'])}) r
 JOIN ({S.ORDERS}) o USING (query_id) WHERE r.rank = 1 AND upper(o.text) = o.text
 AND regexp_matches(o.text, '{T.DISTRIBUTOR_STYLE}') ORDER BY o.query_id LIMIT 6"""),
    "requests": (requests, _requests_sql("''")),
    "requests_few_shot": (requests_few_shot, _requests_sql(f"'{FEW_SHOT}' || chr(10) || chr(10)")),
    "resume_pending": (resume_pending, f"SELECT query_id, text FROM ({S.ORDERS}) WHERE query_id NOT IN (SELECT conv_id FROM conversations)"),
    "ledger_latest": (ledger_latest, f"SELECT query_id, arg_max(ranking, seq) AS ranking FROM ({_LEDGER}) GROUP BY query_id"),
    "ledger_flatten": (ledger_flatten, _LEDGER),
    "batch_requests": (batch_requests, f"""WITH b AS (SELECT o.query_id, 'Pedido ' || o.query_id || ': "' || o.text || '"' || chr(10) || 'Candidatos:' || chr(10) || c.lines AS block
 FROM ({S.ORDERS}) o JOIN {_blocks('  ')} c USING (query_id) WHERE o.query_id NOT IN (SELECT conv_id FROM conversations))
 SELECT query_id // 32 AS batch, count(*) AS queries, 'Rank the candidates of every order.' || chr(10) || chr(10) ||
 string_agg(block, chr(10) || chr(10) ORDER BY query_id) || chr(10) || chr(10) || 'Answer with JSON only.' AS request FROM b GROUP BY batch"""),
    "parse_answers": (parse_answers, f"WITH {_PARSED} SELECT query_id, array_to_string(ranking, ',') AS ranking FROM pa"),
    "parse_free_text": (parse_free_text, f"""WITH ans AS (SELECT query_id, {_JSON} AS a FROM (SELECT query_id, {_FIVE} AS f FROM ({S.ORDERS}))),
 cl AS ({_CLEAN}) SELECT query_id // 32 AS batch, query_id, array_to_string(ranking, ',') AS ranking FROM cl"""),
    "rerank_fallbacks": (fallbacks, f"WITH {_PARSED} SELECT count(*) AS queries, count(*) FILTER (WHERE len(ranking) = 0) AS fallbacks FROM pa"),
    "reranked_top5": (reranked, f"WITH {_RERANK} SELECT * FROM rr"),
    "batch_reranked_top5": (batch_reranked, f"""WITH ans AS (SELECT query_id, CASE WHEN query_id % 5 = 0 THEN '[2, 1]' ELSE {_JSON} END AS a
 FROM (SELECT query_id, {_FIVE} AS f FROM ({S.ORDERS}))), cl AS ({_CLEAN}),
 pa AS (SELECT o.query_id, coalesce(cl.ranking, []) AS ranking FROM ({S.ORDERS}) o LEFT JOIN cl USING (query_id)){_RANKED_LISTS} SELECT * FROM rr"""),
    "rerank_metrics": (rerank_metrics, f"""WITH {_RERANK}, g AS (SELECT o.split, coalesce(rr.rank, 0) AS rank FROM ({S.ORDERS}) o
 LEFT JOIN rr ON rr.query_id = o.query_id AND rr.doc_id = o.gold_id) SELECT split, {_METRICS} FROM g GROUP BY split"""),
    "vocabulary_union": (vocabulary_union, _vocab_sql(S.ARTICLES)),
    "oov_terms": (oov_terms, f"WITH {_OOV} SELECT query_id, terms FROM oov"),
    "nomatch_candidates": (nomatch_candidates, f"WITH {_OOV} SELECT query_id, terms FROM nm"),
    "nomatch_sample": (nomatch_sample, f"WITH {_OOV} SELECT query_id, text FROM sam"),
    "score_distribution": (score_distribution, f"""WITH {_TOPS} SELECT grp, count(*) AS n, round(min(score), 6) AS least, round(max(score), 6) AS greatest,
 round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.05), 6) AS p5 FROM tops GROUP BY grp"""),
    "score_threshold": (score_threshold, f"WITH {_TOPS} SELECT round(score_limit, 6) AS score_limit FROM lim"),
    "nomatch_rates": (nomatch_rates, f"""WITH {_TOPS} SELECT grp, count(*) AS n, count(*) FILTER (WHERE score < score_limit) AS flagged,
 round(avg(CASE WHEN score < score_limit THEN 1.0 ELSE 0.0 END), 6) AS flagged_share FROM tops, lim GROUP BY grp"""),
    "nomatch_examples": (nomatch_examples, f"""WITH {_OOV}, {_UNMATCHED} SELECT um.query_id, p.name, round(um.score, 6) AS score
 FROM um JOIN ({S.PRODUCTS}) p USING (doc_id) WHERE um.rank = 1 ORDER BY um.query_id LIMIT 4"""),
    "abstention": (abstention, f"""WITH {_ABST} SELECT grp, count(*) AS n, count(*) FILTER (WHERE abstained) AS abstained,
 round(avg(CASE WHEN abstained THEN 1.0 ELSE 0.0 END), 6) AS abstained_share, count(*) FILTER (WHERE hit) AS hits,
 count(*) FILTER (WHERE NOT abstained) AS answered FROM pq GROUP BY grp"""),
    "abstention_picks": (abstention_picks, f"""WITH {_ABST} SELECT query_id, doc_id FROM pq WHERE grp = 'no match' AND NOT abstained
 ORDER BY query_id LIMIT 6"""),
    "keyword_lookup": (keyword_lookup, " UNION ALL ".join(
        f"SELECT doc_id, name, '{k}' AS key, '{t}' AS title FROM ({S.PRODUCTS}) WHERE contains(lower(name), '{k}')"
        for k, t in (("anvil", "anvils"), ("red", "red products"), ("rod 1", "small rods")))),
    "keyword_table": (keyword_table, f"""WITH keys AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS key, 'first word' AS title FROM part
 UNION SELECT lower(n_name), 'nation' FROM nation UNION SELECT lower(substring(text, 1, 12)), 'benchmark' FROM benchmark
 UNION SELECT lower(substring(p_type, 1, 2)), 'short' FROM part),
 hits AS (SELECT doc_id, key, title FROM ({S.PRODUCTS}), keys WHERE contains(lower(name), key)
  UNION ALL SELECT doc_id, key, title FROM ({S.ARTICLES}), keys WHERE title <> 'short' AND contains(lower(name), key))
 SELECT key, title, count(*) AS rows, min(doc_id) AS first, sum(doc_id)::BIGINT AS ids FROM hits GROUP BY ALL"""),
    "combined_flags": (combined_flags, f"""WITH {_TOPS}, {_ABST.removeprefix(f"{_OOV}, {_UNMATCHED}, ")},
 fl AS (SELECT query_id, grp, score < score_limit AS low_score FROM tops, lim)
 SELECT coalesce(fl.query_id, ab.query_id) AS query_id, coalesce(fl.grp, ab.grp) AS grp, low_score, abstained,
 coalesce(low_score, TRUE) AND coalesce(abstained, TRUE) AS no_match FROM fl FULL JOIN ab ON fl.query_id = ab.query_id"""),
    "unsure_queries": (unsure_queries, f"""SELECT query_id, round(a, 6) AS first, round(b, 6) AS second FROM (SELECT query_id,
 max(score) FILTER (WHERE rank = 1) AS a, max(score) FILTER (WHERE rank = 2) AS b FROM {_tops_sql(('char35', 'tfidf', False))} GROUP BY query_id)
 WHERE a - b < 0.02"""),
}
