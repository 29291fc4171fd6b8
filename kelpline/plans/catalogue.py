"""Registered linkage queries and the SQL they are compared with.

The driver tables stand in for catalogues and new rows: a part's brand and size
make a code, its type and name a description; line items and orders give years.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import contracts
from kelpline.config import HoldoutConfig, NoiseConfig, PrimaryConfig, RetrievalConfig
from kelpline.functions import text as tx
from kelpline.functions.similarity import lcs, ratio, token_set_ratio, token_sort_ratio
from kelpline.operators import dedupe, dictionary, holdout, match, noise, pairwise, panel, ranking
from kelpline.plans import sqltext as sx
from kelpline.plans.preflight import check_primary
from kelpline.sources import sinks
from kelpline.streaming import intake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- inputs ------------------------------------------------------------------------------------------------------

CODE = "concat(p_brand, '-', p_size)"
DESC = "upper(concat(p_type, ' ', p_name))"
#: A misspelt description: the last letter is lost in one type, two letters swap in another, words turn round in a third.
NOISED = """CASE p_type WHEN 'ECONOMY' THEN upper(concat(p_type, ' ', p_name))
  WHEN 'SMALL' THEN upper(substr(concat(p_type, ' ', p_name), 1, length(concat(p_type, ' ', p_name)) - 1))
  WHEN 'LARGE' THEN upper(concat(p_name, ' ', p_type))
  WHEN 'PROMO' THEN upper(concat('PORMO ', p_name))
  ELSE upper(concat(p_name, ' 12345 ', p_type)) END"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_type", "p_name", F.expr(CODE).alias("code"), F.expr(DESC).alias("desc"), F.expr(NOISED).alias("noised"))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly catalogue rows: a part per line item, its year and a load order."""
    lines = table(spark, sf, "lineitem").select("l_partkey", F.year("l_shipdate").alias("source_year"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).alias("load_seq"))
    return lines.join(parts(spark, sf), F.col("l_partkey") == F.col("p_partkey")).select("code", F.col("desc"), "source_year", "load_seq", F.col("p_partkey"))


SALES = f"""s AS (SELECT {CODE} AS code, {DESC} AS "desc", year(l_shipdate) AS source_year, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS load_seq, p_partkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """One reference row per (code, desc)."""
    return parts(spark, sf).groupBy("code", "desc").agg(F.min("p_partkey").alias("ref_id")).withColumn("ref_pos", F.col("ref_id"))


CATALOGUE = f"""ref AS (SELECT {CODE} AS code, {DESC} AS "desc", min(p_partkey) AS ref_id FROM part GROUP BY 1, 2)"""


def names(spark: SparkSession, sf: str) -> DataFrame:
    """A small reference: one row per part name."""
    p = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("ref_id"), F.min_by("p_brand", "p_partkey").alias("code"))
    return p.select("ref_id", F.col("ref_id").alias("ref_pos"), "code", F.upper("p_name").alias("desc"))


def name_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Noisy queries for it: one per type and name, without a code for two types."""
    p = parts(spark, sf).groupBy("p_type", "p_name").agg(F.min("p_partkey").alias("query_id"), F.first("noised").alias("desc"))
    t = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("target"), F.min_by("p_brand", "p_partkey").alias("brand"))
    code = F.when(F.col("p_type").isin("MEDIUM", "PROMO"), "").otherwise(F.replace("brand", F.lit("#"), F.lit("/")))
    return p.join(t, "p_name").select("query_id", code.alias("code"), "desc", "target")


NAMES = f"""ref AS (SELECT min(p_partkey) AS ref_id, arg_min(p_brand, p_partkey) AS code, upper(p_name) AS "desc" FROM part GROUP BY p_name),
q AS (SELECT min(p_partkey) AS query_id, CASE WHEN p_type IN ('MEDIUM', 'PROMO') THEN '' ELSE replace(any_value(brand), '#', '/') END AS code,
        any_value({NOISED}) AS "desc", any_value(target) AS target
      FROM part JOIN (SELECT p_name AS n, min(p_partkey) AS target, arg_min(p_brand, p_partkey) AS brand FROM part GROUP BY p_name) ON n = p_name GROUP BY p_type, p_name)"""

# ---- scalar functions and filters --------------------------------------------------------------------------------

RAW_CODE = "CASE c_mktsegment WHEN 'MACHINERY' THEN ' n/a ' WHEN 'HOUSEHOLD' THEN NULL WHEN 'BUILDING' THEN concat('  ', lower(c_name), '\t') ELSE c_name END"


@query("normalize_codes", f"SELECT c_custkey, {sx.code(f'({RAW_CODE})')} AS code FROM customer")
def normalize_codes(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", tx.normalize_code(F.expr(RAW_CODE)).alias("code"))


@query("normalize_desc", f"SELECT p_partkey, {sx.code('p_name')} AS upper_desc, lower({sx.code('p_type')}) AS lower_desc FROM part")
def normalize_desc(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.normalize_description(F.col("p_name")).alias("upper_desc"), tx.normalize_description(F.col("p_type"), lower=True).alias("lower_desc"))


@query("strip_code", f"SELECT p_partkey, {sx.strip(CODE)} AS code FROM part")
def strip_code(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.strip_code(F.expr(CODE)).alias("code"))


@query("clean_space", f"SELECT doc_id, md5({sx.squeeze('text')}) AS digest, CAST(length({sx.squeeze('text')}) AS BIGINT) AS n, md5(upper({sx.squeeze('source')})) AS source FROM documents")
def clean_space(spark, sf):
    s = tx.squeeze(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(s.cast("binary")).alias("digest"), F.length(s).cast("long").alias("n"), F.md5(tx.search_text(F.col("source")).cast("binary")).alias("source"))


KEY = "CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'x' WHEN 'view' THEN '0.0' ELSE CAST(event_id % 3 AS {text}) END"


@query("new_rows_coerced", f"SELECT event_id, TRY_CAST({KEY.format(text='VARCHAR')} AS DOUBLE) AS charge_key FROM events WHERE coalesce(TRY_CAST({KEY.format(text='VARCHAR')} AS DOUBLE), 0) = 0")
def new_rows_coerced(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr(KEY.format(text="STRING")).alias("key"))
    return e.where(tx.is_new(F.col("key"))).select("event_id", tx.number(F.col("key")).alias("charge_key"))


ROUTED = ("CASE p_brand WHEN 'Brand#1' THEN '' ELSE p_brand END", "CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'SMALL' THEN concat(p_name, '-') WHEN 'LARGE' THEN 'ab' ELSE p_name END")


@query(
    "route_rows",
    f"""WITH r AS (SELECT p_partkey, {ROUTED[0]} AS code, {ROUTED[1]} AS d FROM part)
SELECT p_partkey, CASE WHEN length(d) >= 3 AND d NOT LIKE '%-' THEN 'described' WHEN code <> '' THEN 'code_only' ELSE 'dropped' END AS route FROM r""",
)
def route_rows(spark, sf):
    r = table(spark, sf, "part").select("p_partkey", F.expr(ROUTED[0]).alias("code"), F.expr(ROUTED[1]).alias("desc"))
    return r.select("p_partkey", tx.route(F.col("code"), F.col("desc")).alias("route"))


@query(
    "conform_union",
    """SELECT o_orderkey AS id, o_orderstatus AS chrg_code, o_orderpriority AS chrg_desc, CAST(NULL AS VARCHAR) AS chrg_type_seg FROM orders
UNION ALL SELECT c_custkey, c_name, CAST(NULL AS VARCHAR), c_mktsegment FROM customer""",
)
def conform_union(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("chrg_code"), F.col("o_orderpriority").alias("chrg_desc"), "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("chrg_code"), F.col("c_mktsegment").alias("chrg_type_seg"))
    return contracts.conform(dedupe.union_by_name(o, c), ["id", "chrg_code", "chrg_desc", "chrg_type_seg"])


# ---- de-duplication and dictionaries -----------------------------------------------------------------------------


def _pick_sql(order: str) -> str:
    return f'WITH {SALES} SELECT code, "desc" AS d, source_year, load_seq FROM (SELECT *, row_number() OVER (PARTITION BY code, "desc" ORDER BY {order}) AS n FROM s) WHERE n = 1'


@query("dedupe_last_year", _pick_sql("source_year DESC, load_seq DESC"))
def dedupe_last_year(spark, sf):
    return dedupe.keep_last(sales(spark, sf), ["code", "desc"], "source_year", "load_seq").select("code", F.col("desc").alias("d"), "source_year", "load_seq")


@query("dedupe_first", _pick_sql("load_seq"))
def dedupe_first(spark, sf):
    return dedupe.keep_first(sales(spark, sf), ["code", "desc"], "load_seq").select("code", F.col("desc").alias("d"), "source_year", "load_seq")


@query(
    "reference_positions",
    f"""WITH {SALES}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code, "desc" ORDER BY source_year DESC, load_seq DESC) AS n FROM s) WHERE n = 1)
SELECT code, "desc" AS d, row_number() OVER (ORDER BY source_year, load_seq) - 1 AS ref_pos FROM k""",
)
def reference_positions(spark, sf):
    return dedupe.reference(sales(spark, sf), "code", "desc").select("code", F.col("desc").alias("d"), "ref_pos")


@query("latest_desc_by_code", f"""WITH {SALES} SELECT code, arg_max("desc", struct_pack(y := source_year, s := load_seq)) AS d FROM s GROUP BY code""")
def latest_desc_by_code(spark, sf):
    return dedupe.latest_descriptions(sales(spark, sf), "code", "desc").select(F.col("dict_code").alias("code"), F.col("dict_desc").alias("d"))


DICT = """dict AS (SELECT upper(p_brand) AS dict_code, arg_max(upper(p_name), p_partkey) AS dict_desc FROM part GROUP BY 1)"""
ODD_CODE = "CASE p_type WHEN 'ECONOMY' THEN concat(p_brand, '(', p_size, 'A)') WHEN 'SMALL' THEN concat('664/', p_brand) WHEN 'LARGE' THEN concat(p_brand, 'ABC') WHEN 'PROMO' THEN concat(p_brand, '.', p_size) WHEN 'MEDIUM' THEN concat(p_brand, ' VC/', p_size) ELSE concat('Z', p_size) END"


def brand_dictionary(spark, sf):
    return table(spark, sf, "part").groupBy(F.upper("p_brand").alias("dict_code")).agg(F.max_by(F.upper("p_name"), "p_partkey").alias("dict_desc"))


@query(
    "derive_desc",
    rf"""WITH {DICT}, c AS (SELECT p_partkey, upper({ODD_CODE}) AS code FROM part),
t AS (SELECT p_partkey, 0 AS k, regexp_extract(code, '^664/(.+)$', 1) AS c, 'ATT:' AS prefix, code FROM c
  UNION ALL SELECT p_partkey, 1, trim(regexp_replace(code, '\([A-Z0-9]+\)$', '')), '', code FROM c
  UNION ALL SELECT p_partkey, 2, trim(regexp_replace(code, '[A-Z]+$', '')), '', code FROM c
  UNION ALL SELECT p_partkey, 3, trim(split_part(code, '.', 1)), '', code FROM c
  UNION ALL SELECT p_partkey, 4, trim(regexp_replace(code, '\s+(MPOL|VC|PC)/?.*$', '')), '', code FROM c),
h AS (SELECT p_partkey, arg_min(prefix || dict_desc, k) AS d FROM t JOIN dict ON dict_code = c WHERE c <> '' AND (k = 0 OR c <> code) GROUP BY p_partkey)
SELECT p_partkey, coalesce(d, '') AS derived_desc FROM part LEFT JOIN h USING (p_partkey)""",
)
def derive_desc(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.expr(ODD_CODE).alias("code"))
    return dictionary.derive(p, brand_dictionary(spark, sf), "p_partkey", "code")


SHORT_DESC = "CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'SMALL' THEN 'X' ELSE upper(p_name) END"


@query(
    "backfill_desc",
    f"""WITH {DICT}, all_years AS (SELECT upper(concat(p_brand, '-', p_size)) AS dict_code, max(p_name) AS dict_desc FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN length({SHORT_DESC}) >= 3 THEN {SHORT_DESC} ELSE coalesce(nullif(dict.dict_desc, ''), nullif(all_years.dict_desc, ''), '') END AS d
FROM part LEFT JOIN dict ON dict.dict_code = CASE WHEN p_size % 2 = 0 THEN upper(p_brand) ELSE upper({CODE}) END
LEFT JOIN all_years ON all_years.dict_code = CASE WHEN p_size % 2 = 0 THEN upper(p_brand) ELSE upper({CODE}) END""",
)
def backfill_desc(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select("p_partkey", F.upper(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.expr(CODE))).alias("chrg_code"), F.expr(SHORT_DESC).alias("chrg_desc"))
    all_years = p.groupBy(F.upper(F.expr(CODE)).alias("dict_code")).agg(F.max("p_name").alias("dict_desc"))
    return dictionary.backfill(rows, brand_dictionary(spark, sf), all_years).select("p_partkey", F.col("chrg_desc").alias("d"))


FLAGS = "CASE WHEN p_type = 'SMALL' THEN 1 WHEN p_type = 'PROMO' THEN NULL ELSE 0 END", "CASE WHEN p_retailprice > 950 THEN 1 ELSE 0 END"


def flagged(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.expr(CODE).alias("code"), F.col("p_name").alias("desc"), F.col("p_partkey").alias("ref_id"), F.col("p_partkey").alias("ref_pos"), (F.col("p_size") % 5).alias("source_year"), F.expr(FLAGS[0]).alias("chrg_type_a"), F.expr(FLAGS[1]).alias("chrg_type_b"))


GROUPS = f"""g AS (SELECT {CODE} AS code, arg_max(p_partkey, struct_pack(y := p_size % 5, k := p_partkey)) AS ref_id,
  count(DISTINCT {FLAGS[0]}) + max(CASE WHEN {FLAGS[0]} IS NULL THEN 1 ELSE 0 END) > 1 OR count(DISTINCT {FLAGS[1]}) + max(CASE WHEN {FLAGS[1]} IS NULL THEN 1 ELSE 0 END) > 1 AS conflict
  FROM part GROUP BY 1)"""


@query("code_conflict", f"WITH {GROUPS} SELECT code, ref_id, conflict FROM g")
def code_conflict(spark, sf):
    return dedupe.code_groups(flagged(spark, sf), ["chrg_type_a", "chrg_type_b"], code="code").select("code", "ref_id", "conflict")


@query(
    "code_only_match",
    f"""WITH {GROUPS} SELECT p_partkey AS query_id, ref_id, CASE WHEN g.code IS NULL THEN 0.0 ELSE 1.0 END AS score,
CASE WHEN g.code IS NULL THEN 'code_only_unmatched' WHEN conflict THEN 'exact_code_conflict' ELSE 'exact_code' END AS method, coalesce(conflict, true) AS needs_review
FROM part LEFT JOIN g ON g.code = CASE WHEN p_type = 'LARGE' THEN 'none' ELSE {CODE} END""",
)
def code_only_match(spark, sf):
    q = table(spark, sf, "part").select(F.col("p_partkey").alias("query_id"), F.when(F.col("p_type") == "LARGE", "none").otherwise(F.expr(CODE)).alias("code"))
    return match.code_only(q, dedupe.code_groups(flagged(spark, sf), ["chrg_type_a", "chrg_type_b"], code="code"))


@query(
    "append_key",
    """SELECT chrg_code, chrg_desc, arg_min(src, struct_pack(n := fresh, s := load_seq)) AS src FROM (
  SELECT p_brand AS chrg_code, p_name AS chrg_desc, concat('old', p_partkey) AS src, p_partkey AS load_seq, 0 AS fresh FROM part WHERE p_size < 25
  UNION ALL SELECT p_brand, p_name, concat('new', p_partkey), p_partkey, 1 FROM part WHERE p_size >= 25) GROUP BY 1, 2""",
)
def append_key(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("chrg_code"), F.col("p_name").alias("chrg_desc"), F.col("p_partkey").alias("load_seq"), "p_size")
    side = lambda name, c: p.where(c).withColumn("src", F.concat(F.lit(name), F.col("load_seq")))
    merged = dedupe.append_key(side("old", F.col("p_size") < 25), side("new", F.col("p_size") >= 25), ["chrg_code", "chrg_desc"])
    return merged.select("chrg_code", "chrg_desc", "src")


# ---- matching ----------------------------------------------------------------------------------------------------


def part_queries(spark, sf):
    return parts(spark, sf).select(F.col("p_partkey").alias("query_id"), "code", F.col("noised").alias("desc"))


PART_QUERIES = f'q AS (SELECT p_partkey AS query_id, {CODE} AS code, {NOISED} AS "desc" FROM part)'


def _exact_sql(on: str) -> str:
    return f'WITH {CATALOGUE}, {PART_QUERIES} SELECT query_id, min(ref_id) AS ref_id FROM q JOIN ref ON {on} GROUP BY query_id'


@query("exact_match_primary", _exact_sql('upper(q.code) = upper(ref.code) AND upper(q."desc") = upper(ref."desc")'))
def exact_match_primary(spark, sf):
    return match.exact(part_queries(spark, sf), catalogue(spark, sf))


@query("exact_match_secondary", _exact_sql('upper(q."desc") = upper(ref."desc")'))
def exact_match_secondary(spark, sf):
    return match.exact(part_queries(spark, sf), catalogue(spark, sf), by_code=False)


BEST = f"""a AS (SELECT DISTINCT {sx.sorted_tokens('upper("desc")')} AS a FROM q), b AS (SELECT {sx.sorted_tokens('upper("desc")')} AS b, min(ref_id) AS ref_id FROM ref GROUP BY 1),
p AS (SELECT a, b, ref_id, {sx.lcs('a', 'b')} AS common FROM a JOIN b ON 200 * least(length(a), length(b)) >= 90 * (length(a) + length(b))),
best AS (SELECT a, arg_max(ref_id, struct_pack(r := 200.0 * common / (length(a) + length(b)), n := -ref_id)) AS ref_id, max(200.0 * common / (length(a) + length(b))) AS ratio
  FROM p WHERE 200 * common >= 90 * (length(a) + length(b)) GROUP BY a)"""


@query("fuzzy_best_match", f"""WITH {CATALOGUE}, {PART_QUERIES}, {BEST} SELECT query_id, ref_id, round(ratio, 6) AS ratio FROM q JOIN best ON a = {sx.sorted_tokens('upper("desc")')}""")
def fuzzy_best_match(spark, sf):
    return match.fuzzy(part_queries(spark, sf), catalogue(spark, sf)).select("query_id", "ref_id", F.round("ratio", 6).alias("ratio"))


@query(
    "match_cascade",
    f"""WITH {CATALOGUE}, {PART_QUERIES}, {BEST},
e AS (SELECT query_id, min(ref_id) AS ref_id FROM q JOIN ref ON upper(q.code) = upper(ref.code) AND upper(q."desc") = upper(ref."desc") GROUP BY query_id)
SELECT q.query_id, coalesce(e.ref_id, best.ref_id) AS ref_id, round(CASE WHEN e.ref_id IS NOT NULL THEN 1.0 ELSE coalesce(ratio / 100, 0.0) END, 6) AS score,
CASE WHEN e.ref_id IS NOT NULL THEN 'exact' WHEN best.ref_id IS NOT NULL THEN 'fuzzy' ELSE 'unmatched' END AS method, coalesce(e.ref_id, best.ref_id) IS NULL AS needs_review
FROM q LEFT JOIN e USING (query_id) LEFT JOIN best ON a = {sx.sorted_tokens('upper(q."desc")')}""",
)
def match_cascade(spark, sf):
    out = match.cascade(part_queries(spark, sf), catalogue(spark, sf))
    return out.select("query_id", "ref_id", F.round("score", 6).alias("score"), "method", "needs_review")


PAIRS = 'WITH x AS (SELECT DISTINCT upper(p_name) AS a FROM part), y AS (SELECT DISTINCT upper(concat(p_type, \' \', p_name)) AS b FROM part)'


def text_pairs(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.upper("p_name").alias("a")).distinct().crossJoin(p.select(F.expr(DESC).alias("b")).distinct())


@query("token_sort_pairs", f"{PAIRS}, z AS (SELECT a, b, {sx.sorted_tokens('a')} AS sa, {sx.sorted_tokens('b')} AS sb FROM x CROSS JOIN y) SELECT a, b, round({sx.ratio(sx.lcs('sa', 'sb'), 'sa', 'sb')}, 6) AS r FROM z")
def token_sort_pairs(spark, sf):
    return text_pairs(spark, sf).select("a", "b", F.round(token_sort_ratio(F.col("a"), F.col("b")), 6).alias("r"))


@query("token_set_pairs", f"{PAIRS}, z AS (SELECT a, b, {sx.token_set_columns('a', 'b')} FROM x CROSS JOIN y), l AS (SELECT *, {sx.lcs('ra', 'rb')} AS cset FROM z) SELECT a, b, round({sx.token_set()}, 6) AS r FROM l")
def token_set_pairs(spark, sf):
    return text_pairs(spark, sf).select("a", "b", F.round(token_set_ratio(F.col("a"), F.col("b")), 6).alias("r"))


@query("code_ratio", f"SELECT r_name, n_name, {sx.lcs('r_name', 'n_name')} AS common, round({sx.ratio(sx.lcs('r_name', 'n_name'), 'r_name', 'n_name')}, 6) AS r FROM region CROSS JOIN nation")
def code_ratio(spark, sf):
    pairs = table(spark, sf, "region").crossJoin(table(spark, sf, "nation"))
    return pairs.select("r_name", "n_name", lcs("r_name", "n_name").cast("long").alias("common"), F.round(ratio(F.col("r_name"), F.col("n_name")), 6).alias("r"))


COSINE = "list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))"


def vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    ref = e.select(F.col("vec_id").alias("ref_id"), F.col("vec_id").alias("ref_pos"), F.col("embedding").alias("vector"), "label")
    return e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), F.col("label").alias("own")), ref


@query(
    "semantic_best",
    f"""SELECT query_id, arg_max(ref_id, struct_pack(c := c, n := -ref_id)) AS ref_id, round(max(c), 4) AS cosine FROM (
SELECT q.vec_id AS query_id, e.vec_id AS ref_id, {COSINE} AS c FROM embeddings q JOIN embeddings e ON e.label <> q.label WHERE q.vec_id % 50 = 0) GROUP BY query_id""",
)
def semantic_best(spark, sf):
    q, ref = vectors(spark, sf)
    labels = [r[0] for r in ref.select("label").distinct().collect()]  # a fixed set of ten
    parts_ = [match.semantic(q.where(F.col("own") == v), ref.where(F.col("label") != v)) for v in labels]
    out = parts_[0]
    for p in parts_[1:]:
        out = out.unionAll(p)
    return out.select("query_id", "ref_id", F.round("cosine", 4).alias("cosine"))


@query(
    "semantic_topk",
    f"""SELECT query_id, ref_id, place, round(c, 4) AS cosine FROM (SELECT q.vec_id AS query_id, e.vec_id AS ref_id, {COSINE} AS c,
row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE} DESC, e.vec_id DESC) AS place FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id % 50 = 0) WHERE place <= 3""",
)
def semantic_topk(spark, sf):
    q, ref = vectors(spark, sf)
    near = panel.nearest(q.drop("own"), ref, 3)
    return near.select("query_id", "ref_id", F.col("place").cast("long").alias("place"), F.round("cosine", 4).alias("cosine"))


@query("unit_vectors", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS norm, 1.0 AS unit FROM embeddings")
def unit_vectors(spark, sf):
    v = F.col("embedding")
    e = table(spark, sf, "embeddings").select("vec_id", F.round(F.sqrt(tx.dot(v, v)), 4).alias("norm"), tx.unit(F.transform(v, lambda x: x * 3)).alias("u"))
    return e.select("vec_id", "norm", F.round(F.sqrt(tx.dot(F.col("u"), F.col("u"))), 9).alias("unit"))


# ---- ranking -----------------------------------------------------------------------------------------------------

GRAMS = f"""w AS (SELECT ref_id AS id, concat(' ', unnest({sx.tokens('"desc"')}), ' ') AS w FROM ref), g AS (SELECT id, unnest({sx.ngrams('w', 3, 5)}) AS gram FROM w),
tf AS (SELECT id, gram, count(*) AS tf FROM g GROUP BY ALL), df AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
idf AS (SELECT gram, ln((1.0 + (SELECT count(*) FROM ref)) / (1 + df)) + 1 AS idf FROM df), raw AS (SELECT id, gram, tf * idf AS w FROM tf JOIN idf USING (gram)),
rw AS (SELECT id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""
QUERY_GRAMS = f"""qw AS (SELECT query_id AS id, concat(' ', unnest({sx.tokens('"desc"')}), ' ') AS w FROM q), qg AS (SELECT id, unnest({sx.ngrams('w', 3, 5)}) AS gram FROM qw),
qtf AS (SELECT id, gram, count(*) AS tf FROM qg GROUP BY ALL), qraw AS (SELECT id, gram, tf * idf AS w FROM qtf JOIN idf USING (gram)),
qn AS (SELECT id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM qraw), cos AS (SELECT qn.id AS query_id, rw.id AS ref_id, sum(qn.weight * rw.weight) AS tfidf FROM qn JOIN rw USING (gram) GROUP BY ALL)"""


@query("ngram_counts", f"""WITH {NAMES}, {GRAMS} SELECT id, gram, tf FROM tf""")
def ngram_counts(spark, sf):
    grams = names(spark, sf).select(F.col("ref_id").alias("id"), F.explode(tx.char_ngrams(F.col("desc"), 3, 5)).alias("gram"))
    return grams.groupBy("id", "gram").agg(F.count("*").alias("tf"))


@query("tfidf_weights", f"""WITH {NAMES}, {GRAMS} SELECT id, gram, round(weight, 6) AS weight FROM rw""")
def tfidf_weights(spark, sf):
    texts = names(spark, sf).select(F.col("ref_id").alias("id"), F.col("desc").alias("text"))
    return ranking.tfidf_weights(texts, None, 3, 5)[0].select("id", "gram", F.round("weight", 6).alias("weight"))


@query("tfidf_cosine", f"""WITH {NAMES}, {GRAMS}, {QUERY_GRAMS} SELECT DISTINCT q."desc" AS qt, ref."desc" AS rt, round(tfidf, 6) AS tfidf FROM cos JOIN q USING (query_id) JOIN ref USING (ref_id)""")
def tfidf_cosine(spark, sf):
    q, r = name_queries(spark, sf).select(F.col("desc").alias("qt")).distinct(), names(spark, sf).select(F.col("desc").alias("rt"))
    return ranking.tfidf_cosine(q, r).select("qt", "rt", F.round("tfidf", 6).alias("tfidf"))


SCORED = f"""{NAMES}, {GRAMS}, {QUERY_GRAMS},
t AS (SELECT DISTINCT q."desc" AS qt, ref."desc" AS rt, {sx.sorted_tokens('q."desc"')} AS sa, {sx.sorted_tokens('ref."desc"')} AS sb, {sx.token_set_columns('q."desc"', 'ref."desc"')} FROM q CROSS JOIN ref),
t2 AS (SELECT *, {sx.lcs('ra', 'rb')} AS cset, {sx.lcs('sa', 'sb')} AS csort FROM t),
t3 AS (SELECT qt, rt, ({sx.ratio('csort', 'sa', 'sb')}) / 100 AS token_sort, ({sx.token_set()}) / 100 AS token_set FROM t2),
c AS (SELECT DISTINCT {sx.strip('q.code')} AS qc, {sx.strip('ref.code')} AS rc FROM q CROSS JOIN ref),
c2 AS (SELECT qc, rc, CASE WHEN qc = '' OR rc = '' THEN 0.0 ELSE 2.0 * {sx.lcs('qc', 'rc')} / (length(qc) + length(rc)) END AS code_sim FROM c),
f AS (SELECT q.query_id, q.target, ref.ref_id, qc, code_sim, token_sort, token_set, coalesce(tfidf, 0.0) AS tfidf
  FROM q CROSS JOIN ref JOIN t3 ON qt = q."desc" AND rt = ref."desc" JOIN c2 ON qc = {sx.strip('q.code')} AND rc = {sx.strip('ref.code')} LEFT JOIN cos USING (query_id, ref_id)),
sc AS (SELECT *, CASE WHEN qc = '' THEN (.25 * token_sort + .25 * token_set + .3 * tfidf) / .8 ELSE .2 * code_sim + .25 * token_sort + .25 * token_set + .3 * tfidf END AS score FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, ref_id) AS rank FROM sc)"""


def _ranked(spark, sf):
    return ranking.rank_candidates(name_queries(spark, sf), names(spark, sf))


@query("weighted_rank", f"WITH {SCORED} SELECT query_id, ref_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score, round(code_sim, 6) AS code_sim, round(token_sort, 6) AS token_sort, round(token_set, 6) AS token_set, round(tfidf, 6) AS tfidf FROM r")
def weighted_rank(spark, sf):
    return _ranked(spark, sf).select("query_id", "ref_id", F.col("rank").cast("long").alias("rank"), *[F.round(f, 6).alias(f) for f in ranking.FEATURES])


@query("hard_negatives", f"WITH {SCORED} SELECT query_id, ref_id, CAST(rank AS BIGINT) AS rank, n AS number FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM r WHERE ref_id <> target) WHERE n <= 5")
def hard_negatives(spark, sf):
    return ranking.hard_negatives(_ranked(spark, sf)).select("query_id", "ref_id", F.col("rank").cast("long").alias("rank"), F.col("negative_number").cast("long").alias("number"))


RECALLS = ", ".join(f"round(avg(CASE WHEN rank <= {k} THEN 1.0 ELSE 0.0 END), 6) AS recall_at_{k}" for k in (1, 3, 5))


@query("retrieval_summary", f"WITH {SCORED} SELECT count(*) AS n_queries, round(avg(1.0 / rank), 6) AS mrr, round(avg(rank), 6) AS mean_rank, {RECALLS} FROM r WHERE ref_id = target")
def retrieval_summary(spark, sf):
    cfg = RetrievalConfig()
    s = ranking.summary(ranking.per_query(_ranked(spark, sf), cfg.cuts), cfg.cuts)
    return s.select("n_queries", *[F.round(c, 6).alias(c) for c in s.columns if c != "n_queries"])


DELTAS = ", ".join(f"round(s * (tg.{f} - r.{f}), 6) + 0.0 AS d_{f}" for f in ranking.FEATURES)


@query(
    "pair_examples",
    f"""WITH {SCORED}, tg AS (SELECT * FROM r WHERE ref_id = target), n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM r WHERE ref_id <> target)
SELECT r.query_id, r.ref_id, CASE WHEN s = 1 THEN 1.0 ELSE 0.0 END AS label, {DELTAS} FROM n r JOIN tg USING (query_id) CROSS JOIN (SELECT unnest([1, -1]) AS s) WHERE r.n <= 5""",
)
def pair_examples(spark, sf):
    e = pairwise.pair_examples(_ranked(spark, sf))
    return e.select("query_id", "ref_id", "label", *[(F.round(f"d_{f}", 6) + 0.0).alias(f"d_{f}") for f in ranking.FEATURES])


@query("pairwise_rerank")
def pairwise_rerank(spark, sf):
    return pairwise.evaluate(name_queries(spark, sf), names(spark, sf))[0]


@query("group_split")
def group_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    train, test = pairwise.grouped_split(docs, "source")
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


# ---- noise -------------------------------------------------------------------------------------------------------


@query("synth_variants")
def synth_variants(spark, sf):
    ref = parts(spark, sf).select(F.col("p_partkey").alias("ref_id"), F.col("p_partkey").alias("ref_pos"), "code", "desc")
    return noise.generate(ref, NoiseConfig())


@query("synth_keeps_code", "SELECT 0 AS broken, 4 * count(*) AS n FROM part")
def synth_keeps_code(spark, sf):
    broken = F.count_if(tx.strip_code(F.col("code")) != tx.strip_code(F.col("ref_code")))
    return synth_variants(spark, sf).agg(broken.alias("broken"), F.count("*").alias("n"))


# ---- holdout -----------------------------------------------------------------------------------------------------

#: Orders by year: customers ordered before are known; the price stands for the margin.
JUDGED = """h AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < 1996),
j AS (SELECT o_orderkey AS query_id, o_totalprice / 1000 AS margin, h.o_custkey IS NOT NULL AS is_mapped, o_orderstatus = 'F' AND h.o_custkey IS NOT NULL AS reranked_correct
  FROM orders o LEFT JOIN h ON h.o_custkey = o.o_custkey WHERE year(o_orderdate) = 1996)"""


def judged(spark, sf):
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    known = o.where("y < 1996").select(F.col("o_custkey").alias("known")).distinct()
    new = o.where("y = 1996").join(known, F.col("o_custkey") == F.col("known"), "left")
    mapped = F.col("known").isNotNull()
    return new.select(F.col("o_orderkey").alias("query_id"), (F.col("o_totalprice") / 1000).alias("margin"), mapped.alias("is_mapped"), (~mapped).alias("is_novel"), ((F.col("o_orderstatus") == "F") & mapped).alias("reranked_correct"))


@query("temporal_holdout")
def temporal_holdout(spark, sf):
    """The whole holdout over all names and queries: ids deal five years, names of the last are novel."""
    history = names(spark, sf).withColumn("source_year", 2000 + F.pmod("ref_id", F.lit(5)))
    return holdout.evaluate(history, name_queries(spark, sf), HoldoutConfig(year=2004))[0]


@query("temporal_cut", f"""WITH {SALES}, k AS (SELECT *, row_number() OVER (PARTITION BY code, "desc" ORDER BY source_year DESC, load_seq DESC) AS n FROM s),
c AS (SELECT *, row_number() OVER (ORDER BY source_year, load_seq) AS pos FROM k WHERE n = 1) SELECT code, "desc" AS d, source_year, row_number() OVER (ORDER BY pos) - 1 AS ref_pos FROM c WHERE source_year < 2001""")
def temporal_cut(spark, sf):
    ref = dedupe.reference(sales(spark, sf), "code", "desc").withColumn("ref_id", F.col("ref_pos"))
    return holdout.cut(ref, HoldoutConfig(year=2001)).select("code", F.col("desc").alias("d"), "source_year", "ref_pos")


@query("mapped_novel", f"WITH {JUDGED} SELECT count(*) AS n_queries, count(*) FILTER (WHERE is_mapped) AS n_mapped, count(*) FILTER (WHERE NOT is_mapped) AS n_novel, round(avg(CASE WHEN is_mapped THEN 1.0 ELSE 0.0 END), 6) AS mapped_coverage FROM j")
def mapped_novel(spark, sf):
    return holdout.coverage(judged(spark, sf)).withColumn("mapped_coverage", F.round("mapped_coverage", 6))


@query(
    "acceptance",
    f"""WITH {JUDGED} SELECT 200.0 AS margin, count(*) FILTER (WHERE margin >= 200) AS auto_matches, count(*) FILTER (WHERE margin < 200) AS reviews,
round(avg(CASE WHEN margin < 200 THEN 1.0 ELSE 0.0 END), 6) AS review_rate, round(avg(CASE WHEN margin >= 200 THEN CASE WHEN is_mapped AND reranked_correct THEN 1.0 ELSE 0.0 END END), 6) AS auto_precision,
count(*) FILTER (WHERE NOT is_mapped AND margin >= 200) AS novel_accepted, round(avg(CASE WHEN NOT is_mapped THEN CASE WHEN margin < 200 THEN 1.0 ELSE 0.0 END END), 6) AS novel_review_rate FROM j""",
)
def acceptance(spark, sf):
    a = holdout.acceptance(judged(spark, sf), 200.0)
    return a.withColumns({c: F.round(c, 6) for c in ("review_rate", "auto_precision", "novel_review_rate")})


@query(
    "rank_comparison",
    """WITH p AS (SELECT l_quantity AS rank, l_linenumber AS new_rank FROM lineitem)
SELECT count(*) AS n_queries, round(avg(1.0 / rank), 6) AS baseline_mrr, round(avg(1.0 / new_rank), 6) AS reranked_mrr, round(avg(rank), 6) AS baseline_mean_rank, round(avg(new_rank), 6) AS reranked_mean_rank,
round(avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0.0 END), 6) AS baseline_recall_at_3, round(avg(CASE WHEN new_rank <= 3 THEN 1.0 ELSE 0.0 END), 6) AS reranked_recall_at_3,
count(*) FILTER (WHERE new_rank < rank) AS improved, count(*) FILTER (WHERE new_rank > rank) AS worsened, count(*) FILTER (WHERE new_rank = rank) AS unchanged FROM p""",
)
def rank_comparison(spark, sf):
    p = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("rank"), F.col("l_linenumber").alias("new_rank"))
    c = pairwise.compare(p, [3])
    means = [x for x in c.columns if x not in ("n_queries", "improved", "worsened", "unchanged") and "delta" not in x]
    return c.select("n_queries", *[F.round(x, 6).alias(x) for x in means], "improved", "worsened", "unchanged")


# ---- committee ---------------------------------------------------------------------------------------------------

#: Votes from line items: the line number is the model, quantity and discount make vote and probability.
VOTES = """v AS (SELECT l_orderkey AS query_id, 'chrg_type_a' AS attr, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS vote, CASE WHEN l_quantity > 25 THEN 1 - l_discount ELSE l_discount END AS probability FROM lineitem
  UNION ALL SELECT l_orderkey, 'chrg_type_b', CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, CASE WHEN l_returnflag = 'R' THEN 1 - l_tax ELSE l_tax END FROM lineitem)"""


def vote_table(spark, sf):
    li = table(spark, sf, "lineitem")
    one = lambda attr, hit, p: li.select(F.col("l_orderkey").alias("query_id"), F.lit(attr).alias("attr"), F.col("l_linenumber").cast("string").alias("model"), hit.cast("int").alias("vote"), F.when(hit, 1 - F.col(p)).otherwise(F.col(p)).alias("probability"))
    return one("chrg_type_a", F.col("l_quantity") > 25, "l_discount").unionAll(one("chrg_type_b", F.col("l_returnflag") == "R", "l_tax"))


@query(
    "committee_consensus",
    f"""WITH {VOTES}, m AS (SELECT query_id, attr, round_even(avg(vote), 0) AS major, avg(probability) AS p FROM v GROUP BY ALL),
a AS (SELECT m.*, avg(CASE WHEN vote = major THEN 1.0 ELSE 0.0 END) AS agree, round(any_value(CASE WHEN major = 1 THEN p ELSE 1 - p END), 9) AS sure FROM m JOIN v USING (query_id, attr) GROUP BY query_id, attr, major, p),
d AS (SELECT *, agree >= 0.8 AND sure >= 0.85 AS settled FROM a JOIN (SELECT o_orderkey AS query_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS own FROM orders) USING (query_id) WHERE major <> own)
SELECT o_orderkey AS query_id, count(d.query_id) AS disagreements, count(*) FILTER (WHERE settled) AS resolved, round_even(round(least(1.0, coalesce(min(sure), 1.0)) * 1e9) / 1e5, 0) / 1e4 AS confidence, coalesce(bool_or(NOT settled), false) AS unresolved
FROM orders LEFT JOIN d ON d.query_id = o_orderkey GROUP BY o_orderkey""",
)
def committee_consensus(spark, sf):
    own = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("query_id"), own.alias("chrg_type_a"), own.alias("chrg_type_b"))
    r = panel.resolve(rows, vote_table(spark, sf), ["chrg_type_a", "chrg_type_b"])
    return r.select("query_id", "disagreements", "resolved", "confidence", "unresolved")


@query("vote_majority", f"WITH {VOTES} SELECT query_id, attr, CAST(round_even(avg(vote), 0) AS BIGINT) AS major, round(avg(probability), 6) AS p FROM v GROUP BY ALL")
def vote_majority(spark, sf):
    v = vote_table(spark, sf)
    major = v.groupBy("query_id", "attr").agg(panel.majority(F.avg("vote")).cast("long").alias("major"))
    return major.join(panel.profile(v), ["query_id", "attr"]).withColumn("p", F.round("p", 6))


@query("class_gate", "SELECT 'label' AS attr, count(*) >= 2 AND min(n) >= 5 AS trainable FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)")
def class_gate(spark, sf):
    ok = panel.trainable(table(spark, sf, "embeddings"), "label", 5)
    return spark.createDataFrame([("label", ok)], "attr string, trainable boolean")


@query("panel_predict")
def panel_predict(spark, sf):
    e = table(spark, sf, "embeddings")
    rows = e.select(F.col("vec_id").alias("query_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"), (F.col("label") < 3).cast("int").alias("chrg_type_low"))
    return panel.profile(panel.votes(rows, panel.train(rows, ["chrg_type_low"], 5)))


@query(
    "attribute_rerank",
    f"""WITH n AS (SELECT * FROM (SELECT q.vec_id AS query_id, e.vec_id AS ref_id, e.label, {COSINE} AS c, row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE} DESC, e.vec_id DESC) AS place
  FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id % 50 = 0) WHERE place <= 5),
s AS (SELECT query_id, ref_id, .6 * c + .4 * (((CASE WHEN label < 5 THEN .9 ELSE .1 END) + (CASE WHEN label % 2 = 0 THEN .3 ELSE .7 END)) / 2) AS combined FROM n),
o AS (SELECT *, row_number() OVER w AS k, lead(combined) OVER w AS second FROM s WINDOW w AS (PARTITION BY query_id ORDER BY combined DESC, ref_id DESC))
SELECT query_id, ref_id, round(combined, 4) AS combined, round(combined - coalesce(second, 0), 4) AS margin FROM o WHERE k = 1""",
)
def attribute_rerank(spark, sf):
    q, ref = vectors(spark, sf)
    ref = ref.withColumns({"chrg_type_a": (F.col("label") < 5).cast("int"), "chrg_type_b": (F.col("label") % 2 == 0).cast("int")})
    near = panel.nearest(q.drop("own"), ref, 5)
    fixed = spark.createDataFrame([("chrg_type_a", 0.9), ("chrg_type_b", 0.3)], "attr string, p double")
    profiles = q.select("query_id").crossJoin(fixed)
    best = panel.rerank(near, panel.agreement(near, profiles, ["chrg_type_a", "chrg_type_b"]))
    return best.select("query_id", "ref_id", F.round("combined", 4).alias("combined"), F.round("margin", 4).alias("margin"))


# ---- outcomes ----------------------------------------------------------------------------------------------------

OUTCOMES = "o AS (SELECT o_orderkey, o_orderstatus = 'P' AS needs_human_review, CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS disagreement_count FROM orders)"


def outcomes(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "P").alias("needs_human_review"), F.when(F.col("o_orderpriority").startswith("1"), 1).otherwise(0).alias("disagreement_count"))


@query("outcome_split", f"WITH {OUTCOMES} SELECT o_orderkey, CASE WHEN needs_human_review THEN 'needs_review' WHEN disagreement_count > 0 THEN 'ensemble_resolved' ELSE 'confident' END AS outcome FROM o")
def outcome_split(spark, sf):
    tables = sinks.secondary_tables(outcomes(spark, sf))
    named = [df.select("o_orderkey", F.lit(name).alias("outcome")) for name, df in tables.items()]
    return named[0].unionAll(named[1]).unionAll(named[2])


@query("run_summary", f"WITH {OUTCOMES} SELECT count(*) AS total, count(*) FILTER (WHERE NOT needs_human_review AND disagreement_count = 0) AS confident, count(*) FILTER (WHERE NOT needs_human_review AND disagreement_count > 0) AS ensemble_resolved, count(*) FILTER (WHERE needs_human_review) AS needs_review, round(100.0 * count(*) FILTER (WHERE NOT needs_human_review) / count(*), 1) AS automation_rate FROM o")
def run_summary(spark, sf):
    return sinks.secondary_summary(outcomes(spark, sf))


@query("schema_audit")
def schema_audit(spark, sf):
    a = contracts.audit(["chrg_code", "chrg_ibr_code", "chrg_type_dui", "chrg_type_local"])
    rows = [("present", c) for c in a.present] + [("missing", c) for c in a.missing] + [("extra", c) for c in a.extra]
    return spark.createDataFrame(rows, "kind string, column string")


@query("preflight")
def preflight(spark, sf):
    return check_primary(f"{sf}/none", f"{sf}/none", PrimaryConfig("Cook"), spark).frame(spark)


@query("automation_windows", "SELECT date_trunc('hour', ts) AS window_start, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS automated, round(count(*) FILTER (WHERE event_type <> 'error') * 1.0 / count(*), 6) AS rate FROM events GROUP BY 1")
def automation_windows(spark, sf):
    e = table(spark, sf, "events").select("ts", (F.col("event_type") == "error").alias("needs_review"))
    return intake.automation(e).withColumn("rate", F.round("rate", 6))
