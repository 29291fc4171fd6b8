"""Information-theoretic sanitisation of personal data.

Native: DataFrame operations only. Base matches (email, ip, card, phone) are
found by pattern. Each distinct matched value is a protected entity. Words that
stand within CONTEXT characters of its mentions are counted over distinct
contexts (so copies of a page count once) and compared with their frequency in
the whole corpus: the pointwise mutual information of entity and word, as a
share of the information content of the entity (Sanchez and Batet, "C-sanitized",
2016), says how far the word gives the entity away. From GENERALISE on, the
word's mentions near the entity become a class label; from REMOVE on they go.
Most values are mentioned once: SUPPORT, the distinct contexts that an estimate
needs, is 1, so a rare name beside one address counts as what it is, a sign of it.

Everything before the last join works on mentions, so a value that a third of
all texts share adds rows in proportion to its mentions, combined before they
shuffle. A mention is compared with the NEIGHBOURS matches on either side of it in
its text, which is more than CONTEXT characters can hold; only inside an address that
holds more matches than that could a word be taken for a free one.

Nulls: a null text is empty; a null id is carried along. Repeated rows are kept
and each gets its spans. Empty texts need no special case; of very long ones
each mention is found by its place, which takes time in proportion to both. Other
columns are passed through by ``sanitise`` and ignored by ``detect``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .textstats import barrier, let

#: Patterns of the base kinds, in their order. Look-behinds start a match at the
#: left end of a run or where the last match ended, which is where a plain leftmost
#: search finds it; possessive repeats keep long runs linear.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot match; saves the search.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

CONTEXT = 120
SUPPORT = 1
NEIGHBOURS = 80
GENERALISE, REMOVE = 0.6, 0.9
TERM = r"\p{L}{3,}"


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15)


def _places(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, value>> of all matches; code points, stop exclusive."""

    def located(s: Column) -> Column:
        steps = F.zip_with(s["between"], s["found"], lambda b, m: F.struct(F.length(b).alias("skip"), m.alias("value")))
        ends = F.aggregate(
            steps,
            F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
            lambda a, x: F.struct(
                (a["at"] + F.coalesce(x["skip"], F.lit(0)) + F.coalesce(F.length(x["value"]), F.lit(0))).alias("at"),
                F.when(x["value"].isNull(), a["out"]).otherwise(F.concat(a["out"], (a["at"] + x["skip"]).cast("string"), F.lit(","))).alias("out"),
            ),
        )["out"]
        starts = F.transform(F.split(ends, ","), lambda x: x.try_cast("int"))
        return F.zip_with(
            F.slice(starts, 1, F.size(s["found"])),
            s["found"],
            lambda a, m: F.struct(a.alias("start"), (a + F.length(m)).alias("stop"), m.alias("value")),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(
        F.struct(found.alias("found"), F.split(text, pattern, -1).alias("between")),
        lambda s: F.when(F.size(s["found"]) > 0, located(s)).otherwise(F.array().cast("array<struct<start:int,stop:int,value:string>>")),
    )


_SPANS = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


def _kind_spans(text: Column, rank: int, kind: str) -> Column:
    valid = F.filter(_places(text, KINDS[kind]), lambda x: _valid(kind, x["value"]))
    spans = F.transform(
        valid,
        lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop"), F.lit(kind).alias("kind"), x["value"].alias("value")),
    )
    may = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
    if kind != "email":
        may = may & text.rlike("[0-9]")
    return F.when(may, spans).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, stop, kind, value>> by start, then kind in the order of KINDS."""
    return F.sort_array(F.concat(*[_kind_spans(text, rank, kind) for rank, kind in enumerate(KINDS)]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds row keys: equal rows share them, and equal rows have equal spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"__id": F.col(id_col), "__hash": F.xxhash64(text), "__text": text})


def _mentions(based: DataFrame) -> DataFrame:
    """One row per word near a mention: (__id, __hash, kind, value, context, term, start, stop)."""
    m = based.select("__id", "__hash", "__text", "base", F.posexplode("base").alias("at", "m"))
    around = F.slice("base", F.greatest(F.col("at") + 1 - NEIGHBOURS, F.lit(1)), 2 * NEIGHBOURS + 1)
    before = F.greatest(F.col("m.start") - CONTEXT, F.lit(0))
    left = F.substring("__text", before + 1, F.col("m.start") - before)
    right = F.substring("__text", F.col("m.stop") + 1, F.lit(CONTEXT))
    m = barrier(m.select("__id", "__hash", around.alias("base"), "m", before.alias("from"), left.alias("left"), right.alias("right")))
    cut_left = F.col("from") > 0
    cut_right = F.length("right") == CONTEXT

    def terms(part: Column, offset: Column) -> Column:
        return F.transform(
            _places(part, TERM),
            lambda x: F.struct(F.lower(x["value"]).alias("term"), (x["start"] + offset).alias("start"), (x["stop"] + offset).alias("stop")),
        )

    # a word that the window's edge cuts is none
    lefts = F.filter(terms(F.col("left"), F.col("from")), lambda t: ~cut_left | (t["start"] > F.col("from")))
    rights = F.filter(terms(F.col("right"), F.col("m.stop")), lambda t: ~cut_right | (t["stop"] < F.col("m.stop") + CONTEXT))
    free = F.filter(F.concat(lefts, rights), lambda t: ~F.exists("base", lambda b: (t["start"] < b["stop"]) & (b["start"] < t["stop"])))
    m = barrier(m.select("__id", "__hash", F.col("m.kind").alias("kind"), F.lower("m.value").alias("value"), free.alias("near")))
    context = F.xxhash64(F.array_join(F.transform("near", lambda t: t["term"]), " "))
    return m.select("__id", "__hash", "kind", "value", context.alias("context"), F.explode("near").alias("t")).select(
        "__id", "__hash", "kind", "value", "context", "t.term", "t.start", "t.stop"
    )


def disclosure(mentions: DataFrame, corpus_terms: DataFrame, total: int) -> DataFrame:
    """(kind, value, term, share): how much of the entity's information content the term reveals."""
    entity = ["kind", "value"]
    seen = mentions.select(*entity, "context", "term").distinct()
    pairs = seen.groupBy(*entity, "term").agg(F.count("*").alias("n_pair")).where(F.col("n_pair") >= SUPPORT)
    entities = mentions.select(*entity, "context").distinct().groupBy(*entity).agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    near = pairs.join(entities, entity).join(corpus_terms, "term")
    window = 2.0 * CONTEXT / 6  # words of a context, at six characters a word
    windows = F.lit(max(total / window, 1.0))
    p_term = F.least(F.col("n_corpus") / windows, F.lit(1.0))
    information = F.log2(windows / F.least(F.col("n_entity"), windows))
    pmi = F.log2(F.col("n_pair") / F.col("n_entity") / p_term)
    return near.select(*entity, "term", F.when(information > 0, F.least(pmi / information, F.lit(1.0))).otherwise(F.lit(0.0)).alias("share"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, __hash, __base, __terms): one row per distinct text and id that has a base match.

    ``__terms`` is array<struct<start, rank, stop, kind, value>> like ``__base``, with
    kinds ``term`` (generalised) and ``gone`` (removed).
    """
    keyed = _keyed(docs, id_col, text_col).select("__id", "__hash", "__text")
    based = barrier(keyed.where(F.col("__text").rlike("[0-9@]")).withColumn("base", base_spans(F.col("__text")))).where(F.size("base") > 0)
    based = written(based, "based")
    mentions = written(_mentions(based), "mentions")
    wanted = mentions.select("term").distinct()
    spoken = F.regexp_extract_all(F.lower("__text"), F.lit(TERM), F.lit(0))
    counts = keyed.select(F.explode(spoken).alias("term")).groupBy("term").agg(F.count("*").alias("n_corpus"))
    counts = written(counts, "terms")
    total = counts.agg(F.coalesce(F.sum("n_corpus"), F.lit(0))).first()[0]
    shares = disclosure(mentions, counts.join(wanted, "term"), total).where(F.col("share") >= GENERALISE)
    gone = F.col("share") >= REMOVE
    hits = mentions.join(shares, ["kind", "value", "term"]).select(
        "__id", "__hash",
        F.struct(
            F.col("start"), F.when(gone, F.lit(5)).otherwise(F.lit(4)).alias("rank"), F.col("stop"),
            F.when(gone, F.lit("gone")).otherwise(F.lit("term")).alias("kind"), F.col("term").alias("value"),
        ).alias("span"),
    )
    # near two entities a word takes the stronger measure
    best = hits.groupBy("__id", "__hash", F.col("span.start").alias("start")).agg(F.max("span").alias("span"))
    terms = best.groupBy("__id", "__hash").agg(F.sort_array(F.collect_list("span")).alias("terms"))
    once = based.select("__id", "__hash", "base").dropDuplicates(["__id", "__hash"])
    same = once["__id"].eqNullSafe(terms["__id"]) & (once["__hash"] == terms["__hash"])
    empty = F.array().cast(_SPANS)
    return once.join(terms, same, "left").select(
        once["__id"], once["__hash"], F.col("base").alias("__base"), F.coalesce("terms", empty).alias("__terms")
    )


def _with_spans(keyed: DataFrame, found: DataFrame) -> DataFrame:
    found = found.withColumnsRenamed({"__id": "__fid", "__hash": "__fhash"})
    joined = keyed.join(found, F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__hash") == F.col("__fhash")), "left")
    empty = F.array().cast(_SPANS)
    return joined.withColumns({"__base": F.coalesce("__base", empty), "__terms": F.coalesce("__terms", empty)}).drop("__fid", "__fhash")


def rewritten(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its label; a removed word leaves nothing. Spans by start."""
    label = lambda s: F.when(s["kind"] == "gone", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["stop"].alias("at"),
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), label(s)).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["out"].alias("out"))),
    )
    return let(done, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` with sanitised texts. A null text stays null."""
    joined = _with_spans(_keyed(docs, id_col, text_col), detect(docs, id_col, text_col))
    spans = F.sort_array(F.concat("__base", "__terms"))
    text = F.when(F.size(F.concat("__base", "__terms")) == 0, F.col(text_col)).otherwise(rewritten(F.col("__text"), spans))
    return joined.withColumn(text_col, text).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keyed = _keyed(docs, "doc_id", "text").select("doc_id", "__id", "__hash")
    joined = _with_spans(keyed, detect(docs))
    count = lambda kind: F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return joined.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(digest(F.col("__base")), 256).alias("base_sha256"),
        digest(F.sort_array(F.concat("__base", "__terms"))).alias("spans"),
        F.size("__terms").cast("long").alias("n_terms"),
    )


def _sql_places(pattern: str, text: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}') AS m, regexp_split_to_array({text}, '{pattern}') AS s"


_SQL_START = "CAST(coalesce(list_sum(list_transform(s[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
_SQL_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_SQL_LUHN = (
    f"list_sum(list_transform(range(length({_SQL_DIGITS})), lambda k: CASE WHEN k % 2 = 0 THEN CAST(substr({_SQL_DIGITS}, CAST(length({_SQL_DIGITS}) - k AS INT), 1) AS INT) "
    f"ELSE (2 * CAST(substr({_SQL_DIGITS}, CAST(length({_SQL_DIGITS}) - k AS INT), 1) AS INT)) // 10 + (2 * CAST(substr({_SQL_DIGITS}, CAST(length({_SQL_DIGITS}) - k AS INT), 1) AS INT)) % 10 END)) % 10 = 0"
)
#: The patterns as plain leftmost searches.
_SQL_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", rf"regexp_full_match(value, '{_OCTET}(?:\.{_OCTET}){{3}}')"),
    "card": (r"[0-9](?:[ -]?[0-9])+", f"length({_SQL_DIGITS}) BETWEEN 12 AND 19 AND {_SQL_LUHN}"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", f"length({_SQL_DIGITS}) BETWEEN 9 AND 15"),
}
_SQL_FOUND = " UNION ALL ".join(f"SELECT doc_id, t, {rank} AS rank, '{kind}' AS kind, {_sql_places(p, 't')} FROM d" for rank, (kind, (p, _)) in enumerate(_SQL_KINDS.items()))
_SQL_VALID = " OR ".join(f"(kind = '{kind}' AND {ok})" for kind, (_, ok) in _SQL_KINDS.items())
_SQL_SIDE = " UNION ALL ".join(
    f"SELECT doc_id, kind, value, start, stop, side0, {side} AS side, {at} AS off, {_sql_places(TERM, part)} FROM w"
    for side, at, part in ((0, "from0", "lhs"), (1, "stop", "rhs"))
)
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_SQL_FOUND}),
p AS (SELECT doc_id, t, rank, kind, m[i] AS value, {_SQL_START} AS start FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f)),
b AS (SELECT *, start + length(value) AS stop FROM p WHERE {_SQL_VALID}),
w AS (SELECT doc_id, kind, lower(value) AS value, start, stop, greatest(start - {CONTEXT}, 0) AS from0, greatest(start - {CONTEXT}, 0) > 0 AS side0,
  substr(t, CAST(greatest(start - {CONTEXT}, 0) + 1 AS INT), CAST(start - greatest(start - {CONTEXT}, 0) AS INT)) AS lhs, substr(t, CAST(stop + 1 AS INT), {CONTEXT}) AS rhs FROM b),
x AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({_SQL_SIDE})),
y AS (SELECT doc_id, kind, value, start, stop, side0, side, off, lower(m[i]) AS term, off + {_SQL_START} AS a, off + {_SQL_START} + length(m[i]) AS z, list_sum(list_transform(list_concat(m, s), lambda q: length(q))) AS size FROM x),
n AS (SELECT * FROM y WHERE CASE WHEN side = 0 THEN NOT side0 OR a > off ELSE size < {CONTEXT} OR z < stop + {CONTEXT} END
  AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = y.doc_id AND y.a < b.stop AND b.start < y.z)),
c AS (SELECT doc_id, kind, value, start, string_agg(term, ' ' ORDER BY side, a) AS context FROM n GROUP BY ALL),
e AS (SELECT kind, value, count(DISTINCT context) AS n_entity FROM c GROUP BY ALL HAVING count(DISTINCT context) >= {SUPPORT}),
r AS (SELECT kind, value, term, count(DISTINCT context) AS n_pair FROM n JOIN c USING (doc_id, kind, value, start) GROUP BY ALL HAVING count(DISTINCT context) >= {SUPPORT}),
k AS (SELECT term, count(*) AS n_corpus FROM (SELECT unnest(regexp_extract_all(lower(t), '{TERM}')) AS term FROM d) GROUP BY term),
v AS (SELECT greatest(sum(n_corpus) / {2.0 * CONTEXT / 6}, 1.0) AS windows FROM k),
g AS (SELECT kind, value, term, CASE WHEN log2(windows / least(n_entity, windows)) > 0
  THEN least(log2(n_pair / n_entity / least(n_corpus / windows, 1.0)) / log2(windows / least(n_entity, windows)), 1.0) ELSE 0.0 END AS share FROM r JOIN e USING (kind, value) JOIN k USING (term), v),
h AS (SELECT doc_id, a AS start, max(CASE WHEN share >= {REMOVE} THEN 5 ELSE 4 END) AS rank, any_value(z) AS stop FROM n JOIN g USING (kind, value, term) WHERE share >= {GENERALISE} GROUP BY doc_id, a),
l AS (SELECT doc_id, start, rank, kind || ':' || start || ':' || stop AS span FROM b
  UNION ALL SELECT doc_id, start, rank, CASE WHEN rank = 5 THEN 'gone' ELSE 'term' END || ':' || start || ':' || stop FROM h)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (WHERE rank = {rank}) AS n_{kind}" for rank, kind in enumerate(KINDS))},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 4), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans, count(*) FILTER (WHERE rank > 3) AS n_terms
FROM d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id
"""
