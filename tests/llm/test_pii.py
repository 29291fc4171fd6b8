import hashlib
import re

from pyspark.sql import functions as F

from kelpline.llm import pii

SCHEMA = "doc_id long, text string, base string, terms string, n_chars long, __x int"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 12 <= len(d) <= 19 and luhn(d),
        "phone": lambda: 9 <= len(d) <= 15,
    }[kind]()


def brute(text):
    found = []
    for rank, (kind, p) in enumerate(PATTERNS):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(p, text or "") if ok(kind, m[0])]
    return [(k, s, e) for s, _, e, k in sorted(found)]


TEXTS = [
    None, "", "no data", "write to a.b+c@ex-1.example.co.uk, or x@y", "a@b.c_d@e.f a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 007.08.09.255 1.2.3",
    "card 4539 1488 0343 6467 and 4539-1488-0343-6468, 4539148803436467.", "+1 (988) 555-2485 +12 +1234567890123456 +49 30 123456 78) +1",
    "ünïcödé 😀 me@mail.example.com 😀 10.0.0.1", "4539148803436467@shop.example.com 10.0.0.1@x.yz", "+4539148803436467 1 2 3 4",
    "x" * 40000 + "@" + "y." * 20000 + "com", "9" * 50000, "a@b.c " * 3000, "..@..a@-.-", "\U0001d7d8 ٣.٣.٣.٣ 1.1.1.1",
]


def test_base_spans_match_brute_force(spark, sf):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = df.select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("b")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(s.kind, s.start, s.stop) for s in r.b] == brute(texts[r.doc_id]), texts[r.doc_id]


def test_query_digest(spark, sf):
    want = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.query(spark, sf).collect():
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want[r.doc_id]) for kind, _ in PATTERNS]


def test_words_that_give_an_entity_away(spark):
    common = ["river", "stone", "cloud", "bread", "window", "garden", "paper", "light"]
    rows = [(i, " ".join(common[(i + k) % 8] for k in range(40)), "c", "c", 1, 1) for i in range(300)]
    for i in range(6):
        words = [common[(i * 3 + k) % 8] for k in range(6)]
        rows.append((1000 + i, f"{words[0]} {words[1]} Zebulon wrote from zed@mail.example.com to {words[2]} {words[4]}", None, None, None, None))
    rows.append((2000, "Zebulon and the river stone", None, None, None, None))
    rows += [(3000 + i, "call now or call later", None, None, None, None) for i in range(120)]
    rows.append((2001, "river Quillon stone quill@one.example.com cloud", None, None, None, None))
    rows.append((None, "call +1 (988) 555-2485 now", None, None, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert len(out) == len(rows) and pii.sanitise(df).columns == df.columns
    for i in range(6):
        assert "zed@" not in out[1000 + i] and "[EMAIL]" in out[1000 + i] and "Zebulon" not in out[1000 + i]
    assert out[2000] == "Zebulon and the river stone"  # no entity there
    assert out[2001] == "river  stone [EMAIL] cloud"  # mentioned once: a name that stands nowhere else goes
    assert out[None] == "call [PHONE] now"
    assert all(out[i] == rows[i][1] for i in range(300))


def test_copies_of_one_page_are_one_context(spark):
    rows = [(i, "alpha beta gamma reach me at a@b.example.com delta", None, None, None, None) for i in range(20)]
    out = pii.sanitise(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.text for r in out} == {"alpha beta gamma reach me at [EMAIL] delta"} and len(out) == 20


def test_many_mentions_in_one_text(spark):
    """A text of 10,000 mentions; each is found at its place."""
    text = " ".join(f"word{k % 50} u{k}@mail{k % 97}.example.com" for k in range(10_000))
    rows = spark.createDataFrame([(1, text, None, None, None, None)], SCHEMA)
    got = pii.detect(rows).first()
    assert [(b["start"], b["stop"]) for b in got["__base"]] == [(s, e) for _, s, e in brute(text)]
    assert all(text[t["start"] : t["stop"]].lower() == t["value"] for t in got["__terms"])


def test_empty_table(spark):
    assert pii.sanitise(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_matches_sql(spark, sf):
    from kelpline.llm import registry
    from tests.oracle import same

    assert same(pii.query(spark, sf), registry.ORACLES["op3_pii"], sf) >= 200


def test_terms_match_sql(spark, tmp_path):
    import random

    import duckdb

    rng = random.Random(5)
    vocabulary = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(200)]
    for i in range(60):
        who = i % 5
        words = [rng.choice(vocabulary) for _ in range(30)]
        words[12:12] = [f"Owner{'abcde'[who]}x", f"p{who}@mail.example.com", f"Team{'abcde'[who]}q" if i % 2 else "team"]
        rows.append((500 + i, " ".join(words) + (" 10.0.0.1" if who == 0 else "")))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in pii.query(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(pii.ORACLE).fetchall())
    assert sum(r[-1] for r in got) >= 60
