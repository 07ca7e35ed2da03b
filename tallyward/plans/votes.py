"""Members' votes, the bills behind them, and statements paired with votes by topic."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import bill_key, ratio, vote_position
from ..operators.aggregates import any_member, coverage_totals, first_by, ordered_list, top_n, vote_report
from ..operators.joins import array_member_join, by_name, overlapping, resolve_alias, span_outcomes, topic_bills
from .tables import BILLS_SQL, VOTES_SQL, bills, read, votes

SUBSTANTIVE = ("purchase", "signup", "click")
_SUB = "('purchase', 'signup', 'click')"


def member_record(spark, sf_dir):
    names = ["click", "view", "purchase", "signup", "error"]
    counts = [F.count_if(F.col("position") == n).alias(f"n_{n}") for n in names]
    days = [F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day")]
    return votes(spark, sf_dir).groupBy("member").agg(*counts, F.count("*").alias("votes"), *days)


def participation(spark, sf_dir):
    v = votes(spark, sf_dir)
    taken = v.groupBy("member").agg(F.count("*").alias("votes"), F.count_if(F.col("position") == "purchase").alias("hits"))
    return taken.select("member", "votes", F.round(100 * ratio(F.col("hits"), F.col("votes"), 6), 2).alias("pct"))


def member_topics(spark, sf_dir):
    counts = votes(spark, sf_dir).join(bills(spark, sf_dir), "bill").groupBy("member", "area").agg(F.count("*").alias("votes"))
    return top_n(counts, ["member"], [F.desc("votes"), F.asc("area")], 5)


def recent_votes(spark, sf_dir):
    v = votes(spark, sf_dir).where(F.col("position").isin(*SUBSTANTIVE)).select("member", "bill", "position", "day").distinct()
    return top_n(v, ["member"], [F.desc("day"), F.asc("bill"), F.asc("position")], 3).withColumn("day", F.col("day").cast("string"))


def _filters(spark):
    rows = [("widget", ["Brand#1"], ["widget"], None), ("gadgetry", [], [], "widget"), ("brands", ["Brand#22"], [], None), ("nothing", [], [], None), ("lost", [], [], "unknown")]
    return spark.createDataFrame(rows, "topic string, areas array<string>, subjects array<string>, canonical_topic string")


_FILTERS_SQL = """filters AS (SELECT * FROM (VALUES ('widget', ['Brand#1'], ['widget'], NULL), ('gadgetry', CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), 'widget'),
  ('brands', ['Brand#22'], CAST([] AS VARCHAR[]), NULL), ('nothing', CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), NULL), ('lost', CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), 'unknown'))
  t(topic, areas, subjects, canonical_topic)),
resolved AS (SELECT f.topic, coalesce(b.areas, f.areas) AS areas, coalesce(b.subjects, f.subjects) AS subjects FROM filters f LEFT JOIN filters b ON f.canonical_topic = b.topic)"""


def topic_alias_match(spark, sf_dir):
    hits = topic_bills(resolve_alias(_filters(spark)), bills(spark, sf_dir))
    return hits.groupBy("topic").agg(F.count("*").alias("bills"), F.min("bill").alias("first_bill"))


def _flags(df):
    rank = F.when(F.col("question").startswith("PROMO"), 0).when(F.col("question").startswith("STANDARD"), 1).otherwise(2)
    return df.withColumn("procedural", ~F.col("position").isin(*SUBSTANTIVE)).withColumn("omnibus", F.size(F.coalesce("subjects", F.array())) > 50).withColumn("question_rank", rank)


def promise_votes(spark, sf_dir):
    """Statements (documents, topic by id) with up to 25 votes of their member on bills of the topic, one a bill.

    Which votes are first does not hang on the statement, so votes are cut for each member and topic before statements join.
    """
    topics = F.array(*[F.lit(t) for t in ("widget", "gadgetry", "brands", "nothing")])
    promises = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("promise"), (F.col("doc_id") % 150).alias("member"), F.get(topics, (F.col("doc_id") % 4).cast("int")).alias("topic"))
    on_topic = topic_bills(resolve_alias(_filters(spark)), bills(spark, sf_dir))
    facts = _flags(votes(spark, sf_dir).join(bills(spark, sf_dir), "bill")).select("vote_id", "member", "bill", "position", "day", "procedural", "omnibus", "question_rank")
    one = first_by(facts, ["member", "bill"], [F.asc("question_rank"), F.desc("day"), F.desc("vote_id")])
    cut = top_n(one.join(on_topic, "bill"), ["member", "topic"], [F.asc("omnibus"), F.asc("procedural"), F.desc("day"), F.desc("vote_id")], 25)
    return promises.join(cut, ["member", "topic"]).select("promise", "rank", "vote_id", "bill", "position", "procedural")


def array_membership_join(spark, sf_dir):
    subjects = votes(spark, sf_dir).groupBy("bill").agg(F.count("*").alias("votes"))
    words = spark.createDataFrame([("widget",), ("bolt",), ("none",), (None,)], "word string")
    return array_member_join(words, bills(spark, sf_dir).join(subjects, "bill"), "word", "subjects").groupBy("word").agg(F.count("*").alias("bills"), F.sum("votes").alias("votes"))


def semi_members(spark, sf_dir):
    """Members with votes on widget bills, by EXISTS."""
    v, b = votes(spark, sf_dir), bills(spark, sf_dir).where(F.array_contains("subjects", "widget"))
    return v.select("member").distinct().join(v.join(b, "bill", "left_semi").select("member"), "member", "left_semi")


def state_report(spark, sf_dir):
    """Votes of customers as members, by nation and segment: counts by word and the latest day."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"), F.col("c_nationkey").alias("state"), F.col("c_mktsegment").alias("chamber"))
    kinds = ("click", "error", "purchase", "view")
    return vote_report(votes(spark, sf_dir).join(c, "member"), ["state", "chamber"], words=kinds).withColumn("latest_vote", F.col("latest_vote").cast("string"))


def national_coverage(spark, sf_dir):
    """Customers as candidates: a House seat for each nation and balance's thousand, researched where they have an urgent order."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_nationkey").alias("state"), F.when(F.col("c_mktsegment") == "BUILDING", "senate").otherwise("house").alias("office"), F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 1000)).alias("district"))
    return coverage_totals(c, read(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("person")))


def shown_candidates(spark, sf_dir):
    """Suppliers that received something dear or whose nation has promises, either of which is enough."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    dear = read(spark, sf_dir, "lineitem").where("l_extendedprice > 104800").select(F.col("l_suppkey").alias("s_suppkey"))
    nations = read(spark, sf_dir, "customer").where("c_acctbal > 9990").select(F.col("c_nationkey").alias("s_nationkey"))
    return any_member(s, s_suppkey=dear, s_nationkey=nations)


def anti_missing(spark, sf_dir):
    """Customers without an urgent order, as a queue of missing metadata."""
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


def null_aware_not_in(spark, sf_dir):
    """NOT IN over a list with a null keeps nothing; over one without keeps the rest."""
    n = read(spark, sf_dir, "nation")
    n.createOrReplaceTempView("__nations")
    return spark.sql("""SELECT 'null' AS list, count(*) AS kept FROM __nations WHERE n_nationkey NOT IN (SELECT * FROM VALUES (1), (NULL))
      UNION ALL SELECT 'plain', count(*) FROM __nations WHERE n_nationkey NOT IN (SELECT * FROM VALUES (1), (2))""")


def high_water_mark(spark, sf_dir):
    """Votes above each position's stored mark (0 where nothing is stored)."""
    v = votes(spark, sf_dir)
    marks = v.where(F.col("position") != "error").groupBy("position").agg(F.max(F.when(F.col("vote_id") % 3 == 0, F.col("vote_id"))).alias("mark"))
    return v.join(marks, "position", "left").where(F.col("vote_id") > F.coalesce("mark", F.lit(0))).groupBy("position").agg(F.count("*").alias("fresh"), F.min("vote_id").alias("from_id"))


def review_queue_json(spark, sf_dir):
    t = read(spark, sf_dir, "conversations")
    listed = ordered_list(t.where("role = 'user'").withColumn("chars", F.length("text")), ["conv_id"], "turn", ["chars"], "turns")
    return t.select("conv_id").distinct().join(listed, "conv_id", "left").select("conv_id", F.to_json(F.coalesce("turns", F.array().cast("array<struct<turn:bigint,chars:int>>"))).alias("turns"))


def prompt_render(spark, sf_dir):
    """Turns of a talk as prompt blocks: a head line, the text cut at a word within 400 characters, blank lines between."""
    t = read(spark, sf_dir, "conversations")
    cut = F.when(F.length("text") <= 400, F.col("text")).otherwise(F.concat(F.regexp_replace(F.substring("text", 1, 400), " [^ ]*$", ""), F.lit("...")))
    block = F.concat(F.lit("["), F.col("turn"), F.lit("] "), F.col("role"), F.lit(": "), cut)
    listed = ordered_list(t.withColumn("block", block), ["conv_id"], "turn", ["block"], "b")
    return listed.select("conv_id", F.array_join("b.block", "\n\n").alias("prompt"))


def distinct_reasons(spark, sf_dir):
    return votes(spark, sf_dir).groupBy("position").agg(F.count("*").alias("rows"), F.count_distinct("member").alias("members"))


def review_precision(spark, sf_dir):
    lab = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return lab.groupBy("source").agg(F.count("*").alias("reviewed"), F.sum("quality").alias("good")).select("source", "reviewed", "good", ratio(F.col("good"), F.col("reviewed")).alias("precision"))


def name_lookup(spark, sf_dir):
    people = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("person"), F.when(F.col("s_suppkey") % 10 == 0, F.lower("s_name")).when(F.col("s_suppkey") % 10 == 1, F.lit("Twin")).otherwise(F.col("s_name")).alias("name"))
    return by_name(read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name")).unionByName(spark.createDataFrame([("Twin",), ("Nobody",)], "name string")), people)


_KEYS = ["HR {}", "H.R. {}", "S.J.Res. {}", "PN11-{}", None, "{}"]
_WORDS = ["Yea", " Aye ", "NO", "Not  Voting", "Present", "Smith", None]


def key_normalise(spark, sf_dir):
    """Votes with bill numbers and positions as they are filed: six ways of writing a number, seven words."""
    v = votes(spark, sf_dir)
    keys = F.array(*[F.lit(k) for k in _KEYS])
    number = F.replace(F.get(keys, (F.col("vote_id") % len(_KEYS)).cast("int")), F.lit("{}"), F.col("bill").cast("string"))
    word = F.get(F.array(*[F.lit(w) for w in _WORDS]), (F.col("vote_id") % len(_WORDS)).cast("int"))
    return v.select("vote_id", bill_key(number).alias("bill_key"), vote_position(word).alias("position"))


def span_overlap(spark, sf_dir):
    """Spans of 200 characters every 150 against spans of 120 every 100 from 30 on, in each document."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n")).where("n > 100")
    spans = lambda size, step, lag: d.select("doc_id", F.explode(F.sequence(F.lit(lag), F.col("n") - 1, F.lit(step))).alias("start")).select("doc_id", F.col("start").alias("id"), "start", (F.col("start") + size).alias("end"))
    hits = overlapping(spans(200, 150, 0), spans(120, 100, 30), "doc_id", 0.5)
    return hits.groupBy("doc_id").agg(F.count("*").alias("pairs"), F.sum("chars").cast("long").alias("chars"))


def leak_counts(spark, sf_dir):
    """Labelled spans of 80 characters every 240, each other one wanted, against found spans of 60 every 130, in whole documents."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("n")).where("n > 0")
    spans = lambda size, step: d.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(step))).alias("id"), "n").select("doc_id", "id", F.col("id").alias("start"), F.least(F.col("id") + size, "n").alias("end"))
    out = span_outcomes(spans(60, 130), spans(80, 240).withColumn("wanted", F.col("id") % 480 == 0), "doc_id", 0.5)
    return out.join(d.select("doc_id", "source"), "doc_id").groupBy("source", "outcome").agg(F.count("*").alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (member_record, participation, member_topics, recent_votes, topic_alias_match, promise_votes, array_membership_join, semi_members, state_report, national_coverage, shown_candidates, anti_missing,
              null_aware_not_in, high_water_mark, review_queue_json, prompt_render, distinct_reasons, review_precision, name_lookup, key_normalise, span_overlap, leak_counts)
}


def _values(column):
    return ", ".join("NULL" if x is None else f"'{x}'" for x in column)


ORACLES = {
    "member_record": f"WITH {VOTES_SQL} SELECT member, {', '.join(f'count(*) FILTER (position = {chr(39)}{n}{chr(39)}) AS n_{n}' for n in ('click', 'view', 'purchase', 'signup', 'error'))}, count(*) AS votes, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day FROM votes GROUP BY member",
    "participation": f"WITH {VOTES_SQL} SELECT member, count(*) AS votes, round(100 * round(count(*) FILTER (position = 'purchase') / count(*), 6), 2) AS pct FROM votes GROUP BY member",
    "member_topics": f"WITH {VOTES_SQL}, {BILLS_SQL} SELECT * FROM (SELECT member, area, count(*) AS votes, row_number() OVER (PARTITION BY member ORDER BY count(*) DESC, area) AS rank FROM votes JOIN bills USING (bill) GROUP BY 1, 2) WHERE rank <= 5",
    "recent_votes": f"WITH {VOTES_SQL}, d AS (SELECT DISTINCT member, bill, position, day FROM votes WHERE position IN {_SUB}) SELECT member, bill, position, CAST(day AS VARCHAR) AS day, rank FROM (SELECT *, row_number() OVER (PARTITION BY member ORDER BY day DESC, bill, position) AS rank FROM d) WHERE rank <= 3",
    "topic_alias_match": f"WITH {BILLS_SQL}, {_FILTERS_SQL} SELECT topic, count(*) AS bills, min(bill) AS first_bill FROM resolved JOIN bills ON list_contains(areas, area) OR list_has_any(resolved.subjects, bills.subjects) GROUP BY topic",
    "promise_votes": f"""WITH {VOTES_SQL}, {BILLS_SQL}, {_FILTERS_SQL},
p AS (SELECT doc_id AS promise, doc_id % 150 AS member, (['widget', 'gadgetry', 'brands', 'nothing'])[CAST(doc_id % 4 AS INTEGER) + 1] AS topic FROM documents),
f AS (SELECT vote_id, member, bill, position, day, position NOT IN {_SUB} AS procedural, len(subjects) > 50 AS omnibus,
  CASE WHEN question LIKE 'PROMO%' THEN 0 WHEN question LIKE 'STANDARD%' THEN 1 ELSE 2 END AS q, area, subjects FROM votes JOIN bills USING (bill)),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member, bill ORDER BY q, day DESC, vote_id DESC) AS k FROM f) WHERE k = 1)
SELECT promise, rank, vote_id, bill, position, procedural FROM (SELECT *, row_number() OVER (PARTITION BY promise ORDER BY omnibus, procedural, day DESC, vote_id DESC) AS rank
  FROM p JOIN resolved USING (topic) JOIN o USING (member) WHERE list_contains(areas, area) OR list_has_any(resolved.subjects, o.subjects)) WHERE rank <= 25""",
    "array_membership_join": f"WITH {VOTES_SQL}, {BILLS_SQL}, n AS (SELECT bill, count(*) AS votes FROM votes GROUP BY 1) SELECT word, count(*) AS bills, sum(votes)::BIGINT AS votes FROM (VALUES ('widget'), ('bolt'), ('none'), (NULL)) w(word) JOIN bills ON list_contains(subjects, word) JOIN n USING (bill) GROUP BY word",
    "semi_members": f"WITH {VOTES_SQL}, {BILLS_SQL} SELECT DISTINCT member FROM votes WHERE bill IN (SELECT bill FROM bills WHERE list_contains(subjects, 'widget'))",
    "anti_missing": "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
    "null_aware_not_in": "SELECT 'null' AS list, count(*) AS kept FROM nation WHERE n_nationkey NOT IN (SELECT * FROM (VALUES (1), (NULL))) UNION ALL SELECT 'plain', count(*) FROM nation WHERE n_nationkey NOT IN (1, 2)",
    "high_water_mark": f"WITH {VOTES_SQL}, m AS (SELECT position, max(vote_id) FILTER (vote_id % 3 = 0) AS mark FROM votes WHERE position <> 'error' GROUP BY 1) SELECT position, count(*) AS fresh, min(vote_id) AS from_id FROM votes LEFT JOIN m USING (position) WHERE vote_id > coalesce(mark, 0) GROUP BY 1",
    "review_queue_json": """WITH u AS (SELECT conv_id, '[' || string_agg('{"turn":' || turn || ',"chars":' || length(text) || '}', ',' ORDER BY turn, length(text)) || ']' AS turns FROM conversations WHERE role = 'user' GROUP BY 1)
SELECT conv_id, coalesce(turns, '[]') AS turns FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN u USING (conv_id)""",
    "prompt_render": r"""WITH b AS (SELECT conv_id, turn, '[' || turn || '] ' || role || ': ' || CASE WHEN length(text) <= 400 THEN text ELSE regexp_replace(left(text, 400), ' [^ ]*$', '') || '...' END AS block FROM conversations)
SELECT conv_id, string_agg(block, chr(10) || chr(10) ORDER BY turn, block) AS prompt FROM b GROUP BY 1""",
    "distinct_reasons": f"WITH {VOTES_SQL} SELECT position, count(*) AS rows, count(DISTINCT member) AS members FROM votes GROUP BY 1",
    "review_precision": "SELECT source, count(*) AS reviewed, sum(quality)::BIGINT AS good, round(sum(quality) / count(*), 4) AS precision FROM labels JOIN documents USING (doc_id) GROUP BY 1",
    "name_lookup": """WITH p AS (SELECT s_suppkey AS person, CASE WHEN s_suppkey % 10 = 0 THEN lower(s_name) WHEN s_suppkey % 10 = 1 THEN 'Twin' ELSE s_name END AS name FROM supplier),
n AS (SELECT DISTINCT name FROM (SELECT s_name AS name FROM supplier UNION ALL VALUES ('Twin'), ('Nobody'))),
h AS (SELECT n.name, count(*) FILTER (p.name = n.name) AS ne, count(person) AS nf, min(person) FILTER (p.name = n.name) AS e, min(person) AS f FROM n LEFT JOIN p ON lower(p.name) = lower(n.name) GROUP BY 1)
SELECT name, CASE WHEN ne = 1 THEN e WHEN ne = 0 AND nf = 1 THEN f END AS person, CASE WHEN ne = 1 THEN 'exact' WHEN ne = 0 AND nf = 1 THEN 'folded' WHEN nf = 0 THEN 'unknown' ELSE 'ambiguous' END AS outcome FROM h""",
    "key_normalise": rf"""WITH {VOTES_SQL}, x AS (SELECT vote_id, replace(([{_values(_KEYS)}])[CAST(vote_id % 6 AS BIGINT) + 1], '{{}}', CAST(bill AS VARCHAR)) AS k, ([{_values(_WORDS)}])[CAST(vote_id % 7 AS BIGINT) + 1] AS w FROM votes),
y AS (SELECT vote_id, upper(regexp_replace(k, '[\s.]', '', 'g')) AS f, lower(regexp_replace(trim(w), '\s+', ' ', 'g')) AS v FROM x)
SELECT vote_id, CASE WHEN regexp_full_match(f, '[A-Z]+\d+') THEN regexp_extract(f, '^([A-Z]+)', 1) || '-' || regexp_extract(f, '(\d+)$', 1) END AS bill_key,
  CASE WHEN v IN ('yea', 'aye', 'yes') THEN 'yea' WHEN v IN ('nay', 'no') THEN 'nay' WHEN v = 'present' THEN v WHEN v = 'not voting' THEN 'not_voting' END AS position FROM y""",
    "state_report": f"WITH {VOTES_SQL} SELECT c_nationkey AS state, c_mktsegment AS chamber, count(*) AS votes_recorded, " + ", ".join(f"count(*) FILTER (position = '{w}') AS {w}" for w in ("click", "error", "purchase", "view")) + ", strftime(max(day), '%Y-%m-%d') AS latest_vote FROM votes JOIN customer ON c_custkey = member GROUP BY 1, 2",
    "national_coverage": """WITH c AS (SELECT c_nationkey AS state, c_mktsegment <> 'BUILDING' AS house, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal / 1000) END AS district, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS hit FROM customer),
s AS (SELECT bool_or(hit) AS hit FROM c WHERE house GROUP BY state, district)
SELECT count(*) AS candidates, count(DISTINCT state) AS states, count(DISTINCT state) FILTER (hit) AS researched, (SELECT count(*) FROM s) AS seats, (SELECT count(*) FROM s WHERE hit) AS seats_covered FROM c""",
    "shown_candidates": "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_extendedprice > 104800) OR s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9990)",
    "span_overlap": """WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n FROM documents WHERE length(text) > 100),
a AS (SELECT doc_id, unnest(range(0, n, 150)) AS s FROM d), b AS (SELECT doc_id, unnest(range(30, n, 100)) AS s FROM d)
SELECT doc_id, count(*) AS pairs, sum(least(a.s + 200, b.s + 120) - greatest(a.s, b.s))::BIGINT AS chars FROM a JOIN b USING (doc_id)
WHERE least(a.s + 200, b.s + 120) - greatest(a.s, b.s) >= 60 GROUP BY doc_id""",
    "leak_counts": """WITH d AS (SELECT doc_id, source, length(text) AS n FROM documents WHERE length(text) > 0),
g AS (SELECT doc_id, source, s, least(s + 80, n) AS e FROM (SELECT *, unnest(range(0, n, 240)) AS s FROM d)), f AS (SELECT doc_id, source, s, least(s + 60, n) AS e FROM (SELECT *, unnest(range(0, n, 130)) AS s FROM d)),
h AS (SELECT g.doc_id, g.s AS gs, f.s AS fs FROM g JOIN f USING (doc_id) WHERE least(g.e, f.e) > greatest(g.s, f.s) AND 2 * (least(g.e, f.e) - greatest(g.s, f.s)) >= least(g.e - g.s, f.e - f.s)),
o AS (SELECT source, CASE WHEN s % 480 = 0 THEN 'retained' ELSE 'leaked' END AS outcome FROM g WHERE EXISTS (SELECT 1 FROM h WHERE h.doc_id = g.doc_id AND gs = g.s)
  UNION ALL SELECT source, 'novel' FROM f WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.doc_id = f.doc_id AND fs = f.s))
SELECT source, outcome, count(*) AS spans FROM o GROUP BY 1, 2""",
}
