"""Quotes, gate, evidence and pages as queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import evidence as ev
from ..operators import gate, web
from ..operators.aggregates import procedure_scores
from ..operators.quality import dangling, repeated_keys, violations
from ..operators.text import chunk_text, context, verify_quotes
from .tables import BILLS_SQL, VOTES_SQL, bills, read, votes


def chunk_offsets(spark, sf_dir):
    df = chunk_text(read(spark, sf_dir, "documents"), "text", 1000, 80)
    return df.select("doc_id", "chunk_no", "chunk_offset", F.length("chunk").alias("chars"), F.md5(F.col("chunk").cast("binary")).alias("md5"))


def context_window(spark, sf_dir):
    before, after = context(F.col("text"), F.lit(50), F.lit(80), 60, 40)
    df = read(spark, sf_dir, "documents").where(F.length("text") >= 80)
    return df.select("doc_id", before.alias("before"), F.substring("text", 51, 30).alias("span"), after.alias("after"))


RESIDUES = 40
NBSP, THIN = "\u00a0", "\u2009"


def quote_verification(spark, sf_dir):
    """Quotes of each document, looked for in all of it: its own words at the reported place or beside it, the same with other
    blanks and apostrophes, and every benchmark item whose number is the document's modulo RESIDUES, which claims to stand at the
    start."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    items = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"))
    quotes = d.select("doc_id").join(items, F.col("doc_id") % RESIDUES == F.col("item_id") % RESIDUES).select("doc_id", "item_id", "quote", F.lit(0).alias("offset"), F.lit(0).alias("quote_start"), F.length("quote").alias("quote_end"))
    pieces = d.where(F.length("text") > 60).select(
        "doc_id", F.lit(-1).cast("long").alias("item_id"), F.substring("text", 11, 30).alias("quote"), F.lit(10).alias("offset"), (F.col("doc_id") % 2).cast("int").alias("quote_start"), (F.col("doc_id") % 2 + 30).cast("int").alias("quote_end")
    )
    other = F.replace(F.translate(F.substring("text", 21, 60), "'", "’"), F.lit(" "), F.lit(NBSP + THIN))
    loose = d.where(F.length("text") > 60).select("doc_id", F.lit(-2).cast("long").alias("item_id"), other.alias("quote"), F.lit(0).alias("offset"), F.lit(0).alias("quote_start"), F.lit(0).alias("quote_end"))
    return verify_quotes(quotes.unionByName(pieces).unionByName(loose), d, "doc_id").select("doc_id", "item_id", "method", "start", "end")


#: A quote for each reason, in the order of the rules, and some that stay.
QUOTES = [
    ("fragment", "we'll fight back"), ("fragment", "reforming the tax code to rebuild the middle class"),
    ("reported_speech", "The senator said he would lower the price of drugs."), ("past_action", "I would have voted for that bill on the floor."),
    ("constituent_casework", "Please call our office for help with your benefits."), ("candidacy_motivation", "She is running to bring jobs to the valley."),
    ("campaign_bio", "I am a lifelong resident of this district and a teacher."), ("ongoing_activity", "The team is currently negotiating the new agreement."),
    ("third_party_belief", "Maria believes health care is a human right for all."), ("normative_claim", "Care should not be dictated by large companies."),
    ("hedged_opinion", "I really think families deserve much better."), ("aspirational_hope", "We are hoping to see progress on roads this year."),
    ("kept", "I will vote against any cut to the program, because I think families deserve better."), ("kept", "Chellie supports a clean energy standard for the state."),
    ("kept", "We need to restore the tax credits for working people."),
]


SENTENCE = "[^.!?\\n]+[.!?]*"


def gate_sentences(spark, sf_dir):
    """Every sentence of all documents and talks, screened."""
    texts = read(spark, sf_dir, "documents").select("text").unionByName(read(spark, sf_dir, "conversations").select("text"))
    said = texts.select(F.explode(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))).alias("quote")).select("quote", gate.screen(F.col("quote"), wide=False)["reason"].alias("reason"))
    return said.groupBy("reason").agg(F.count("*").alias("sentences"), F.sum(F.length("quote")).alias("chars"))


def _labelled(spark, sf_dir):
    """Sentences of labelled documents, with the document's label and a stored screening version: those of low quality never had
    one, a third of the others were screened by an older gate."""
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("truth")), "doc_id")
    stamp = F.when(F.col("truth"), F.when(F.col("doc_id") % 3 == 0, "gate_v1").otherwise(gate.VERSION))
    return d.select("truth", stamp.alias("version"), F.explode(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))).alias("quote"))


def gate_screen(spark, sf_dir):
    """A run of the gate over the sentences that were not screened at its version yet, with drop counts by rule."""
    return gate.run(_labelled(spark, sf_dir), "quote", "version", wide=False).groupBy("reason", "version").agg(F.count("*").alias("rows"), F.count_if("keep").alias("kept"))


PHRASES = ["think", "hope", "believe", "ende", "tion "]


def prose_screen(spark, sf_dir):
    """All documents and talks as a verdict's prose that cites one bill."""
    texts = read(spark, sf_dir, "documents").select("text").unionByName(read(spark, sf_dir, "conversations").select("text"))
    found = texts.select(F.length("text").alias("n"), F.array_join(ev.prose_defects(F.col("text"), F.array(F.lit("HR-168"))), ",").alias("defects"))
    return found.groupBy("defects").agg(F.count("*").alias("rows"), F.sum("n").alias("chars"))


def gate_ablation(spark, sf_dir):
    """All procedures over the sentences of labelled documents: the gate, a phrase list, each rule alone and left out."""
    return gate.sweep(_labelled(spark, sf_dir).select("truth", gate.hits(F.col("quote"), PHRASES, wide=False).alias("mask")), "mask", "truth")


def confusion(spark, sf_dir):
    """Short texts as a guess at low quality, by label."""
    d = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    rows = d.select((F.col("quality") == 1).alias("truth"), *[(F.col("n_chars") >= n).alias(f"min_{n}") for n in (100, 500, 2000)])
    return procedure_scores(rows, "truth", {f"min_{n}": f"min_{n}" for n in (100, 500, 2000)})


CONTESTED = {"red": ["paint"], "hot": []}


def _claims(spark, sf_dir):
    """A claim for each vote, spoilt in a way that its number tells."""
    v = votes(spark, sf_dir)
    k = F.col("vote_id") % 23
    return v.select(
        (F.col("vote_id") % 400).alias("evaluation"), F.when(k == 1, F.col("member") + 1).otherwise(F.col("member")).alias("member"),
        F.when(F.col("vote_id") % 2 == 0, "paint").otherwise("roads").alias("topic"),
        F.when(k == 2, "donation").when(k == 3, "rumour").otherwise("vote").alias("kind"), F.when(k == 4, F.col("vote_id") + 10_000_000).otherwise(F.col("vote_id")).alias("record"),
        F.when(k == 5, "sideways").when(k < 14, "supports").when(k < 20, "contradicts").otherwise("contextual").alias("direction"), F.when(k == 6, "nay").otherwise(F.col("position")).alias("claimed"),
    )


def _facts(spark, sf_dir):
    f = votes(spark, sf_dir).join(bills(spark, sf_dir), "bill")
    return f.select(F.col("vote_id").alias("record"), "member", "position", (F.col("bill") % 17 == 0).alias("omnibus"), (F.col("position") == "error").alias("procedural"), "subjects")


def _checked(spark, sf_dir):
    claims = _claims(spark, sf_dir)
    return ev.check_claims(claims, _facts(spark, sf_dir), claims.where("record % 11 != 0").select("evaluation", "record"), CONTESTED)


def citation_ladder(spark, sf_dir):
    return _checked(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("rows"), F.count_distinct("evaluation").alias("evaluations"), F.count_if("accepted").alias("accepted"))


def status_support(spark, sf_dir):
    names = F.array(*[F.lit(s) for s in ("completed", "broken", "pending", "odd", "in_progress")])
    checked = _checked(spark, sf_dir).where("evaluation % 7 != 0 and (evaluation % 3 != 0 or direction != 'supports')")
    ids = votes(spark, sf_dir).select((F.col("vote_id") % 400).alias("evaluation")).distinct()
    return ev.status_support(ids.withColumn("status", F.get(names, (F.col("evaluation") % 5).cast("int"))), checked)


def store_routing(spark, sf_dir):
    return ev.route(_checked(spark, sf_dir)).groupBy("target", "kind").agg(F.count("*").alias("rows"))


def revalidation(spark, sf_dir):
    """Accepted claims as stored evidence, against facts of which some changed hands since."""
    stored = _checked(spark, sf_dir).where("accepted").select("evaluation", "member", "topic", "kind", "record", "direction", "claimed").withColumn("validated", F.col("record") % 5 != 0)
    facts = _facts(spark, sf_dir).withColumn("member", F.when(F.col("record") % 13 == 0, -1).otherwise(F.col("member")))
    return ev.revalidate(stored, facts).groupBy("validated", "flipped", "valid").agg(F.count("*").alias("rows"))


def export_gate_promises(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("promise"), (F.col("n_chars") > 200).alias("verified"), F.when(F.col("doc_id") % 4 == 0, F.lit(None)).otherwise(F.col("doc_id") % 4 != 1).cast("boolean").alias("gate_keep"))
    return ev.exportable_promises(d, read(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("promise"))).select("promise", "gate_keep")


def export_gate_evaluations(spark, sf_dir):
    checked = _checked(spark, sf_dir).where("reason in ('ok', 'omnibus_not_contextual') and (reason = 'ok' or record % 9 = 0)").withColumn("validated", F.col("accepted"))
    e = votes(spark, sf_dir).select((F.col("vote_id") % 400).alias("evaluation")).distinct()
    e = e.select("evaluation", F.when(F.col("evaluation") % 2 == 0, "broken").otherwise("completed").alias("status"), (F.col("evaluation") % 5 != 0).alias("is_current"), F.when(F.col("evaluation") % 6 == 0, "reviewer").alias("reviewed_by"))
    return ev.exportable_evaluations(e, checked).select("evaluation", "status")


def prose_defects(spark, sf_dir):
    """Turns of talks as prose that names the bill of its talk's number and cites that of its turn's; every fifth shows its notes."""
    t = read(spark, sf_dir, "conversations")
    said = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("conv_id") % 5 == 0, " Wait, ").otherwise(" "), F.lit("H.R. "), (F.col("conv_id") * 7 + 990).cast("string"))
    cited = F.array(F.concat(F.lit("HR-"), (F.col("conv_id") * 7 + 990 + F.col("turn") % 2).cast("string")))
    return t.select(F.array_join(ev.prose_defects(said, cited), ",").alias("defects"), F.length(said).alias("n")).groupBy("defects").agg(F.count("*").alias("rows"), F.sum("n").alias("chars"))


def contested_block(spark, sf_dir):
    b = bills(spark, sf_dir).crossJoin(F.broadcast(spark.createDataFrame([("paint",), (" Roads ",), (None,)], "topic string")))
    return b.select("topic", ev.contested_block(F.col("subjects"), F.col("topic"), CONTESTED).alias("block")).groupBy("topic", "block").agg(F.count("*").alias("bills"))


def page_links(spark, sf_dir):
    return web.links(read(spark, sf_dir, "pages"))


WORDS = ("the", "and", "of", "que", "der")


def issue_links(spark, sf_dir):
    return web.issue_links(web.same_site(read(spark, sf_dir, "pages")), words=WORDS, cap=8)


def press_index(spark, sf_dir):
    return web.press_index(web.same_site(read(spark, sf_dir, "pages")), in_path="on", in_anchor="an")


def child_links(spark, sf_dir):
    """Pages taken as the roots of their sites, so that all links lie below them."""
    pages = read(spark, sf_dir, "pages").withColumn("url", F.regexp_replace("url", r"^(https?://[^/]+).*$", "$1/"))
    return web.child_links(web.same_site(pages), pages, cap=8)


def page_text(spark, sf_dir):
    t = web.main_text(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.length(t).alias("chars"), F.md5(t.cast("binary")).alias("md5"))


#: Ways in which a page's address ({}: without scheme) may be filed.
FILED = ["{}", " HTTPS://{} ", "<{}>", "none", "N/A", "me@{}", "see {}", "ftp://{}", "m.facebook.com/{}", "notfacebook.com/{}", None, "", "http://x"]


def url_normalise(spark, sf_dir):
    ways = F.array(*[F.lit(x) for x in FILED])
    bare = F.regexp_replace("url", "^[a-z]+://", "")
    raw = read(spark, sf_dir, "pages").select("page_id", F.replace(F.get(ways, (F.col("page_id") % len(FILED)).cast("int")), F.lit("{}"), bare).alias("raw"))
    url = web.declared_url(F.col("raw"))
    return raw.select("page_id", url.alias("url"), web.is_non_site(F.coalesce(url, F.lit(""))).alias("non_site"))


def host_throttle_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(web.throttle_key(F.col("url")).alias("key")).agg(F.count("*").alias("pages"), F.count_distinct(web.host(F.col("url"))).alias("hosts"))


def crawl_frontier(spark, sf_dir):
    return web.frontier(read(spark, sf_dir, "pages"), ("/issues", "/about"), cap=24, words=WORDS)


def document_dedupe(spark, sf_dir):
    """One document of each (source, text hash): the smallest id."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    return d.groupBy("source", "content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def expectations(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    checks = {"quantity": F.col("l_quantity") > 1, "flag": F.col("l_returnflag").isin("A", "N"), "discount": F.col("l_discount").between(0, 0.09), "price": F.col("l_extendedprice") > 0}
    return violations(li, checks)


def unique_and_foreign(spark, sf_dir):
    li, o = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders").where("o_orderstatus != 'P'")
    a = repeated_keys(li, ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("keys"), F.sum("rows").alias("rows")).select(F.lit("repeated").alias("check"), "keys", "rows")
    b = dangling(li, "l_orderkey", o, "o_orderkey").agg(F.count("*").alias("keys"), F.sum("rows").alias("rows")).select(F.lit("dangling").alias("check"), "keys", "rows")
    return a.unionByName(b)


QUERIES = {
    f.__name__: f
    for f in (chunk_offsets, context_window, quote_verification, gate_sentences, prose_screen, gate_screen, gate_ablation, confusion, citation_ladder, status_support, store_routing, revalidation,
              export_gate_promises, export_gate_evaluations, prose_defects, contested_block, page_links, issue_links, press_index, child_links, page_text, url_normalise,
              host_throttle_key, crawl_frontier, document_dedupe, expectations, unique_and_foreign)
}

_CLAIMS = f"""{VOTES_SQL}, {BILLS_SQL},
claims AS (SELECT vote_id % 400 AS evaluation, CASE WHEN vote_id % 23 = 1 THEN member + 1 ELSE member END AS member, CASE WHEN vote_id % 2 = 0 THEN 'paint' ELSE 'roads' END AS topic,
  CASE vote_id % 23 WHEN 2 THEN 'donation' WHEN 3 THEN 'rumour' ELSE 'vote' END AS kind, CASE WHEN vote_id % 23 = 4 THEN vote_id + 10000000 ELSE vote_id END AS record,
  CASE WHEN vote_id % 23 = 5 THEN 'sideways' WHEN vote_id % 23 < 14 THEN 'supports' WHEN vote_id % 23 < 20 THEN 'contradicts' ELSE 'contextual' END AS direction,
  CASE WHEN vote_id % 23 = 6 THEN 'nay' ELSE position END AS claimed FROM votes),
facts AS (SELECT vote_id AS record, member AS f_member, position, bill % 17 = 0 AS omnibus, position = 'error' AS procedural, subjects FROM votes JOIN bills USING (bill)),
checked AS (SELECT c.*, CASE WHEN direction NOT IN ('supports', 'contradicts', 'contextual') THEN 'bad_direction'
  WHEN kind = 'donation' AND direction <> 'contextual' THEN 'donation_not_contextual' WHEN kind = 'donation' THEN 'kind_not_validatable_yet' WHEN kind <> 'vote' THEN 'unsupported_kind'
  WHEN f_member IS NULL THEN 'unknown_record' WHEN f_member <> member THEN 'wrong_politician' WHEN record % 11 = 0 THEN 'not_offered' WHEN claimed <> position THEN 'position_mismatch'
  WHEN direction = 'contextual' THEN 'ok' WHEN omnibus THEN 'omnibus_not_contextual' WHEN procedural THEN 'procedural_not_contextual'
  WHEN list_contains(subjects, 'hot') OR (list_contains(subjects, 'red') AND topic <> 'paint') THEN 'contested_subject_not_contextual' ELSE 'ok' END AS reason
  FROM claims c LEFT JOIN facts USING (record))"""

_SITE = r"""p AS (SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host,
  unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS anchor,
  unnest(range(len(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)))) AS pos FROM pages),
l AS (SELECT page_id, url, pos, href, trim(regexp_replace(regexp_replace(anchor, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS anchor, host, CASE WHEN href LIKE '/%' THEN origin || href ELSE href END AS abs FROM p),
s AS (SELECT page_id, pos, regexp_replace(regexp_extract(abs, '^([^#]*)', 1), '/+$', '') AS link, lower(regexp_extract(abs, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS path, lower(anchor) AS anchor, url FROM l
  WHERE abs LIKE 'http%://%' AND regexp_replace(lower(regexp_extract(abs, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') = host),
site AS (SELECT page_id, min(pos) AS pos, link, any_value(path) AS path, arg_min(anchor, pos) AS anchor FROM s WHERE link <> regexp_replace(url, '/+$', '') GROUP BY page_id, link)"""


def _scores(source: str, names: list[str]) -> str:
    one = "SELECT '{0}' AS procedure, count(*) FILTER ({0} AND truth) AS tp, count(*) FILTER ({0} AND NOT truth) AS fp, count(*) FILTER (NOT {0} AND truth) AS fn, count(*) FILTER (NOT {0} AND NOT truth) AS tn FROM " + source
    return "SELECT *, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 4) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 4) AS retention FROM (" + " UNION ALL ".join(one.format(n) for n in names) + ")"


def _gate_rules() -> list[tuple[str, str]]:
    """The ladder of the gate as conditions over RE2 patterns, with \\w widened to Unicode's letters and digits."""
    wide = lambda p: "'" + p.replace("\\w", "[\\pL\\pN_]").replace("'", "''") + "'"
    hit = lambda p: f"regexp_matches(t, {wide(p)})"
    plain = {"reported_speech": gate.REPORTED_SPEECH, "past_action": gate.PAST_ACTION, "constituent_casework": gate.CASEWORK}
    frame = {"candidacy_motivation": gate.CANDIDACY, "campaign_bio": gate.BIO, "ongoing_activity": gate.ONGOING, "third_party_belief": gate.THIRD_PARTY}
    head = f"lower(regexp_extract(t, {wide(gate.GERUND)}, 1))"
    fragment = f"""length(t) < {gate.MIN_CHARS} OR {hit(gate.LONE_LETTER)} OR ({head} <> '' AND {head} NOT IN ({", ".join(f"'{w}'" for w in gate.NOT_GERUNDS)}) AND NOT {hit(gate.FINITE_VERB)}) OR (NOT {hit(gate.CLOSING)} AND {hit(gate.SENTENCE_END)})"""
    cases = [("fragment", fragment), *[(k, hit(p)) for k, p in plain.items()], ("kept", " OR ".join(map(hit, (gate.SELF_COMMITMENT, gate.NAMED_COMMITMENT, gate.PRONOUN_COMMITMENT))))]
    cases += [*[(k, hit(p)) for k, p in frame.items()], ("normative_claim", f"NOT {hit(gate.FIRST_PERSON)} AND {hit(gate.NORMATIVE)}"), ("hedged_opinion", hit(gate.HEDGED)), ("aspirational_hope", hit(gate.HOPE))]
    return cases


def _gate_sql() -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, c in _gate_rules()) + " ELSE 'kept' END"


_LABELLED = f"""s AS (SELECT truth, CASE WHEN truth THEN CASE WHEN doc_id % 3 = 0 THEN 'gate_v1' ELSE '{gate.VERSION}' END END AS version, unnest(regexp_extract_all(text, '{SENTENCE}', 0)) AS q
  FROM documents JOIN (SELECT doc_id, quality = 1 AS truth FROM labels) USING (doc_id)), x AS (SELECT *, regexp_replace(q, '^\\s+|\\s+$', '', 'g') AS t FROM s)"""


def _sweep_sql() -> str:
    """Every procedure as a list of the rules that it heeds, tried on every sentence anew."""
    rules = [("empty", "t = ''"), *[("commitment" if r == "kept" else r, c) for r, c in _gate_rules()], ("phrase", " OR ".join(f"contains(lower(q), '{p}')" for p in PHRASES))]
    heeds = [(name, [r for r, _ in rules if not gate.BIT[r] & off]) for name, off in gate.procedures().items()]
    none = lambda on: " AND ".join(f"NOT {r}" for r in on) or "true"

    def keep(on: list[str]) -> str:  # structural rules always drop; frame rules unless a commitment stands
        before = [r for r in on if r in ("empty", *gate.STRUCTURAL)]
        frame = [r for r in on if r in (*gate.FRAME, "phrase")]
        return f"({none(before)}) AND ({'commitment OR ' if 'commitment' in on else ''}({none(frame)}))"

    flags = ", ".join(f"coalesce({c}, false) AS {r}" for r, c in rules)
    source = "r AS (SELECT truth, " + ", ".join(f"{keep(on)} AS {name}" for name, on in heeds) + f" FROM (SELECT truth, {flags} FROM x))"
    return f"WITH {_LABELLED}, {source} " + _scores("r", [n for n, _ in heeds])


ORACLES = {
    "gate_sentences": f"""WITH s AS (SELECT unnest(regexp_extract_all(text, '{SENTENCE}', 0)) AS q FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)), x AS (SELECT q, regexp_replace(q, '^\\s+|\\s+$', '', 'g') AS t FROM s)
SELECT {_gate_sql()} AS reason, count(*) AS sentences, sum(length(q))::BIGINT AS chars FROM x GROUP BY 1""",
    "prose_screen": f"""WITH d AS (SELECT coalesce(text, '') AS t, length(text) AS n FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)),
b AS (SELECT t, n, list_transform(regexp_extract_all(t, '{ev.BILL_IN_PROSE}', 1), lambda x: regexp_replace(x, '^0+', '')) AS bills FROM d),
c AS (SELECT *, list_filter(list_transform(bills, lambda x: CASE WHEN length(x) >= 5 THEN 'impossible_bill_number' WHEN x <> '168' THEN 'uncited_bill_reference' END), lambda x: x IS NOT NULL) AS bad FROM b)
SELECT CASE WHEN NOT regexp_matches(t, '\\S') THEN 'empty' ELSE concat_ws(',', CASE WHEN length(t) > {ev.MAX_PROSE} THEN 'overlong' END, CASE WHEN regexp_matches(t, '{ev.SCRATCHPAD.replace("'", "''")}') THEN 'scratchpad' END, bad[1]) END AS defects, count(*) AS rows, sum(n)::BIGINT AS chars FROM c GROUP BY 1""",
    "chunk_offsets": """WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
c AS (SELECT *, unnest(range(CASE WHEN n <= 1000 THEN 1 ELSE CAST(ceil((n - 1000) / 920) AS BIGINT) + 1 END)) AS k FROM d)
SELECT doc_id, k AS chunk_no, k * 920 AS chunk_offset, length(substring(text, k * 920 + 1, 1000)) AS chars, md5(substring(text, k * 920 + 1, 1000)) AS md5 FROM c""",
    "context_window": "SELECT doc_id, substring(text, 1, 50) AS before, substring(text, 51, 30) AS span, substring(text, 81, 40) AS after FROM documents WHERE length(text) >= 80",
    # the looser arm by a pattern made of each quote: runs of blanks as a class, apostrophes, quotes and dashes as classes
    "quote_verification": rf"""WITH q AS (SELECT d.doc_id, item_id, b.text AS quote, 0 AS lo, length(b.text) AS hi, d.text FROM documents d JOIN benchmark b ON d.doc_id % {RESIDUES} = item_id % {RESIDUES}
  UNION ALL SELECT doc_id, -1, substring(text, 11, 30), 10 + doc_id % 2, 40 + doc_id % 2, text FROM documents WHERE length(text) > 60
  UNION ALL SELECT doc_id, -2, replace(replace(substring(text, 21, 60), '''', '’'), ' ', '{NBSP}{THIN}'), 0, 0, text FROM documents WHERE length(text) > 60),
f AS (SELECT *, regexp_replace(translate(quote, '‘’“”–—', '''''""--'), '^[\s{NBSP}{THIN}]+|[\s{NBSP}{THIN}]+$', '', 'g') AS flat FROM q),
e AS (SELECT *, regexp_replace(regexp_escape(flat), '(\\?[\s{NBSP}{THIN}])+', '[\\s{NBSP}{THIN}]+', 'g') AS pattern FROM f),
p AS (SELECT *, regexp_extract(text, replace(replace(replace(pattern, '\''', '[''‘’]'), '\"', '["“”]'), '\-', '[-–—]')) AS span FROM e),
m AS (SELECT *, CASE WHEN hi > lo AND substring(text, lo + 1, hi - lo) = quote THEN 'exact' WHEN contains(text, quote) THEN 'relocated' WHEN flat <> '' AND span <> '' THEN 'normalized' ELSE 'rejected' END AS method FROM p)
SELECT doc_id, item_id, method, (CASE method WHEN 'exact' THEN lo WHEN 'relocated' THEN strpos(text, quote) - 1 WHEN 'normalized' THEN strpos(text, span) - 1 ELSE -1 END)::INT AS start,
  (CASE method WHEN 'exact' THEN hi WHEN 'relocated' THEN strpos(text, quote) - 1 + length(quote) WHEN 'normalized' THEN strpos(text, span) - 1 + length(span) ELSE -1 END)::INT AS "end" FROM m""",
    "gate_screen": f"WITH {_LABELLED}, g AS (SELECT {_gate_sql()} AS reason FROM x WHERE version IS DISTINCT FROM '{gate.VERSION}') SELECT reason, '{gate.VERSION}' AS version, count(*) AS rows, count(*) FILTER (reason = 'kept') AS kept FROM g GROUP BY reason",
    "gate_ablation": _sweep_sql(),
    "confusion": "WITH r AS (SELECT quality = 1 AS truth, n_chars >= 100 AS min_100, n_chars >= 500 AS min_500, n_chars >= 2000 AS min_2000 FROM labels JOIN documents USING (doc_id)) " + _scores("r", ["min_100", "min_500", "min_2000"]),
    "citation_ladder": f"WITH {_CLAIMS} SELECT reason, count(*) AS rows, count(DISTINCT evaluation) AS evaluations, count(*) FILTER (reason = 'ok') AS accepted FROM checked GROUP BY 1",
    "status_support": f"""WITH {_CLAIMS}, k AS (SELECT * FROM checked WHERE evaluation % 7 <> 0 AND (evaluation % 3 <> 0 OR direction <> 'supports')),
n AS (SELECT evaluation, count(*) AS cited, count(*) FILTER (reason = 'ok') AS good, count(*) FILTER (reason = 'ok' AND direction = 'supports') AS s, count(*) FILTER (reason = 'ok' AND direction = 'contradicts') AS c FROM k GROUP BY 1),
e AS (SELECT DISTINCT vote_id % 400 AS evaluation, (['completed', 'broken', 'pending', 'odd', 'in_progress'])[CAST(vote_id % 400 % 5 AS INTEGER) + 1] AS status FROM votes),
j AS (SELECT e.*, coalesce(cited, 0) AS cited, coalesce(good, 0) AS good, coalesce(s, 0) AS s, coalesce(c, 0) AS c FROM e LEFT JOIN n USING (evaluation))
SELECT evaluation, status, cited, good, CASE WHEN status = 'pending' THEN CASE WHEN cited > 0 THEN 'unevidenced_status_with_citations' ELSE 'ok' END WHEN status = 'odd' THEN 'unknown_status'
  WHEN good = 0 THEN 'no_valid_evidence' WHEN status = 'broken' AND c = 0 THEN 'no_contradicts_evidence' WHEN status <> 'broken' AND s = 0 THEN 'no_supports_evidence' ELSE 'ok' END AS verdict FROM j""",
    "store_routing": f"WITH {_CLAIMS} SELECT CASE WHEN kind = 'vote' AND reason NOT IN ('bad_direction', 'unknown_record') THEN 'evidence' ELSE 'rejects' END AS target, kind, count(*) AS rows FROM checked GROUP BY 1, 2",
    "revalidation": f"""WITH {_CLAIMS}, s AS (SELECT *, record % 5 <> 0 AS validated FROM checked WHERE reason = 'ok'),
r AS (SELECT validated, record % 13 <> 0 AND (direction = 'contextual' OR NOT (omnibus OR procedural)) AS accepted FROM s JOIN facts USING (record))
SELECT validated, validated AND NOT accepted AS flipped, validated AND accepted AS valid, count(*) AS rows FROM r GROUP BY 1, 2, 3""",
    "export_gate_promises": "SELECT doc_id AS promise, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 4 <> 1 END AS gate_keep FROM documents WHERE n_chars > 200 AND doc_id % 4 <> 1 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "export_gate_evaluations": f"""WITH {_CLAIMS}, x AS (SELECT evaluation, bool_and(reason = 'ok') AS v FROM checked WHERE reason = 'ok' OR (reason = 'omnibus_not_contextual' AND record % 9 = 0) GROUP BY 1)
SELECT evaluation, CASE WHEN evaluation % 2 = 0 THEN 'broken' ELSE 'completed' END AS status FROM x WHERE v AND evaluation % 5 <> 0 AND (evaluation % 2 <> 0 OR evaluation % 6 = 0)""",
    "prose_defects": rf"""WITH p AS (SELECT coalesce(text, '') || CASE WHEN conv_id % 5 = 0 THEN ' Wait, ' ELSE ' ' END || 'H.R. ' || (conv_id * 7 + 990) AS t, CAST(conv_id * 7 + 990 + turn % 2 AS VARCHAR) AS cited FROM conversations),
b AS (SELECT *, list_filter(list_transform(list_transform(regexp_extract_all(t, '{ev.BILL_IN_PROSE}', 1), lambda x: regexp_replace(x, '^0+', '')), lambda x: CASE WHEN length(x) >= 5 THEN 'impossible_bill_number' WHEN x <> cited THEN 'uncited_bill_reference' END), lambda x: x IS NOT NULL) AS bad FROM p)
SELECT concat_ws(',', CASE WHEN length(t) > {ev.MAX_PROSE} THEN 'overlong' END, CASE WHEN regexp_matches(t, '{ev.SCRATCHPAD.replace("'", "''")}') THEN 'scratchpad' END, bad[1]) AS defects, count(*) AS rows, sum(length(t))::BIGINT AS chars FROM b GROUP BY 1""",
    "contested_block": f"""WITH {BILLS_SQL} SELECT topic, CASE WHEN list_contains(subjects, 'hot') THEN 'hot' WHEN list_contains(subjects, 'red') AND lower(trim(coalesce(topic, ''))) <> 'paint' THEN 'red' END AS block, count(*) AS bills
FROM bills, (VALUES ('paint'), (' Roads '), (NULL)) t(topic) GROUP BY 1, 2""",
    "page_links": f"WITH {_SITE} SELECT page_id, pos, href, anchor FROM l",
    "issue_links": f"""WITH {_SITE}, w AS (SELECT *, CASE {' '.join(f"WHEN contains(path, '{x}') OR contains(anchor, '{x}') THEN {i}" for i, x in enumerate(WORDS))} END AS w FROM site)
SELECT page_id, rank, link FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY w, pos) AS rank FROM w WHERE w IS NOT NULL) WHERE rank <= 8""",
    "press_index": f"WITH {_SITE} SELECT page_id, arg_min(link, pos) AS link FROM site WHERE contains(path, 'on') OR contains(anchor, 'an') GROUP BY 1",
    "child_links": f"WITH {_SITE} SELECT page_id, rank, link FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM site WHERE path <> '/') WHERE rank <= 8",
    "page_text": r"""WITH c AS (SELECT page_id, regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<nav\b[^>]*>.*?</nav\s*>|<footer\b[^>]*>.*?</footer\s*>|<!--.*?-->', ' ', 'g') AS h FROM pages),
e AS (SELECT page_id, regexp_replace(h, '(?s)<[^>]*>', ' ', 'g') AS h FROM c),
n AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(h, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM e)
SELECT page_id, CASE WHEN length(t) >= 400 THEN length(t) END AS chars, CASE WHEN length(t) >= 400 THEN md5(t) END AS md5 FROM n""",
    "crawl_frontier": rf"""WITH {_SITE}, w AS (SELECT *, CASE {' '.join(f"WHEN contains(path, '{x}') OR contains(anchor, '{x}') THEN {i}" for i, x in enumerate(WORDS))} END AS w FROM site),
below AS (SELECT s.* FROM site s JOIN pages g USING (page_id) WHERE starts_with(regexp_replace(s.path, '/+$', ''), lower(regexp_replace(regexp_extract(g.url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')) || '/')),
r AS (SELECT page_id, 0 AS p, 0 AS n, regexp_replace(url, '/+$', '') AS link, 'page' AS origin FROM pages
  UNION ALL SELECT page_id, 1, k, link, 'issue' FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY w, pos) AS k FROM w WHERE w IS NOT NULL) WHERE k <= 8
  UNION ALL SELECT page_id, 2, n, regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '/+$', '') || x, 'probe' FROM pages, (VALUES (0, '/issues'), (1, '/about')) t(n, x)
  UNION ALL SELECT page_id, 3, k, link, 'child' FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM below) WHERE k <= 8
  UNION ALL SELECT page_id, 4, 0, arg_min(link, pos), 'press' FROM site WHERE contains(path, 'press-release') OR contains(anchor, 'press releases') GROUP BY page_id),
d AS (SELECT *, row_number() OVER (PARTITION BY page_id, link ORDER BY p, n) AS again FROM r)
SELECT page_id, rank, link, origin FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY p, n) AS rank FROM d WHERE again = 1) WHERE rank <= 24""",
    "url_normalise": rf"""WITH p AS (SELECT page_id, page_id % {len(FILED)} AS k, regexp_extract(regexp_replace(url, '^[a-z]+://', ''), '^([^#]*)', 1) AS u FROM pages),
q AS (SELECT page_id, k, lower(regexp_extract(u, '^([^/?]*)', 1)) || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') || regexp_extract(u, '(\?.*)$', 1) AS good,
  regexp_replace(regexp_extract(u, '^([^?]*)', 1), '/+$', '') || regexp_extract(u, '(\?.*)$', 1) AS tail FROM p)
SELECT page_id, CASE WHEN k <= 2 THEN 'https://' || good WHEN k = 8 THEN 'https://m.facebook.com/' || tail WHEN k = 9 THEN 'https://notfacebook.com/' || tail END AS url, k = 8 AS non_site FROM q""",
    "host_throttle_key": r"""WITH h AS (SELECT regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages)
SELECT CASE WHEN host <> '' THEN array_to_string(string_split(regexp_replace(host, ':\d+$', ''), '.')[-2:], '.') END AS key, count(*) AS pages, count(DISTINCT host) AS hosts FROM h GROUP BY 1""",
    "document_dedupe": "SELECT source, sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1, 2",
    "expectations": """SELECT 'quantity' AS "check", count(*) FILTER (NOT l_quantity > 1) AS rows FROM lineitem UNION ALL SELECT 'flag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'discount', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.09) FROM lineitem UNION ALL SELECT 'price', count(*) FILTER (NOT l_extendedprice > 0) FROM lineitem""",
    "unique_and_foreign": """WITH r AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1), d AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1)
SELECT 'repeated' AS "check", count(*) AS keys, sum(n)::BIGINT AS rows FROM r UNION ALL SELECT 'dangling', count(*), sum(n)::BIGINT FROM d""",
}

