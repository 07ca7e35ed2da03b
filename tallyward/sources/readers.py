"""Readers of landed files; each gives typed rows and keeps what it could not read apart where that matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, iso_day
from ..operators.web import declared_url


def read_pipe(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """A pipe file without header: Latin-1, no quoting, trimmed; blank lines go, short rows have nulls at their end."""
    schema = ", ".join(f"`{c}` string" for c in header)
    raw = spark.read.schema(schema).options(sep="|", quote="", escape="", encoding="ISO-8859-1", mode="PERMISSIVE").csv(path)
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in header]).dropna(how="all")


def scan_wanted(df: DataFrame, key: str, wanted: DataFrame, name: str = "scan") -> tuple[DataFrame, Observation, Observation]:
    """Rows whose key is wanted, and two observations: rows scanned and rows kept, filled as the scan runs."""
    seen, kept = Observation(f"{name}_scanned"), Observation(f"{name}_kept")
    rows = df.observe(seen, F.count("*").alias("rows")).join(wanted.select(key).distinct(), key, "left_semi")
    return rows.observe(kept, F.count("*").alias("rows")), seen, kept


def read_after_preamble(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A tab or comma file whose header line, the first that names all required columns, stands after other text.

    Only that one line comes to the driver; names are lower case.
    """
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    low = F.lower("value")
    head = lines.where(" and ".join(f"lower(value) like '%{c}%'" for c in required)).orderBy("n").limit(1).select("n", low.alias("h")).first()
    if head is None:
        raise ValueError(f"no line of {path} names {required}")
    sep = "\t" if "\t" in head["h"] else ","
    names = [c.strip().strip('"') for c in head["h"].split(sep)]
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    schema = ", ".join(f"`{c}` string" for c in names)
    rows = lines.where((F.col("n") > head["n"]) & (F.trim("value") != ""))
    return rows.select(F.from_csv("value", schema, {"sep": sep}).alias("r")).select("r.*")


def gazetteer(rows: DataFrame, prefix: str) -> DataFrame:
    """Population rows of one geography (GEO_ID prefix, value as text): geoid, population; negatives and junk go."""
    n = F.col("value").try_cast("long")
    return rows.where(F.startswith("geo_id", F.lit(prefix)) & (n >= 0)).select(F.substr(F.col("geo_id"), F.lit(len(prefix) + 1)).alias("geoid"), n.alias("population"))


ROLL_CALL = "struct<congress:int,session:int,rollCall:int,date:string,bill:string,members:array<struct<id:string,name:string,vote:string>>>"


def roll_call_members(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A row per member of roll-call payloads in JSON."""
    p = df.select(F.from_json(payload, ROLL_CALL).alias("p")).select("p.*", F.explode("p.members").alias("m"))
    return p.select("congress", "session", F.col("rollCall").alias("roll_call"), iso_day(F.col("date")).alias("day"), "bill", F.col("m.id").alias("member"), F.col("m.name").alias("name"), F.col("m.vote").alias("vote"))


BILL = "struct<congress:int,type:string,number:string,title:string,policyArea:struct<name:string>,subjects:array<struct<name:string>>,introducedDate:string,summaries:array<struct<actionDate:string,text:string>>>"


def bill_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A row per bill: distinct sorted subjects, and the text of the newest summary as prose (null dates are oldest)."""
    p = df.select(F.from_json(payload, BILL).alias("p")).select("p.*")
    newest = F.get(F.array_sort(F.transform("summaries", lambda s: F.struct(F.coalesce(s["actionDate"], F.lit("")).alias("d"), s["text"].alias("t")))), F.size("summaries") - 1)
    prose = blank_to_null(F.regexp_replace(F.regexp_replace(newest["t"], "<[^>]+>", " "), r"\s+", " "))
    return p.select(
        "congress", F.concat_ws("-", F.upper("type"), "number").alias("bill_key"), "title", F.col("policyArea.name").alias("policy_area"),
        F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("subjects", F.array()), lambda s: s["name"]), lambda x: x.isNotNull()))).alias("subjects"),
        iso_day(F.col("introducedDate")).alias("introduced"), prose.alias("summary"),
    )


#: Fields of the official totals, and the columns that they become.
TOTALS = {
    "receipts": "receipts", "disbursements": "disbursements", "last_cash_on_hand_end_period": "cash_on_hand", "last_debts_owed_by_committee": "debts_owed",
    "individual_itemized_contributions": "individual_itemized", "individual_unitemized_contributions": "individual_unitemized", "other_political_committee_contributions": "pac_contributions",
}


def finance_totals(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Official totals in JSON as flat decimal columns; the first ten characters of the coverage end are its day."""
    p = df.select(F.from_json(payload, "struct<candidate_id:string,cycle:int,coverage_end_date:string," + ",".join(f"{n}:double" for n in TOTALS) + ">").alias("p")).select("p.*")
    return p.select("candidate_id", "cycle", *[F.col(n).cast("decimal(14,2)").alias(c) for n, c in TOTALS.items()], iso_day(F.col("coverage_end_date")).alias("coverage_end"))


def declared_sites(df: DataFrame, key: str, payload: str = "payload", authorised: tuple[str, ...] = ("P", "A")) -> DataFrame:
    """(key, cmte_id, declared, url) of a payload's authorised committees that declare a website; of those that declare the same
    site, as it is normalised, the first by place counts."""
    item = "struct<committee_id:string,designation:string,website:string>"
    rows = df.select(key, F.posexplode(F.from_json(payload, f"struct<results:array<{item}>>")["results"]).alias("at", "c")).select(key, "at", "c.*")
    rows = rows.where(F.col("designation").isin(*authorised) & (F.col("committee_id") != "") & (F.col("website") != "")).withColumn("url", declared_url(F.col("website")))
    first = rows.where("url is not null").groupBy(key, "url").agg(F.min_by(F.struct("committee_id", "website"), "at").alias("c"))
    return first.select(key, F.col("c.committee_id").alias("cmte_id"), F.trim("c.website").alias("declared"), "url")


SENATE = "struct<congress:int,session:int,vote_number:string,vote_date:string,members:struct<member:array<struct<last_name:string,lis_member_id:string,vote_cast:string>>>>"


def senate_members(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A row per member of Senate roll calls in XML; padded text is trimmed, numbers lose their zeros."""
    p = df.select(F.from_xml(F.col(payload), SENATE).alias("p")).select("p.*", F.explode("p.members.member").alias("m"))
    day = F.to_date(F.try_to_timestamp(F.regexp_replace(F.trim("vote_date"), r"\s+", " "), F.lit("MMMM d, yyyy, hh:mm a")))
    return p.select("congress", "session", F.col("vote_number").try_cast("int").alias("vote_number"), day.alias("day"), F.trim("m.lis_member_id").alias("member"), F.trim("m.vote_cast").alias("vote"))


def vote_menu(spark: SparkSession, path: str) -> DataFrame:
    """number, issue, result of the votes that menu files in XML list; white space is collapsed, votes without a number go."""
    raw = spark.read.format("xml").option("rowTag", "vote").schema("vote_number string, issue string, result string").load(path)
    plain = lambda c: blank_to_null(F.regexp_replace(F.col(c), r"(?U)\s+", " "))
    return raw.select(plain("vote_number").try_cast("int").alias("number"), plain("issue").alias("issue"), plain("result").alias("result")).where("number is not null")


def new_roll_calls(menu: DataFrame, details: DataFrame, stored: DataFrame) -> DataFrame:
    """A row a member of the roll calls that the menu lists and `stored` (number) lacks, with the menu's issue and result.
    details: number, payload. Only payloads that are wanted are parsed; a vote of the menu without a payload has no row."""
    wanted = menu.dropDuplicates(["number"]).join(stored.select("number"), "number", "left_anti")
    payloads = details.join(wanted.select("number"), "number", "left_semi")
    return senate_members(payloads).join(wanted.withColumnRenamed("number", "vote_number"), "vote_number")


def import_verdicts(verdicts: DataFrame, pending: DataFrame, allowed: list[str], confidence: str = "high") -> DataFrame:
    """verdicts (id, verdict, confidence) with outcome: unknown_id, unknown_verdict, low_confidence or taken."""
    df = verdicts.join(pending.select("id", F.lit(True).alias("p")).distinct(), "id", "left")
    outcome: Column = F.when(F.col("p").isNull(), "unknown_id").when(~F.coalesce(F.col("verdict").isin(allowed), F.lit(False)), "unknown_verdict")
    return df.withColumn("outcome", outcome.when(~F.col("confidence").eqNullSafe(F.lit(confidence)), "low_confidence").otherwise("taken")).drop("p")


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged): a file of JSON lines by its schema, and the lines that are no JSON object of it, as text. Blank lines go."""
    text = spark.read.text(path).where(F.trim("value") != "")
    parsed = text.select("value", F.from_json("value", f"{schema}, __damaged string", {"columnNameOfCorruptRecord": "__damaged"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r.__damaged").isNotNull()
    return parsed.where(~bad).select("r.*").drop("__damaged"), parsed.where(bad).select("value")


def write_lines(df: DataFrame, path: str) -> None:
    """Decisions or a review queue as JSON lines; fields that are null are written, so that every line has all of them."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def cached_spans(spans: DataFrame, path: str, stamp: str) -> DataFrame:
    """spans as computed once for this stamp (prompt, model, version): read from path where they stand, else written there."""
    spark = spans.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/stamp={stamp}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spans.write.mode("overwrite").parquet(f"{path}/stamp={stamp}")
    return spark.read.schema(spans.schema).parquet(f"{path}/stamp={stamp}")
