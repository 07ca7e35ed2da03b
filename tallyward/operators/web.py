"""Pages and URLs: links with their anchor text, same-site pages worth reading, main text, declared addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Link words in order of worth, path segments that are never content, endings of files, hosts that are no site.
ISSUE_WORDS = ("issue", "priorit", "platform", "plan", "agenda", "legislat", "about", "record")
JUNK_SEGMENTS = (
    "contact", "services", "offices", "office-locations", "events", "committees-and-caucuses", "staff-page",
    "our-district", "press-kit", "newsletter-subscribe", "newsletter-unsubscribe", "survey", "internships",
    "tours-and-tickets", "flags", "grant-applicants", "help-federal-agency", "commendations-and-greetings",
    "art-competition", "congressional-app-challenge", "military-academy-nominations", "request-an-appearance",
    "website-problem", "rss.xml", "privacy", "copyright", "accessibility", "terms-conditions",
)
NOT_ISSUE_SEGMENTS = ("press-releases", "in-the-news", "editorial")
FILE_ENDINGS = ("png", "jpg", "jpeg", "gif", "svg", "pdf", "xml", "ico", "mp4", "mp3")
INDEX_TAILS = ("issues", "priorities", "legislation", "platform", "agenda")
NON_SITE_HOSTS = (
    "facebook.com", "fb.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "youtube.com", "youtu.be",
    "tiktok.com", "threads.net", "actblue.com", "winred.com", "anedot.com", "donorbox.org", "gofundme.com", "linktr.ee",
)
PLACEHOLDER = r"(?i)^(n/?a|none|no|nil|tbd|pending|not applicable|unknown|[-.]+)$"
MIN_TEXT = 400
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
TAGS = r"(?s)<[^>]*>"
CHROME = r"(?is)<(script|style|nav|footer)\b[^>]*>.*?</\1\s*>|<!--.*?-->"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row per link, in page order: key, pos, href, anchor (tags off, blanks squeezed)."""
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(LINK), F.lit(2)).alias("anchor"))
    rows = pages.select(key, F.posexplode(found).alias("pos", "l"))
    return rows.select(key, "pos", F.col("l.href").alias("href"), squeeze(F.regexp_replace("l.anchor", TAGS, " ")).alias("anchor"))


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def absolute(href: Column, base: Column) -> Column:
    """href as seen from base: absolute addresses, //host, /rooted, ?query, #fragment and plain relative paths; . and ..
    segments are resolved one level each."""
    h = F.trim(href)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    here = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(path(base).contains("/"), F.regexp_replace(here, r"/[^/]*$", "/")).otherwise(F.concat(origin, F.lit("/")))
    relative = F.regexp_replace(F.regexp_replace(F.concat(folder, h), r"/(\./)+", "/"), r"/[^/]+/\.\./", "/")
    return (
        F.when(h == "", base).when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, h)).when(h.startswith("?"), F.concat(here, h)).when(h.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), h))
        .otherwise(relative)
    )


def _first_of_each(df: DataFrame, by: list[str], order: str) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where("__n = 1").drop("__n")


def same_site(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, pos, link, path, anchor (both lower case) of links to other pages of the same host: fragment and closing slash
    off, each link once at its first place, the page itself left out."""
    rows = links(pages, key, html).join(pages.select(key, F.col(url).alias("__base")), key)
    rows = rows.withColumn("__abs", absolute(F.col("href"), F.col("__base")))
    rows = rows.where(F.col("__abs").rlike("^https?://") & (host(F.col("__abs")) == host(F.col("__base"))))
    rows = rows.withColumn("link", F.regexp_replace(F.regexp_extract("__abs", r"^([^#]*)", 1), r"/+$", ""))
    rows = rows.where(F.col("link") != F.regexp_replace("__base", r"/+$", ""))
    rows = rows.select(key, "pos", "link", F.lower(path(F.col("__abs"))).alias("path"), F.lower("anchor").alias("anchor"))
    return _first_of_each(rows, [key, "link"], "pos")


def is_junk(path: Column) -> Column:
    segments = F.split(path, "/")
    return F.arrays_overlap(segments, F.array(*[F.lit(s) for s in JUNK_SEGMENTS])) | F.element_at(F.split(path, r"\."), -1).isin(*FILE_ENDINGS)


def issue_links(site: DataFrame, key: str = "page_id", words: tuple[str, ...] = ISSUE_WORDS, cap: int = 8) -> DataFrame:
    """key, rank, link: the first `cap` links by (word that matches in path or anchor, place), no junk, no press segments."""
    hit = [F.when(F.contains("path", F.lit(w)) | F.contains("anchor", F.lit(w)), F.lit(i)) for i, w in enumerate(words)]
    press = F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(s) for s in NOT_ISSUE_SEGMENTS]))
    rows = site.withColumn("__w", F.coalesce(*hit)).where(F.col("__w").isNotNull() & ~is_junk(F.col("path")) & ~press)
    w = Window.partitionBy(key).orderBy("__w", "pos")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap).select(key, "rank", "link")


def press_index(site: DataFrame, key: str = "page_id", in_path: str = "press-release", in_anchor: str = "press releases") -> DataFrame:
    """key, link: the first link to an index of press releases."""
    rows = site.where(~is_junk(F.col("path")) & (F.contains("path", F.lit(in_path)) | F.contains("anchor", F.lit(in_anchor))))
    return rows.groupBy(key).agg(F.min_by("link", "pos").alias("link"))


def child_links(site: DataFrame, pages: DataFrame, key: str = "page_id", url: str = "url", cap: int = 8) -> DataFrame:
    """key, rank, link: links below the page's own path, in page order."""
    base = pages.select(key, F.concat(F.lower(F.regexp_replace(path(F.col(url)), r"/+$", "")), F.lit("/")).alias("__p"))
    rows = site.join(base, key).where(F.startswith(F.regexp_replace("path", r"/+$", ""), F.col("__p")) & ~is_junk(F.col("path")))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("rank") <= cap).select(key, "rank", "link")


def plain(html: Column) -> Column:
    """Tags off, the common entities read, blanks squeezed."""
    text = F.regexp_replace(html, TAGS, " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return squeeze(text)


def main_text(html: Column, least: int = MIN_TEXT) -> Column:
    """The prose of a page without scripts, styles, navigation and footers; null if it has fewer than `least` characters."""
    text = plain(F.regexp_replace(html, CHROME, " "))
    return F.when(F.length(text) >= least, text)


def throttle_key(url: Column) -> Column:
    """The last two labels of the host, by which requests would be spaced."""
    labels = F.split(F.regexp_replace(host(url), r":\d+$", ""), r"\.")
    return F.when(host(url) != "", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))


def declared_url(raw: Column) -> Column:
    """An address that can be fetched from what was filed, else null: scheme and host in lower case, the path as it is."""
    t = F.regexp_replace(F.trim(raw), r"""^[<>"'\s]+|[<>"'\s]+$""", "")
    full = F.when(t.contains("://"), t).otherwise(F.concat(F.lit("https://"), t))
    parts = [F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?", i) for i in range(1, 5)]
    name = F.lower(parts[1])
    sound = (t != "") & ~t.rlike(PLACEHOLDER) & ~(t.contains("@") & ~t.contains("://")) & ~t.rlike(r"[ \t]")
    sound &= F.lower(parts[0]).isin("http", "https") & name.contains(".") & ~name.endswith(".")
    return F.when(sound, F.concat(F.lower(parts[0]), F.lit("://"), name, F.regexp_replace(parts[2], r"/+$", ""), F.when(parts[3] == "?", "").otherwise(parts[3])))


def is_non_site(url: Column, hosts: list[str] = NON_SITE_HOSTS) -> Column:
    h = host(url)
    return reduce(Column.__or__, [(h == b) | h.endswith("." + b) for b in hosts])


def frontier(pages: DataFrame, probes: tuple[str, ...], cap: int = 24, key: str = "page_id", url: str = "url", words: tuple[str, ...] = ISSUE_WORDS) -> DataFrame:
    """What to read next from pages at hand: the page, its issue links, probes not linked, children, press pages; by that
    order, each address once a page, `cap` at most: key, rank, link, origin."""
    site = same_site(pages, key, url)
    own = pages.select(key, F.lit(0).alias("p"), F.lit(0).alias("n"), F.regexp_replace(url, r"/+$", "").alias("link"), F.lit("page").alias("origin"))
    part = lambda d, p, o: d.select(key, F.lit(p).alias("p"), F.col("rank").alias("n"), "link", F.lit(o).alias("origin"))
    probe = F.posexplode(F.array(*[F.lit(x) for x in probes]))
    probed = pages.select(key, F.regexp_replace(F.regexp_extract(url, r"^([^?#]*)", 1), r"/+$", "").alias("b"), probe.alias("n", "x")).select(key, F.lit(2).alias("p"), F.col("n"), F.concat("b", "x").alias("link"), F.lit("probe").alias("origin"))
    press = press_index(site, key).select(key, F.lit(4).alias("p"), F.lit(0).alias("n"), "link", F.lit("press").alias("origin"))
    rows = own.unionByName(part(issue_links(site, key, words), 1, "issue")).unionByName(probed).unionByName(part(child_links(site, pages, key, url), 3, "child")).unionByName(press)
    rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(key, "link").orderBy("p", "n"))).where("__n = 1")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("p", "n"))).where(F.col("rank") <= cap).select(key, "rank", "link", "origin")
