"""Pages to lead records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions import classify, html
from siftworks.functions.domains import host
from siftworks.functions.text import label0, strip

Translate = Callable[[Column], Column]


def premium(domains: DataFrame, column: str = "domain") -> DataFrame:
    """Rows whose domain is worth a visit; the domain keeps its case."""
    from siftworks.functions.domains import is_premium

    return domains.where(is_premium(F.col(column)))


def in_english(c: Column, translate: Translate | None) -> Column:
    """The text, by `translate` where it is long enough and not mostly ASCII; what that gives no answer for stays as it is."""
    from siftworks.functions.text import needs_translation

    return c if translate is None else F.when(needs_translation(c), F.coalesce(translate(c), c)).otherwise(c)


def enrich(pages: DataFrame, translate: Translate | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """pages: url (or domain) and html. One row per page: the keys and the lead's twelve columns; null where nothing is found.

    translate: an expression over a text that isn't mostly ASCII; the text itself by default. Pages that can't be parsed are
    dropped. One Python parse per page; all else are expressions over its result and the raw markup.
    """
    domain = F.col("domain") if "domain" in pages.columns else host(F.col("url"))
    rows = pages.select(*keep, strip(domain).alias("Domain"), "html").where(F.col("html").isNotNull() & (F.col("Domain") != ""))
    rows = rows.withColumn("p", html.parse_html("html")).where("p.text is not null")
    meta = F.coalesce(F.nullif(F.substring("p.description", 1, 300), F.lit("")), F.nullif(F.substring("p.og_description", 1, 300), F.lit("")))
    rows = rows.withColumn("meta", meta).withColumn("body", html.page_text(F.col("p.text"), label0(F.col("Domain"))))
    classified = F.lower(F.concat(F.coalesce("meta", F.lit("")), F.lit(" "), F.col("body")))
    raw = F.col("html")
    return rows.select(
        *keep,
        "Domain",
        html.brand_stage(raw).alias("Brand_Stage"),
        F.substring(strip(F.nullif(F.col("p.title"), F.lit(""))), 1, 60).alias("Title"),
        F.substring(in_english(strip(F.col("meta")), translate), 1, 300).alias("Meta_Description"),
        F.substring(in_english(F.col("body"), translate), 1, 500).alias("Page_Text"),
        html.emails(raw).alias("Emails"),
        html.phones(raw).alias("Phones"),
        html.socials(F.col("p.hrefs")).alias("Socials_Found"),
        html.tech_stack(raw).alias("Tech_Stack_Ads"),
        html.intent(raw).alias("Intent_Trust"),
        classify.business_type(classified, F.col("p.nav")).alias("Business_Type"),
        classify.product_category(classified).alias("Product_Category"),
    )


def useful(leads: DataFrame) -> DataFrame:
    """Leads with an address, a platform, a technology or a stage. Phones, titles and intent alone don't count."""
    return leads.where("Emails is not null or Socials_Found is not null or Tech_Stack_Ads is not null or Brand_Stage is not null")


def egress(leads: DataFrame) -> DataFrame:
    """The table as it is handed out: the words for what is missing instead of nulls."""
    words = {c: rules.LIVE if c == "Brand_Stage" else rules.MISSING for c in rules.LEAD_COLUMNS}
    return leads.withColumns({c: F.coalesce(F.col(c), F.lit(w)) for c, w in words.items() if c in leads.columns})


def ingress(leads: DataFrame) -> DataFrame:
    """The inverse: words for what is missing become nulls; empty texts stay."""
    return leads.withColumns({c: F.when(F.lower(strip(F.col(c))) != ("live" if c == "Brand_Stage" else "none"), F.col(c)) for c in rules.LEAD_COLUMNS if c in leads.columns})
