"""Labels by ordered rules: the first that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions.text import any_of, clean_field, content_reaches, content_words, first_match, label0, strip, title_case


def business_type(text: Column, nav: Column | None = None) -> Column:
    whole = text if nav is None else F.concat(text, F.lit(" "), F.array_join(nav, " "))
    return first_match(whole, rules.BUSINESS, rules.BUSINESS_ELSE)


def product_category(text: Column) -> Column:
    return first_match(text, rules.PRODUCT, rules.PRODUCT_ELSE)


def lead_class(stage: Column, title: Column, meta: Column, text: Column, domain: Column) -> Column:
    """parked, prelaunch, no_content or ai: disjoint, in this order."""
    whole = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit(""))))
    fields = F.length(clean_field(title)) + F.length(clean_field(meta))
    bare = (fields < rules.EMPTY_CONTENT) & ~content_reaches(text, domain, rules.EMPTY_CONTENT)
    few = bare & (fields + F.length(content_words(text, domain)) < rules.EMPTY_CONTENT)  # what little there is may add up
    early = (F.lower(F.coalesce(stage, F.lit(""))) == "pre-launch") | any_of(whole, rules.PRELAUNCH)
    return F.when(any_of(whole, rules.PARKED), "parked").when(early, "prelaunch").when(few, "no_content").otherwise("ai")


def normalise_category(pitch: Column, domain: Column, business: Column, product: Column) -> Column:
    """Puts a label into form: its leading emoji, invented roles, and a placeholder for the niche."""
    fixed = pitch
    for wrong, right in rules.LEADING_EMOJI.items():
        fixed = F.when(F.startswith(pitch, F.lit(wrong)), F.concat(F.lit(right), F.substr(pitch, F.lit(len(wrong) + 1)))).otherwise(fixed)
    low = F.lower(fixed)
    role = F.lit(False)
    for word in rules.INVENTED_ROLES:
        role = role | F.startswith(low, F.lit(word)) | F.contains(F.substring(low, 1, 15), F.lit(f" {word}"))
    named = F.when(role, strip(F.concat(F.lit(f"{rules.AGENCIES} "), F.regexp_extract(fixed, r"\(.*?\)", 0)))).otherwise(fixed)
    hint = F.lower(F.concat(F.coalesce(business, F.lit("")), F.lit(" "), F.coalesce(product, F.lit(""))))
    own = F.when(F.coalesce(domain, F.lit("")) == "", "General").otherwise(title_case(label0(domain)))
    niche = F.coalesce(first_match(hint, rules.NICHES, None), own)
    literal = F.regexp_replace(niche, r"([\\$])", r"\\$1")
    filled = F.when(F.contains(F.lower(named), F.lit("(niche)")), F.regexp_replace(named, F.lit(r"(?i)\(NICHE\)"), F.concat(F.lit("("), literal, F.lit(")")))).otherwise(named)
    return F.when(F.coalesce(pitch, F.lit("")) == "", rules.GENERAL).otherwise(filled)
