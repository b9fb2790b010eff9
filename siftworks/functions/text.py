"""Text as Column expressions. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks import rules


def strip(c: Column) -> Column:
    """Without white space at either end, as Unicode has it (trim() takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def quoted(words: Iterable[str]) -> str:
    """A pattern for one of the words, each as it stands."""
    return "|".join(f"\\Q{w}\\E" for w in words)


def any_of(c: Column, words: Iterable[str]) -> Column:
    """Does the text contain one of the words? Plain searches; many of them stand in a lambda, which keeps the generated code small."""
    words = list(words)
    return contains_any(c, words) if len(words) <= 4 else F.exists(F.array(c), lambda t: contains_any(t, words))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def first_match(c: Column, rules_: Iterable[tuple[str, list[str]]], default: str | None) -> Column:
    """The label of the first rule of which a word is in the text. The text is computed once, for the lambda's variable."""

    def pick(t: Column) -> Column:
        first, *others = [(contains_any(t, words), label) for label, words in rules_]
        return reduce(lambda case, rule: case.when(*rule), others, F.when(*first)).otherwise(F.lit(default))

    return F.element_at(F.transform(F.array(c), pick), 1)


def all_matches(c: Column, rules_: Iterable[tuple[str, list[list[str]]]], separator: str) -> Column:
    """The labels, in order, of rules whose lists each have a word in the text; null if none."""
    labels = [F.when(reduce(lambda a, b: a & b, [any_of(c, words) for words in lists]), label) for label, lists in rules_]
    return F.nullif(F.array_join(F.array_compact(F.array(*labels)), separator), F.lit(""))


def missing(c: Column) -> Column:
    """Null, blank, or the word none."""
    return F.coalesce(F.lower(strip(c)), F.lit("")).isin("", "none")


def printable(c: Column) -> Column:
    """Without control, format, separator (but for the blank) and private characters, and those beyond the first plane."""
    return F.regexp_replace(F.regexp_replace(c, r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]", ""), r"[\x{10000}-\x{10FFFF}]", "")


def clean_field(c: Column, most: int = 250) -> Column:
    whole = F.substring(strip(F.translate(printable(c), '\\"', " '")), 1, most)
    return F.when(missing(c), "").otherwise(whole)


def label0(domain: Column) -> Column:
    """What stands before the first dot."""
    return F.split_part(domain, F.lit("."), F.lit(1))


def title_case(c: Column) -> Column:
    """Upper case after anything that isn't a letter."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+|[^a-z]+"), 0), F.initcap), "")


#: Letters whose capital is more than one character, as Java and Python have it, and the one character that Unicode's simple mapping has.
WIDE = [x for x in map(chr, range(0x80, 0x10000)) if len(x.upper()) > 1]
NARROW = "".join("\u1e9e" if x == "\xdf" else x.title() if len(x.title()) == 1 else x for x in WIDE)


def capitals(c: Column) -> Column:
    """Upper case letter by letter, as SQL has it: as many characters as before."""
    wide = "".join(WIDE)
    parts = F.regexp_extract_all(c, F.lit(f"[{wide}]+|[^{wide}]+"), 0)
    return F.array_join(F.transform(parts, lambda x: F.when(F.rlike(x, F.lit(f"^[{wide}]")), F.translate(x, wide, NARROW)).otherwise(F.upper(x))), "")


def ascii_share(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\x00-\x7F]", "")) / F.length(c)


def needs_translation(c: Column) -> Column:
    """Long enough, and not mostly ASCII."""
    return F.coalesce((F.length(strip(c)) >= rules.ASCII_LENGTH) & (ascii_share(c) <= rules.ASCII_SHARE), F.lit(False))


#: Characters of a text that are gone through first.
BEGINNING = 1500


def beginning(text: Column) -> Column:
    """The first characters, up to the last word that surely ends in them; all of a text that has no more."""
    return F.when(F.length(text) <= BEGINNING, text).otherwise(F.regexp_replace(printable(F.substring(text, 1, BEGINNING)), r"[a-zA-Z]+\z", ""))


def kept_words(text: Column, domain: Column) -> Column:
    """Words of three letters or more, in order, without stop words and the domain's own name: structs of low (the word in lower
    case), i (its place) and w (the word)."""
    own = F.regexp_replace(F.lower(label0(F.coalesce(domain, F.lit("")))), "[^a-z0-9]", "")
    words = F.regexp_extract_all(printable(F.coalesce(text, F.lit(""))), F.lit("[a-zA-Z]{3,}"), 0)
    every = F.transform(words, lambda w, i: F.struct(F.lower(w).alias("low"), i.alias("i"), w.alias("w")))
    return F.filter(every, lambda x: ~x["low"].isin(*rules.STOP_WORDS) & (x["low"] != own))


def content_words(text: Column, domain: Column) -> Column:
    """Up to 80 words of three letters or more, each twice at most, without stop words and the domain's own name, in order.

    Sorted by word, a third occurrence follows an equal word two places before; what is left is sorted by place and cut. No row
    leaves its partition. Words hang only on those before: where the beginning of a text has 80, the rest isn't gone through."""

    def chosen(ranked: Column) -> Column:  # the lambda's variable is computed once
        before = F.concat(F.transform(F.slice(ranked, 1, rules.MAX_REPEATS), lambda _: F.lit(None).cast("string")), F.transform(ranked, lambda x: x["low"]))
        once = F.zip_with(ranked, F.slice(before, 1, F.size(ranked)), lambda x, low: F.when(low.isNull() | (low != x["low"]), F.struct(x["i"].alias("i"), x["w"].alias("w"))))
        return F.slice(F.array_sort(F.filter(once, lambda x: x.isNotNull())), 1, rules.MAX_WORDS)

    def of(part: Column) -> Column:
        return F.element_at(F.transform(F.array(F.array_sort(kept_words(part, domain))), chosen), 1)

    enough = lambda found: (F.size(found) >= rules.MAX_WORDS) | (F.length(text) <= BEGINNING)
    found = F.element_at(F.transform(F.array(of(beginning(text))), lambda x: F.when(enough(x), x).otherwise(of(text))), 1)
    return F.when(missing(text), "").otherwise(F.array_join(F.transform(found, lambda x: x["w"]), " "))


def content_reaches(text: Column, domain: Column, least: int) -> Column:
    """Whether content_words() has `least` characters or more. Three words have eleven, so up to that nothing has to be sorted."""
    if least > 11:
        return F.length(content_words(text, domain)) >= least

    def reaches(kept: Column) -> Column:
        several = F.size(F.array_distinct(F.transform(kept, lambda x: x["low"]))) > 1
        first = F.array_join(F.transform(F.slice(kept, 1, rules.MAX_REPEATS), lambda x: x["w"]), " ")
        return ((F.size(kept) > 2) & several) | (F.length(first) >= least)

    of = lambda part: F.element_at(F.transform(F.array(kept_words(part, domain)), reaches), 1)
    return ~missing(text) & (of(beginning(text)) | of(text))
