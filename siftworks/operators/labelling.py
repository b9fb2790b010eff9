"""Lead records to labels: instant rules, batches for a model, its answers, and their join back."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions import classify
from siftworks.functions.text import clean_field, content_words, strip
from siftworks.session import cut


def split_classes(leads: DataFrame) -> DataFrame:
    """Adds lead_class; one pass, one CASE."""
    return leads.withColumn("lead_class", classify.lead_class(F.col("Brand_Stage"), F.col("Title"), F.col("Meta_Description"), F.col("Page_Text"), F.col("Domain")))


def instant(classed: DataFrame) -> DataFrame:
    """Rows of instant classes with their labels."""
    labels = F.create_map(*[x for k, v in rules.INSTANT.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    found = classed.withColumn("__label", F.try_element_at(labels, F.col("lead_class"))).where("__label is not null")
    return found.withColumns({c: F.col("__label")[i] for i, c in enumerate(rules.LABEL_COLUMNS)}).drop("__label")


def numbered(rows: DataFrame, *key: str | Column, ranges: int | None = None, steady: bool = False) -> DataFrame:
    """Adds place, from 0, in order of the key. Rows alike in all of it are numbered in any order.

    Rows are numbered within ranges of the key and shifted by what the ranges before hold, so that no task has to number all. Rows with
    one key are told apart by where they lie, so that ranges split them, too: no key, however common, fills a task. Where they lie has
    to be the same whenever it is asked: rows are cut first, unless they are steady (of files or cut already, and filtered at most).
    The ranges, as many as a shuffle has partitions but 64 at least, are cut as well: both uses must see the same ones.
    """
    ranges = ranges or max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    key = [F.col(k) if isinstance(k, str) else k for k in key]
    names = [f"__key{k}" for k in range(len(key))] + ["__tie"]
    told = (rows if steady else cut(rows)).withColumns(dict(zip(names, [*key, F.monotonically_increasing_id()], strict=True)))
    parts = cut(told.repartitionByRange(ranges, *names)).withColumn("__part", F.spark_partition_id())
    inner = parts.withColumn("__n", F.row_number().over(W.partitionBy("__part").orderBy(*names)))
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))  # at most `ranges` rows
    return inner.join(F.broadcast(offsets), "__part").withColumn("place", F.col("__before") + F.col("__n") - 1).drop("__part", "__n", "__before", *names)


def number_batches(rows: DataFrame, *key: str, size: int = rules.BATCH_SIZE, ranges: int | None = None, steady: bool = False) -> DataFrame:
    """Adds batch and index: consecutive rows in order of the key columns, `size` to a batch. See numbered()."""
    found = numbered(rows, *key, ranges=ranges, steady=steady)
    return found.withColumn("batch", F.floor(F.col("place") / size).cast("bigint")).withColumn("index", (F.col("place") % size).cast("int")).drop("place")


def request_item(title: Column, meta: Column, text: Column, domain: Column, index: Column) -> Column:
    return F.struct(index.cast("int").alias("index"), F.coalesce(domain, F.lit("")).alias("domain"), clean_field(title, 150).alias("title"), clean_field(meta, 300).alias("meta"), content_words(text, domain).alias("content"))


def told(leads: DataFrame) -> DataFrame:
    """Domain, and told: what a request says of each row, so that whole texts needn't be moved when rows are numbered."""
    item = request_item(F.col("Title"), F.col("Meta_Description"), F.col("Page_Text"), F.col("Domain"), F.lit(0))
    return leads.select("Domain", item.alias("told"))


def requests(numbered: DataFrame) -> DataFrame:
    """One row per batch: its JSON request. A batch holds a bounded number of rows: those of leads, or of told()."""
    if "told" in numbered.columns:
        item = F.struct(F.col("index").cast("int").alias("index"), *[F.col(f"told.{c}").alias(c) for c in ("domain", "title", "meta", "content")])
    else:
        item = request_item(F.col("Title"), F.col("Meta_Description"), F.col("Page_Text"), F.col("Domain"), F.col("index"))
    return numbered.select("batch", item.alias("item")).groupBy("batch").agg(F.to_json(F.array_sort(F.collect_list("item"))).alias("request"))


def envelopes(requests_: DataFrame, model: str, instructions: str, temperature: float = 0.0) -> DataFrame:
    """batch, request: each batch's request in the envelope that a chat service takes: the model's name, the instructions as the system's
    message, the batch as the user's, how free the answer may be, and that it has to be a JSON object."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    whole = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(instructions)), message("user", F.col("request"))).alias("messages"),
        F.lit(temperature).alias("temperature"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
    )
    return requests_.select("batch", F.to_json(whole).alias("request"))


class RateLimited(Exception):
    """What a model raises to be asked again later. seconds: how much later."""

    def __init__(self, seconds: float = rules.LONG_WAIT):
        super().__init__(seconds)
        self.seconds = seconds


def is_json(raw: str) -> bool:
    """Does the answer read as JSON, with or without a fence?"""
    body = raw.strip()
    if body.startswith("```"):
        body = body.partition("\n")[2].rpartition("\n")[0].removeprefix("json")
    try:
        return isinstance(json.loads(body), dict | list)
    except ValueError:
        return False


def ask_once(model: Callable[[str], str], request: str, attempts: int, sleep: Callable[[float], None]) -> tuple[str | None, str | None, int]:
    """The answer or the last failure's name, and how many attempts it took. The wait grows with each, or is what the failure asks for."""
    error = None
    for n in range(1, attempts + 1):
        wait = rules.BACK_OFF * n
        try:
            raw = model(request)
            if is_json(raw):
                return raw, None, n
            error = "JSON_ERROR"
        except RateLimited as e:
            error, wait = "RATE_LIMITED", e.seconds
        except ConnectionError:
            error, wait = "CONNECTION_ERROR", rules.LONG_WAIT
        except TimeoutError:
            error = "TIMEOUT"
        except Exception:
            error = "UNKNOWN_ERROR"
        if n < attempts:
            sleep(wait)
    return None, error, attempts


def ask(requests_: DataFrame, model: Callable[[str], str], attempts: int = rules.ATTEMPTS, sleep: Callable[[float], None] = time.sleep, pause: float = 0.0, lanes: int | None = None) -> DataFrame:
    """batch, raw, error, tries: the model's answers. A batch whose attempts all fail has an error and no answer.

    pause: seconds between a task's batches. lanes: how many tasks ask side by side at most; with both, a service gets lanes / pause
    requests a second at most, besides those that are tried again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for frame in frames:
            out = []
            for batch, request in zip(frame["batch"], frame["request"], strict=True):
                if pause and not first:
                    sleep(pause)
                first = False
                out.append((batch, *ask_once(model, request, attempts, sleep)))
            yield pd.DataFrame(out, columns=["batch", "raw", "error", "tries"])

    return (requests_.coalesce(lanes) if lanes else requests_).mapInPandas(run, "batch bigint, raw string, error string, tries int")


def outcome(numbered: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: processed (rows), skipped (rows whose batch got no answer) and retries (attempts that failed)."""
    sizes = numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    failed = F.col("error").isNotNull()
    counts = sizes.join(answers.select("batch", "error", "tries"), "batch", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return counts.agg(total(F.col("n")).alias("processed"), total(F.when(failed, F.col("n"))).alias("skipped"), total(F.col("tries") - F.when(failed, 0).otherwise(1)).alias("retries"))


def message_content(response: Column) -> Column:
    """The answer's text in the envelope that a chat service sends; null if it isn't there."""
    return F.get_json_object(response, rules.CONTENT_PATH)


def answer_text(raw: Column) -> Column:
    """Without the fence that some models put around their answer."""
    text = strip(raw)
    lines = F.split(text, "\n")
    inner = F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 2, F.lit(0))), "\n")
    unfenced = F.when(F.startswith(inner, F.lit("json")), strip(F.substr(inner, F.lit(5)))).otherwise(inner)
    return F.when(F.startswith(text, F.lit("```")), unfenced).otherwise(text)


def is_kind(v: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def parse_answers(answers: DataFrame) -> DataFrame:
    """answers: batch, raw. One row per item: batch, pos, index, domain, pitch, biz, prod; broken answers give one row with error.

    The items are a list, or stand below `items`, else below the first key that has a list, else the object is the one item. An answer is
    parsed once, into a variant, whose items are rows by a lateral join; of its text only the order of its keys is asked for, as a variant
    has none."""
    spark = answers.sparkSession
    parsed = answers.select("batch", answer_text(F.col("raw")).alias("text")).select("batch", "text", F.try_parse_json("text").alias("v"))
    field = lambda key: F.try_variant_get("v", F.concat(F.lit('$["'), key, F.lit('"]')), "variant")
    named, keys = F.try_variant_get("v", "$.items", "variant"), F.filter(F.json_object_keys("text"), lambda k: ~F.contains(k, F.lit('"')))
    below = F.get(F.filter(F.transform(keys, field), lambda x: is_kind(x, "ARRAY<")), F.lit(0))
    filled = is_kind(named, "ARRAY<") & F.try_variant_get(named, "$[0]", "variant").isNotNull()
    of_object = F.when(filled, named).otherwise(F.coalesce(below, F.to_variant_object(F.array("v"))))
    held = F.when(is_kind(F.col("v"), "ARRAY<"), F.col("v")).when(is_kind(F.col("v"), "OBJECT<"), of_object)
    found = parsed.select("batch", held.alias("held"), F.when(held.isNull(), "JSON_ERROR").alias("error"))
    rows = found.lateralJoin(spark.tvf.variant_explode_outer(F.col("held").outer())).where(F.col("error").isNotNull() | is_kind(F.col("value"), "OBJECT<"))
    of = lambda c: F.try_variant_get("value", f"$.{c}", "string")
    items = rows.select("batch", "error", "pos", of("index").try_cast("int").alias("index"), F.coalesce(of("domain"), F.lit("")).alias("domain"), *[of(c).alias(c) for c in ("pitch_category", "true_business_type", "true_product_category")])
    real = lambda c: F.when(F.col("error").isNull(), c)
    known = lambda c: real(F.coalesce(F.nullif(F.col(c), F.lit("Unknown")), F.lit("")))
    pitch = classify.normalise_category(*(F.col(c) for c in ("pitch_category", "domain", "true_business_type", "true_product_category")))
    return items.select("batch", "error", "pos", "index", "domain", real(pitch).alias("pitch"), known("true_business_type").alias("biz"), known("true_product_category").alias("prod"))


def last_by(items: DataFrame, key: str) -> DataFrame:
    """Of items that share a key within a batch the last counts."""
    real = items.where(F.col("error").isNull() & F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return real.groupBy("batch", key).agg(F.max_by(F.struct("pitch", "biz", "prod"), "pos").alias("found"))


def look_up(numbered: DataFrame, items: DataFrame) -> DataFrame:
    """numbered: batch, index, Domain and more. Adds the labels: by domain, else by index, else the defaults."""
    by_domain = last_by(items, "domain").select("batch", F.col("domain").alias("Domain"), F.col("found").alias("__d"))
    by_index = last_by(items, "index").select("batch", "index", F.col("found").alias("__i"))
    joined = numbered.join(by_domain, ["batch", "Domain"], "left").join(by_index, ["batch", "index"], "left")
    found = F.coalesce("__d", "__i")
    review = lambda c: F.coalesce(F.nullif(found[c], F.lit("")), F.lit(rules.REVIEW))
    return joined.withColumns({"Pitch_Category": F.coalesce(found["pitch"], F.lit(rules.GENERAL)), "Business_Type": review("biz"), "Product_Category": review("prod")}).drop("__d", "__i")


def final_columns(leads: DataFrame) -> DataFrame:
    """Labels first, then the others in their order."""
    return leads.select(*rules.LABEL_COLUMNS, *[c for c in leads.columns if c not in rules.LABEL_COLUMNS])


def label(leads: DataFrame, model: Callable[[str], str], key: str = "Domain", sleep: Callable[[float], None] = time.sleep, keep_class: bool = False) -> DataFrame:
    """All of it: instant classes by rule, the others by the model, in one table.

    Batches are in order of key; rows that share it, by what the model is told of them. The answers are written before they are
    read, so each batch is asked once. keep_class: with lead_class."""
    classed = cut(split_classes(leads))
    todo = number_batches(classed.where("lead_class = 'ai'"), key, *[c for c in ("Title", "Meta_Description", "Page_Text") if c != key], steady=True)
    items = cut(parse_answers(cut(ask(requests(todo), model, sleep=sleep))))
    kept = [c for c in leads.columns if c not in rules.LABEL_COLUMNS]
    wanted = [*rules.LABEL_COLUMNS, *kept, *(["lead_class"] if keep_class else [])]
    return instant(classed).select(wanted).unionByName(look_up(todo.drop(*[c for c in rules.LABEL_COLUMNS if c in todo.columns]), items).select(wanted))


def class_rank() -> Column:
    return F.array_position(F.array(*map(F.lit, rules.CLASS_ORDER)), F.col("lead_class"))


def in_class_order(labelled: DataFrame, key: str = "Domain") -> DataFrame:
    """Rows by lead_class, in the order in which a run hands them out: instant classes first. A sort, for those who need the order."""
    return labelled.orderBy(class_rank(), key)


def rule_model(request: str) -> str:
    """A stand-in for a remote model: answers from the rules, in the form that models answer in."""
    def first(text: str, rules_: list, default: str) -> str:
        return next((name for name, words in rules_ if any(w in text for w in words)), default)

    items = []
    for x in json.loads(request):
        text = " ".join((x["title"], x["meta"], x["content"])).lower()
        business = first(text, rules.BUSINESS, "Unknown")
        items.append({"index": x["index"], "domain": x["domain"], "pitch_category": "🤖 2. SaaS/Tech (NICHE)", "true_business_type": business, "true_product_category": first(text, rules.PRODUCT, "Unknown")})
    return json.dumps({"items": items})
