"""Chat formatting: tool calls linked with their results (DataFrame operations only).

Calls and results are joined by conversation and identifier with a hash join. Calls are put in topological order of what they
say they come after: a call's rank is how many waits for something that doesn't stand before it lie on the way of waits to it (of
several ways, the most). So rank, turn and place are an order in which each call comes after what it waits for, and where all stand in
order already their ranks are 0. Calls that wait for each other in a circle, at once or by others, are marked cyclic; among them there
is no order, so they share a rank, and the waits within a circle don't count. What is behind a circle is in order again.

Ranks grow along waits until none grows any more; besides the waits each call holds one way far back that doubles in length each
round, so a chain of n calls takes about log n rounds. A rank beyond the number of a conversation's waits for what doesn't stand
before shows that a circle leads there. Only in such conversations circles are looked for: among calls that lead to a circle and are
led to by one, each takes the greatest name that reaches it, and those that reach back to the call of that name are one circle. Then
ranks are counted once more with each circle as one call. Arguments are validated against the tool's schema, and each call is
serialised with its result as canonical JSON: keys sorted, no blanks, numbers and strings as they parse.

Nothing is gathered per conversation: the order is given by columns (rank, turn, place), and joins are per call, but for the one
that leaves out conversations in order, in which frequent conversations are broadcast. So a conversation that holds a third of
all rows doesn't meet in one task. An identifier that repeats is reduced to its first result before the join. Each
round's tables are written to the shared folder; where there are few waits (they are counted first) in one part, and broadcast.

Defined cases: of calls that repeat an identifier each is kept and linked to the same result; of results that repeat one the
first by turn, place and content counts; results without a call are given as orphans; calls without a result as unanswered;
null or broken arguments are invalid; an unknown tool is invalid; null identifiers link to nothing; what a call waits for and
isn't there is ignored; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import forget, join_groups, settle

# A tool's schema: field -> (type, required). Types as in JSON Schema.
Schemas = dict[str, dict[str, tuple[str, bool]]]
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*", "null": "VOID"}


def faults(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments (a variant), as a text; empty if nothing is."""
    out = F.lit("unknown tool")
    for tool, fields in schemas.items():
        found = []
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_variant_get(arguments, f"$.{field}", "variant")
            wrong = ~F.schema_of_variant(value).rlike(f"^({TYPES[kind]})$")
            found.append(F.when(value.isNull(), F.lit(f"{field} is missing") if required else F.lit(None).cast("string")).when(wrong, F.lit(f"{field} is not {kind}")))
        shape = F.when(~F.schema_of_variant(arguments).startswith("OBJECT<"), F.lit("not an object"))
        out = F.when(name == tool, F.coalesce(shape, F.concat_ws("; ", *found))).otherwise(out)
    return F.when(arguments.isNull(), F.lit("not JSON")).when(name.isNull(), F.lit("unknown tool")).otherwise(out)


def waits(calls: DataFrame) -> DataFrame:
    """calls: conv_id, call_id, turn, place, after (array of call ids). Per call and other call that it waits for: conv_id, call_id,
    need, and back: 1 if what it waits for doesn't stand before it, else 0."""
    place = F.struct("turn", "place")
    named = calls.where("call_id is not null").select("conv_id", "call_id", place.alias("own"), "after")
    there = named.groupBy("conv_id", F.col("call_id").alias("need")).agg(F.min("own").alias("there"))
    each = named.select("conv_id", "call_id", "own", F.explode("after").alias("need")).where("need is not null").join(there, ["conv_id", "need"])
    return each.groupBy("conv_id", "call_id", "need").agg(F.max(F.when(F.col("there") < F.col("own"), 0).otherwise(1).cast("bigint")).alias("back"))


class Held:
    """The tables of a computation in rounds, written to the shared folder; what a round has replaced is removed. small: in one part each,
    and joined by broadcasts."""

    def __init__(self, spark: SparkSession, small: bool):
        self.spark, self.small, self.paths = spark, small, {}

    def keep(self, df: DataFrame, what: str, instead_of: DataFrame | None = None) -> DataFrame:
        found, path = settle(df.coalesce(1) if self.small else df, what)
        found = found.coalesce(1) if self.small else found  # one part needs no shuffle
        self.paths[id(found)] = (found, path)  # the table is kept alive, and so its id its own
        if instead_of is not None:
            self.drop(instead_of)
        return found

    def drop(self, df: DataFrame) -> None:
        _, path = self.paths.pop(id(df))
        forget(self.spark, path)

    def side(self, df: DataFrame) -> DataFrame:
        """For the smaller side of a join: with at most a row for each wait."""
        return F.broadcast(df) if self.small else df


KEYS = ["conv_id", "call_id"]


def longest(edges: DataFrame, held: Held) -> DataFrame:
    """edges: conv_id, call_id, need, back. Of each call that waits for something: rank, the most waits with back = 1 on a way from it, and
    endless: it leads to a circle of them."""
    most = edges.groupBy("conv_id").agg(F.sum("back").alias("most"))
    # far: a call further back, and over: how much the rank grows on the way from it
    state = edges.groupBy(*KEYS).agg(F.max(F.struct("back", "need")).alias("f")).join(held.side(most), "conv_id")
    state = held.keep(state.select(*KEYS, "most", F.lit(0).cast("bigint").alias("rank"), F.col("f.need").alias("far"), F.col("f.back").alias("over"), F.lit(True).alias("grew")), "ranks")
    while True:
        of_need = state.select("conv_id", F.col("call_id").alias("need"), F.col("rank").alias("r"))
        steps = edges.join(held.side(of_need), ["conv_id", "need"], "left").groupBy(*KEYS).agg(F.max(F.struct((F.coalesce("r", F.lit(0)) + F.col("back")).alias("r"), "need", "back")).alias("step"))
        of_far = state.select("conv_id", F.col("call_id").alias("far"), F.col("rank").alias("far_rank"), F.col("far").alias("farther"), F.col("over").alias("more"))
        both = state.join(held.side(steps), KEYS).join(held.side(of_far), ["conv_id", "far"], "left")
        known = F.greatest("rank", F.coalesce("far_rank", F.lit(0)) + F.col("over"))
        grown = F.least(F.greatest(known, F.col("step.r")), F.col("most") + 1)
        turned = F.col("step.r") > known  # a step leads to more than the way held: go on from there
        state = held.keep(
            both.select(
                *KEYS,
                "most",
                grown.alias("rank"),
                F.when(turned, F.col("step.need")).otherwise(F.coalesce("farther", "far")).alias("far"),
                F.when(turned, F.col("step.back")).otherwise(F.least(F.col("over") + F.coalesce("more", F.lit(0)), F.col("most") + 1)).alias("over"),
                (grown > F.col("rank")).alias("grew"),
            ),
            "ranks",
            state,
        )
        if state.where("grew").isEmpty():
            return state.select(*KEYS, "rank", (F.col("rank") > F.col("most")).alias("endless"))


def swapped(edges: DataFrame) -> DataFrame:
    return edges.select("conv_id", F.col("need").alias("call_id"), F.col("call_id").alias("need"), "back")


def within(edges: DataFrame, nodes: DataFrame, held: Held) -> DataFrame:
    """Edges both of whose calls are among the nodes."""
    nodes = nodes.select(*KEYS)
    return edges.join(held.side(nodes), KEYS, "left_semi").join(held.side(nodes.withColumnRenamed("call_id", "need")), ["conv_id", "need"], "left_semi")


def spread(edges: DataFrame, values: DataFrame, held: Held) -> DataFrame:
    """values: conv_id, call_id, value (null is less than any). Each call's greatest value of those on the ways of waits to it."""
    values = held.keep(values.select(*KEYS, "value"), "circles")
    while True:
        given = edges.join(held.side(values.select("conv_id", F.col("call_id").alias("need"), "value")), ["conv_id", "need"]).groupBy(*KEYS).agg(F.max("value").alias("given"))
        found = values.join(held.side(given), KEYS, "left").select(*KEYS, F.greatest("value", "given").alias("value"), (F.col("given") > F.coalesce("value", F.lit(""))).alias("grew"))
        grown = held.keep(found, "circles")
        done = grown.where(F.coalesce("grew", F.lit(False))).isEmpty()
        held.drop(values)
        values = grown
        if done:
            return values.select(*KEYS, "value")


def circles(edges: DataFrame, endless: DataFrame, held: Held) -> DataFrame:
    """conv_id, call_id, circle (the greatest name in it) of the calls that wait for themselves, at once or by others. endless: the calls
    that lead to circles."""
    selves = edges.where("call_id = need").select(*KEYS, F.col("call_id").alias("circle"))
    left, found = edges.where("call_id <> need"), selves.limit(0)
    left, turns = held.keep(within(left, endless, held), "circles"), [swapped]
    while True:
        # what a circle leads to and what leads to one: the others peel off
        for turn in turns:
            if not left.isEmpty():
                left = held.keep(within(left, longest(turn(left), held).where("endless"), held), "circles")
        if left.isEmpty():
            break
        turns = [lambda e: e, swapped]
        nodes = left.select(*KEYS).union(left.select("conv_id", "need")).distinct()
        colour = held.keep(spread(left, nodes.withColumn("value", F.col("call_id")), held), "circles")
        mine = colour.select(*KEYS, F.col("value").alias("circle"))
        alike = left.join(held.side(mine), KEYS).join(held.side(mine.toDF("conv_id", "need", "other")), ["conv_id", "need"]).where(F.col("circle") == F.col("other"))
        alike = held.keep(alike.select("conv_id", "call_id", "need", "back"), "circles")
        back = spread(swapped(alike), mine.select(*KEYS, F.when(F.col("call_id") == F.col("circle"), F.col("circle")).alias("value")), held)
        one = held.keep(back.where("value is not null").select(*KEYS, F.col("value").alias("circle")), "circles")
        found = held.keep(found.union(one), "circles")
        left = held.keep(left.join(held.side(one.select(*KEYS)), KEYS, "left_anti").join(held.side(one.select("conv_id", F.col("call_id").alias("need"))), ["conv_id", "need"], "left_anti"), "circles")
    # a circle of one call is none unless it waits for itself
    several = found.groupBy("conv_id", "circle").agg(F.count(F.lit(1)).alias("calls")).where("calls > 1").drop("calls")
    both = found.join(held.side(several), ["conv_id", "circle"]).select(*KEYS, "circle").union(selves)
    return both.groupBy(*KEYS).agg(F.max("circle").alias("circle"))


def ranks(calls: DataFrame, small: int = 1 << 16) -> DataFrame | None:
    """conv_id, call_id, rank and cyclic of the calls that wait for something, or are waited for, in a conversation that doesn't stand in
    order; None where all do. small: up to how many waits tables are broadcast."""
    spark = calls.sparkSession
    every, path = settle(waits(calls), "waits")
    # conversations in which something waits for what doesn't stand before it: all ranks in others are 0
    most = settle(every.groupBy("conv_id").agg(F.sum("back").alias("most"), F.count(F.lit(1)).alias("edges")).where("most > 0"), "waits")[0]
    n = most.agg(F.sum("edges")).first()[0]
    if not n:
        return None
    held = Held(spark, n <= small)
    edges = held.keep(join_groups(every, most, "conv_id", "edges").select("conv_id", "call_id", "need", "back"), "waits")
    forget(spark, path)
    found = longest(edges, held)
    endless = found.where("endless").select(*KEYS)
    if endless.isEmpty():
        return found.select(*KEYS, "rank", F.lit(False).alias("cyclic"))
    odd = held.keep(endless.select("conv_id").distinct(), "circles")
    others = found.join(held.side(odd), "conv_id", "left_anti").select(*KEYS, "rank", F.lit(False).alias("cyclic"))
    edges = held.keep(edges.join(held.side(odd), "conv_id", "left_semi"), "waits")
    several = held.keep(circles(edges, endless, held), "circles")
    named = lambda name, to: several.select("conv_id", F.col("call_id").alias(name), F.col("circle").alias(to))
    # each circle as one call, by the name of its greatest; the waits within it don't count
    whole = edges.join(held.side(named("call_id", "c")), KEYS, "left").join(held.side(named("need", "d")), ["conv_id", "need"], "left")
    whole = whole.select("conv_id", F.coalesce("c", "call_id").alias("call_id"), F.coalesce("d", "need").alias("need"), "back").where("call_id <> need")
    whole = held.keep(whole.groupBy("conv_id", "call_id", "need").agg(F.max("back").alias("back")), "waits")
    of = longest(whole, held).select("conv_id", F.col("call_id").alias("circle"), "rank")
    nodes = edges.select(*KEYS).union(edges.select("conv_id", "need")).distinct().join(held.side(several), KEYS, "left")
    nodes = nodes.select(*KEYS, F.coalesce("circle", "call_id").alias("circle"), F.col("circle").isNotNull().alias("cyclic"))
    return others.union(nodes.join(held.side(of), ["conv_id", "circle"], "left").select(*KEYS, F.coalesce("rank", F.lit(0).cast("bigint")).alias("rank"), "cyclic"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """calls: conv_id, turn, place, call_id, name, arguments (JSON text), after; results: conv_id, turn, place, call_id, content.

    Returns conv_id, call_id, rank, turn, place, status (linked, unanswered, orphan), valid, faults, cyclic, json.
    """
    calls = calls.select("conv_id", "turn", "place", "call_id", "name", "arguments", "after")
    parsed = calls.withColumn("parsed", F.try_parse_json(F.col("arguments")))
    first = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "content")).alias("r"))
    joined = parsed.join(first.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    order = ranks(calls)
    if order is None:
        joined = joined.withColumns({"rank": F.lit(0), "cyclic": F.lit(False)})
    else:
        joined = joined.join(order, ["conv_id", "call_id"], "left")
    fault = faults(F.col("name"), F.col("parsed"), schemas)
    body = F.to_json(
        F.struct(
            F.coalesce(F.parse_json(F.to_json("parsed")), F.parse_json(F.lit("null"))).alias("arguments"),
            F.col("call_id").alias("id"),
            F.col("name").alias("name"),
            F.col("r.content").alias("result"),
        ),
        {"ignoreNullFields": "false"},
    )
    linked = joined.select(
        "conv_id",
        "call_id",
        F.coalesce("rank", F.lit(0)).cast("bigint").alias("rank"),
        "turn",
        "place",
        F.when(F.col("r").isNull(), "unanswered").otherwise("linked").alias("status"),
        (fault == "").alias("valid"),
        fault.alias("faults"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        body.alias("json"),
    )
    known = calls.where("call_id is not null").select("conv_id", "call_id").distinct()
    alone = results.join(known, ["conv_id", "call_id"], "left_anti")
    orphan = alone.select("conv_id", "call_id", F.lit(0).cast("bigint").alias("rank"), "turn", "place", F.lit("orphan").alias("status"), F.lit(False).alias("valid"), F.lit("no call").alias("faults"), F.lit(False).alias("cyclic"), F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result")), {"ignoreNullFields": "false"}).alias("json"))
    return linked.unionByName(orphan)


def from_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table of turns as calls and results, each turn as one of them. Its identifier is its number.

    A user's turn asks the tool `reply`; a turn of the assistant (or of a tool) is the result of the turn before it; a turn of any
    other role (system, null) asks the tool `instruct`. Calls come after those of the two turns before."""
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.lit(0).alias("place"), F.coalesce(F.lower("role"), F.lit("")).alias("role"), "text")
    arguments = F.to_json(F.struct(F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"), F.col("text").alias("prompt")), {"ignoreNullFields": "false"})
    after = F.array((F.col("turn") - 2).cast("string"), (F.col("turn") - 1).cast("string"))
    name = F.when(F.col("role") == "user", "reply").otherwise("instruct")
    calls = turns.where("role not in ('assistant', 'tool')").select("conv_id", "turn", "place", F.col("turn").cast("string").alias("call_id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = turns.where("role in ('assistant', 'tool')").select("conv_id", "turn", "place", (F.col("turn") - 1).cast("string").alias("call_id"), F.col("text").alias("content"))
    return calls, results


TURNS: Schemas = {tool: {"prompt": ("string", True), "n_bytes": ("integer", True)} for tool in ("reply", "instruct")}
