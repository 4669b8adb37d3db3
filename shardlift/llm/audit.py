"""Filter interaction audit: removals of every coalition of filters, their potentials, steps of every order."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.shared import write_shared

MIN_WORDS = 200
# Per cent of the words that have to be distinct.
MIN_DISTINCT = 50
# Per cent of the characters that may be capitals.
MAX_CAPITALS = 3
SYMBOLS = "[#$%&*|]"
GAMES = ("all", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions on a text itself, by the letter of their filter. A null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    # The array is bound once; both sizes come from it.
    sizes = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": sizes["n"] < MIN_WORDS,
        "B": 100 * sizes["d"] < MIN_DISTINCT * sizes["n"],
        "C": 100 * capitals > MAX_CAPITALS * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def repeats(docs: DataFrame, key: str, digest: str) -> DataFrame:
    """Adds `_again`: some row with a smaller key has the same digest. Null keys are neither smaller nor larger.

    Only digests with two keys or more are joined back, one row for each, so the join stays narrow; the least key
    is found map-side, so a text with a third of all rows is one row for each task.
    """
    shared = (
        docs.groupBy(digest)
        .agg(F.min(key).alias("_least"), F.max(key).alias("_most"))
        .where("_least < _most")
        .select(F.col(digest).alias("_digest"), "_least")
    )
    joined = docs.join(write_shared(shared, "repeats"), F.col(digest) == F.col("_digest"), "left")
    return joined.withColumn("_again", F.coalesce(F.col(key) > F.col("_least"), F.lit(False))).drop("_digest", "_least")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, mask, all, good, toxic): documents by the set of filters they fail, as bits, A the lowest."""
    # Names first, so that other columns of the tables cannot clash.
    text = F.coalesce(F.col("text"), F.lit(""))
    failed = list(text_failures(text).values())
    bits = sum((F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(failed)), F.lit(0))
    narrow = docs.select(
        F.col("doc_id").alias("key"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"),
        bits.alias("bits"),
    )
    narrow = repeats(write_shared(narrow, "failures"), "key", "digest")
    # A document with several label rows is good or toxic if one of them says so.
    marks = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = narrow.join(marks.where("good = 1 OR toxic = 1"), "key", "left")
    mask = F.col("bits") + F.when(F.col("_again"), F.lit(1 << len(failed))).otherwise(0)
    return marked.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("all"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def coalition_values(counts: DataFrame, filters: str) -> DataFrame:
    """For each part its documents `n`, and for each game an array: what each coalition of filters removes.

    A coalition is a set of filters as bits and the position in the array; it removes whatever fails one of them.
    """
    masks = 1 << len(filters)
    coalition = F.col("coalition")
    removed = (
        counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(masks - 1))))
        .groupBy("part", "coalition")
        .agg(
            F.sum("all").alias("n"),
            *(
                F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(coalition) != 0, F.col(g))), F.lit(0)).alias(g)
                for g in GAMES
            ),
        )
    )
    ordered = F.array_sort(F.collect_list(F.struct("coalition", *GAMES)))
    parts = removed.groupBy("part").agg(F.max("n").alias("n"), ordered.alias("v"))
    return parts.select("part", "n", *(F.col("v")[g].alias(g) for g in GAMES))


def potentials(values: Column, players: int) -> Column:
    """Potentials of all coalitions of a game, by the recursion |S| P(S) = v(S) + sum of P(S without i).

    They are times players!, so that all are whole: P is a sum of dividends over the sizes of their coalitions.
    """
    scale = 1
    for k in range(2, players + 1):
        scale *= k
    bit = [1 << i for i in range(players)]

    def following(known: Column, s: Column) -> Column:
        below = sum(
            (F.when(s.bitwiseAND(b) != 0, F.get(known, s - b)).otherwise(F.lit(0).cast("long")) for b in bit),
            F.get(values, s).cast("long") * scale,
        )
        # Spark's whole division keeps longs exact.
        return F.concat(known, F.array(F.call_function("div", below, F.bit_count(s).cast("long"))))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), start, following)


def audit(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Rows (part, filter_order, step, …) for every part and every order of the filters.

    The Shapley value of a filter is the potential of all filters minus the potential without it. It is summed over
    all orders. What a filter removes at a step is the difference between the coalitions after and before it.

    A part without failures has rows of zeros; no documents give no rows; several copies of a row count each. Null
    texts are empty texts; the null language is the part ''. Labels of unknown documents and null labels count
    nothing.
    """
    n_filters = len(filters)
    full = (1 << n_filters) - 1
    orders = ["".join(p) for p in permutations(filters)]
    parts = coalition_values(counts, filters).withColumn("potential", potentials(F.col("all"), n_filters))
    steps = parts.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " "))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(n_filters)))
    )

    def bits(letters: Column) -> Column:
        return sum(
            (F.when(F.contains(letters, F.lit(f)), F.lit(1 << k)).otherwise(0) for k, f in enumerate(filters)), F.lit(0)
        )

    steps = steps.select(
        "*",
        bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)).alias("before"),
        bits(F.substring("filter_order", F.col("step"), F.lit(1))).alias("own"),
    )
    after = F.col("before") + F.col("own")

    def lost(game: str) -> Column:
        return F.get(game, after) - F.get(game, F.col("before"))

    without = F.lit(full) - F.col("own")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - F.get("all", after)).alias("kept"),
        lost("all").alias("removed"),
        (F.get("all", F.col("own")) - lost("all")).alias("redundant"),
        (F.get("all", F.lit(full)) - F.get("all", without)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(full)) - F.get("potential", without)).alias("shapley"),
    )
