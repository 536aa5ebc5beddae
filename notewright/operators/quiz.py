"""Multiple-choice items from records, and the course of a tournament."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.functions.arguments import within
from notewright.operators.numbering import number_rows
from notewright.operators.sizing import join_measured
from notewright.session import materialised

_HASH_DIGITS = 15
SHORT_DATASET = 200_000
HASH_CHUNK_BITS = 44  # 2**16 chunks over the 60 bits of the hash


def hash_number(text: Column) -> Column:
    """First 60 bits of the MD5 of a text: a repeatable shuffle order."""
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("bigint")


def eligible_datasets(catalogue: DataFrame) -> DataFrame:
    """Datasets with at least two text fields."""
    return catalogue.filter(F.size("text_fields") > 1)


def value_ring(values: DataFrame, dataset: str, value: str, wrong: int, seed: int = 0, chunk_bits: int = HASH_CHUNK_BITS) -> DataFrame:
    """Per distinct value of a dataset, the ``wrong`` values that follow it in hash order.

    The order is closed to a ring, so each value gets others and never itself. Positions
    come from chunked numbering and neighbours from a join on the position; no task sees
    all values of a dataset.
    """
    distinct = values.select(dataset, value).filter(F.col(value).isNotNull()).distinct()
    keyed = distinct.withColumn("__hash", hash_number(F.concat(F.lit(f"{seed}|"), value)))
    placed = materialised(number_rows(keyed, [dataset], "__hash", "__place", chunk_bits, tie_break=[value]))
    sizes = placed.groupBy(dataset).agg(F.count(F.lit(1)).alias("__size"))
    placed = join_measured(placed, sizes, dataset)
    steps = F.sequence(F.lit(1), F.least(F.lit(wrong).cast("bigint"), F.col("__size") - 1))
    wanted = (
        placed.filter("__size > 1")
        .withColumn("__step", F.explode(steps))
        .select(dataset, value, ((F.col("__place") + F.col("__step")) % F.col("__size")).alias("__place"))
    )
    return wanted.join(placed.select(dataset, F.col(value).alias("option"), "__place"), [dataset, "__place"]).select(
        dataset, value, "option"
    )


def choice_items(
    records: DataFrame,
    prompt: str,
    answer: str,
    options: int = 4,
    dataset: str = "dataset",
    order: str = "ord",
    seed: int = 0,
    chunk_bits: int = HASH_CHUNK_BITS,
) -> DataFrame:
    """``(dataset, ord, prompt, answer, options)``: one item per record that has both fields.

    The right answer is the record's own value; the others are values of other records
    of the dataset. The options are in hash order, different for each record.
    """
    within("options", options, 3, 5)
    items = records.select(
        dataset, order, F.col("text")[prompt].alias("prompt"), F.col("text")[answer].alias("answer")
    ).filter("prompt is not null and answer is not null")
    ring = value_ring(items, dataset, "answer", options - 1, seed, chunk_bits)
    wrong = ring.groupBy(dataset, "answer").agg(F.collect_list("option").alias("__wrong"))
    shuffled = F.transform(
        F.array_sort(
            F.transform(
                F.concat(F.array("answer"), "__wrong"),
                lambda option: F.struct(
                    F.md5(F.concat(F.lit(f"{seed}|"), F.col(order).cast("string"), F.lit("|"), option)).alias("at"),
                    option.alias("option"),
                ),
            )
        ),
        lambda entry: entry["option"],
    )
    return join_measured(items, wrong, [dataset, "answer"]).select(
        dataset, order, "prompt", "answer", shuffled.alias("options")
    )


def cross_dataset_items(
    records: DataFrame,
    prompt_dataset: str,
    prompt: str,
    datasets: Sequence[str],
    order: str = "ord",
    seed: int = 0,
    chunk_bits: int = HASH_CHUNK_BITS,
) -> DataFrame:
    """``(item, prompt, dataset, id, correct, place)``: which id belongs to the prompt?

    Every record of the prompt dataset gives an item with one id from each of 3 to 5
    datasets. Records are numbered in hash order per dataset and paired by number,
    starting over in the shorter datasets. ``place`` is the position of the option.
    """
    within("datasets", len(set(datasets)), 3, 5)
    keyed = records.filter(F.col("dataset").isin(*datasets)).select(
        "dataset", order, "id", F.col("text")[prompt].alias("prompt"),
        hash_number(F.concat(F.lit(f"{seed}|"), F.col(order).cast("string"))).alias("__hash"),
    )
    placed = materialised(number_rows(keyed, ["dataset"], "__hash", "__place", chunk_bits, tie_break=[order]))
    sizes = placed.groupBy("dataset").agg(F.count(F.lit(1)).alias("__size"))  # at most five rows
    items = placed.filter((F.col("dataset") == prompt_dataset) & F.col("prompt").isNotNull()).select(
        F.col(order).alias("item"), "prompt", F.col("__place").alias("__item_place")
    )
    slots = (
        items.withColumn("dataset", F.explode(F.array(*[F.lit(d) for d in dict.fromkeys(datasets)])))
        .join(F.broadcast(sizes), "dataset")
        .withColumn("__place", F.col("__item_place") % F.col("__size"))
    )
    ids = placed.join(F.broadcast(sizes), "dataset").select("dataset", "__place", "id", "__size")
    short = F.col("__size") <= SHORT_DATASET
    # Items reuse the rows of a short dataset many times; those few rows travel to the items.
    options = (
        slots.filter(short)
        .join(F.broadcast(ids.filter(short).drop("__size")), ["dataset", "__place"])
        .unionByName(slots.filter(~short).join(ids.filter(~short).drop("__size"), ["dataset", "__place"]))
        .withColumn("correct", F.col("dataset") == prompt_dataset)
    )
    def mixed(dataset: Column) -> Column:
        return F.md5(F.concat(F.lit(f"{seed}|"), F.col("item").cast("string"), F.lit("|"), dataset))

    # Every item has the same datasets, so a row can tell its place among them by itself.
    present = [row["dataset"] for row in sizes.collect()]
    earlier = [(mixed(F.lit(name)) < mixed(F.col("dataset"))).cast("int") for name in present]
    return options.select("item", "prompt", "dataset", "id", "correct", (F.lit(1) + sum(earlier, F.lit(0))).alias("place"))


def eliminations(
    answers: DataFrame,
    participant: str = "participant",
    round: str = "round",
    correct: str = "correct",
    chunk_bits: int = 17,
) -> DataFrame:
    """``(participant, eliminated_round)``: the round of the first second wrong answer in a row, else null.

    Answers are cut into runs of rounds. Inside a run the previous answer is one row
    back; across runs only the first and last answer of each run matter, so a
    participant with very many answers is still spread over many tasks.
    """
    wrong = answers.select(
        participant,
        F.col(round).cast("bigint").alias("round"),
        (~F.col(correct)).alias("wrong"),
        F.shiftright(F.col(round).cast("bigint"), chunk_bits).alias("run"),
    )
    in_run = Window.partitionBy(participant, "run").orderBy("round")
    second = F.col("wrong") & F.coalesce(F.lag("wrong").over(in_run), F.lit(False))
    runs = (
        wrong.withColumn("second", second)
        .groupBy(participant, "run")
        .agg(
            F.min(F.when(F.col("second"), F.col("round"))).alias("inside"),
            F.min("round").alias("first_round"),
            F.min_by("wrong", "round").alias("first_wrong"),
            F.max_by("wrong", "round").alias("last_wrong"),
        )
    )
    by_run = Window.partitionBy(participant).orderBy("run")
    at_border = F.col("first_wrong") & F.coalesce(F.lag("last_wrong").over(by_run), F.lit(False))
    return (
        runs.withColumn("border", F.when(at_border, F.col("first_round")))
        .groupBy(participant)
        .agg(F.min(F.least("border", "inside")).alias("eliminated_round"))
    )


def tournament_report(
    answers: DataFrame,
    participant: str = "participant",
    round: str = "round",
    correct: str = "correct",
    chunk_bits: int = 17,
) -> DataFrame:
    """One row per participant: answers, correct answers, first round and round of elimination.

    The single answers stay rows of ``answers``.
    """
    out = eliminations(answers, participant, round, correct, chunk_bits)
    scores = answers.groupBy(participant).agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(correct).alias("correct_answers"),
        F.min(F.col(round).cast("bigint")).alias("started_round"),
    )
    return scores.join(out, participant)


def winner(report: DataFrame, participant: str = "participant") -> DataFrame:
    """One row: participants, eliminated ones, and the winner with the number of correct answers.

    The winner stayed in longest, then has more correct answers, then the lower name.
    """
    lasted = F.coalesce(F.col("eliminated_round"), F.lit((1 << 63) - 1))
    standing = F.struct(-lasted, -F.col("correct_answers"), F.col(participant))
    best = F.min_by(F.struct(F.col(participant).alias("winner"), F.col("correct_answers").alias("winner_score")), standing)
    return report.agg(
        F.count(F.lit(1)).alias("participants"), F.count("eliminated_round").alias("eliminated"), best.alias("best")
    ).select("participants", "eliminated", "best.winner", "best.winner_score")
