"""Multiple-choice items and tournaments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.catalogue import field_catalogue
from notewright.operators.quiz import (
    choice_items,
    cross_dataset_items,
    eligible_datasets,
    eliminations,
    tournament_report,
    winner,
)
from notewright.plans.registry import query, table
from notewright.plans.search_queries import document_records, part_records
from notewright.operators.records import records_from_table

_HASH = "CAST('0x' || left(md5({}), 15) AS BIGINT)"
_BRAND_HASH = _HASH.format("'0|' || brand")


@query(
    f"""WITH ring AS (SELECT brand, row_number() OVER (ORDER BY {_BRAND_HASH}, brand) - 1 AS place, count(*) OVER () AS size
                      FROM (SELECT DISTINCT p_brand AS brand FROM part)),
             wrong AS (SELECT r.brand AS answer, o.brand AS option FROM ring r, range(1, 4) s(step)
                       JOIN ring o ON o.place = (r.place + s.step) % r.size WHERE s.step < r.size),
             choice AS (SELECT p_partkey AS ord, p_name AS prompt, p_brand AS answer, p_brand AS option FROM part
                        UNION ALL SELECT p_partkey, p_name, p_brand, option FROM part JOIN wrong ON answer = p_brand)
        SELECT ord, prompt, answer, string_agg(option, ',' ORDER BY md5('0|' || ord || '|' || option)) AS options
        FROM choice GROUP BY ord, prompt, answer"""
)
def quiz_items(spark, sf_dir):
    items = choice_items(part_records(spark, sf_dir), "Name", "Brand", options=4)
    return items.select("ord", "prompt", "answer", F.array_join("options", ",").alias("options"))


@query("SELECT DISTINCT 'part' AS dataset, 4 AS n_fields FROM part")
def quiz_datasets(spark, sf_dir):
    catalogue = field_catalogue(part_records(spark, sf_dir)).unionByName(field_catalogue(document_records(spark, sf_dir)))
    return eligible_datasets(catalogue).select("dataset", F.size("text_fields").alias("n_fields"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, customers and suppliers as records with a ``Name``."""

    def records(name: str, key: str, label: str) -> DataFrame:
        rows = table(spark, sf_dir, name).withColumn("name", F.col(label))
        ident = F.concat(F.lit(f"{name}-"), F.col(key).cast("string"))
        return records_from_table(rows, ["name"], key, ident, F.lit(name), name, clean=False)

    return (
        records("part", "p_partkey", "p_name")
        .unionByName(records("customer", "c_custkey", "c_name"))
        .unionByName(records("supplier", "s_suppkey", "s_name"))
    )


@query(
    f"""WITH named AS (SELECT 'part' AS dataset, p_partkey AS ord, p_name AS prompt FROM part
                       UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
                       UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier),
             placed AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {_HASH.format("'0|' || ord")}, ord) - 1 AS place,
                               count(*) OVER (PARTITION BY dataset) AS size FROM named)
        SELECT i.ord AS item, i.prompt, o.dataset, o.dataset || '-' || o.ord AS id, o.dataset = 'part' AS correct,
               row_number() OVER (PARTITION BY i.ord ORDER BY md5('0|' || i.ord || '|' || o.dataset)) AS place
        FROM placed i JOIN placed o ON o.place = i.place % o.size WHERE i.dataset = 'part'"""
)
def cross_dataset_quiz(spark, sf_dir):
    items = cross_dataset_items(_named(spark, sf_dir), "part", "Name", ["part", "customer", "supplier"])
    return items.withColumn("place", F.col("place").cast("bigint"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as answers: the user takes part, the event is the round, an error is a wrong answer."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("participant"),
        F.col("event_id").alias("round"),
        (F.col("event_type") != "error").alias("correct"),
    )


_OUT_SQL = """SELECT user_id AS participant, min(event_id) FILTER (WHERE wrong AND before) AS eliminated_round FROM
    (SELECT user_id, event_id, event_type = 'error' AS wrong,
            lag(event_type = 'error') OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) GROUP BY user_id"""
_REPORT_SQL = f"""SELECT user_id AS participant, count(*) AS answers, count(*) FILTER (WHERE event_type <> 'error') AS correct_answers,
    min(event_id) AS started_round, any_value(o.eliminated_round) AS eliminated_round
    FROM events JOIN ({_OUT_SQL}) o ON o.participant = user_id GROUP BY user_id"""


@query(_OUT_SQL)
def elimination(spark, sf_dir):
    return eliminations(_answers(spark, sf_dir), chunk_bits=12)


@query(_REPORT_SQL)
def tournament(spark, sf_dir):
    return tournament_report(_answers(spark, sf_dir), chunk_bits=12)


@query(
    f"""SELECT count(*) AS participants, count(eliminated_round) AS eliminated,
               arg_min(participant, (-coalesce(eliminated_round, 9223372036854775807), -correct_answers, participant)) AS winner,
               arg_min(correct_answers, (-coalesce(eliminated_round, 9223372036854775807), -correct_answers, participant)) AS winner_score
        FROM ({_REPORT_SQL})"""
)
def tournament_winner(spark, sf_dir):
    return winner(tournament_report(_answers(spark, sf_dir), chunk_bits=12))
