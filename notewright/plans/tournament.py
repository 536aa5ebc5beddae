"""Export of a finished tournament."""

from __future__ import annotations

from pyspark.sql import DataFrame

from notewright.operators.quiz import tournament_report, winner
from notewright.sinks.records import write_flat


def export_tournament(
    answers: DataFrame, out: str, participant: str = "participant", round: str = "round", correct: str = "correct"
) -> None:
    """Write three flat tables below ``out``: all answers with their correct flag, the report, the outcome."""
    report = tournament_report(answers, participant, round, correct)
    write_flat(answers, f"{out}/answers")
    write_flat(report, f"{out}/report")
    write_flat(winner(report, participant), f"{out}/outcome")
