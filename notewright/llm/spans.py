"""Positions of pattern matches in texts, as DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str | Column, kind: str) -> Column:
    """The leftmost non-overlapping matches: an array of (start, end, kind, hit), code points, end exclusive.

    The pieces between the matches and the matches themselves alternate, so the lengths of
    both, added up, are the positions. ``pattern`` must not match the empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    between = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(between.alias("gap"), hits.alias("hit"))
    return F.aggregate(
        F.filter(pairs, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["hit"])).alias("at"),
            F.concat(
                acc["found"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + F.length(x["hit"])).alias("end"),
                        F.lit(kind).alias("kind"),
                        x["hit"].alias("hit"),
                    )
                ),
            ).alias("found"),
        ),
        lambda acc: acc["found"],
    )


_SPANS = "array<struct<start:int,end:int,kind:string,hit:string>>"


def no_spans() -> Column:
    return F.array().cast(_SPANS)


def matches_where(likely: Column, text: Column, pattern: str, kind: str, holds: Callable[[Column], Column]) -> Column:
    """Matches whose hit ``holds``; texts that are not ``likely`` to have any are not searched."""
    return F.when(likely, F.filter(matches(text, pattern, kind), lambda x: holds(x["hit"]))).otherwise(no_spans())


def written(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """``kind:start:end`` comma-joined, by start and then kind as listed, or by kind and then start."""
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in kinds]), x["kind"]).cast("int")
    first = (lambda x: (rank(x), x["start"])) if by_kind else (lambda x: (x["start"], rank(x)))
    keyed = F.transform(
        spans,
        lambda x: F.struct(
            first(x)[0].alias("a"),
            first(x)[1].alias("b"),
            F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")).alias("s"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), ",")


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """The text with every span replaced by its label; of overlapping spans, the one that starts first (then the longer) gives the label.

    The kept stretches between spans are joined with the labels in order, so nothing shifts.
    """
    ordered = F.array_sort(
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind")))
    )
    cut = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], -x["back"]).alias("at"),
            F.when(
                x["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.array(F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), label(x["kind"])),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substr(text, acc["at"] + 1))), ""),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)
