"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import spans


@dataclass(frozen=True)
class Rule:
    """A pattern whose hits count if their ``group`` has ``least`` characters; texts without any ``sign`` have no hit."""

    name: str
    version: int
    pattern: str
    group: int
    least: int
    signs: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# Patterns of the rules. Possessive repeats change no hit and bound the work on long runs.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)
RULES = (
    Rule("assign", 1, ASSIGN, 1, 6, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]++", 0, 20, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)


def blob_id(text: Column) -> Column:
    """Content address of a text; a null text is the empty blob."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _scanned(text: Column, rule: Rule) -> Column:
    likely = F.lit(not rule.signs)
    for sign in rule.signs:
        likely = likely | F.contains(text, F.lit(sign))
    due = F.array_contains("due", rule.key)
    long_enough = lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group)) >= rule.least
    return spans.matches_where(due & likely, text, rule.pattern, rule.key, long_enough)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    schema = "blob binary, scanned array<string>, findings array<struct<start:int,end:int,kind:string,hit:string>>"
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Findings of every row of ``versions`` (a path's text at one time), scanning only what the ledger lacks.

    The ledger lists which rules at which versions each blob was scanned with, and what they
    found. Blobs of ``versions`` that miss some of ``rules`` are scanned once each with just
    those, however many rows hold them, and added to the ledger. A row of the ledger stands for itself, so an append that
    breaks off loses nothing but work, and findings that two runs at once have added under the same blob and rule count once. Then the
    findings of these rules are joined back to all rows.

    Returns the rows of ``versions`` without their text, with ``blob`` and ``findings``: start,
    end (code points, end exclusive), kind and hit, by start and then rule. Texts without
    findings, null and empty ones among them, get an empty array; repeated rows each get theirs;
    an empty table gives no rows. A column of ``versions`` named blob or findings is an error.
    """
    if {"blob", "findings"} & {name.lower() for name in versions.columns}:
        raise ValueError("columns blob and findings are made here")
    spark = versions.sparkSession
    keys = [rule.key for rule in rules]
    wanted = F.array(*[F.lit(key) for key in keys])
    addressed = versions.withColumn("blob", blob_id(F.col(text_col)))
    seen = _ledger(spark, ledger_path).groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("scanned"))
    blobs = addressed.select("blob", F.coalesce(text_col, F.lit("")).alias("text")).dropDuplicates(["blob"])
    unseen = (
        blobs.join(seen, "blob", "left")
        .withColumn("due", F.array_except(wanted, F.coalesce("scanned", F.array().cast("array<string>"))))
        .filter(F.size("due") > 0)
    )
    found = F.concat(*[_scanned(F.col("text"), rule) for rule in rules])
    unseen.select("blob", F.col("due").alias("scanned"), found.alias("findings")).write.mode("append").parquet(ledger_path)

    ordered = F.array_sort(
        F.transform(
            F.filter(F.array_distinct(F.flatten(F.collect_list("findings"))), lambda x: F.array_contains(wanted, x["kind"])),
            lambda x: F.struct(
                x["start"].alias("start"),
                F.array_position(wanted, x["kind"]).alias("rule"),
                x["end"].alias("end"),
                x["hit"].alias("hit"),
            ),
        )
    )
    found = (
        _ledger(spark, ledger_path)
        .filter(F.size("findings") > 0)
        .groupBy("blob")
        .agg(ordered.alias("found"))
        .select(
            "blob",
            F.transform(
                "found",
                lambda x: F.struct(
                    x["start"].alias("start"),
                    x["end"].alias("end"),
                    F.split_part(F.element_at(wanted, x["rule"].cast("int")), F.lit("@"), F.lit(1)).alias("kind"),
                    x["hit"].alias("hit"),
                ),
            ).alias("findings"),
        )
    )
    rows = addressed.drop(text_col).join(found, "blob", "left")
    return rows.withColumn("findings", F.coalesce("findings", spans.no_spans()))
