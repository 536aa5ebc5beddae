"""Personal data: direct identifiers by pattern, and terms that give an identified entity away by co-occurrence."""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm import spans
from notewright.operators.sizing import join_measured
from notewright.session import materialised

KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
LINE_PRIOR, DOCUMENT_PRIOR = 0.5, 2.0  # lines or documents without the entity that a term is taken to have besides those counted

# The patterns. Look-behinds and possessive repeats change no match; they keep the
# work linear on long runs of matching characters and the stack flat.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
NAME_INSIDE = r"(?<=[\p{L},;]\x20[\"'(]?)\p{Lu}\p{Ll}{2,}(?!\p{L})"
NAME_LINE = r"^\P{L}*(?:\p{Lu}\p{Ll}+\P{L}+){0,3}\p{Lu}\p{Ll}+\P{L}*$"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Whether the digits pass: every second from the right doubled, digits of the results added up."""
    digits = F.filter(F.split(F.reverse(_digits(hit)), ""), lambda d: d != "")
    value = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)),
    )
    return F.aggregate(value, F.lit(0).cast("long"), lambda a, v: a + v) % 10 == 0


def base_spans(text: Column) -> Column:
    """E-mail addresses, IP and card numbers and phone numbers of a text, leftmost and non-overlapping per kind."""
    between = lambda n, low, high: (n >= low) & (n <= high)
    return F.concat(
        spans.matches_where(F.contains(text, F.lit("@")), text, EMAIL, "email", lambda hit: F.lit(True)),
        spans.matches_where(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), text, IP, "ip", lambda hit: F.rlike(hit, F.lit(IP_PARTS))),
        spans.matches_where(
            F.rlike(text, F.lit(r"(?:[0-9][\x20-]?){13}")),
            text,
            CARD,
            "card",
            lambda hit: between(F.length(_digits(hit)), 13, 19) & _luhn(hit),
        ),
        spans.matches_where(
            F.contains(text, F.lit("+")), text, PHONE, "phone", lambda hit: between(F.length(_digits(hit)), 9, 15)
        ),
    )


def _words(text: Column) -> Column:
    """Distinct lower-case words; those of less than three letters are no terms, and left out where terms are chosen."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))


def _likely(text: Column) -> Column:
    return F.rlike(text, F.lit(r"@|\+[0-9]|[0-9][.\x20-]?[0-9]"))


def _entities(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["hit"])))


def _beside(text: Column) -> Column:
    """A text outside its e-mail addresses, the only direct identifiers with letters."""
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)


def _names(line: Column) -> Column:
    """Lower-case words of a line that are written like names: capitalised inside a sentence, or in a line of few, all capitalised words."""
    inside = F.regexp_extract_all(line, F.lit(NAME_INSIDE), F.lit(0))
    alone = F.when(F.rlike(line, F.lit(NAME_LINE)), F.filter(F.split(line, r"[^\p{L}]+"), lambda w: w != ""))
    return F.transform(F.concat(inside, F.coalesce(alone, F.array().cast("array<string>"))), F.lower)


def _of_entity(term: Column, entity: Column) -> Column:
    """Whether the name part of an e-mail address holds the term."""
    part = F.lower(F.regexp_extract(entity, r"^email:([^@]*)@", 1))
    return (F.length(term) > 3) & F.contains(part, term)


def _disclosing(pairs: DataFrame, of_term: DataFrame, of_entity: DataFrame, total: int, prior: float, least: tuple[float, float]) -> DataFrame:
    """(term, entity, share, bits) of the pairs that reach the share, shrunk for little distinct evidence, and the bits,
    and are either written like names or meet more often than chance lets any of all these pairs meet.

    By chance a term of d / share different contents meets an entity of ``distinct_entity`` ones
    ``met`` times. Every term beside an entity has met it once, so the first meeting proves nothing;
    each further one has that probability, and there are as many trials as pairs.
    """
    share = F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0))
    sure = share * F.col("distinct") / (F.col("distinct") + prior)
    bits = F.log2(share * total / F.col("n_entity"))
    met = F.least(F.col("distinct") / share * F.col("distinct_entity") / total, F.lit(1.0))
    beyond_chance = -(F.col("distinct") - 1) * F.log2(met) >= log2(max(2, pairs.count()))
    return (
        pairs.join(of_term, "term")
        .join(of_entity, "entity")
        .filter((sure >= least[0]) & (bits >= least[1]) & (F.col("named") | beyond_chance))
        .select("term", "entity", share.alias("share"), bits.alias("bits"))
    )


def _counted(rows: DataFrame) -> DataFrame:
    """(entity, term, n_both, distinct, named) of rows (entity, term, mark, n, named): how often they meet, on how many different
    contents, and whether the term is written like a name there. Unnamed pairs that meet on one content only are left out."""
    once = rows.filter(F.length("term") > 2).groupBy("entity", "term", "mark").agg(F.sum("n").alias("n"), F.max("named").alias("named"))
    met = once.groupBy("entity", "term").agg(
        F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("distinct"), F.max("named").alias("named")
    )
    return met.withColumn("named", F.col("named") | _of_entity(F.col("term"), F.col("entity"))).filter("named or distinct > 1")


def _term_counts(texts: DataFrame, terms: DataFrame, documents: bool) -> DataFrame:
    """(term, lines, documents): in how many lines and documents each of the terms stands, by one reading of all texts."""
    piece = lambda of_line: lambda part: F.struct(part.alias("part"), F.lit(of_line).alias("of_line"))
    pieces = F.transform(F.split("text", "\n"), piece(True))
    if documents:
        pieces = F.concat(pieces, F.array(piece(False)(F.col("text"))))
    words = texts.select(F.explode_outer(pieces).alias("piece")).select("piece.of_line", F.explode_outer(_words(F.col("piece.part"))).alias("term"))
    return join_measured(words, terms, "term", "left_semi").groupBy("term").agg(
        F.count_if("of_line").alias("lines"), F.count_if(~F.col("of_line")).alias("documents")
    )


def revealing_terms(docs: DataFrame, text_col: str = "text", min_share: float = 0.5, min_bits: float = 6.0) -> DataFrame:
    """Terms that disclose a protected entity: (term, entity, share, bits), from counts over all of ``docs``.

    Terms are counted by lines, where a term meets an entity named on its own line or the line
    above or below, and by documents. ``share`` is the part of the lines (documents) with the
    term that meet the entity, ``bits`` how much more likely the entity is there than anywhere
    (pointwise mutual information). Both have to reach their thresholds, the share after it is shrunk by
    d / (d + prior), d the number of different lines on which they meet (by documents: of different lines
    that name the entity), so copies are no further evidence. A rare word stands beside some entity or other by chance, so that alone
    is no disclosure: a term has to meet the entity on several different contents, more often than chance
    explains for any of the pairs counted, or be written like a name (``_names``), or be part of the
    entity's own address. One line is enough for such a name found nowhere else, be the entity seen
    once. In languages that capitalise all nouns, a rare noun beside an entity passes for a name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Outer forms: for the plain ones the optimizer adds a filter on the array, below which it is computed once more.
    lines = docs.select(F.xxhash64(text).alias("mark"), F.split(text, "\n").alias("all"))
    lines = lines.select("mark", "all", F.posexplode("all").alias("at", "line"))
    around = F.slice("all", F.greatest(F.col("at"), F.lit(1)), F.when(F.col("at") == 0, 2).otherwise(3))
    # No identifier reaches over a line end, so those of the documents are those of their lines.
    protected = materialised(
        lines.filter(_likely(F.col("line")))
        .select("mark", "at", "line", around.alias("around"))
        .groupBy("mark", "at", "line", "around")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("mark", F.xxhash64("line").alias("own"), "around", "n", base_spans(F.col("line")).alias("found"))
        .filter(F.size("found") > 0)
        .select("mark", "own", "around", "n", F.explode(_entities(F.col("found"))).alias("entity"))
    )
    none = docs.sparkSession.createDataFrame([], "term string, entity string, share double, bits double")
    if protected.isEmpty():
        return none
    near = protected.select("entity", "n", F.explode("around").alias("line"))
    near = near.select("entity", "n", F.xxhash64("line").alias("mark"), _beside(F.col("line")).alias("rest"))
    near = near.select("entity", "n", "mark", _names(F.col("rest")).alias("names"), F.explode(_words(F.col("rest"))).alias("term"))
    by_line = materialised(_counted(near.withColumn("named", F.array_contains("names", F.col("term"))).drop("names")))
    of_line_entity = protected.groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count_distinct("own").alias("distinct_entity")
    )

    # Documents that name an entity on the same line may be edited copies, and count as one content. Entities
    # of one content cannot reach the share by documents, so words are counted only for the others.
    named = materialised(protected.groupBy("entity", "mark").agg(F.max("n").alias("n"), F.min("own").alias("own")))
    of_entity = named.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count_distinct("own").alias("distinct_entity"))
    of_entity = of_entity.filter(F.col("distinct_entity") / (F.col("distinct_entity") + DOCUMENT_PRIOR) >= min_share)
    of_entity = materialised(of_entity)
    named = materialised(join_measured(named, of_entity.select("entity"), "entity", "left_semi"))
    marked = docs.select(F.xxhash64(text).alias("mark"), text.alias("text"))
    texts = join_measured(marked, named.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
    words = texts.select("mark", F.explode_outer(_words(_beside(F.col("text")))).alias("term")).filter("term is not null")
    met = named.join(words.hint("merge"), "mark").select("entity", "term", F.col("own").alias("mark"), "n", F.lit(False).alias("named"))
    by_document = materialised(_counted(met))

    terms = by_line.select("term").unionByName(by_document.select("term")).distinct()
    counts = materialised(_term_counts(marked.select("text"), terms, not by_document.isEmpty()))
    n_lines = F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    total_lines, total_documents = docs.agg(n_lines, F.count(F.lit(1))).first()
    least = (min_share, min_bits)
    of_lines = counts.select("term", F.col("lines").alias("n_term"))
    of_documents = counts.select("term", F.col("documents").alias("n_term"))
    found = _disclosing(by_line, of_lines, of_line_entity, total_lines, LINE_PRIOR, least).unionByName(
        _disclosing(by_document, of_documents, of_entity, total_documents, DOCUMENT_PRIOR, least)
    )
    return found.groupBy("term", "entity").agg(F.max("share").alias("share"), F.max("bits").alias("bits"))


def with_spans(docs: DataFrame, text_col: str = "text", **thresholds: float) -> DataFrame:
    """``docs`` with ``pii_spans``: start, end (code points, end exclusive), kind and hit of all personal data.

    Direct identifiers come from ``base_spans``; occurrences of revealing terms outside them,
    as whole words in either case, are added as kind ``term``. Null and empty texts have an
    empty array; repeated rows each get theirs; an empty table gives no rows. A column named
    pii_spans, pii_terms or pii_blob is an error.
    """
    if {"pii_spans", "pii_terms", "pii_blob"} & {name.lower() for name in docs.columns}:
        raise ValueError("columns pii_spans, pii_terms and pii_blob are made here")
    text = F.coalesce(F.col(text_col), F.lit(""))
    terms = materialised(revealing_terms(docs, text_col, **thresholds).select("term").distinct())
    base = base_spans(text)
    if terms.isEmpty():
        return docs.withColumn("pii_spans", base)
    blob = F.unhex(F.sha2(text, 256))
    words = docs.select(blob.alias("pii_blob"), F.explode_outer(_words(text)).alias("term"))
    hits = (
        join_measured(words, terms, "term", "left_semi")
        .groupBy("pii_blob")
        .agg(F.array_join(F.array_sort(F.collect_set("term")), "|").alias("pii_terms"))
    )
    marked = join_measured(docs.withColumn("pii_blob", blob), materialised(hits), "pii_blob", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.col("pii_terms"), F.lit(r")(?!\p{L})"))
    marked = marked.withColumn("pii_spans", base)
    apart = lambda x: ~F.exists("pii_spans", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))
    added = F.when(F.col("pii_terms").isNull(), spans.no_spans()).otherwise(
        F.filter(spans.matches(text, pattern, TERM), apart)
    )
    return marked.withColumn("pii_spans", F.concat("pii_spans", added)).select(*docs.columns, "pii_spans")


def sanitise(docs: DataFrame, text_col: str = "text", **thresholds: float) -> DataFrame:
    """``docs`` with every personal span of its text generalised to its kind, such as ``[EMAIL]``; same columns and rows.

    Null texts stay null.
    """
    found = with_spans(docs, text_col, **thresholds)
    clean = spans.replaced(
        F.col(text_col), F.col("pii_spans"), lambda kind: F.concat(F.lit("["), F.upper(kind), F.lit("]"))
    )
    return found.withColumn(text_col, clean).select(*docs.columns)
