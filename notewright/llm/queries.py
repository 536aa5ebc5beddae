"""Queries of the training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import (
    chat,
    decontaminate,
    importance,
    lm,
    minhash,
    negatives,
    ngram_join,
    packing,
    pages,
    piecebpe,
    pii,
    quality,
    secrets,
    spans,
)
from notewright.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, vocabulary_path())
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


@_query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_trees(chat.reply_chains(turns, "conv_id", "turn", "role", "text"))
    back = formatted.select(
        F.col("tree").alias("conv_id"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL["op8_chat"] = """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(12 + length(replace(replace(role, '<|', '<||'), chr(10), '<|br|>')) + 1
        + length(replace(text, '<|', '<||')) + 11) as bigint) as formatted_chars
from turns group by conv_id
"""


def _count(kind: str, of: str = "findings") -> Column:
    return F.size(F.filter(of, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


@_query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, scratch_path(spark, "secret-ledger"))
    kinds = [rule.name for rule in secrets.RULES]
    text = spans.written(F.col("findings"), kinds, by_kind=False)
    counts = [_count(kind) for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = spans.written(F.filter("pii_spans", lambda x: x["kind"] != pii.TERM), pii.KINDS, by_kind=True)
    everything = spans.written(F.col("pii_spans"), [*pii.KINDS, pii.TERM], by_kind=True)
    counts = [_count(kind, "pii_spans") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), everything.alias("spans"))


@_query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = minhash.parts_for(docs, least=int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = minhash.compare_edits(docs, parts)
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs.select("doc_id", "text"), benchmark)


SQL["op6_decontamination"] = r"""
with w as (
    select 'd' as side, doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents
    union all
    select 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')
    from benchmark
), sizes as (
    select distinct least(5, len(w)) as k from w where side = 'i' and len(w) > 0
), s as (
    select distinct side, id, k, array_to_string(w[i:i + k - 1], ' ') as shingle
    from (select side, id, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from w, sizes
        where len(w) >= k and (side = 'd' or k = least(5, len(w))))
), n as (select id, count(*) as n_item from s where side = 'i' group by id)
select d.id as doc_id, i.id as item_id, count(*) / any_value(n_item) as containment
from s d join s i on d.shingle = i.shingle and d.k = i.k and d.side = 'd' and i.side = 'i' join n on n.id = i.id
group by d.id, i.id having count(*) * 10 >= any_value(n_item) * 8
"""


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def scored_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, fit_on: DataFrame) -> DataFrame | None:
    """``docs`` with score and predicted; the model sees only labels whose rows are not held out. None without any label to learn from."""
    labels = _table(spark, sf_dir, "labels").filter(_remainder(4) != 2)
    model = quality.fit(fit_on, labels)
    return None if model is None else _predicted(quality.score(docs, model))


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    scored = scored_quality(spark, docs, sf_dir, fit_on=docs)
    if scored is None:
        scored = _predicted(quality.score(docs, None))
    return scored.select("doc_id", held_out, "score", "predicted")


@_query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.extract(found, pages.fit(found))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op1_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(7) == 2, F.lit(False))
    model = lm.fit(docs.filter(~held_out).select("text"))
    return lm.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(model.totals.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@_query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as e
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
        cast(list_inner_product(a.e, b.e) as bigint) as score
    from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), p as (
    select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
), n as (
    select anchor_id, positive_id,
        cast(row_number() over (partition by anchor_id, positive_id order by score desc, other) as integer) as rank,
        other as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select * from n where rank <= 3
"""


@_query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.resample(docs, benchmark, share_percent=10, least=1, most=1, min_words=20, seed=2024)


SQL["op12_importance"] = r"""
with recursive crc(b, c, step) as (
    select i, i, 0 from range(256) t(i)
    union all
    select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from crc where step < 8
), byte_table as (select list(c order by b) as t from crc where step = 8
), words as (
    select 'd' as side, doc_id as id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from documents
    union all
    select 'b', null, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark
), hashed as (
    select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(hex(encode(word))) // 2),
            lambda i: ('0x' || substr(hex(encode(word)), 2 * i::int + 1, 2))::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from (select distinct word from words), byte_table
), counts as (
    select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from words join hashed using (word) group by bucket
), gains as (
    select bucket, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)
        / ((s + 1)::double * (sum(t) over () + 10000)))) as bigint) as gain
    from counts
), weights as (
    select id, count(*) as n, sum(gain)::bigint as weight from words join hashed using (word) join gains using (bucket)
    where side = 'd' group by id
), scored as (
    select doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5)
            / 4294967296))) as bigint) as score
    from documents left join weights on id = doc_id
), ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join ranked using (doc_id)
"""


@_query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piecebpe.encode(_table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
