"""Registered queries: every operator over the driver's tables, which stand in for chats, prompts and scored candidates.

Orders are prompts and their lines the candidates, scored by price; conversations are chats; documents are prompts by source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import stats as S
from rankloom.functions import text as X
from rankloom.operators import candidates as C
from rankloom.operators import checks, labels, metrics, ordering, pairs, pool, work
from rankloom.operators.hard_prompts import hard_prompts, hard_training_rows
from rankloom.sources import state, tables
from rankloom.sources.catalog import Source
from rankloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUOTAS = {"src0": 20, "src1": 12, "src2": 5000, "src3": 0, "src4": 15, "src5": 9}
MEAN, STD = 30_000.0, 12_000.0
RATIO, SEED = 0.1, 42


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, messages) with the turns in order."""
    turns = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return turns.select("conv_id", F.transform("turns", lambda t: M.message(t["role"], t["text"])).alias("messages"))


def _said(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with other names for roles and contents."""
    chats = _chats(spark, sf_dir)
    other = lambda r: F.when(r == "user", "Human").when(r == "assistant", " gpt ").otherwise("sys")
    lists = F.transform("messages", lambda m: F.struct(other(m["role"]).alias("from"), F.concat(F.lit("  "), m["content"], F.lit("\n")).alias("value")))
    return chats.select(lists.alias("conversations"), F.lit(0).alias("id"), F.concat(F.lit("u"), "conv_id").alias("uuid"), F.lit("Be brief.").alias("system_prompt"), F.col("conv_id").alias("position"))


def _candidates(spark: SparkSession, sf_dir: str, score: str = "l_extendedprice") -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    response = F.concat(F.lit("r"), F.col("l_partkey"))
    return lines.select(
        F.array(M.message("user", F.concat(F.lit("order "), F.col("l_orderkey")))).alias("messages"), response.alias("response"), ids.response_hash(response).alias("response_hash"), F.col(score).alias("teacher_score"),
        F.lit("teacher").alias("teacher_model"), F.concat(F.lit("gen/"), F.col("l_linenumber")).alias("generator_model"), X.file_key(F.concat(F.lit("gen/"), F.col("l_linenumber"))).alias("generator_key"),
        F.col("l_linenumber").cast("long").alias("generator_model_index"), F.lit(0).cast("long").alias("candidate_index"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sample_id"),
        ids.sha1(F.concat(F.lit("o"), F.col("l_orderkey"))).alias("prompt_hash"), F.concat(F.lit("order "), F.col("l_orderkey")).alias("prompt_raw"), F.col("l_orderkey").alias("global_prompt_index"),
    )


def _pairs(strategy: str, score: str = "l_extendedprice", min_margin: float = 0.0, max_pairs: int | None = None, dedupe: bool = True) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        options = pairs.PairOptions(strategy, min_margin, max_pairs, dedupe=dedupe, val_ratio=RATIO, seed=SEED)
        columns = (
            "global_prompt_index", "pair_id", "split", "pair_strategy", "pair_rank_within_prompt", "chosen", "rejected", "chosen_sample_id", "rejected_sample_id",
            "score_margin", "num_candidates_raw", "num_candidates_after_filter",
        )
        return pairs.build_pairs(_candidates(spark, sf_dir, score), options, columns, at_rest=True).withColumn("score_margin", F.round("score_margin", 4))

    return query


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with a student's scores: a fixed function of price and quantity, in hundreds so that some tie."""
    lines = _read(spark, sf_dir, "lineitem")
    student = F.floor((F.col("l_extendedprice") * 0.9 + F.col("l_quantity") * 50) / 100) * 100.0
    return lines.select(
        F.col("l_orderkey").alias("global_prompt_index"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sample_id"), F.col("l_extendedprice").alias("teacher_score"),
        student.alias("student_score_denorm"), ((student - MEAN) / STD).alias("student_score_norm"),
    )


_EVALUATED = ("global_prompt_index", "teacher_score", "student_score_denorm", "sample_id")


def _rounded(df: DataFrame, digits: int = 6, coarse: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded: sums depend on their order."""
    return df.select(*(F.round(c, 2 if c in coarse else digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


def messages_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chats(spark, sf_dir).select("conv_id", F.size("messages").alias("n"), _said(F.col("messages")).alias("said"))


def prompt_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = _chats(spark, sf_dir).select("conv_id", M.trim_to_prompt(F.col("messages")).alias("m")).where("m IS NOT NULL")
    return trimmed.select("conv_id", F.size("m").alias("n"), M.last_user(F.col("m")).alias("last_user"), _said(F.col("m")).alias("said"))


def prompt_pool_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pool.prompt_rows(_records(spark, sf_dir), Source("chats", "chats", language="auto", ask_for_japanese=True), "position")
    return rows.withColumn("said", _said(F.col("messages"))).drop("messages")


def role_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelt = F.explode(F.array(F.col("role"), F.concat(F.lit(" "), F.upper("role"), F.lit("\t")), F.replace(F.replace(F.col("role"), F.lit("user"), F.lit("prompter")), F.lit("assistant"), F.lit("bot")), F.concat(F.col("role"), F.lit("?"))))
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role"))
    spelt_roles = turns.select(spelt.alias("spelt"))
    return spelt_roles.groupBy("spelt", X.role(F.col("spelt")).alias("role")).agg(F.count(F.lit(1)).alias("n"))


def language_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit("日本語" * 9)).when(F.col("doc_id") % 3 == 1, F.lit("か")).otherwise(F.lit("")))
    short = F.when(F.col("doc_id") % 7 == 0, F.lit("12 漢 a")).otherwise(tagged)
    return _read(spark, sf_dir, "documents").select("doc_id", X.language(short).alias("language"), X.prompt_language(short, F.when(F.col("doc_id") % 2 == 0, "auto").otherwise("en")).alias("prompt_language"))


def wrap_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _chats(spark, sf_dir).select("conv_id", M.ask_for_answer(F.col("messages")).alias("m"))
    return asked.select("conv_id", _said(F.col("m")).alias("said"))


def full_chat_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _chats(spark, sf_dir)
    response = F.when(F.col("conv_id") % 2 == 0, F.try_element_at("messages", F.lit(-1))["content"]).otherwise(F.lit(" An answer. "))
    full = M.full_chat(F.col("messages"), response)
    return chats.select("conv_id", F.size(full).alias("n"), M.render(full).alias("rendered"), F.size(M.with_response(F.col("messages"), response)).alias("n_with_response"))


def dedup_key_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each text, white space aside."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", ids.dedup_key(F.array(M.message("user", F.col("text")))).alias("key"))
    return docs.groupBy(ids.sha1(F.col("key")).alias("key")).agg(F.min_by("doc_id", "doc_id").alias("doc_id"), F.min_by("source", "doc_id").alias("source"), F.count(F.lit(1)).alias("copies"))


def message_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chats(spark, sf_dir).select("conv_id", ids.prompt_hash(F.col("messages")).alias("prompt_hash"), ids.response_hash(M.last_user(F.col("messages"))).alias("response_hash"))


def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _candidates(spark, sf_dir)
    made = ids.sample_id(F.col("prompt_hash"), F.col("generator_model"), F.col("candidate_index"), F.col("response_hash"))
    return c.select(F.col("sample_id").alias("row_key"), "generator_key", made.alias("sample_id"))


def hash_split_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ids.sha1(F.col("o_orderkey").cast("string"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", F.round(ids.fraction(F.concat(F.lit("42:"), key)), 12).alias("fraction"), ids.split_by_fraction(key, RATIO, SEED).alias("split"))


def hash_split_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("k"), F.col("doc_id"))).alias("prompt_hash"))
    key = ids.example_key(docs)
    return docs.select("doc_id", key.alias("example_key"), ids.bucket(key, 10_000).alias("bucket"), ids.split_by_bucket(key, 0.29, 100).alias("split"))


def _pool_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("lang") != "de", ids.sha1(X.collapse(F.col("text"))))
    return _read(spark, sf_dir, "documents").select(F.col("source").alias("source_alias"), F.col("doc_id").alias("source_row_number"), key.alias("dedup_key"))


def quota_dedup_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool.quota_dedup(_pool_input(spark, sf_dir), QUOTAS)[0]


def quota_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool.quota_dedup(_pool_input(spark, sf_dir), QUOTAS)[1]


pairs_best_vs_rest = _pairs("best_vs_rest")
pairs_top_bottom = _pairs("top_bottom")
pairs_adjacent = _pairs("adjacent")
pairs_all = _pairs("all_pairs")
pairs_margin_topk = _pairs("all_pairs", min_margin=5000.0, max_pairs=2)
pairs_ties = _pairs("all_pairs", score="l_quantity", dedupe=False)


def pair_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.value_counts(_pairs("best_vs_rest")(spark, sf_dir), "split", "pair_strategy")


def margin_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(pairs.margins(_pairs("all_pairs")(spark, sf_dir)), 3)


def group_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir)
    return pairs.group_outcomes(rows, pairs.build_pairs(rows, pairs.PairOptions("top_bottom", 20_000.0)))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pairs.build_pairs(_candidates(spark, sf_dir), pairs.PairOptions("top_bottom", conversations=True))
    return made.select("pair_id", _said(F.col("chosen_messages")).alias("chosen"), _said(F.col("rejected_messages")).alias("rejected"))


def first_n_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.first_groups(_candidates(spark, sf_dir), "global_prompt_index", 100).select("global_prompt_index", "sample_id")


def score_stats_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").withColumn("one", F.lit(1.0))
    return _rounded(labels.score_stats_row(lines, "l_extendedprice").unionByName(labels.score_stats_row(lines, "one")).unionByName(labels.score_stats_row(lines, "l_tax", "none")), 4)


def score_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("teacher_score")
    stats = labels.ScoreStats("train_zscore", MEAN, STD, 1.5)
    raw = labels.ScoreStats("none", 0.0, 1.0, 40_000.0)
    return _rounded(_candidates(spark, sf_dir).select("sample_id", labels.label(price, stats).alias("label"), labels.label(price, raw).alias("clipped")), 9)


def score_denorm_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = S.normalised(F.col("teacher_score"), MEAN, STD)
    return _rounded(_candidates(spark, sf_dir).select("sample_id", z.alias("z"), S.denormalised(z, MEAN, STD).alias("back"), S.denormalised(z, MEAN, STD, "none").alias("same")), 9).withColumn("back", F.round("back", 4))


def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.global_metrics(_scores(spark, sf_dir)), 4, ("mse_denorm",))


def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir).withColumn("label", (F.col("teacher_score") - MEAN) / STD)
    return _rounded(metrics.training_metrics(rows, "student_score_norm", "label", MEAN, STD), 4, ("mse_denorm",))


def group_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.group_metrics(_scores(spark, sf_dir), *_EVALUATED, margin=500.0))


def _by_prompt(spark: SparkSession, sf_dir: str, margin: float = 0.0) -> DataFrame:
    return metrics.prompt_metrics(_scores(spark, sf_dir), *_EVALUATED, margin=margin)


def group_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_prompt(spark, sf_dir).where("candidates > 1").select("group_key", "top1_match")


def group_pairwise_acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_by_prompt(spark, sf_dir, 1000.0).where("pairs > 0").select("group_key", "pairs", "credit", "pairwise_accuracy"))


def group_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_by_prompt(spark, sf_dir).where("candidates > 1").select("group_key", "prompt_spearman"))


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _scores(spark, sf_dir).groupBy("global_prompt_index").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("num_groups"), F.round(F.avg("n"), 6).alias("mean"), F.median("n").alias("median"), F.max("n").alias("max"))


def rank_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = metrics.rank_average(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_quantity", "rank")
    return metrics.rank_average(ranked, "l_quantity", "rank_in_order", "l_orderkey")


def sorted_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.head(_read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), 250, "o_orderkey")


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.seeded_sample(_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 200, SEED, "o_orderkey")


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.value_counts(_read(spark, sf_dir, "documents"), "source", "lang")


def shard_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select((F.col("o_orderkey") - 1).alias("position"))
    return ordering.value_counts(ordering.with_contiguous_shard(_dense(rows), "position", 7), "shard")


def shard_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dense(_read(spark, sf_dir, "orders").select((F.col("o_orderkey") - 1).alias("position")))
    return ordering.with_floor_shard(rows, "position", 7).groupBy("shard").agg(F.min("position").alias("start"), (F.max("position") + 1).alias("end"))


def _dense(rows: DataFrame) -> DataFrame:
    """Positions from 0 without gaps: tie-averaged ranks of distinct keys are their places."""
    return metrics.average_ranks(rows, "position", "r").select((F.col("r") - 1).cast("long").alias("position"))


def contiguous_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.createDataFrame([("a", 0, 64), ("a", 64, 128), ("a", 192, 256), ("b", 64, 128), ("c", 0, 10), ("c", 10, 20), ("c", 20, 25)], "generator string, start long, end long")
    return state.contiguous_prefix(parts, by=["generator"])


def completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.createDataFrame([("a", 0, 64), ("a", 64, 128), ("b", 0, 100)], "generator string, start long, end long")
    totals = spark.createDataFrame([("a", 128), ("b", 128), ("c", 128)], "generator string, total long")
    return state.completion(parts, totals, ["generator"])


def leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a split by document puts in both parts."""
    docs = _read(spark, sf_dir, "documents").select(ids.sha1(F.col("text")).alias("prompt_hash"), ids.split_by_bucket(F.col("doc_id").cast("string"), 0.3, 100).alias("split"))
    return checks.leaked(docs)


def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.repeated(_read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.without(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "doc_id")


def row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("messages")
    rows = _chats(spark, sf_dir).select("conv_id", "messages", F.when(F.col("conv_id") % 5 == 0, F.lit(" ")).otherwise(M.last_user(m)).alias("prompt_raw"), F.size(m).cast("long").alias("num_prompt_messages"), F.length(M.last_user(m)).cast("long").alias("prompt_char_len"))
    return checks.prompt_violations(rows).select("conv_id", F.array_join("violations", ",").alias("violations"))


def pair_row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a score and its neighbour, whichever is better."""
    made = pairs.build_pairs(_candidates(spark, sf_dir), pairs.PairOptions("adjacent")).withColumn("rejected_score", F.col("rejected_score") + 2000)
    return checks.pair_violations(made).select("pair_id", F.array_join("violations", ",").alias("violations"))


def fallback_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    fields = docs.select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.col("text")).alias("question"), F.when(F.col("doc_id") % 5 == 1, F.lit(" ")).otherwise(F.lit(None)).alias("instruction"), F.when(F.col("doc_id") % 5 == 2, F.col("lang")).alias("prompt"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(F.lit("Sys")).alias("system"), F.col("text").alias("content"), F.col("source").alias("task"),
    )
    return fields.select("doc_id", _said(M.extract(fields)).alias("said"))


def context_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("Translate "), "lang"))
    c = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise(F.col("source"))
    return _read(spark, sf_dir, "documents").select("doc_id", X.with_context(i, c).alias("combined"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, parsed, and written with a field more."""
    events = _read(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
    parsed = tables.parse_jsonl(events.unionByName(spark.createDataFrame([("  ",)], "value string")), "event_id long, user_id long, event_type string")
    more = tables.with_fields(F.col("_line"), score=F.col("event_id") % 10)
    return parsed.select("event_id", "user_id", "event_type", F.get_json_object(more, "$.score").cast("long").alias("score"), F.get_json_object(more, "$.event_type").alias("kept"))


def merged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tables.merge_scores(orders, "o_orderkey", tables.partial_scores(orders, "o_orderkey", "o_totalprice")).withColumn("student_score_norm", F.round("student_score_norm", 4))


def committed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entry for each part: the latest event of each user."""
    log = _read(spark, sf_dir, "events").select(F.col("user_id").alias("part_id"), F.col("event_id").alias("seq"), "event_type")
    return tables.committed(log)


def generation_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", S.batch_seed(SEED, F.col("o_custkey") % 3, F.col("o_orderkey")).alias("seed"))


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws("/", "o_orderpriority", F.concat(F.lit("v1 :"), "o_orderstatus"))
    return ordering.value_counts(_read(spark, sf_dir, "orders").select(X.file_key(name).alias("key")), "key")


def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))


def candidate_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = _chats(spark, sf_dir).select("messages", F.col("conv_id").alias("global_prompt_index"))
    g = C.Generation(models=("org/model a", "org/model-b"), candidates=3)
    return C.fan_out(prompts, g).select("global_prompt_index", "generator_model", "generator_key", "generator_model_index", "candidate_index")


def stub_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = _chats(spark, sf_dir).select("messages", F.col("conv_id").alias("global_prompt_index"))
    made = C.build_candidates(prompts, C.Generation(models=("a", "b"), candidates=2))
    return made.select("global_prompt_index", "generator_model", "candidate_index", "generation_seed", "response", "response_token_len", "response_char_len", "sample_id", F.round("teacher_score", 9).alias("teacher_score"))


def tokenized_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = labels.tokenized(_candidates(spark, sf_dir), labels.ScoreStats("train_zscore", MEAN, STD))
    rows = made.select(F.array_join("input_ids", " ").alias("input_ids"), F.array_join("attention_mask", "").alias("attention_mask"), F.round("labels", 9).alias("labels"), "teacher_score_raw", "length")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def scored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a text, or a prompt and a response, scored by the stub."""
    docs = _read(spark, sf_dir, "documents")
    records = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).otherwise(F.col("source")).alias("text"), F.concat(F.lit(" about "), "lang").alias("prompt"), F.col("source").alias("response"))
    return _rounded(C.score_records(records, ("train_zscore", MEAN, STD)).select("doc_id", "student_score_norm", "student_score_denorm"), 4)


def example_chat_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of examples that have a chat and a response alone."""
    chats = _chats(spark, sf_dir).select("conv_id", "messages", F.when(F.col("conv_id") % 2 == 0, F.lit(" yes ")).alias("response"))
    return chats.select("conv_id", ids.example_key(chats).alias("example_key"))


def other_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt rows of chats with roles of unknown spelling, contents in lists and a chat under a later name."""
    chats = _chats(spark, sf_dir)
    other = lambda r: F.when(r == "user", "PROMPTER ").when(r == "assistant", "bot").otherwise("tool")
    lists = F.transform("messages", lambda m: F.struct(other(m["role"]).alias("speaker"), F.array(F.concat(F.lit("  "), m["content"]), F.lit(None).cast("string"), F.lit("end\t")).alias("content")))
    raw = chats.select("conv_id", lists.alias("dialogue"))
    trimmed = M.trim_to_prompt(F.transform("messages", lambda m: M.message(F.concat(m["role"], F.when(m["role"] == "system", "?").otherwise("")), m["content"])))
    said = lambda m: F.coalesce(_said(m), F.lit("none"))
    kept = chats.select("conv_id", said(trimmed).alias("trimmed"))
    return raw.select("conv_id", said(M.extract(raw)).alias("extracted")).join(kept, "conv_id")


def empty_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates left after blank responses, copies and small groups are dropped."""
    rows = _candidates(spark, sf_dir).withColumn("response", F.when(F.col("generator_model_index") % 3 == 0, F.lit(" \t")).otherwise(F.col("response")))
    left = pairs.ranked(rows, dedupe=None, min_candidates=3)
    return left.select("sample_id", "position", "num_candidates_raw", "num_candidates_after_filter")


def candidate_row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir).withColumn("sample_id", ids.sha1(F.col("sample_id")))
    spoilt = rows.withColumn("teacher_score", F.when(F.col("generator_model_index") == 2, F.lit(float("nan"))).otherwise(F.col("teacher_score"))).withColumn("response_hash", F.when(F.col("generator_model_index") == 3, "short").otherwise(F.col("response_hash")))
    spoilt = spoilt.withColumn("candidate_index", F.col("generator_model_index") - 2).withColumn("response", F.when(F.col("generator_model_index") != 4, F.col("response")))
    return ordering.value_counts(checks.candidate_violations(spoilt).select(F.array_join("violations", ",").alias("violations"), "global_prompt_index"), "global_prompt_index", "violations")


def subset_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir).withColumn("position", F.concat_ws("-", F.lpad(F.col("global_prompt_index").cast("string"), 9, "0"), "sample_id"))
    return _rounded(metrics.recheck(rows, 1000, "position", group="global_prompt_index"), 4)


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by split and one split read back."""
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", ids.split_by_bucket(F.col("o_orderkey").cast("string"), 0.2, 100).alias("split"))
    path = work.new_path(spark, "orders")
    tables.write_table(rows, path, "split", rows_per_file=5000)
    return tables.read_split(spark, path, "validation", ["o_orderkey"]).withColumn("split", F.col("split").cast("string"))


def finalised_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written one by one with a commit log, one of them replaced and one gone, compacted by split."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", F.pmod("o_custkey", F.lit(4)).alias("part"), F.when(F.col("o_orderkey") % 10 == 0, "validation").otherwise("train").alias("split"))
    root, log = work.new_path(spark, "parts"), work.new_path(spark, "log")
    schema = "part_id long, seq long, path string, end long"
    for seq, part in enumerate((0, 1, 2, 1)):
        path = f"{root}/{seq}"
        orders.where((F.col("part") == part) & ((F.col("o_orderkey") % 2 == 0) | F.lit(seq != 1))).write.parquet(path)
        state.append_log(spark.createDataFrame([(part, seq, path, part + 1)], schema), log)
    state.append_log(spark.createDataFrame([(3, 9, f"{root}/gone", 4)], schema), log)
    entries = state.read_log(spark, log, schema)
    done = state.finalise(spark, entries, work.new_path(spark, "final"))
    return done.select("o_orderkey", "part", F.col("split").cast("string").alias("split"), F.lit(state.resume_at(entries)).cast("long").alias("resume_at"))


def stream_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of files, appended with a column more, in two runs of one checkpoint."""
    source, out, at = (work.new_path(spark, x) for x in ("stream", "appended", "progress"))
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, events.schema)
        ingest.append(stream, out, at, lambda b: b.withColumn("kind", F.upper("event_type"))).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users and kinds of a stream of events, each once over two runs."""
    source, out, at = (work.new_path(spark, x) for x in ("stream", "first", "progress"))
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).select("user_id", "event_type").write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, spark.read.parquet(source).schema)
        ingest.append(ingest.first_seen(stream, "user_id", "event_type"), out, at).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_type")


def light_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.predictions(_scores(spark, sf_dir), "global_prompt_index"), 4)


def hard_prompt_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hard_prompts(_scores(spark, sf_dir), *_EVALUATED, n=150)).where("candidates > 1")


def hard_prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir)
    hard = hard_prompts(rows, *_EVALUATED, n=150)
    return _rounded(hard_training_rows(rows, hard, "global_prompt_index", "teacher_score", "student_score_denorm").drop("student_score_norm"), 4)


def queries() -> dict[str, Query]:
    """The public functions of this module, in the order of definition."""
    return {name: f for name, f in globals().items() if not name.startswith("_") and name != "queries" and getattr(f, "__module__", "") == __name__}
