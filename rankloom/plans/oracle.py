"""DuckDB SQL with the same rows as the registered queries, written apart from their DataFrame code."""

from __future__ import annotations

from rankloom.plans.queries import MEAN, QUOTAS, RATIO, STD

_BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_BLANK}+', ''), '{_BLANK}+$', '')"


_TURNS = "SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS last_user FROM conversations"
_PROMPT = f"""
t AS ({_TURNS}),
p AS (SELECT *, {_strip('text')} AS said FROM t WHERE turn <= last_user)"""
_JA, _EN = r"[^\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]", "[^A-Za-z]"
_REQUEST = "chr(10) || chr(10) || 'Please answer in Japanese.' || chr(10) || '日本語で回答してください。'"


def _language(x: str) -> str:
    ja, en = f"length(regexp_replace({x}, '{_JA}', '', 'g'))", f"length(regexp_replace({x}, '{_EN}', '', 'g'))"
    return f"CASE WHEN {ja} >= 2 AND {ja} >= greatest(1, floor({en} * 0.05)) THEN 'ja' WHEN {en} >= 8 AND {ja} = 0 THEN 'en' WHEN {ja} > {en} THEN 'ja' WHEN {en} > {ja} THEN 'en' ELSE 'unknown' END"


def _fraction(key: str) -> str:
    return f"(('0x' || substr(sha1({key}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


def _bucket(key: str, base: int) -> str:
    return f"(('0x' || substr(sha1({key}), 1, 8))::UBIGINT % {base})::BIGINT"


def _hash32(x: str) -> str:
    return f"('0x' || substr(sha1({x}), 1, 8))::UBIGINT"


def _candidates(score: str = "l_extendedprice", dedupe: bool = True) -> str:
    copy = "row_number() OVER (PARTITION BY g, response ORDER BY score DESC, sid)" if dedupe else "1"
    return f"""
c AS (SELECT l_orderkey AS g, {score} AS score, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sid, 'r' || l_partkey AS response, sha1('o' || l_orderkey) AS ph FROM lineitem),
d AS (SELECT *, count(*) OVER (PARTITION BY g) AS raw, {copy} AS k FROM c),
e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, sid) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d WHERE k = 1)"""


_MEET = {"best_vs_rest": "a.i = 0 AND b.i > 0", "top_bottom": "a.i = 0 AND b.i = a.n - 1 AND b.i > 0", "adjacent": "b.i = a.i + 1", "all_pairs": "b.i > a.i"}


def _pairs(strategy: str, score: str = "l_extendedprice", min_margin: float = 0.0, most: int | None = None, dedupe: bool = True) -> str:
    limit = f"WHERE r < {most}" if most else ""
    return f"""
WITH {_candidates(score, dedupe)},
m AS (SELECT a.g, a.ph, a.response AS chosen, b.response AS rejected, a.sid AS cs, b.sid AS rs, a.score - b.score AS margin, a.raw, a.n FROM e a JOIN e b ON a.g = b.g AND {_MEET[strategy]} WHERE a.n >= 2 AND a.score - b.score > 0 AND a.score - b.score >= {min_margin}),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY margin DESC, cs, rs) - 1 AS r FROM m)
SELECT g AS global_prompt_index, sha1(ph || '|' || cs || '|' || rs || '|{strategy}') AS pair_id, CASE WHEN {_fraction("'42:' || ph")} < {RATIO} THEN 'validation' ELSE 'train' END AS split,
  '{strategy}' AS pair_strategy, r AS pair_rank_within_prompt, chosen, rejected, cs AS chosen_sample_id, rs AS rejected_sample_id, round(margin, 4) AS score_margin, raw AS num_candidates_raw, n AS num_candidates_after_filter
FROM r {limit}"""


_SCORES = f"""
s AS (SELECT l_orderkey AS g, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sid, l_extendedprice AS t, floor((l_extendedprice * 0.9 + l_quantity * 50) / 100) * 100.0 AS s FROM lineitem),
z AS (SELECT *, (s - {MEAN}) / {STD} AS z, row_number() OVER (PARTITION BY g ORDER BY sid, t, s) AS i FROM s)"""


def _rank(x: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    same = f"PARTITION BY {by}, {x}" if by else f"PARTITION BY {x}"
    return f"(rank() OVER ({part} ORDER BY {x}) + (count(*) OVER ({same}) - 1) / 2.0)"


def _by_prompt(margin: float) -> str:
    """w: a row a group with top-1 agreement, pairs, credit and Spearman's correlation."""
    return f"""
WITH {_SCORES},
k AS (SELECT *, {_rank('t', 'g')} AS rt, {_rank('s', 'g')} AS rs, row_number() OVER (PARTITION BY g ORDER BY t DESC, sid) AS bt, row_number() OVER (PARTITION BY g ORDER BY s DESC, sid) AS bs FROM z),
q AS (SELECT g, count(*) AS candidates, min(sid) FILTER (bt = 1) = min(sid) FILTER (bs = 1) AS top1,
  CASE WHEN count(*) > 1 AND stddev_pop(rt) > 0 AND stddev_pop(rs) > 0 THEN covar_pop(rt, rs) / (stddev_pop(rt) * stddev_pop(rs)) ELSE 0.0 END AS spearman FROM k GROUP BY g),
x AS (SELECT a.g, count(*) AS pairs, sum(CASE WHEN (a.t - b.t) * (a.s - b.s) > 0 THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END) AS credit FROM z a JOIN z b ON a.g = b.g AND a.i < b.i WHERE abs(a.t - b.t) > {margin} GROUP BY a.g),
w AS (SELECT q.g, candidates, CASE WHEN candidates > 1 THEN top1 END AS top1, coalesce(pairs, 0) AS pairs, coalesce(credit, 0.0) AS credit, CASE WHEN pairs > 0 THEN credit / pairs END AS acc, CASE WHEN candidates > 1 THEN spearman END AS spearman FROM q LEFT JOIN x USING (g))"""


_HARD = (
    _by_prompt(0.0)
    + """,
h AS (SELECT *, CASE WHEN pairs > 0 THEN abs(round((1 - acc) + 0.25 * (1 - spearman) + CASE WHEN top1 THEN 0.0 ELSE 0.5 END, 9)) ELSE 0.0 END AS score FROM w),
n AS (SELECT *, CASE WHEN pairs > 0 THEN row_number() OVER (PARTITION BY pairs > 0 ORDER BY score DESC, g) END AS r FROM h),
o AS (SELECT *, CASE WHEN r <= 150 THEN r END AS place, CASE WHEN r <= 150 THEN CASE WHEN NOT top1 THEN 'top1_mismatch' WHEN acc < 1 THEN 'pair_errors' ELSE 'lowest_rank' END END AS reason FROM n)"""
)


def _quota() -> tuple[str, str]:
    """A chain of sources: each takes first rows of keys that the earlier ones left."""
    key = f"sha1({_strip(f"regexp_replace(text, '{_BLANK}+', ' ', 'g')")})"
    parts = [f"r AS (SELECT source, doc_id AS pos, CASE WHEN lang <> 'de' THEN {key} END AS key FROM documents)", "t0 AS (SELECT NULL::VARCHAR AS key, NULL::VARCHAR AS source, NULL::BIGINT AS pos WHERE false)"]
    stats = []
    for i, (alias, n) in enumerate(QUOTAS.items(), 1):
        parts.append(f"a{i} AS (SELECT key, '{alias}' AS source, min(pos) AS pos FROM r WHERE source = '{alias}' AND key IS NOT NULL AND key NOT IN (SELECT key FROM t{i - 1}) GROUP BY key ORDER BY pos LIMIT {n})")
        parts.append(f"t{i} AS (SELECT * FROM t{i - 1} UNION ALL SELECT * FROM a{i})")
        parts.append(f"s{i} AS (SELECT * FROM r WHERE source = '{alias}' AND {n} > 0 AND ((SELECT count(*) FROM a{i}) < {n} OR pos <= (SELECT max(pos) FROM a{i})))")
        stats.append(f"SELECT '{alias}' AS source_alias, {n}::BIGINT AS requested, (SELECT count(*) FROM a{i}) AS collected, count(*) AS scanned, count(key) - (SELECT count(*) FROM a{i}) AS skipped_dedup, count(*) - count(key) AS skipped_parse FROM s{i}")
    head = "WITH " + ",\n".join(parts)
    return f"{head}\nSELECT source AS source_alias, pos AS source_row_number, key AS dedup_key FROM t{len(QUOTAS)}", f"{head}\n" + "\nUNION ALL ".join(stats)


_POOL, _POOL_STATS = _quota()
_JSON = "'[' || string_agg('{\"content\":' || to_json(" + _strip("text") + ")::VARCHAR || ',\"role\":\"' || role || '\"}', ',' ORDER BY turn) || ']'"
_LAST_TEXT = _strip("arg_max(text, turn)")
_TEXT_KEY = f"sha1({_strip(f"regexp_replace(text, '{_BLANK}+', ' ', 'g')")})"

SQL = {
    "messages_assemble": "SELECT conv_id, count(*)::INT AS n, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS said FROM conversations GROUP BY 1",
    "prompt_trim": f"WITH {_PROMPT} SELECT conv_id, count(*)::INT AS n, arg_max(said, turn) AS last_user, string_agg(role || ': ' || said, chr(10) ORDER BY turn) AS said FROM p WHERE said <> '' GROUP BY 1",
    "prompt_pool_row": f"""WITH {_PROMPT},
x AS (SELECT conv_id, arg_max(said, turn) AS prompt_raw, arg_min(role, turn) = 'system' AS has_system, count(*) AS n, string_agg(role || ': ' || said, chr(10) ORDER BY turn) AS said FROM p WHERE said <> '' GROUP BY 1),
y AS (SELECT *, {_language('prompt_raw')} AS lang FROM x)
SELECT prompt_raw, lang AS prompt_language, 'ja' AS answer_language, 'chats' AS source_alias, 'chats' AS source_dataset, 'train' AS source_split, '' AS source_config_name, '' AS source_data_dir,
  'u' || conv_id AS source_example_id, conv_id AS source_row_number, lang = 'en' AS wrapped_for_japanese_answer, n + (NOT has_system)::INT AS num_prompt_messages, length(prompt_raw) AS prompt_char_len,
  CASE WHEN has_system THEN '' ELSE 'system: Be brief.' || chr(10) END || said || CASE WHEN lang = 'en' THEN {_REQUEST} ELSE '' END AS said FROM y""",
    "role_normalize": """WITH s AS (SELECT unnest([role, ' ' || upper(role) || chr(9), replace(replace(role, 'user', 'prompter'), 'assistant', 'bot'), role || '?']) AS spelt FROM conversations),
n AS (SELECT spelt, lower(trim(spelt, ' ' || chr(9))) AS x FROM s)
SELECT spelt, CASE WHEN x IN ('system', 'user', 'assistant') THEN x WHEN x = 'prompter' THEN 'user' WHEN x = 'bot' THEN 'assistant' END AS role, count(*) AS n FROM n GROUP BY 1, 2""",
    "language_guess": f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '12 漢 a' ELSE text || CASE doc_id % 3 WHEN 0 THEN repeat('日本語', 9) WHEN 1 THEN 'か' ELSE '' END END AS x FROM documents),
g AS (SELECT doc_id, {_language('x')} AS language FROM d)
SELECT doc_id, language, CASE WHEN doc_id % 2 = 0 THEN language ELSE 'en' END AS prompt_language FROM g""",
    "wrap_request": f"WITH t AS ({_TURNS}) SELECT conv_id, string_agg(role || ': ' || CASE WHEN turn = last_user THEN regexp_replace(text, '{_BLANK}+$', '') || {_REQUEST} ELSE text END, chr(10) ORDER BY turn) AS said FROM t GROUP BY 1",
    "full_chat_append": f"""WITH c AS (SELECT conv_id, count(*) AS k, arg_max(role, turn) AS last_role, {_LAST_TEXT} AS last_text, string_agg('<|' || role || '|>' || chr(10) || {_strip('text')} || chr(10), '' ORDER BY turn) AS said FROM conversations GROUP BY 1),
d AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN last_text ELSE 'An answer.' END AS response FROM c),
e AS (SELECT *, last_role = 'assistant' AND last_text = response AS ends FROM d)
SELECT conv_id, (k + (NOT ends)::INT)::INT AS n, said || CASE WHEN ends THEN '' ELSE '<|assistant|>' || chr(10) || response || chr(10) END AS rendered, (k + 1)::INT AS n_with_response FROM e""",
    "dedup_key_first": f"""WITH d AS (SELECT doc_id, source, sha1('[{{"role":"user","content":' || to_json({_strip(f"regexp_replace(text, '{_BLANK}+', ' ', 'g')")})::VARCHAR || '}}]') AS key FROM documents)
SELECT key, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, count(*) AS copies FROM d GROUP BY key""",
    "message_hash": f"SELECT conv_id, sha1({_JSON}) AS prompt_hash, sha1(coalesce({_strip("arg_max(text, turn) FILTER (role = 'user')")}, '')) AS response_hash FROM conversations GROUP BY 1",
    "sample_ids": "SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS row_key, 'gen__' || l_linenumber AS generator_key, sha1(sha1('o' || l_orderkey) || '|gen/' || l_linenumber || '|0|' || sha1('r' || l_partkey)) AS sample_id FROM lineitem",
    "hash_split_fraction": f"SELECT o_orderkey, round({_fraction("'42:' || sha1(o_orderkey::VARCHAR)")}, 12) AS fraction, CASE WHEN {_fraction("'42:' || sha1(o_orderkey::VARCHAR)")} < {RATIO} THEN 'validation' ELSE 'train' END AS split FROM orders",
    "hash_split_bucket": f"""WITH k AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN sha1(text) ELSE 'k' || doc_id END AS example_key FROM documents)
SELECT doc_id, example_key, {_bucket('example_key', 10000)} AS bucket, CASE WHEN {_bucket('example_key', 100)} < 28 THEN 'validation' ELSE 'train' END AS split FROM k""",
    "quota_dedup_pool": _POOL,
    "quota_dedup_stats": _POOL_STATS,
    "pairs_best_vs_rest": _pairs("best_vs_rest"),
    "pairs_top_bottom": _pairs("top_bottom"),
    "pairs_adjacent": _pairs("adjacent"),
    "pairs_all": _pairs("all_pairs"),
    "pairs_margin_topk": _pairs("all_pairs", min_margin=5000.0, most=2),
    "pairs_ties": _pairs("all_pairs", score="l_quantity", dedupe=False),
    "pair_split_counts": f"SELECT split, pair_strategy, count(*) AS n FROM ({_pairs('best_vs_rest')}) GROUP BY 1, 2",
    "margin_stats": f"SELECT split, count(*) AS pairs, round(min(score_margin), 3) AS min_margin, round(max(score_margin), 3) AS max_margin, round(avg(score_margin), 3) AS avg_margin FROM ({_pairs('all_pairs')}) GROUP BY 1",
    "group_outcomes": f"WITH m AS (SELECT DISTINCT global_prompt_index AS g FROM ({_pairs('top_bottom', min_margin=20000.0)})), o AS (SELECT DISTINCT l_orderkey AS g FROM lineitem) SELECT CASE WHEN g IN (SELECT g FROM m) THEN 'processed' ELSE 'skipped' END AS outcome, count(*) AS groups FROM o GROUP BY 1",
    "conversation_pairs": f"SELECT pair_id, 'user: order ' || global_prompt_index || chr(10) || 'assistant: ' || chosen AS chosen, 'user: order ' || global_prompt_index || chr(10) || 'assistant: ' || rejected AS rejected FROM ({_pairs('top_bottom')})",
    "first_n_groups": "WITH g AS (SELECT *, dense_rank() OVER (ORDER BY l_orderkey) AS r FROM lineitem) SELECT l_orderkey AS global_prompt_index, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sample_id FROM g WHERE r <= 100",
    "score_stats_zscore": """SELECT 'train_zscore' AS mode, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS std, count(*) AS n FROM lineitem
UNION ALL SELECT 'train_zscore', 1.0, 1.0, count(*) FROM lineitem UNION ALL SELECT 'none', 0.0, 1.0, count(l_tax) FROM lineitem""",
    "score_clip": f"SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sample_id, round(greatest(-1.5, least(1.5, (l_extendedprice - {MEAN}) / {STD})), 9) AS label, round(least(l_extendedprice, 40000.0), 9) AS clipped FROM lineitem",
    "score_denorm_roundtrip": f"SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sample_id, round((l_extendedprice - {MEAN}) / {STD}, 9) AS z, round((l_extendedprice - {MEAN}) / {STD} * {STD} + {MEAN}, 4) AS back, round((l_extendedprice - {MEAN}) / {STD}, 9) AS same FROM lineitem",
    "global_metrics": f"""WITH {_SCORES}, r AS (SELECT *, {_rank('t')} AS rt, {_rank('s')} AS rs FROM z)
SELECT count(*) AS n, round(avg(t), 4) AS teacher_score_mean, round(stddev_pop(t), 4) AS teacher_score_std, round(avg(s), 4) AS student_score_denorm_mean, round(stddev_pop(s), 4) AS student_score_denorm_std,
  round(avg(z), 4) AS student_score_norm_mean, round(stddev_pop(z), 4) AS student_score_norm_std, round(avg((s - t) * (s - t)), 2) AS mse_denorm, round(avg(abs(s - t)), 4) AS mae_denorm,
  round(corr(s, t), 4) AS pearson_denorm, round(corr(rs, rt), 4) AS spearman_denorm FROM r""",
    "training_metrics": f"""WITH {_SCORES}, l AS (SELECT *, (t - {MEAN}) / {STD} AS y FROM z)
SELECT round(avg((z - y) * (z - y)), 4) AS mse, round(avg(abs(z - y)), 4) AS mae, round(corr(z, y), 4) AS pearson, round(avg(CASE WHEN abs(z - y) < 1 THEN 0.5 * (z - y) * (z - y) ELSE abs(z - y) - 0.5 END), 4) AS smooth_l1,
  round(avg((s - t) * (s - t)), 2) AS mse_denorm, round(avg(abs(s - t)), 4) AS mae_denorm, round(corr(s, t), 4) AS pearson_denorm FROM l""",
    "group_metrics": _by_prompt(500.0)
    + """ SELECT count(*) AS num_prompt_groups, count(*) FILTER (candidates > 1) AS num_prompt_groups_multi_candidate, round(avg(candidates), 6) AS candidate_count_per_prompt_mean, round(median(candidates), 6) AS candidate_count_per_prompt_median,
  max(candidates) AS candidate_count_per_prompt_max, round(avg(top1::INT), 6) AS top1_agreement, count(top1) AS top1_agreement_num_prompts, round(sum(credit) / sum(pairs), 6) AS pairwise_accuracy_micro, sum(pairs)::BIGINT AS pairwise_accuracy_micro_num_pairs,
  round(avg(acc), 6) AS pairwise_accuracy_macro, count(acc) AS pairwise_accuracy_macro_num_prompts, round(avg(spearman), 6) AS prompt_spearman_mean, round(median(spearman), 6) AS prompt_spearman_median, count(spearman) AS prompt_spearman_num_prompts,
  500.0::DOUBLE AS pairwise_margin FROM w""",
    "group_top1": _by_prompt(0.0) + " SELECT g AS group_key, top1 AS top1_match FROM w WHERE candidates > 1",
    "group_pairwise_acc": _by_prompt(1000.0) + " SELECT g AS group_key, pairs, round(credit::DOUBLE, 6) AS credit, round(acc::DOUBLE, 6) AS pairwise_accuracy FROM w WHERE pairs > 0",
    "group_spearman": _by_prompt(0.0) + " SELECT g AS group_key, round(spearman, 6) AS prompt_spearman FROM w WHERE candidates > 1",
    "group_sizes": "WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT count(*) AS num_groups, round(avg(n), 6) AS mean, median(n) AS median, max(n) AS max FROM c",
    "rank_average": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_rank('l_quantity')} AS rank, {_rank('l_quantity', 'l_orderkey')} AS rank_in_order FROM lineitem",
    "sorted_head": "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 250",
    "seeded_sample": "SELECT o_orderkey, o_custkey FROM orders ORDER BY sha1('42|' || o_orderkey), o_orderkey LIMIT 200",
    "value_counts": "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2",
    "shard_contiguous": "WITH p AS (SELECT ntile(7) OVER (ORDER BY o_orderkey) - 1 AS shard FROM orders) SELECT shard::INT AS shard, count(*) AS n FROM p GROUP BY 1",
    "shard_floor": "WITH n AS (SELECT count(*) AS n FROM orders) SELECT r::INT AS shard, (n * r // 7)::BIGINT AS start, (n * (r + 1) // 7)::BIGINT AS end FROM n, range(7) t(r)",
    "contiguous_prefix": "SELECT * FROM (VALUES ('a', 0::BIGINT, 64::BIGINT), ('a', 64, 128), ('c', 0, 10), ('c', 10, 20), ('c', 20, 25)) t(generator, start, \"end\")",
    "completion": "SELECT * FROM (VALUES ('a', 128::BIGINT, 128::BIGINT, true), ('b', 128, 100, false), ('c', 128, 0, false)) t(generator, total, committed_end, complete)",
    "leak_check": f"WITH d AS (SELECT sha1(text) AS prompt_hash, {_bucket('doc_id::VARCHAR', 100)} < 30 AS v FROM documents) SELECT prompt_hash FROM d WHERE v INTERSECT SELECT prompt_hash FROM d WHERE NOT v",
    "unique_check": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "completeness_check": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "row_violations": """WITH c AS (SELECT conv_id, arg_max(role, turn) <> 'user' AS a, conv_id % 5 = 0 AS b, bool_or(role = 'user') AS u, length(trim(arg_max(text, turn) FILTER (role = 'user'))) <> 1 AS l FROM conversations GROUP BY 1)
SELECT conv_id, concat_ws(',', CASE WHEN a THEN 'last_not_user' END, CASE WHEN b THEN 'blank_prompt' END, CASE WHEN b AND l THEN 'wrong_length' END) AS violations FROM c WHERE a OR b""",
    "pair_row_violations": f"SELECT pair_id, 'not_better' AS violations FROM ({_pairs('adjacent')}) WHERE score_margin <= 2000",
    "fallback_coalesce": f"""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'system: Sys' || chr(10) END || 'user: ' || CASE WHEN doc_id % 5 = 0 AND {_strip('text')} <> '' THEN {_strip('text')} WHEN doc_id % 5 = 2 THEN lang
  WHEN length({_strip('text')}) BETWEEN 1 AND 10000 THEN {_strip('text')} ELSE source END AS said FROM documents""",
    "context_combine": """WITH x AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Translate ' || lang END AS i, coalesce(CASE doc_id % 3 WHEN 0 THEN lang WHEN 2 THEN source END, '') AS c FROM documents)
SELECT doc_id, CASE WHEN i <> '' AND c <> '' THEN CASE WHEN contains(i, c) THEN i ELSE i || chr(10) || chr(10) || '### 追加情報' || chr(10) || c END WHEN i <> '' THEN i ELSE c END AS combined FROM x""",
    "jsonl_roundtrip": "SELECT event_id, user_id, event_type, event_id % 10 AS score, event_type AS kept FROM events",
    "merged_scores": "SELECT o_orderkey, o_totalprice, round(o_totalprice::FLOAT::DOUBLE, 4) AS student_score_norm FROM orders",
    "committed_parts": "SELECT user_id AS part_id, max(event_id) AS seq, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
    "generation_seeds": "SELECT o_orderkey, 42 + (o_custkey % 3) * 1000003 + o_orderkey * 97 AS seed FROM orders",
    "name_keys": "SELECT regexp_replace(replace(o_orderpriority || '/v1 :' || o_orderstatus, '/', '__'), '[^A-Za-z0-9._-]+', '_', 'g') AS key, count(*) AS n FROM orders GROUP BY 1",
    "previews": "SELECT doc_id, substr(replace(text, chr(10), ' '), 1, 80) AS preview FROM documents",
    "candidate_fanout": "SELECT c AS global_prompt_index, m[1] AS generator_model, m[2] AS generator_key, m[3]::BIGINT AS generator_model_index, i::BIGINT AS candidate_index FROM (SELECT DISTINCT conv_id AS c FROM conversations), (VALUES (['org/model a', 'org__model_a', '0']), (['org/model-b', 'org__model-b', '1'])) t(m), range(3) r(i)",
    "light_predictions": f"WITH {_SCORES} SELECT sid AS sample_id, g AS global_prompt_index, round(t, 4) AS teacher_score, round(z::FLOAT::DOUBLE, 4) AS student_score_norm, round(s, 4) AS student_score_denorm FROM z",
    "hard_prompt_select": _HARD + " SELECT g AS group_key, candidates, top1 AS top1_match, pairs, round(acc, 6) AS pairwise_accuracy, round(spearman, 6) AS prompt_spearman, round(score, 6) AS hard_prompt_score, place AS hard_prompt_rank, place IS NOT NULL AS selected, reason AS selection_reason, round(off, 6) AS mean_abs_error FROM o JOIN (SELECT g, avg(abs(s - t)) AS off FROM z GROUP BY g) USING (g) WHERE candidates > 1",
    "hard_prompt_rows": _HARD
    + """ SELECT g AS global_prompt_index, sid AS sample_id, round(t, 4) AS teacher_score, round(s, 4) AS student_score_denorm, round(score, 4) AS hard_prompt_score, place AS hard_prompt_rank, reason AS hard_selection_reason,
  round(acc, 4) AS prompt_pairwise_accuracy, round(spearman, 4) AS prompt_spearman, round(abs(s - t), 4) AS score_abs_error_denorm FROM z JOIN o USING (g) WHERE place IS NOT NULL""",
    "stub_score": f"""WITH c AS (SELECT conv_id, {_JSON} AS canon, '[' || string_agg('{{"role":"' || role || '","content":' || to_json(text)::VARCHAR || '}}', ',' ORDER BY turn) || ']' AS asked, string_agg('<|' || role || '|>' || chr(10) || {_strip('text')} || chr(10), '' ORDER BY turn) AS said FROM conversations GROUP BY 1),
f AS (SELECT conv_id, sha1(canon) AS prompt, asked, said, m, i, ({_hash32("'42|' || sha1(canon) || '|' || m || '|' || i")} % 2147483648)::BIGINT AS seed FROM c, (VALUES ('a'), ('b')) t(m), range(2) r(i)),
a AS (SELECT *, m || ' answers ' || ({_hash32('asked')} % 9973) || ' in way ' || (seed % 7) AS response FROM f)
SELECT conv_id AS global_prompt_index, m AS generator_model, i::BIGINT AS candidate_index, seed AS generation_seed, response, 6::BIGINT AS response_token_len, length(response)::BIGINT AS response_char_len, sha1(prompt || '|' || m || '|' || i || '|' || sha1(response)) AS sample_id,
  round({_hash32("said || '<|assistant|>' || chr(10) || response || chr(10)")}::DOUBLE / 4294967296.0, 9) AS teacher_score FROM a""",
    "tokenized_labels": f"""WITH t AS (SELECT ['<|user|>', 'order', l_orderkey::VARCHAR, '<|assistant|>', 'r' || l_partkey] AS words, l_extendedprice AS raw FROM lineitem),
u AS (SELECT array_to_string(list_transform(words, lambda w: ({_hash32('w')} % 32000)::VARCHAR), ' ') AS input_ids, '11111' AS attention_mask, round((raw - {MEAN}) / {STD}, 9) AS labels, raw AS teacher_score_raw, 5::BIGINT AS length FROM t)
SELECT *, count(*) AS n FROM u GROUP BY ALL""",
    "scored_records": f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<|user|>' || chr(10) || 'about ' || lang || chr(10) || '<|assistant|>' || chr(10) || source || chr(10) ELSE source END AS text FROM documents),
z AS (SELECT doc_id, ({_hash32('text')}::DOUBLE / 4294967296.0)::FLOAT::DOUBLE AS z FROM r) SELECT doc_id, round(z, 4) AS student_score_norm, round(z * {STD} + {MEAN}, 4) AS student_score_denorm FROM z""",
    "example_chat_keys": f"SELECT conv_id, sha1(string_agg('<' || role || '>' || chr(10) || {_strip('text')}, chr(10) ORDER BY turn) || chr(10) || '<assistant>' || chr(10) || CASE WHEN conv_id % 2 = 0 THEN 'yes' ELSE '' END) AS example_key FROM conversations GROUP BY 1",
    "other_spellings": f"""WITH t AS ({_TURNS}),
x AS (SELECT conv_id, coalesce(string_agg(role || ': ' || {_strip("'  ' || text || chr(10) || 'end'")}, chr(10) ORDER BY turn) FILTER (role <> 'system'), 'none') AS extracted FROM t GROUP BY 1),
r AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'user' ELSE role END AS role, {_strip('text')} AS said FROM conversations WHERE {_strip('text')} <> ''),
k AS (SELECT *, max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS last FROM r)
SELECT conv_id, extracted, coalesce(said, 'none') AS trimmed FROM x LEFT JOIN (SELECT conv_id, string_agg(role || ': ' || said, chr(10) ORDER BY turn) AS said FROM k WHERE turn <= last GROUP BY 1) USING (conv_id)""",
    "empty_responses": """WITH c AS (SELECT l_orderkey AS g, l_linenumber AS m, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sid, l_extendedprice AS score, count(*) OVER (PARTITION BY l_orderkey) AS raw FROM lineitem),
k AS (SELECT sid, (row_number() OVER (PARTITION BY g ORDER BY score DESC, sid) - 1)::INT AS position, raw AS num_candidates_raw, count(*) OVER (PARTITION BY g) AS num_candidates_after_filter FROM c WHERE m % 3 <> 0)
SELECT sid AS sample_id, * EXCLUDE (sid) FROM k WHERE num_candidates_after_filter >= 3""",
    "candidate_row_violations": """WITH v AS (SELECT l_orderkey AS global_prompt_index, concat_ws(',', CASE WHEN l_linenumber = 4 THEN 'no_response' END, CASE WHEN l_linenumber = 2 THEN 'bad_score' END, CASE WHEN l_linenumber = 3 THEN 'bad_hash' END, CASE WHEN l_linenumber < 2 THEN 'negative_index' END) AS violations FROM lineitem)
SELECT *, count(*) AS n FROM v WHERE violations <> '' GROUP BY ALL""",
    "subset_recheck": f"""WITH {_SCORES}, f AS (SELECT * FROM z ORDER BY lpad(g::VARCHAR, 9, '0') || '-' || sid LIMIT 1000)
SELECT (SELECT count(*) FROM z) AS num_rows_total, count(*) AS num_rows_checked, round(avg(abs(s - t)), 4) AS mae, round(avg((s - t) ** 2), 4) AS mse, round(corr(s, t), 4) AS pearson, count(DISTINCT g) AS num_prompt_groups_checked FROM f""",
    "split_table": f"SELECT o_orderkey, o_totalprice, 'validation' AS split FROM orders WHERE {_bucket('o_orderkey::VARCHAR', 100)} < 20",
    "finalised_parts": "SELECT o_orderkey, o_custkey % 4 AS part, CASE WHEN o_orderkey % 10 = 0 THEN 'validation' ELSE 'train' END AS split, 4::BIGINT AS resume_at FROM orders WHERE o_custkey % 4 < 3",
    "stream_appended": "SELECT event_id, user_id, event_type, upper(event_type) AS kind FROM events",
    "stream_first_seen": "SELECT DISTINCT user_id, event_type FROM events",
}
