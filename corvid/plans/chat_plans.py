"""Chat data: collection, rendering, context prompts, stop rules, masks (step 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import chat as C
from corvid.functions.text import join_ints, tokenize_words
from corvid.operators import chat as ops
from corvid.operators.vocab import build_vocab
from corvid.plans import register
from corvid.plans.common import VOCAB_K, tok
from corvid.sources.tables import load_table

CHAT_MAX_LEN = 512
MICRO_BATCH = 2
ACCUMULATE = 8  # effective batch = 2 x 8 = 16
TOPK = 3
NL = "chr(10)"
BOS_LEN = len(C.BOS)
GEN_LEN = len(C.HEADER_START) + len("assistant") + len(C.HEADER_END) + 1


def fp_sql(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


SEG_SQL = f"'{C.HEADER_START}' || role || '{C.HEADER_END}' || {NL} || text || '{C.EOT}'"
STRIP_SQL = r"regexp_replace(text, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def conversations(spark, sf_dir):
    return load_table(spark, sf_dir, "conversations")


# ---- terminal input: the conversations and what is typed between their turns ----
# The table has no blank or "quit" turns, which the interactive rules are about.
# All its turns stay as they are, with room between their numbers; inputs of
# these kinds are added behind some user turns, picked by their ids.

ROOM = 5
NBSP = "\u00a0"


def terminal_inputs(turns):
    cid, t = F.col("conv_id"), F.col("turn")
    quit_text = (F.when(F.pmod(cid, F.lit(3)) == 0, F.lit("quit"))
                 .when(F.pmod(cid, F.lit(3)) == 1, F.lit("  QUIT "))
                 .otherwise(F.lit(f" Quit{NBSP}")))
    added = F.array(
        F.when(F.pmod(cid * 31 + t * 7, F.lit(9)) == 0, F.struct(F.lit(1).alias("at"), F.lit(f" {NBSP} ").alias("text"))),
        F.when(F.pmod(cid * 13 + t * 3, F.lit(17)) == 0, F.struct(F.lit(2).alias("at"), F.lit("quit now").alias("text"))),
        F.when(F.pmod(cid * 17 + t * 5, F.lit(11)) == 0, F.struct(F.lit(3).alias("at"), quit_text.alias("text"))))
    real = F.struct(F.lit(0).alias("at"), F.col("text"))
    inputs = F.when(F.col("role") == "user", F.concat(F.array(real), F.array_compact(added))).otherwise(F.array(real))
    return (turns.select("conv_id", "turn", "role", F.explode(inputs).alias("input"))
            .select("conv_id", (t * ROOM + F.col("input.at")).alias("turn"), "role", F.col("input.text").alias("text")))


INPUTS_CTE = f"""inp AS (
  SELECT conv_id, turn * {ROOM} AS turn, role, text FROM conversations
  UNION ALL SELECT conv_id, turn * {ROOM} + 1, role, ' ' || chr(160) || ' ' FROM conversations
  WHERE role = 'user' AND (conv_id * 31 + turn * 7) % 9 = 0
  UNION ALL SELECT conv_id, turn * {ROOM} + 2, role, 'quit now' FROM conversations
  WHERE role = 'user' AND (conv_id * 13 + turn * 3) % 17 = 0
  UNION ALL SELECT conv_id, turn * {ROOM} + 3, role,
                   CASE conv_id % 3 WHEN 0 THEN 'quit' WHEN 1 THEN '  QUIT ' ELSE ' Quit' || chr(160) END
  FROM conversations WHERE role = 'user' AND (conv_id * 17 + turn * 5) % 11 = 0)"""

DROP_BLANK_CTE = INPUTS_CTE + f""",
nb AS (
  SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN {STRIP_SQL.format()} ELSE text END AS text
  FROM inp
  WHERE NOT (role = 'user' AND {STRIP_SQL.format()} = ''))"""


@register("chat_collect", f"""SELECT conv_id, count(*) AS n_turns, min(turn) AS first_turn, max(turn) AS last_turn,
  CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS n_user,
  CAST(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS BIGINT) AS n_assistant,
  CAST(sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) AS BIGINT) AS n_system,
  CAST(sum(length(text)) AS BIGINT) AS total_chars,
  CAST(sum({fp_sql("CAST(turn AS VARCHAR) || '|' || role || '|' || text")}) AS BIGINT) AS conv_fp
FROM conversations GROUP BY conv_id""")
def q_chat_collect(spark, sf_dir):
    return ops.conversation_summary(conversations(spark, sf_dir))


MAX_TURNS = 64


@register("chat_messages", f"""SELECT conv_id, CAST(turn // {MAX_TURNS} AS BIGINT) AS part, count(*) AS n_messages,
  md5(string_agg(turn || '|' || role || '|' || text, {NL} ORDER BY turn)) AS messages_md5
FROM conversations GROUP BY ALL""")
def q_chat_messages(spark, sf_dir):
    rows = ops.collect_conversation(conversations(spark, sf_dir), MAX_TURNS)
    line = F.transform("messages", lambda m: F.concat_ws("|", m["turn"].cast("string"), m["role"], m["text"]))
    return rows.select("conv_id", "part", F.size("messages").cast("bigint").alias("n_messages"),
                       F.md5(F.array_join(line, "\n")).alias("messages_md5"))


@register("chat_render", f"""WITH s AS (
  SELECT conv_id, turn, role, {SEG_SQL} AS segment FROM conversations
  UNION ALL SELECT conv_id, max(turn) + 1, 'assistant', '{C.HEADER_START}assistant{C.HEADER_END}' || {NL}
  FROM conversations GROUP BY conv_id)
SELECT conv_id, turn, role, segment, CAST(length(segment) AS BIGINT) AS seg_len,
       CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + {BOS_LEN} AS BIGINT) AS seg_start
FROM s""")
def q_chat_render(spark, sf_dir):
    return ops.render_segments(conversations(spark, sf_dir), ask=True).select(
        "conv_id", "turn", "role", "segment", "seg_len", "seg_start")


@register("chat_context", f"""WITH s AS (
  SELECT conv_id, turn, role, {SEG_SQL} AS segment FROM conversations),
f AS (SELECT conv_id, turn, role, length(segment) AS seg_len,
             {fp_sql("CAST(turn AS VARCHAR) || '|' || segment")} AS seg_fp FROM s),
r AS (SELECT conv_id, turn, role, sum(seg_len) OVER w AS c, sum(seg_fp) OVER w AS fpx FROM f
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, turn, CAST(c + {BOS_LEN + GEN_LEN} AS BIGINT) AS prompt_chars,
       CAST(fpx AS BIGINT) AS prompt_fp
FROM r WHERE role = 'user'""")
def q_chat_context(spark, sf_dir):
    return ops.context_prompts(conversations(spark, sf_dir))


@register("chat_drop_blank", f"""WITH {DROP_BLANK_CTE}
SELECT conv_id, turn, role, text FROM nb""")
def q_chat_drop_blank(spark, sf_dir):
    return ops.drop_blank(terminal_inputs(conversations(spark, sf_dir))).select(
        "conv_id", "turn", "role", "text")


@register("chat_stop", f"""WITH {DROP_BLANK_CTE},
q AS (SELECT conv_id, min(turn) AS qt FROM nb WHERE role = 'user' AND lower(text) = 'quit'
      GROUP BY conv_id)
SELECT nb.conv_id, nb.turn, nb.role, nb.text FROM nb LEFT JOIN q ON nb.conv_id = q.conv_id
WHERE q.qt IS NULL OR nb.turn < q.qt""")
def q_chat_stop(spark, sf_dir):
    return ops.chat_rules(terminal_inputs(conversations(spark, sf_dir))).select(
        "conv_id", "turn", "role", "text")


CHAT_ROWS_CTE = f"""st AS (SELECT conv_id, turn, role,
              list_concat(list_concat(['{C.HEADER_START}', role, '{C.HEADER_END}'], {tok('text')}), ['{C.EOT}']) AS toks
       FROM conversations),
sp AS (SELECT *, 1 + coalesce(sum(len(toks)) OVER (PARTITION BY conv_id ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tok_start FROM st),
ex AS (SELECT conv_id, turn, role, tok_start, unnest(toks) AS token, unnest(range(len(toks))) AS i FROM sp),
cr AS (SELECT conv_id, CAST(tok_start + i AS BIGINT) AS pos, turn, token,
              CASE WHEN role = 'assistant' AND i >= {ops.HEADER_TOKENS} THEN 1 ELSE 0 END AS mask FROM ex
       UNION ALL SELECT DISTINCT conv_id, 0, NULL, '{C.BOS}', 0 FROM conversations),
cv AS (SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 3 AS INTEGER) AS token_id
       FROM (SELECT token, count(*) AS cnt FROM cr GROUP BY token ORDER BY cnt DESC, token ASC LIMIT {VOCAB_K})),
ci AS (SELECT cr.*, coalesce(token_id, 1) AS token_id FROM cr LEFT JOIN cv USING (token))"""


def chat_tokens(spark, sf_dir):
    """Token rows of all conversations and the vocabulary over them."""
    turns = conversations(spark, sf_dir)
    return ops.token_rows(turns), build_vocab(spark, ops.all_tokens(turns), VOCAB_K)


@register("assistant_mask", f"""WITH {CHAT_ROWS_CTE}
SELECT conv_id, pos, turn, token_id, CAST(mask AS INTEGER) AS mask FROM ci""")
def q_assistant_mask(spark, sf_dir):
    rows, vocab = chat_tokens(spark, sf_dir)
    return ops.encode_ids(rows, vocab).select("conv_id", "pos", "turn", "token_id", "mask")


@register("pad_batch", f"""WITH {CHAT_ROWS_CTE},
s AS (SELECT conv_id, count(*) AS seq_len, list(token_id ORDER BY pos) AS ids,
             list(CASE WHEN mask = 1 THEN token_id ELSE -100 END ORDER BY pos) AS labels
      FROM ci WHERE pos < {CHAT_MAX_LEN} GROUP BY conv_id),
b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // {MICRO_BATCH} AS micro_batch FROM s),
w AS (SELECT *, max(seq_len) OVER (PARTITION BY micro_batch) AS padded_len,
             (SELECT token_id FROM cv WHERE token = '{C.EOS_TOKEN}') AS pad FROM b)
SELECT conv_id, CAST(micro_batch AS BIGINT) AS micro_batch, seq_len, padded_len, padded_len - seq_len AS n_pad,
       CAST(micro_batch // {ACCUMULATE} AS BIGINT) AS step_id,
       array_to_string(list_resize(ids, padded_len, pad), ' ') AS input_ids,
       array_to_string(list_resize(list_transform(ids, lambda x: 1), padded_len, 0), ' ') AS attention_mask,
       array_to_string(list_resize(labels, padded_len, -100), ' ') AS labels
FROM w""")
def q_pad_batch(spark, sf_dir):
    rows, vocab = chat_tokens(spark, sf_dir)
    out = ops.pad_batches(rows, vocab, CHAT_MAX_LEN, MICRO_BATCH, ACCUMULATE)
    return out.select("conv_id", "micro_batch", "seq_len", "padded_len", "n_pad", "step_id",
                      *[join_ints(F.col(c)).alias(c) for c in ("input_ids", "attention_mask", "labels")])


@register("decode_reply", f"""SELECT conv_id, turn, array_to_string({tok('text')}, ' ') AS reply
FROM conversations WHERE role = 'assistant'""")
def q_decode_reply(spark, sf_dir):
    a = conversations(spark, sf_dir).filter(F.col("role") == "assistant")
    # The generated sequence starts with the open assistant header (the prompt tail).
    seq = C.segment_tokens(F.col("role"), F.col("text"))
    return a.select("conv_id", "turn", C.decode_reply(seq, F.lit(3)).alias("reply"))


PAIRS_CTE = f"""d AS (SELECT doc_id, {tok('text')} AS t FROM documents),
pairs AS (SELECT unnest(t[1:len(t) - 1]) AS token, unnest(t[2:len(t)]) AS next_token
          FROM d WHERE len(t) >= 2)"""


def doc_pairs(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    return ops.next_token_pairs(docs.select("doc_id", tokenize_words(F.col("text")).alias("t")),
                                "doc_id", "t")


@register("next_token_pairs", f"""WITH {PAIRS_CTE}
SELECT token, next_token, count(*) AS cnt FROM pairs GROUP BY token, next_token""")
def q_next_token_pairs(spark, sf_dir):
    return doc_pairs(spark, sf_dir).groupBy("token", "next_token").agg(
        F.count(F.lit(1)).alias("cnt"))


@register("next_token_topk", f"""WITH {PAIRS_CTE},
p AS (SELECT token, next_token, count(*) AS cnt FROM pairs GROUP BY token, next_token),
s AS (SELECT token, next_token, cnt, cnt / sum(cnt) OVER (PARTITION BY token) AS share,
             row_number() OVER (PARTITION BY token ORDER BY cnt DESC, next_token ASC) AS rk FROM p)
SELECT token, next_token, cnt, round(share, 6) AS share, CAST(rk AS INTEGER) AS rank
FROM s WHERE rk <= {TOPK}""")
def q_next_token_topk(spark, sf_dir):
    return ops.next_token_topk(doc_pairs(spark, sf_dir), TOPK)


@register("causal_context", f"""WITH d AS (SELECT doc_id, {tok('text')} AS t FROM documents),
u AS (SELECT doc_id, unnest(t) AS token, unnest(generate_series(0, len(t) - 1)) AS pos
      FROM d WHERE len(t) > 0)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, CAST(pos AS BIGINT) AS n_context,
       lag(token) OVER (PARTITION BY doc_id ORDER BY pos) AS prev_token,
       CAST(coalesce(sum({fp_sql("CAST(pos AS VARCHAR) || '|' || token")}) OVER (
            PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS context_fp
FROM u""")
def q_causal_context(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    toks = docs.select("doc_id", tokenize_words(F.col("text")).alias("t"))
    return ops.causal_context(toks, "doc_id", tokens_col="t")
