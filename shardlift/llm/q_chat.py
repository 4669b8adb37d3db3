"""Query of the chat formatting: assistant turns of the conversations framed as tool calls.

Every assistant turn makes two calls, one that measures its text and one that replies and needs the first; the
measure's result comes with the turn, the reply's with the next user turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.chat import CLOSE, OPEN, format_chats, schema_table
from shardlift.llm.registry import query, table

SCHEMAS = {
    "measure": {"properties": {"text": {"type": "string"}}, "required": ["text"], "additionalProperties": False},
    "reply": {
        "properties": {
            "length": {"type": "integer", "minimum": 40, "maximum": 400},
            "of": {"type": "string"},
            "tone": {"type": "string", "enum": ["short", "medium"]},
        },
        "required": ["length", "of", "tone"],
        "additionalProperties": False,
    },
}


def framed(rows: DataFrame) -> DataFrame:
    turn = F.col("turn").cast("string")
    length = F.length("text")
    tone = F.when(length < 100, "short").when(length < 300, "medium").otherwise("long")
    measure_id, reply_id = F.concat(F.lit("a"), turn), F.concat(F.lit("b"), turn)

    def call(name: str, call_id, arguments):
        body = F.struct(call_id.alias("id"), F.lit(name).alias("name"), arguments.alias("arguments"))
        return F.concat(F.lit(OPEN), F.to_json(body), F.lit(CLOSE))

    arguments = F.struct(tone.alias("tone"), F.concat(F.lit("$call:"), measure_id).alias("of"), length.alias("length"))
    calls = F.concat("text", call("reply", reply_id, arguments), call("measure", measure_id, F.struct("text")))

    def result(call_id, content):
        body = F.to_json(F.struct(call_id.alias("call_id"), content.alias("content")))
        return F.struct(F.lit("tool").alias("role"), body.alias("text"))

    said = F.struct("role", "text")
    answered = F.concat(F.lit("b"), (F.col("turn") - 1).cast("string"))
    messages = (
        F.when(
            F.col("role") == "assistant",
            F.array(F.struct("role", calls.alias("text")), result(measure_id, length.cast("string"))),
        )
        .when(F.col("role") == "user", F.array(said, result(answered, F.col("text"))))
        .otherwise(F.array(said))
    )
    return rows.select("conv_id", "turn", F.explode(messages).alias("m")).select("conv_id", "turn", "m.*")


_SQL = """
WITH r AS (SELECT conv_id, turn, role, text FROM conversations),
a AS (SELECT * FROM r WHERE role = 'assistant'),
u AS (SELECT * FROM r WHERE role = 'user'),
b AS (
  SELECT a.conv_id, a.turn, length(a.text) AS n, u.text AS result,
         CASE WHEN length(a.text) < 100 THEN 'short' WHEN length(a.text) < 300 THEN 'medium' ELSE 'long' END AS tone
  FROM a LEFT JOIN u ON u.conv_id = a.conv_id AND u.turn = a.turn + 1
)
SELECT conv_id, turn, 0 AS step, 'message' AS kind, CAST(NULL AS VARCHAR) AS call_id, '' AS problems,
       CAST(to_json({'content': text, 'kind': 'message', 'role': role}) AS VARCHAR) AS json
FROM r
UNION ALL
SELECT conv_id, turn, 1, 'call', 'a' || turn, '',
       CAST(to_json({'arguments': {'text': text}, 'call_id': 'a' || turn, 'kind': 'call', 'name': 'measure',
                     'result': CAST(length(text) AS VARCHAR)}) AS VARCHAR)
FROM a
UNION ALL
SELECT conv_id, turn, 2, 'call', 'b' || turn,
       array_to_string(list_filter([
         CASE WHEN result IS NULL THEN 'no result' END,
         CASE WHEN tone = 'long' THEN 'not a choice: tone' END,
         CASE WHEN n < 40 OR n > 400 THEN 'out of range: length' END], lambda x: x IS NOT NULL), '; '),
       CASE WHEN result IS NULL
         THEN CAST(to_json({'arguments': {'length': n, 'of': '$call:a' || turn, 'tone': tone}, 'call_id': 'b' || turn,
                            'kind': 'call', 'name': 'reply'}) AS VARCHAR)
         ELSE CAST(to_json({'arguments': {'length': n, 'of': '$call:a' || turn, 'tone': tone}, 'call_id': 'b' || turn,
                            'kind': 'call', 'name': 'reply', 'result': result}) AS VARCHAR) END
FROM b
UNION ALL
SELECT u.conv_id, u.turn, 0, 'orphan', 'b' || (u.turn - 1), 'result without a call',
       CAST(to_json({'call_id': 'b' || (u.turn - 1), 'kind': 'orphan', 'result': u.text}) AS VARCHAR)
FROM u LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn - 1
WHERE a.conv_id IS NULL
"""


@query(_SQL)
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    messages = framed(table(spark, folder, "conversations"))
    return format_chats(messages, schema_table(spark, SCHEMAS))
