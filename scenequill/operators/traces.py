"""Event logs of an agent to training conversations.

Events: trace_id, seq, event_type, tool_call_id, name, arguments, result, stdout, stderr, execution_status, content, all text but
seq. Traces: trace_id, image_ref, question, system_prompt, tool_schema, confidence, tool_calls_used, wall_clock_s."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What the kinds of events are called, and which calls' own results are left out.
TASK, CALL, OUTPUT = "Task", "ToolCallEvent", "PythonOutput"
SAID = ("Message", "LLMOutput", "TextOnlyReply", "AssistantEvent")
PREFILL = "prefill_"
NO_RESULT = ("execute_python", "return_result")

COLUMNS = ["part", "role", "content", "image", "call_id", "tool_name", "arguments"]


def short_ids(events: DataFrame) -> DataFrame:
    """trace_id, tool_call_id, call_id: call_1, call_2, ... in the order in which a trace first names them."""
    first = events.where(F.col("tool_call_id") != "").groupBy("trace_id", "tool_call_id").agg(F.min("seq").alias("seq"))
    nth = F.row_number().over(Window.partitionBy("trace_id").orderBy("seq", "tool_call_id"))
    return first.select("trace_id", "tool_call_id", F.concat(F.lit("call_"), nth.cast("string")).alias("call_id"))


def trace_turns(traces: DataFrame, events: DataFrame) -> DataFrame:
    """trace_id, seq, part and the COLUMNS of each message. A system turn if there is a prompt or a schema; the image and the
    question at the first task; a call and, unless its output comes as an event of its own, its result; output of code, the
    error text if it failed; texts that are not empty. Prefilled calls and unknown events are left out."""
    e = events.withColumn("tool_call_id", F.coalesce("tool_call_id", F.lit("")))
    e = e.where(~F.startswith("tool_call_id", F.lit(PREFILL)) & F.col("event_type").isin(TASK, CALL, OUTPUT, *SAID))
    calls = e.where(F.col("event_type").isin(CALL, OUTPUT))
    task = e.where(F.col("event_type") == TASK).groupBy("trace_id").agg(F.min("seq").alias("task_seq"))
    e = e.join(short_ids(calls), ["trace_id", "tool_call_id"], "left").join(task, "trace_id", "left")
    e = e.where((F.col("event_type") != TASK) | (F.col("seq") == F.col("task_seq")))
    e = e.join(traces.select("trace_id", "image_ref", "question"), "trace_id")
    none = F.lit(None).cast("string")
    call_id = F.coalesce("call_id", F.concat(F.lit("call_at_"), F.col("seq").cast("string")))

    def row(part, role, content=none, image=none, call=none, name=none, arguments=none):
        return F.struct(*[(F.lit(v) if isinstance(v, (int, str)) else v).alias(c) for c, v in zip(COLUMNS, (part, role, content, image, call, name, arguments), strict=True)])

    name = F.coalesce("name", F.lit("unknown"))
    asked = row(0, "assistant", call=call_id, name=name, arguments=F.coalesce("arguments", F.lit("{}")))
    got = row(1, "tool", F.col("result"), call=call_id)
    failed = F.endswith(F.lower(F.coalesce("execution_status", F.lit(""))), F.lit("error")) & (F.coalesce("stderr", F.lit("")) != "")
    printed = row(0, "tool", F.when(failed, F.col("stderr")).otherwise(F.coalesce("stdout", F.lit(""))), call=call_id)
    kind = F.col("event_type")
    rows = (
        F.when(kind == TASK, F.array(row(0, "user", F.col("question"), F.col("image_ref"))))
        .when((kind == CALL) & F.col("result").isNotNull() & ~name.isin(*NO_RESULT), F.array(asked, got))
        .when(kind == CALL, F.array(asked))
        .when(kind == OUTPUT, F.array(printed))
        .when(F.coalesce("content", F.lit("")) != "", F.array(row(0, "assistant", F.col("content"))))
    )
    out = e.select("trace_id", "seq", F.explode(rows).alias("m")).select("trace_id", "seq", "m.*")
    prompt, schema = (F.coalesce(c, F.lit("")) for c in ("system_prompt", "tool_schema"))
    text = F.concat(prompt, F.when(schema != "", F.concat(F.lit("\n\n# Tools\n"), schema)).otherwise(""))
    system = traces.where((prompt != "") | (schema != "")).select("trace_id", F.lit(-1).cast("long").alias("seq"), row(0, "system", text).alias("m")).select("trace_id", "seq", "m.*")
    return system.unionByName(out)


def conversations(traces: DataFrame, events: DataFrame) -> DataFrame:
    """trace_id, messages (in order), meta: a row for each trace."""
    m = trace_turns(traces, events).groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("seq", *COLUMNS))).alias("m"))
    meta = F.struct("image_ref", "question", "confidence", "tool_calls_used", "wall_clock_s").alias("meta")
    drop = F.transform("m", lambda x: F.struct(*[x[c].alias(c) for c in COLUMNS[1:]]))
    return traces.select("trace_id", meta).join(m, "trace_id", "left").select("trace_id", F.coalesce(drop, F.array()).alias("messages"), "meta")


def since(events: DataFrame, seq: int) -> DataFrame:
    """What came from a place on."""
    return events.where(F.col("seq") >= seq)


def last_user(messages: DataFrame) -> DataFrame:
    """conv_id, text, image of the last user turn; a turn's text fragments (seq, at, kind, text) are joined by newlines."""
    turn = messages.where(F.col("role") == "user").groupBy("conv_id", "seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "text", F.struct("at", "text")))), lambda x: x["text"]), "\n").alias("text"),
        F.min_by("text", F.when(F.col("kind") == "image", F.col("at"))).alias("image"),
    )
    return turn.groupBy("conv_id").agg(F.max_by(F.struct("text", "image"), "seq").alias("t")).select("conv_id", "t.*")
